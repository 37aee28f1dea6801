"""Repair of conversation structure: faults, cheapest edits, least audit string.

Rows of a conversation, in order of turn (nulls first; equal turns by role and text),
get one fault each: blank, else duplicate (role and text seen earlier), else
truncated.  Edits turn the rows into one that reads ``(s?(ua)+)?`` in the initials
of its roles: Keep 0, Rerole 1 (to user or assistant), Delete 2 (blank and duplicate
rows must go), Insert an empty user or assistant turn 5; a truncated row that stays
adds 5.  Of all cheapest edits the audit string of initials that is least in ASCII
wins.

Method.  A node is (row, state of the pattern: start, s, u, a).  A DP from the end
gives every node its cost to the end; arcs that keep this cost are optimal.  Nodes
are then ranked by the audit of their next 1, 2, 4, ... edits: the rank of 2L edits
orders pairs (rank of L edits, rank of L edits at the node L edits on), and the
pointer of 2L edits is the pointer of L edits taken twice.  Each node's arc is the
least by (initial, rank of what follows), and the doubled pointers lay out the path
of every conversation in logarithmically many steps.  Numpy does this for many
conversations at once.

A conversation may be of any length.  Rows are sorted and numbered by range, so a
long one lies in several tasks, and are cut into blocks of at most BLOCK rows (a
code byte each).  A block's least costs between its 4 entry and 4 exit states are
16 numbers; composed from the end they give each block its cost to the end, and the
exits by entry, followed from the start, its entry.  Only these numbers of a
conversation of several blocks meet in one task.  The hash of a repaired
conversation is taken as its lines stream by in order.

A null role or text is one space, as is a null turn or conv_id in the damage hash; a
null conv_id is a conversation of its own.  Repeated rows are duplicates.  Empty and
very long texts and empty tables are handled like any other; a conversation that
lost all rows has zeros, an empty audit and the hash of nothing.  Other columns are
not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WHITE, freed, table, written

BLOCK = 4096  # rows of a conversation that one array holds
NODES = 1 << 20  # nodes that are ranked together
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
FAR = 1 << 40
END, BLANK, DUPLICATE, CUT = 0, 1, 2, 3  # faults; END: none
START, S, U, A = range(4)
INITIAL = {"s": 0, "u": 1, "a": 2}  # any other: 3
AUDIT = b"\0DIKR"  # labels 1 to 4, in ASCII order
NEXT = np.array([U, U, A, U])  # the state after the turn that a state waits for
KEEP = np.array([[S, U, -1, -1], [-1, U, -1, -1], [-1, -1, A, -1], [-1, U, -1, -1]])  # by state and initial
AT_END = (0, 2 * INSERT, INSERT, 0)


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the damage that each row's hash picks."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"),
                                (F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20).alias("h"))
    copies = F.when(F.col("h") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.where("h <> 0").select(
        "conv_id", "turn", F.when(F.col("h") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(copies).alias("copy"))


def numbered(rows: DataFrame) -> DataFrame:
    """The rows with ``pos``, ascending in order of conversation and turn.  Rows are
    dealt by range of all sort keys and of the row's number, so neither a long
    conversation nor many copies of one row fill a task."""
    rows = rows.withColumn("salt", F.monotonically_increasing_id())
    keys = ["conv_id", "turn", "role", "text", "salt"]
    in_order = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return written(in_order.select("conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("pos")), "turns")


def coded(turns: DataFrame) -> DataFrame:
    """conv_id, pos, code (initial + 4 x fault)."""
    first = turns.groupBy("conv_id", "role", "text").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("first"))
    ends = F.rtrim("text", F.lit(WHITE))
    initial, start = F.lit(3), F.substring("role", 1, 1)
    for letter, n in INITIAL.items():
        initial = F.when(start == letter, n).otherwise(initial)
    fault = (F.when(F.col("ends") == "", BLANK).when(F.col("first").isNull(), DUPLICATE)
             .when(~F.col("ends").isin(".", "!", "?"), CUT).otherwise(END))
    light = turns.select("conv_id", "pos", initial.alias("initial"), F.right(ends, F.lit(1)).alias("ends"))
    return light.join(first, "pos", "left").select("conv_id", "pos", (F.col("initial") + 4 * fault).cast("byte").alias("code"))


def blocks(codes: DataFrame, block: int = BLOCK) -> DataFrame:
    """Runs of at most ``block`` rows of one conversation: conv_id, pos (of the first),
    codes, fault counts and illegal neighbours inside, first and last initial."""
    names = ["blank", "duplicate", "truncated", "illegal", "first", "last"]

    def run(batches):
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            conv = pc.dictionary_encode(b.column("conv_id"), null_encoding="encode").indices.to_numpy()
            pos, code = b.column("pos").to_numpy(), b.column("code").to_numpy().astype(np.uint8)
            new = np.ones(n, bool)
            new[1:] = (np.diff(conv) != 0) | (np.diff(pos) != 1)
            at = np.flatnonzero(new)
            inside = np.arange(n) - np.repeat(at, np.diff(np.append(at, n)))
            new |= inside % block == 0
            at = np.flatnonzero(new)
            size = np.diff(np.append(at, n))
            initial, fault = code % 4, code // 4
            illegal = np.zeros(n, np.int64)
            illegal[1:] = ~np.isin(initial[:-1] * 4 + initial[1:], [1, 6, 9]) & ~new[1:]
            sums = [np.add.reduceat((fault == f).astype(np.int64), at) for f in (BLANK, DUPLICATE, CUT)]
            ends = [initial[at].astype(np.int64), initial[at + size - 1].astype(np.int64)]
            yield pa.RecordBatch.from_arrays(
                [b.column("conv_id").take(pa.array(at)), pa.array(pos[at]),
                 pa.array([code[i:i + k].tobytes() for i, k in zip(at, size)], pa.binary()),
                 *[pa.array(x) for x in (*sums, np.add.reduceat(illegal, at), *ends)]], ["conv_id", "pos", "codes", *names])

    kind = codes.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, pos long, codes binary, " + ", ".join(f"{c} long" for c in names)
    dealt = codes.repartition(F.shiftright("pos", 33)).sortWithinPartitions("pos")
    return written(dealt.mapInArrow(freed(run), schema), "blocks")


class Rows:
    """The rows of several blocks, laid end to end, each with one more place after
    its last row.  Blocks come longest first."""

    def __init__(self, codes: list[bytes]):
        self.size = np.array([len(c) for c in codes], np.int64)
        self.base = np.cumsum(self.size + 1) - self.size - 1
        self.places = int((self.size + 1).sum())
        code = np.frombuffer(b"".join(c + b"\xff" for c in codes), np.uint8)
        self.row = code != 255
        initial, fault = np.where(self.row, code % 4, 3), np.where(self.row, code // 4, END)
        stays = np.where((fault == BLANK) | (fault == DUPLICATE) | ~self.row, FAR, np.where(fault == CUT, TRUNCATED, 0))
        self.to_keep = KEEP[:, initial].T  # place, state: the next state, -1 if none
        self.keep = np.where(self.to_keep >= 0, stays[:, None], FAR)
        self.rerole = (stays + REROLE)[:, None]

    def costs(self, at_end: np.ndarray) -> np.ndarray:
        """(place, state): the least cost to the end, given that at each block's end."""
        h = np.full((self.places, 4), FAR, np.int64)
        h[self.base + self.size] = at_end
        active = len(self.size)
        for back in range(1, int(self.size.max(initial=0)) + 1):
            while self.size[active - 1] < back:
                active -= 1
            i = (self.base + self.size)[:active] - back
            then = h[i + 1]
            here = np.minimum(then + DELETE, then[:, NEXT] + self.rerole[i])
            kept = np.take_along_axis(then, np.maximum(self.to_keep[i], 0), 1)
            here = np.minimum(here, kept + self.keep[i])
            here[:, [U, A]] = np.minimum(here[:, [U, A]], here[:, [A, U]] + INSERT)
            here[:, [START, S]] = np.minimum(here[:, [START, S]], here[:, [U]] + INSERT)
            h[i] = np.minimum(here, FAR)
        return h

    def arcs(self, h: np.ndarray, last: np.ndarray) -> np.ndarray:
        """(node, label): the node an optimal edit leads to, -1 if it is not optimal.
        ``last``: the conversation ends with the block, so turns may be added there."""
        place = np.arange(self.places)[:, None]
        state = np.arange(4)[None, :]
        after = np.vstack([h[1:], np.full((1, 4), FAR)])
        out = np.full((self.places, 4, 5), -1, np.int64)
        may_insert = self.row.copy()
        may_insert[(self.base + self.size)[last]] = True
        is_row = self.row[:, None]

        def put(label: int, cost: np.ndarray, fits: np.ndarray, to: np.ndarray) -> None:
            good = fits & (cost == h) & (h < FAR)
            out[:, :, label] = np.where(good, to, -1)

        put(1, after + DELETE, is_row, 4 * (place + 1) + state)
        put(2, h[:, NEXT] + INSERT, may_insert[:, None], 4 * place + NEXT)
        kept = np.take_along_axis(after, np.maximum(self.to_keep, 0), 1)
        put(3, kept + self.keep, is_row & (self.to_keep >= 0), 4 * (place + 1) + np.maximum(self.to_keep, 0))
        put(4, after[:, NEXT] + self.rerole, is_row, 4 * (place + 1) + NEXT)
        return out.reshape(-1, 5)


def least_paths(arcs: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(path x step): the nodes of the least path from every start node, and the
    labels on it (0 past its end)."""
    nodes = np.arange(len(arcs))
    fits = arcs >= 0
    ends = ~fits.any(1)
    rank = np.where(ends, 0, fits.argmax(1))  # audits of one edit; an end is least
    pointers: list[np.ndarray] = []
    big = np.int64(len(arcs) + 5)
    pointer = None
    while True:
        # The least arc by label and by the rank of the audit that follows.
        key = np.where(fits, np.arange(5) * big + rank[np.where(fits, arcs, 0)], np.iinfo(np.int64).max)
        label = np.where(ends, 0, key.argmin(1))
        if pointer is None:
            pointer = np.where(ends, nodes, arcs[nodes, label])
        pointers.append(pointer)
        if ends[pointer[start]].all():
            break
        rank = np.unique(rank * big + rank[pointer], return_inverse=True)[1]
        pointer = pointer[pointer]
    path = start[:, None]
    for p in pointers:
        path = np.concatenate([path, p[path]], 1)
    return path, label[path]


def grouped(size: np.ndarray):
    """Indices of blocks, longest first, alike in length, a bounded sum at a time."""
    order = np.argsort(-size, kind="stable")
    kind = np.frexp(size[order])[1]
    a = 0
    while a < len(order):
        most = max(1, NODES // (4 * (int(size[order[a]]) + 1)))
        b = a + int(np.searchsorted(-kind[a:a + most], -kind[a], "right"))
        yield order[a:b]
        a = b


def matrices(some: DataFrame) -> DataFrame:
    """conv_id, pos, m: least cost by entry and exit state, of every block."""
    def run(batches):
        for b in batches:
            codes = b.column("codes").to_pylist()
            m = np.zeros((len(codes), 4, 4), np.int64)
            for part in grouped(np.array([len(c) for c in codes])):
                rows = Rows([codes[i] for i in part])
                for out in range(4):
                    at_end = np.where(np.arange(4) == out, 0, FAR)
                    m[part, :, out] = rows.costs(at_end)[rows.base]
            yield pa.RecordBatch.from_arrays(
                [b.column("conv_id"), b.column("pos"), pa.array(m.reshape(len(m), 16).tolist(), pa.list_(pa.int64()))],
                ["conv_id", "pos", "m"])

    kind = some.schema["conv_id"].dataType.simpleString()
    return some.select("conv_id", "pos", "codes").mapInArrow(freed(run), f"conv_id {kind}, pos long, m array<long>")


def ends(some: DataFrame) -> DataFrame:
    """pos, cost (to the end, by exit state), closing (it is the last), of every block."""
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("pos")
        m = np.array(t["m"].to_pylist(), np.int64).reshape(-1, 4, 4)
        cost = np.empty((len(m), 4), np.int64)
        cost[-1] = AT_END
        for i in range(len(m) - 1, 0, -1):
            cost[i - 1] = np.minimum((m[i] + cost[i]).min(1), FAR)
        last = np.arange(len(m)) == len(m) - 1
        return pa.table({"pos": t["pos"], "cost": pa.array(cost.tolist(), pa.list_(pa.int64())), "closing": pa.array(last)})

    return matrices(some).groupBy("conv_id").applyInArrow(run, "pos long, cost array<long>, closing boolean")


def edits(some: DataFrame) -> DataFrame:
    """A row for each block and entry state: the least audit of its rows, its cost,
    its exit state, and the turns it leaves (pos, seq, role if it is a new one,
    row: whether it is a row's)."""
    def run(batches):
        for b in batches:
            codes, pos = b.column("codes").to_pylist(), b.column("pos").to_numpy()
            alone = ~b.column("cost").is_valid().to_numpy(zero_copy_only=False)
            last = alone | pc.fill_null(b.column("closing"), True).to_numpy(zero_copy_only=False)
            at_end = np.array([c if c else AT_END for c in b.column("cost").to_pylist()], np.int64).reshape(-1, 4)
            for part in grouped(np.array([len(c) for c in codes])):
                rows = Rows([codes[i] for i in part])
                h = rows.costs(at_end[part])
                arcs = rows.arcs(h, last[part])
                entry = [np.flatnonzero(~alone[part] | (s == START)) for s in range(4)]
                block = np.concatenate(entry)
                state = np.repeat(np.arange(4), [len(e) for e in entry])
                reached = h[rows.base[block], state] < FAR
                block, state = block[reached], state[reached]
                path, label = least_paths(arcs, 4 * rows.base[block] + state)
                out = path[:, -1] % 4
                end_cost = np.where(last[part][block], 0, at_end[part][block, out])
                audit = np.frombuffer(AUDIT, np.uint8)[label]
                k, step = np.nonzero(label > 1)
                what, node = label[k, step], path[k, step]
                turn = pa.StructArray.from_arrays(
                    [pa.array(pos[part][block[k]] + node // 4 - rows.base[block[k]]), pa.array(step.astype(np.int32)),
                     pa.array(np.where(node % 4 == U, "assistant", "user"), pa.string(), mask=what == 3), pa.array(what > 2)],
                    ["pos", "seq", "role", "row"])
                upto = np.concatenate([[0], np.cumsum((label > 1).sum(1))]).astype(np.int32)
                index = pa.array(part[block])
                yield pa.RecordBatch.from_arrays(
                    [b.column("conv_id").take(index), b.column("pos").take(index), pa.array(alone[part][block]),
                     pa.array(state), pa.array(out), pa.array(h[rows.base[block], state] - end_cost),
                     pa.array([r[:n].tobytes().decode() for r, n in zip(audit, (label > 0).sum(1))], pa.string()),
                     pa.ListArray.from_arrays(pa.array(upto), turn)],
                    ["conv_id", "pos", "alone", "entry", "out", "cost", "audit", "turns"])

    kind = some.schema["conv_id"].dataType.simpleString()
    schema = (f"conv_id {kind}, pos long, alone boolean, entry long, out long, cost long, audit string, "
              "turns array<struct<pos: long, seq: int, role: string, row: boolean>>")
    return some.select("conv_id", "pos", "codes", "cost", "closing").mapInArrow(freed(run), schema)


def entered(some: DataFrame) -> DataFrame:
    """pos, entry: the entry state of every block that is not alone."""
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by([("pos", "ascending"), ("entry", "ascending")])
        state, pos, entry = START, [], []
        for p, e, out in zip(t["pos"].to_pylist(), t["entry"].to_pylist(), t["out"].to_pylist()):
            if e == state and (not pos or pos[-1] != p):
                pos.append(p)
                entry.append(e)
                state = out
        return pa.table({"pos": pa.array(pos, pa.int64()), "entry": pa.array(entry, pa.int64())})

    return (some.where("NOT alone").select("conv_id", "pos", "entry", "out").groupBy("conv_id")
            .applyInArrow(run, "pos long, entry long"))


def line_hashes(lines: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256 of the lines (conv_id, pos, seq, line), joined by
    newlines.  Lines of a conversation stream through one task; none are held."""
    def run(batches):
        now, digest = None, None
        for b in batches:
            ids, text = b.column("conv_id").to_pylist(), b.column("line").to_pylist()
            done = []
            for i, line in zip(ids, text):
                if digest is None or i != now:
                    if digest is not None:
                        done.append((now, digest.hexdigest()))
                    now, digest = i, hashlib.sha256(line.encode())
                else:
                    digest.update(b"\n" + line.encode())
            yield made(done, b.schema.field("conv_id").type)
        if digest is not None:
            yield made([(now, digest.hexdigest())], b.schema.field("conv_id").type)

    def made(rows, kind):
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], kind), pa.array([r[1] for r in rows], pa.string())],
                                          ["conv_id", "repaired_sha256"])

    kind = lines.schema["conv_id"].dataType.simpleString()
    streamed = lines.repartition("conv_id").sortWithinPartitions("conv_id", "pos", "seq").select("conv_id", "line")
    return streamed.mapInArrow(run, f"conv_id {kind}, repaired_sha256 string")


def by_conversation(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join on conv_id, nulls equal."""
    other = right.withColumnRenamed("conv_id", "of")
    return left.join(other, left["conv_id"].eqNullSafe(other["of"]), "left").drop("of")


def repaired(turns: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(conv_id, faults, cost, audit) and (conv_id, pos, seq, role, text) of the
    repaired turns, of rows from ``numbered``."""
    all_ = blocks(coded(turns), block)
    several = all_.groupBy("conv_id").agg(F.count("*").alias("parts")).where("parts > 1")
    long_ones = by_conversation(all_, several).where("parts IS NOT NULL")
    done = written(edits(all_.join(written(ends(long_ones), "block_ends"), "pos", "left")), "block_edits")
    chosen = done.where("alone").unionByName(done.join(entered(done), ["pos", "entry"], "left_semi").select(*done.columns))
    parts = F.sort_array(F.collect_list(F.struct("pos", "first", "last", "audit")))
    legal = F.array(F.lit(1), F.lit(6), F.lit(9))  # su, ua, au as 4 x initial + initial
    between = lambda i: ~F.array_contains(legal, (F.get("parts", i - 1)["last"] * 4 + F.get("parts", i)["first"]).cast("int"))
    seams = F.when(F.size("parts") > 1, F.size(F.filter(F.sequence(F.lit(1), F.size("parts") - 1), between))).otherwise(0)
    faults = (all_.drop("codes", "conv_id").join(chosen.select("conv_id", "pos", "cost", "audit"), "pos")
              .groupBy("conv_id").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
                                      parts.alias("parts"))
              .select("conv_id", "blank", "duplicate", "truncated", (F.col("illegal") + seams).alias("illegal"), "cost",
                      F.concat_ws("", F.transform("parts", lambda p: p["audit"])).alias("audit")))
    left = chosen.select("conv_id", F.explode("turns").alias("t")).select("conv_id", "t.*")
    of_row = turns.select("pos", F.col("role").alias("own"), F.col("text").alias("words"))
    rows = left.where("row").join(of_row, "pos").select(
        "conv_id", "pos", "seq", F.coalesce("role", "own").alias("role"), F.col("words").alias("text"))
    added = left.where("NOT row").select("conv_id", "pos", "seq", "role", F.lit("").alias("text"))
    return faults, rows.union(added)


def repair(conversations: DataFrame, rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row for each conv_id of ``conversations``, whose rows are now ``rows``."""
    turns = numbered(rows)
    faults, turns_left = repaired(turns, block)
    hashes = line_hashes(turns_left.select("conv_id", "pos", "seq", F.concat("role", F.lit(":"), "text").alias("line")))
    gaps = (turns.groupBy("conv_id", "turn").agg(F.lit(0)).groupBy("conv_id")
            .agg((F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps")))
    out = by_conversation(by_conversation(by_conversation(conversations.select("conv_id").distinct(), gaps), faults), hashes)
    count = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(0).cast("long")).alias(c)
    return out.select("conv_id", *[count(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair(conversations, damaged(conversations))
