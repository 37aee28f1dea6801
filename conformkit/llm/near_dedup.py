"""MinHash near-dedup by improved consistent weighted sampling over TF-IDF shingles.

A document's elements are its shingles of SHINGLE words (lower case, split at
[\\x20\\x09-\\x0D]; a shorter text is one shingle), weighted

    tf * (1 + ln(N / df) / ln(RESOLUTION)),   df at least 1 and N / RESOLUTION.

Document frequencies count groups of copies once, else the shingles that thousands of
copies share would be taken for common ones and weigh less than the few that tell the
copies apart.  A document's group goes by the first (by digest) of all documents that
share any of its MINS plain min-hashes: a copy shares one with its group but for the
power MINS of its difference.  N is the number of groups, and every document counts
for its share of its group: df sums, over all groups, the part of their documents that
hold the shingle.  Frequencies come from a count sketch of 2^20 cells; its resolution
is relative to N, so it serves any corpus alike: a shingle with df under
N / RESOLUTION has the full idf.

HASHES samples (Ioffe's consistent weighted sampling; weights on a logarithmic
grid) form a signature, cut into bands of ROWS.  Texts that share a band are
candidates, and a candidate is a link if its exact weighted Jaccard similarity is
THRESHOLD or more.  Classes are the connected components of the links.  A candidate
is not compared if fewer than LIKELY of its samples agree: a link of similarity 0.8
does so with probability 3e-10, and shares no band with probability 2e-4.

Texts of the same word sequence are one node from the start.  A band's nodes are
not paired with each other: every node is compared to the band's first one and to
the NEAR before it in a hash order (salted into parts for a large band).  In a
band that is too large for this to compare all and that then still holds several
components, the nodes outside its largest component are compared to all its nodes,
in blocks inside tasks that give out only links between components.

Nulls are empty texts; texts without a word are one class; repeated rows fall in
one class (rows that share a doc_id but not their text each in the class of their
text); very long texts are compared whole; an empty table gives an empty result;
other columns are not read by ``classes``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Powers, columns, freed, mix64, runs, span_hashes, summed, table, text_buffers, white_class, written
from .components import components

SHINGLE, THRESHOLD = 5, 0.8
HASHES, ROWS = 64, 4  # a link of 0.8 shares no band with probability 0.0002
SKETCH_BITS, RESOLUTION, MINS = 20, 1024, 4
NEAR = 2
LIKELY = 0.45  # agreeing share of a signature: 29 of 64 samples
SALTS = 16  # parts of a key in joins
UNIT = 1 << 30  # a group's count, so that shares sum as integers
SLOT_BITS, GRID, SEED = 14, 0.05, 3
SLICE = 1 << 20
STRAYS, MEMBERS = 256, 1024  # block sizes of the comparison inside large bands


def shingle_words(col, shingle: int, powers: Powers):
    """(row, word hashes, shingle codes ascending, tf) of every document of a text
    column, in order."""
    data, off = text_buffers(pc.utf8_lower(col))
    white = white_class()
    steps = [np.uint64(pow(0x9E3779B97F4A7C15, 2 * i + 1, 1 << 64)) for i in range(shingle)]
    n, row = len(off) - 1, 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(off, off[row] + SLICE, "right")) - 1)
        raw, edges = data[off[row]:off[end]], off[row:end + 1] - off[row]
        s, e = runs(white[raw], edges)
        word = span_hashes(raw, s, e, powers)
        first = np.searchsorted(s, edges)
        every = np.zeros(max(0, len(word) - shingle + 1), np.uint64)
        for i, step in enumerate(steps):
            every += word[i:len(every) + i] * step
        every = (mix64(every) >> np.uint64(32)).astype(np.uint32)
        for r in range(row, end):
            a, b = first[r - row], first[r - row + 1]
            if b - a >= shingle:
                code = every[a:b - shingle + 1]
            elif b > a:  # a short text: one shingle of all its words
                h = np.array([(word[a:b] * steps[:b - a]).sum()], np.uint64)
                code = (mix64(h) >> np.uint64(32)).astype(np.uint32)
            else:
                code = np.zeros(0, np.uint32)
            yield r, word[a:b], *np.unique(code, return_counts=True)
        row = end


def marks(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, digest (of its text), node (of its word sequence), min-hashes of every
    row that has a word."""
    odd = [np.uint32(2 * 0x1E3779B1 * (i + 1) + 1 & 0xFFFFFFFF) for i in range(MINS)]

    def run(batches):
        powers = Powers()
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                node, mins, row = [], [], []
                for r, word, code, _ in shingle_words(part.column(1), shingle, powers):
                    if len(code):
                        row.append(r)
                        node.append(node_name(word))
                        mixed = code ^ (code >> np.uint32(15))
                        mins.append([int(i) << 32 | int((mixed * m).min()) for i, m in enumerate(odd)])
                row = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(row), part.column(2).take(row), pa.array(node, pa.binary()),
                     pa.array(mins, pa.list_(pa.int64()))], ["doc_id", "digest", "node", "mins"])

    return docs.select("doc_id", "text", text_digest().alias("digest")).mapInArrow(
        freed(run), "doc_id long, digest binary, node binary, mins array<long>")


def salted(rows: DataFrame, keys: DataFrame, key: str, how: str) -> DataFrame:
    """``rows`` joined to the one row of ``keys`` with their key, a key's nodes in SALTS
    parts: no hot key in one task."""
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
    keys = keys.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.join(keys, [key, "salt"], how).drop("salt")


def groups(docs: DataFrame, shingle: int) -> DataFrame:
    """node, copies (its rows), leader (the first node of all that share any of its
    min-hashes), and doc_id, digest, repeats of the row that speaks for the node and is
    there ``repeats`` times."""
    rows = written(marks(docs, shingle), "marks")
    nodes = (rows.groupBy("node", "doc_id", "digest").agg(F.count("*").alias("repeats"))
             .groupBy("node").agg(F.sum("repeats").alias("copies"), F.min(F.struct("doc_id", "digest", "repeats")).alias("d")))
    mins = rows.select("node", F.explode("mins").alias("m")).distinct()
    shared = (mins.groupBy("m").agg(F.min("node").alias("first"), F.max("node").alias("last"))
              .where("first <> last").select("m", "first"))
    leaders = salted(mins, shared, "m", "inner").groupBy("node").agg(F.min("first").alias("leader"))
    return (nodes.join(leaders, "node", "left")
            .select("node", "copies", F.coalesce("leader", "node").alias("leader"), "d.doc_id", "d.digest", "d.repeats"))


def firsts(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, node of the documents that are the first of all that share any of
    their min-hashes."""
    return groups(docs, shingle).where("node = leader").select("doc_id", "node")


def shares(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, digest, share (of UNIT, of the group that the rows of its word sequence
    are part of) of a row that speaks for all of its word sequence."""
    of = written(groups(docs, shingle), "groups")
    sizes = (of.groupBy("leader").agg(F.sum("copies").alias("size"), F.count("*").alias("nodes"))
             .where("nodes > 1").select("leader", "size"))
    share = F.col("copies") / F.coalesce("size", "copies") / F.col("repeats")
    return salted(of, sizes, "leader", "left").select("doc_id", "digest", F.round(share * UNIT).cast("long").alias("share"))


def idf_table(docs: DataFrame, shingle: int) -> np.ndarray:
    """The idf of every sketch cell as a byte: 255 is the full idf, 0 that of a
    shingle in all documents."""
    def count(batch: pa.RecordBatch, total: np.ndarray) -> None:
        powers, flat = Powers(), total.reshape(-1)
        held, held_share, size = [], [], 0
        share = batch.column(1).to_numpy(zero_copy_only=False)

        def add() -> None:
            cell, of = np.concatenate(held) >> np.uint32(32 - SKETCH_BITS), np.concatenate(held_share)
            sums = np.bincount(cell, of, len(flat))  # exact: under 2^53
            sums[0] = 0  # one cell is given to the number of groups
            np.add(flat, sums.astype(np.int64), out=flat)

        for row, _, code, _ in shingle_words(batch.column(0), shingle, powers):
            flat[0] += share[row]
            for a in range(0, len(code), SLICE):
                held.append(code[a:a + SLICE])
                held_share.append(np.full(len(held[-1]), share[row], float))
                size += len(held[-1])
                if size > SLICE or len(held) > 4096:
                    add()
                    held, held_share, size = [], [], 0
        if held:
            add()

    width = 64
    same = F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("d.digest") == F.col("s.digest"))
    texts = (docs.select("doc_id", "text", text_digest().alias("digest")).alias("d")
             .join(shares(docs, shingle).alias("s"), same).select("text", "share"))
    cells = summed(texts, count, (1 << SKETCH_BITS) // width, width).reshape(-1) / UNIT
    n = max(1.0, cells[0])
    cells[0] = 0
    noise = np.median(cells)  # what rare shingles add to a cell
    least = max(1.0, n / RESOLUTION)  # a shingle is in its own document at least
    df = np.clip(cells - noise, least, n)
    df[0] = least
    return np.round(255 * np.log(n / df) / np.log(RESOLUTION)).astype(np.uint8)


def weights(code: np.ndarray, tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return tf * (1 + idf[code >> np.uint32(32 - SKETCH_BITS)] / 255)


class Sampler:
    """Consistent weighted samples.  Element and hash number pick one of 2^14
    random triples (r, c, beta); per weight on the grid their ln a and t are
    tabulated once, so a sample costs one look-up an element."""

    def __init__(self):
        rng = np.random.default_rng(SEED)
        slots = 1 << SLOT_BITS
        self.r, self.lnc = rng.gamma(2, 1, slots), np.log(rng.gamma(2, 1, slots))
        self.beta = rng.random(slots)
        self.mul = (rng.integers(0, 1 << 31, HASHES, np.uint32) << np.uint32(1)) | np.uint32(1)
        self.add = rng.integers(0, 1 << 32, HASHES, np.uint32)
        self.levels: dict[int, int] = {}
        self.lna, self.t = np.zeros((0, slots), np.float32), np.zeros((0, slots), np.int32)

    def rows(self, weight: np.ndarray) -> np.ndarray:
        level = np.round(np.log(weight) / GRID).astype(np.int64)
        for at in np.unique(level):
            if int(at) not in self.levels:
                t = np.floor(at * GRID / self.r + self.beta)
                lna = self.lnc - self.r * (t - self.beta + 1)
                self.levels[int(at)] = len(self.lna)
                self.lna = np.concatenate([self.lna, lna[None].astype(np.float32)])
                self.t = np.concatenate([self.t, t[None].astype(np.int32)])
        values, inverse = np.unique(level, return_inverse=True)
        return np.array([self.levels[int(v)] for v in values], np.int64)[inverse]

    def sample(self, code: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """HASHES 32-bit sample names."""
        row = self.rows(weight) << SLOT_BITS
        best, name = np.full(HASHES, np.inf, np.float32), np.zeros(HASHES, np.uint32)
        flat, flat_t, all_ = self.lna.reshape(-1), self.t.reshape(-1), np.arange(HASHES)
        for a in range(0, len(code), 1024):
            c = code[a:a + 1024]
            x = c[:, None] * self.mul + self.add
            x ^= x >> np.uint32(15)
            x *= np.uint32(0x2C1B3C6D)
            at = (x >> np.uint32(32 - SLOT_BITS)).astype(np.int64) + row[a:a + 1024, None]
            value = flat[at]
            low = value.argmin(0)
            least = value[low, all_]
            better = least < best
            picked = c[low].astype(np.uint64) | (flat_t[at[low, all_]].astype(np.uint32).astype(np.uint64) << np.uint64(32))
            best = np.where(better, least, best)
            name = np.where(better, (mix64(picked) >> np.uint64(32)).astype(np.uint32), name)
        return name


def node_name(word: np.ndarray) -> bytes:
    """A digest of a word sequence."""
    return hashlib.blake2b(word.tobytes(), digest_size=16).digest()


def signed(docs: DataFrame, idf: np.ndarray, shingle: int) -> DataFrame:
    """One row per document: digest (of its text), node (of its word sequence), sig (a
    byte per sample), bands."""
    n_bands = HASHES // ROWS

    def run(batches):
        powers, sampler = Powers(), Sampler()
        step = np.arange(1, ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        salt = np.arange(1, n_bands + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                node, sig, bands = [], [], []
                for _, word, code, tf in shingle_words(part.column(1), shingle, powers):
                    node.append(node_name(word))
                    if len(code):
                        name = sampler.sample(code, weights(code, tf, idf))
                        key = mix64((name.reshape(n_bands, ROWS).astype(np.uint64) * step).sum(1) ^ salt)
                        bands.append(key.view(np.int64))
                        sig.append(name.astype(np.uint8).tobytes())
                    else:
                        bands.append(np.zeros(0, np.int64))
                        sig.append(b"")
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(node, pa.binary()), pa.array(sig, pa.binary()),
                     pa.array(bands, pa.list_(pa.int64()))], ["doc_id", "digest", "node", "sig", "bands"])

    return docs.select("doc_id", "text", text_digest().alias("digest")).mapInArrow(
        freed(run), "doc_id long, digest binary, node binary, sig binary, bands array<long>")


def text_digest() -> Column:
    return F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))


def bodies(docs: DataFrame, used: DataFrame, shingle: int) -> DataFrame:
    """node, body (struct of its shingles and their tf, empty if all are 1) of the
    documents that ``used`` (doc_id, node) names, shingled again from their texts."""
    def run(batches):
        powers = Powers()
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                node, codes, tfs = [], [], []
                for _, word, code, tf in shingle_words(part.column(0), shingle, powers):
                    node.append(node_name(word))
                    codes.append(code.tobytes())
                    tfs.append(tf.astype(np.uint32).tobytes() if len(tf) and tf.max() > 1 else b"")
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in (node, codes, tfs)],
                                                 ["node", "codes", "tfs"])

    named = F.col("d.doc_id").eqNullSafe(F.col("u.doc_id"))
    texts = docs.select("doc_id", "text").alias("d").join(used.select("doc_id").distinct().alias("u"), named, "left_semi")
    found = texts.select("text").mapInArrow(freed(run), "node binary, codes binary, tfs binary")
    return found.groupBy("node").agg(F.min(F.struct("codes", "tfs")).alias("body"))


def signatures(col) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), np.uint8).reshape(-1, HASHES)


def likely(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose signatures agree enough."""
    sig = nodes.select("node", "sig")
    both = (pairs.join(sig.select(F.col("node").alias("a"), F.col("sig").alias("sa")), "a")
            .join(sig.select(F.col("node").alias("b"), F.col("sig").alias("sb")), "b"))

    def run(batches):
        for t in batches:
            if t.num_rows:
                agree = (signatures(t.column("sa")) == signatures(t.column("sb"))).mean(1)
                yield t.filter(pa.array(agree >= LIKELY)).select(["a", "b"])

    return both.mapInArrow(freed(run), "a binary, b binary")


def elements(body: dict, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(shingles ascending, weights) of a body."""
    code = np.frombuffer(body["codes"], np.uint32)
    tf = np.frombuffer(body["tfs"], np.uint32) if body["tfs"] else np.ones(len(code))
    return code, weights(code, tf, idf)


def similar(a: tuple, b: tuple, threshold: float) -> bool:
    """Whether the weighted Jaccard similarity is ``threshold`` or more."""
    (ca, wa), (cb, wb) = a, b
    at = np.searchsorted(cb, ca)
    at[at == len(cb)] = 0
    same = cb[at] == ca
    shared = np.minimum(wa[same], wb[at[same]]).sum()
    return bool(shared >= threshold * (wa.sum() + wb.sum() - shared) - 1e-9)


def verified(pairs: DataFrame, body: DataFrame, idf: np.ndarray, threshold: float) -> DataFrame:
    """The pairs that are links."""
    both = (pairs.join(body.select(F.col("node").alias("a"), F.col("body").alias("x")), "a")
            .join(body.select(F.col("node").alias("b"), F.col("body").alias("y")), "b"))

    def run(batches):
        for t in batches:
            keep = [similar(elements(t.column("x")[i].as_py(), idf), elements(t.column("y")[i].as_py(), idf), threshold)
                    for i in range(t.num_rows)]  # one pair's bytes at a time
            yield t.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    return both.mapInArrow(freed(run), "a binary, b binary")


def band_members(nodes: DataFrame) -> DataFrame:
    """key, node, h (order in the band), n (nodes in it), first: for bands of two
    nodes or more."""
    rows = nodes.select(F.explode("bands").alias("key"), "node").select(
        "key", "node", F.xxhash64("node", "key").alias("h"))
    groups = (rows.groupBy("key").agg(F.count("*").alias("n"), F.min(F.struct("h", "node")).alias("c"))
              .where("n > 1").select("key", "n", F.col("c.node").alias("first"),
                                     F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    salted = rows.withColumn("salt", F.pmod(F.shiftright("h", 20), F.lit(SALTS)).cast("int"))  # no hot band in one task
    return salted.join(groups, ["key", "salt"]).drop("salt")


def near_pairs(members: DataFrame) -> DataFrame:
    """Distinct pairs of each node with the band's first node and the NEAR before
    it; a large band is ordered in salted parts."""
    part = F.pmod("h", F.ceil(F.col("n") / 512))
    order = W.partitionBy("key", "part").orderBy("h")
    others = [F.lag("node", i).over(order) for i in range(1, NEAR + 1)]
    ordered = members.withColumn("part", part).select("node", F.array("first", *others).alias("others"))
    return (ordered.select("node", F.explode(F.array_distinct(F.array_compact("others"))).alias("other"))
            .where("node <> other").select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))
            .distinct())


def stray_links(members: DataFrame, roots: DataFrame, nodes: DataFrame, body: DataFrame,
                idf: np.ndarray, threshold: float) -> DataFrame:
    """Links inside large bands between nodes of different components."""
    large = (members.where(F.col("n") > NEAR + 1).select("key", "node")
             .join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    sizes = large.groupBy("key", "root").agg(F.count("*").alias("m"))
    open_ = (sizes.groupBy("key").agg(F.count("*").alias("parts"), F.sum("m").alias("n"),
                                      F.max(F.struct("m", "root")).alias("big"))
             .where("parts > 1").select("key", "n", F.col("big.root").alias("big"),
                                        (F.col("n") - F.col("big.m")).alias("strays")))
    rows = (large.join(open_, "key").join(nodes.select("node", "sig", "bands"), "node").join(body, "node")
            .withColumn("stray", F.col("root") != F.col("big")))
    m_blocks = F.ceil(F.col("n") / MEMBERS).cast("int")
    s_blocks = F.ceil(F.col("strays") / STRAYS).cast("int")
    h = F.xxhash64("node")
    up = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    cols = ["key", "node", "root", "sig", "bands", "body"]
    member = (rows.withColumn("mb", F.pmod(h, m_blocks).cast("int")).withColumn("sb", up(s_blocks))
              .select(*cols, "mb", "sb", F.lit(False).alias("stray")))
    stray = (rows.where("stray").withColumn("sb", F.pmod(h, s_blocks).cast("int")).withColumn("mb", up(m_blocks))
             .select(*cols, "mb", "sb", F.lit(True).alias("stray")))

    def run(t: pa.Table) -> pa.Table:
        is_stray = t["stray"].to_numpy(zero_copy_only=False)
        key, node, root = t["key"][0].as_py(), t["node"].to_pylist(), t["root"].to_pylist()
        part_of = {r: r for r in root}  # components as linked in this task

        def find(r: bytes) -> bytes:
            while part_of[r] != r:
                part_of[r] = r = part_of[part_of[r]]
            return r

        sig, bands = signatures(t["sig"]), np.array(t["bands"].to_pylist())
        mine, all_ = np.flatnonzero(is_stray), np.flatnonzero(~is_stray)
        a, b, held = [], [], {}

        def body_of(i: int) -> tuple:
            if i not in held:
                held[i] = elements(t["body"][int(i)].as_py(), idf)
            return held[i]

        for i in mine:
            # A pair that shares several bands is compared in the first of them.
            common = bands[all_] == bands[i]
            here = bands[i][common.argmax(1)] == key
            for j in all_[here & ((sig[all_] == sig[i]).mean(1) >= LIKELY)]:
                one, two = find(root[i]), find(root[j])
                if one != two and similar(body_of(i), body_of(j), threshold):
                    part_of[one] = two
                    a.append(node[i])
                    b.append(node[j])
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return member.union(stray).groupBy("key", "mb", "sb").applyInArrow(run, "a binary, b binary")


def classified(docs: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, digest, root (a name of the class), class_id, class_size of every row."""
    idf = idf_table(docs, shingle)
    rows = written(signed(docs, idf, shingle), "signed")
    nodes = rows.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))
    nodes = written(nodes, "nodes")
    # One document speaks for each node; repeated rows of it are the same.
    speaks = (F.col("r.node") == F.col("n.node")) & F.col("r.doc_id").eqNullSafe(F.col("n.doc_id"))
    own = (rows.where(F.size("bands") > 0).alias("r").join(nodes.alias("n"), speaks, "left_semi")
           .dropDuplicates(["node"]))
    own = written(own, "signatures")
    members = written(band_members(own), "bands")
    pairs = written(likely(near_pairs(members), own), "pairs")
    used = (pairs.select(F.explode(F.array("a", "b")).alias("node"))
            .union(members.where(F.col("n") > NEAR + 1).select("node")).distinct())
    body = written(bodies(docs, own.join(used, "node", "left_semi").select("doc_id", "node"), shingle), "bodies")
    links = written(verified(pairs, body, idf, threshold), "links")
    roots = components(links)
    late = written(stray_links(members, roots, own, body, idf, threshold), "links")
    named = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    if not late.isEmpty():
        # The late links join components, so only their roots are linked anew.
        of = lambda side: roots.select(F.col("node").alias(side), F.col("root").alias(f"{side}_root"))
        lifted = (late.join(of("a"), "a", "left").join(of("b"), "b", "left")
                  .select(F.coalesce("a_root", "a").alias("a"), F.coalesce("b_root", "b").alias("b")))
        above = components(lifted).select(F.col("node").alias("root"), F.col("root").alias("top"))
        named = named.join(above, "root", "left").withColumn("root", F.coalesce("top", "root")).drop("top")
    groups = named.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.sum("copies").alias("class_size"))
    of = named.join(groups, "root").select("node", "root", "class_id", "class_size")
    return rows.select("doc_id", "digest", "node").join(of, "node").drop("node")


def classes(docs: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, class_id (the least doc_id of the class), class_size, kept (the row
    of that doc_id) of every row."""
    return classified(docs, threshold, shingle).select(
        "doc_id", "class_id", "class_size", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


def deduplicate(docs: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE) -> DataFrame:
    """One document of each class, all columns: that of the least doc_id, of several
    texts with this doc_id that of the least digest."""
    rows = classified(docs, threshold, shingle).where(F.col("doc_id").eqNullSafe(F.col("class_id")))
    keep = rows.groupBy("root").agg(F.min(F.struct("digest", "doc_id")).alias("k"))
    # Plain equal keys on both sides: texts are shuffled once, for the join and for
    # dropping repeated rows.
    key = lambda doc, digest: [F.coalesce(doc, F.lit(0)).alias("id"), doc.isNull().alias("no_id"), digest.alias("digest")]
    whole = docs.select(F.struct(*columns(docs)).alias("row"), *key(F.col("doc_id"), text_digest()))
    return (whole.join(keep.select(*key(F.col("k.doc_id"), F.col("k.digest"))), ["id", "no_id", "digest"], "left_semi")
            .dropDuplicates(["id", "no_id", "digest"]).select("row.*"))


def op4_weighted_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents"))
