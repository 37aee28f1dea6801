"""The schema-driven roll-up job: typed CSV from config → transformations →
grouped measures (AGG-4, PRJ-8, PRJ-9, PRJ-11, SRC-3).

Config shape (the reference's roll-up file)::

    {"<name>": {"sourceCSVPath": ..., "targetTable": ...,
                "readSchema": [{"col_name": ..., "col_type": ...}],
                "transformations": [{"column_name": ..., "expression": ...}],
                "read_db_tables": {"<query name>": "<sql>"}}}

The grouping keys and measures are job parameters (the reference writes them in
its script).  One scan (only the columns used), one Project, partial aggregate →
shuffle on the keys → final aggregate.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from conformkit.operators.conform import apply_transformations
from conformkit.operators.summarize import summarize
from conformkit.sources.files import read_config, read_csv_typed
from conformkit.specs import MeasureSpec, SpecError, Transform, build_schema, transforms_from


@dataclass(frozen=True)
class RollupSpec:
    name: str
    source_path: str
    read_schema: tuple[tuple[str, str], ...]
    transformations: tuple[Transform, ...] = ()
    target: str | None = None
    db_queries: Mapping[str, str] = field(default_factory=dict)

    @classmethod
    def from_dict(cls, d: Mapping[str, Any], name: str | None = None) -> RollupSpec:
        if name is None:
            if len(d) != 1:
                raise SpecError(f"roll-up config holds {len(d)} jobs; name one of {sorted(d)}")
            name = next(iter(d))
        body = d[name]
        try:
            schema = tuple((str(f["col_name"]), str(f["col_type"])) for f in body["readSchema"])
            path = body["sourceCSVPath"]
        except KeyError as e:
            raise SpecError(f"roll-up {name!r} lacks {e.args[0]!r}") from None
        return cls(name=name, source_path=path, read_schema=schema,
                   transformations=transforms_from(body.get("transformations")),
                   target=body.get("targetTable"),
                   db_queries=dict(body.get("read_db_tables", {})))


def rollup_rows(spark: SparkSession, spec: RollupSpec) -> DataFrame:
    """The source CSV read with its declared schema, then transformed."""
    df = read_csv_typed(spark, spec.source_path, build_schema(spec.read_schema))
    return apply_transformations(df, spec.transformations, spec.name)


def run_rollup(spark: SparkSession, spec: RollupSpec | Mapping[str, Any] | str,
               keys: Sequence[str], measures: Sequence[MeasureSpec | dict],
               **summary_opts: Any) -> DataFrame:
    """Roll the source up by ``keys`` (AGG-4).  ``spec`` may be a spec, the
    config dict, or the path of the config file."""
    if isinstance(spec, str):
        spec = RollupSpec.from_dict(read_config(spark, spec))
    elif not isinstance(spec, RollupSpec):
        spec = RollupSpec.from_dict(spec)
    return summarize(rollup_rows(spark, spec), keys, measures, **summary_opts)
