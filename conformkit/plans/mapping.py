"""The mapping job (LOD-8): read N sources → transform → conform → union →
summarise → sink.

The whole job is one lazy plan.  Per source: scan + one Project; then a Union
(no shuffle); the summary is partial aggregate → shuffle on the keys → final.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from conformkit.operators.conform import (
    apply_transformations,
    check_case_unique,
    conform_and_union,
)
from conformkit.operators.summarize import summarize
from conformkit.sinks.files import append_partitioned, write_csv, write_parquet
from conformkit.specs import MappingSpec, MeasureSpec, SpecError
from conformkit.sources.files import read_config, read_source


def transformed_sources(spark: SparkSession, spec: MappingSpec,
                        frames: Mapping[str, DataFrame] | None = None) -> list[tuple[str, DataFrame]]:
    """Each source read (or taken from ``frames`` by name) and transformed."""
    out = []
    for s in spec.sources:
        df = frames[s.name] if frames and s.name in frames else read_source(spark, s)
        check_case_unique(df, s.name)
        out.append((s.name, apply_transformations(df, s.transformations, s.name)))
    return out


def conformed(spark: SparkSession, spec: MappingSpec,
              frames: Mapping[str, DataFrame] | None = None,
              safe_cast: bool = False) -> DataFrame:
    """All sources conformed to the declared (or derived) schema and unioned."""
    return conform_and_union(transformed_sources(spark, spec, frames), spec.columns, safe_cast)


def summary(spark: SparkSession, spec: MappingSpec,
            frames: Mapping[str, DataFrame] | None = None,
            keys: Sequence[str] | None = None,
            measures: Sequence[MeasureSpec | dict] | None = None, **opts: Any) -> DataFrame:
    """The measures by the keys over the conformed rows.  ``keys`` and
    ``measures`` given here override the config's (mapping files that carry
    none leave them to the job)."""
    keys = list(keys if keys is not None else spec.keys)
    measures = list(measures if measures is not None else spec.measures)
    if not measures:
        raise SpecError("mapping has no measures to summarise; pass measures=")
    return summarize(conformed(spark, spec, frames), keys, measures, **opts)


def run_mapping(spark: SparkSession, spec: MappingSpec,
                frames: Mapping[str, DataFrame] | None = None,
                output_format: str = "csv",
                keys: Sequence[str] | None = None,
                measures: Sequence[MeasureSpec | dict] | None = None,
                partition_by: Sequence[str] = (), mode: str = "overwrite") -> DataFrame:
    """Run the mapping and, if ``output_path`` is set, write the summary there
    (CSV with header by default, SNK-1; or Parquet, optionally appended and
    partitioned, e.g. by ``source_key``, SNK-2).  Returns the summary frame."""
    out = summary(spark, spec, frames, keys=keys, measures=measures)
    if spec.output_path:
        if partition_by and mode == "append":
            append_partitioned(out, spec.output_path, list(partition_by))
        elif output_format == "csv":
            write_csv(out, spec.output_path, mode=mode)
        else:
            write_parquet(out, spec.output_path, mode=mode, partition_by=tuple(partition_by))
    return out


def load_mapping(spark: SparkSession, path: str) -> MappingSpec:
    """A mapping config file (local or object store) as a spec (SRC-13)."""
    return MappingSpec.from_dict(read_config(spark, path))
