"""conformkit: configuration-driven conform, summarise and load jobs on Spark.

Every operator takes and returns ``DataFrame`` / ``Column`` objects; the work is
planned by Catalyst and run by Spark.  Sub-packages:

``sources``    readers (CSV, text, JSON, Parquet, JDBC) and config loading
``sinks``      writers (CSV, Parquet, text, JSON documents, JDBC)
``operators``  conform / align / union, summaries and profiles, joins, ordering
``functions``  column helpers: strings, dates, arrays, maps, JSON, arithmetic
``plans``      load jobs (full, incremental replace), job registry and runner,
               the mapping job, and the query catalogue
``streaming``  intentionally empty (the reference has no streaming work)
"""

from conformkit.specs import (
    ConnectionProfile,
    LoadSpec,
    LoadType,
    MappingSpec,
    MeasureSpec,
    SourceSpec,
    Transform,
)

__all__ = [
    "ConnectionProfile",
    "LoadSpec",
    "LoadType",
    "MappingSpec",
    "MeasureSpec",
    "SourceSpec",
    "Transform",
]
