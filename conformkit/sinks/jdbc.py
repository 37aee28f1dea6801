"""JDBC sink (SNK-3, SNK-4).

Executors write in parallel, one connection per task; ``numPartitions`` caps
the number of concurrent connections (the write coalesces to it), and
``batchsize`` sets rows per round trip.  Overwrite truncates instead of
dropping the table (D15).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from conformkit.specs import ConnectionProfile, SpecError

_MODES = {"append", "overwrite"}


def write_jdbc(df: DataFrame, profile: ConnectionProfile, table: str, mode: str = "append",
               batchsize: int = 10000, max_connections: int | None = None) -> None:
    if mode not in _MODES:
        raise SpecError(f"jdbc write mode must be one of {sorted(_MODES)}, got {mode!r}")
    opts = profile.jdbc_options()
    opts.update(dbtable=table, batchsize=str(batchsize))
    if mode == "overwrite":
        opts["truncate"] = "true"
    if max_connections:
        opts["numPartitions"] = str(max_connections)
    df.write.format("jdbc").mode(mode).options(**opts).save()


def write_named(df: DataFrame, profiles: dict[str, ConnectionProfile], connection_name: str,
                table: str, mode: str = "append", **kw) -> None:
    """SNK-3 through a named connection profile (SNK-4)."""
    if connection_name not in profiles:
        raise SpecError(f"unknown connection {connection_name!r}")
    write_jdbc(df, profiles[connection_name], table, mode, **kw)
