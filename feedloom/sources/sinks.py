"""Sinks (A16)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_records(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite",
                  fmt: str = "parquet", dynamic: bool = True) -> None:
    """Write records partitioned by ``partition_by``. A dynamic overwrite replaces only the
    partitions present in ``df`` and leaves the others (a version directory is rewritten
    without touching the rest); otherwise ``df`` is all there is afterwards."""
    w = df.write.mode(mode).format(fmt).option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
