"""Publish a mart under a name.

``publish`` writes the mart as a table (overwrite) or, for interactive use,
registers it as a temp view. Writing is the lineage cut: later marts that read
a published table start from the files, not from the whole upstream plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def publish(df: DataFrame, alias: str, mode: str = "table", path: str | None = None,
            partition_by: list[str] | None = None) -> DataFrame:
    if mode == "view":
        df.createOrReplaceTempView(alias)
        return df
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if mode == "parquet":
        if not path:
            raise ValueError("parquet sink needs a path")
        writer.parquet(path)
        return df.sparkSession.read.parquet(path)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(alias)
    return df.sparkSession.table(alias)
