"""Write and open tables (S6, S7): Parquet under one root folder, named in the catalog as layer.table."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


LAYERS = ["raw", "staging", "intermediate", "marts"]


def path_of(root: str, layer: str, name: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{name}"


def write_table(df: DataFrame, root: str, layer: str, name: str, month_of: str | None = None) -> DataFrame:
    """Overwrite a table and return it as read back.

    With ``month_of`` (a date column) the table is partitioned by that month. The rows are rebalanced by month first,
    which AQE splits where a month is large, so each month gets files of even size however it is distributed.
    """
    path = path_of(root, layer, name)
    if month_of is None:
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)
    monthly = df.withColumn("event_month", F.trunc(month_of, "month")).hint("rebalance", "event_month")
    monthly.write.mode("overwrite").partitionBy("event_month").parquet(path)
    return df.sparkSession.read.schema(monthly.schema).parquet(path)


def write_bucketed(df: DataFrame, root: str, layer: str, name: str, by: str, buckets: int) -> DataFrame:
    """Overwrite a table bucketed and sorted by a key and return it as a catalog table, which knows its buckets.

    Tables of as many buckets are then joined and grouped by the key without a shuffle. The name is one of this root's
    own, in the database ``bucketed``; :func:`register` gives the table its usual one. Rows without a key are dealt to
    the writing tasks by their other columns, else one task would write them all.
    """
    spark = df.sparkSession
    own = f"bucketed.{name}_{zlib.crc32(path_of(root, layer, name).encode()):08x}"
    spark.sql("CREATE DATABASE IF NOT EXISTS bucketed")
    others = F.xxhash64(*(c for c in df.columns if c != by)).cast("string")
    dealt = df.repartition(buckets, F.coalesce(F.col(by), others))
    spark.sql(f"DROP TABLE IF EXISTS {own}")
    writer = dealt.write.mode("overwrite").bucketBy(buckets, by).sortBy(by)
    writer.option("path", path_of(root, layer, name)).saveAsTable(own)
    return spark.table(own)


def write_counted(df: DataFrame, root: str, layer: str, name: str) -> int:
    """Overwrite a table and return its row count, counted by the same job that writes it."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path_of(root, layer, name))
    return seen.get["rows"]


def open_table(spark: SparkSession, root: str, layer: str, name: str) -> DataFrame:
    return spark.read.parquet(path_of(root, layer, name))


def register(
    table: DataFrame,
    root: str,
    layer: str,
    name: str,
    partitioned: bool = False,
    bucketed: tuple[str, int] | None = None,
) -> None:
    """Name a written table in the catalog, replacing the name's earlier table (its files stay).

    ``bucketed``: the key and the number of buckets of a table of :func:`write_bucketed`.
    """
    spark = table.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} LOCATION '{path_of(root, layer, '_database')}'")
    spark.sql(f"DROP TABLE IF EXISTS {layer}.{name}")
    path = path_of(root, layer, name)
    if bucketed:
        by, buckets = bucketed
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema)
        spark.sql(
            f"CREATE TABLE {layer}.{name} ({columns}) USING parquet "
            f"CLUSTERED BY (`{by}`) SORTED BY (`{by}`) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
    elif partitioned:
        # With its columns declared, so that a fact without rows, which has no files, can be named as well.
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema)
        spark.sql(f"CREATE TABLE {layer}.{name} ({columns}) USING parquet PARTITIONED BY (event_month) LOCATION '{path}'")
        spark.catalog.recoverPartitions(f"{layer}.{name}")
    else:
        spark.catalog.createTable(f"{layer}.{name}", path=path, source="parquet", schema=table.schema)
