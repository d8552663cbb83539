"""What several operators need: reading tables, written intermediate tables, running sums, connected components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WORD_SEPARATORS = r"[\x20\x09-\x0D]+"
"""White space of the word contracts: space, tab, line feed, vertical tab, form feed, carriage return."""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the cluster names it; one of our own only where none is set."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="run-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


BROADCAST_ROWS = 1_000_000
"""Most keys that are broadcast; beyond it the same join is shuffled."""


def with_keys(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows whose key (the columns of ``keys``) is among the keys, so that other rows are not shuffled later."""
    wanted = written(keys.distinct(), "keys")
    wanted = F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted
    return rows.join(wanted, keys.columns, "left_semi")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
"""Spark's own setting: an execution's shuffle files go when it has ended."""


@contextmanager
def own_shuffles(spark: SparkSession) -> Iterator[None]:
    """What is executed inside shares its shuffles with nothing else, so they leave the executors' disks with it."""
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts the lineage, and a lost executor loses nothing."""
    spark, path = df.sparkSession, new_folder(df.sparkSession, name)
    with own_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables of :func:`written` that nothing reads again: all that was computed from them is written itself."""
    for t in tables:
        spark, files = t.sparkSession, t.inputFiles()
        if files:
            folder = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(files[0])).getParent()
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def spare_prefix(columns: Sequence[str]) -> str:
    """How no column's name begins, for names beside them."""
    prefix = "__"
    while any(c.lower().startswith(prefix) for c in columns):
        prefix += "_"
    return prefix


def set_aside(docs: DataFrame, results: Sequence[str], prefix: str) -> tuple[DataFrame, dict[str, str]]:
    """The table with the columns that are named as a result renamed, and every column's name by its former one."""
    names = {c: prefix + c if c.lower() in results else c for c in docs.columns}
    return docs.withColumnsRenamed({c: n for c, n in names.items() if c != n}), names


def with_running_start(
    df: DataFrame, group: Sequence[str], bucket: str, order: Sequence[str | Column], value: Column, out: str
) -> DataFrame:
    """Add the sum of ``value`` over the rows before each row, per ``group`` in the order of (``bucket``, ``order``).

    Two levels, so that a group of any size is spread over many tasks: sums per (group, bucket) are accumulated over
    the buckets, and inside a bucket rows are accumulated as usual. ``bucket`` must be monotone in the order.
    """
    valued = df.withColumn("__v", value)
    per_bucket = valued.groupBy(*group, bucket).agg(F.sum("__v").alias("__sum"))
    earlier = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = per_bucket.select(
        *(F.col(c).alias(f"__g{i}") for i, c in enumerate(group)),
        F.col(bucket).alias("__b"),
        F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__start"),
    )
    inside = Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = valued.withColumn("__before", F.coalesce(F.sum("__v").over(inside), F.lit(0)))
    same = F.col(bucket).eqNullSafe(F.col("__b"))
    for i, c in enumerate(group):
        same = same & F.col(c).eqNullSafe(F.col(f"__g{i}"))
    joined = rows.join(starts, same, "inner").withColumn(out, F.col("__start") + F.col("__before"))
    return joined.select(*df.columns, out)


def only_stars(edges: DataFrame) -> bool:
    """Whether every node either has smaller neighbours, exactly one, or larger ones only."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.union(edges.select("b", F.lit(0), F.lit(1)))
    per_node = ends.groupBy("node").agg(F.max("up").alias("up"), F.sum("down").alias("down"))
    with own_shuffles(edges.sparkSession):
        return per_node.where("down > 1 or (down = 1 and up = 1)").isEmpty()


def joined_components(first: DataFrame, more: DataFrame, name: str) -> DataFrame:
    """The components of ``first``, a result of :func:`connected_components`, with the edges ``more`` added.

    Only the components that an added edge touches are worked on.
    """
    more = written(more, name)
    if more.isEmpty():
        return first
    for side in ("a", "b"):
        at = first.select(F.col("node").alias(side), "component")
        more = more.join(at, side, "left").withColumn(side, F.coalesce("component", side)).drop("component")
    over = connected_components(more.select("a", "b"), name)
    old = first.join(over.select(F.col("node").alias("component"), F.col("component").alias("__c")), "component", "left")
    known = old.select("node", F.coalesce("__c", "component").alias("component"))
    return known.union(over.join(first, "node", "left_anti"))


def connected_components(edges: DataFrame, name: str, max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node of the component of every node that has an edge.

    ``edges`` has bigint columns ``a`` and ``b``. Alternating large-star and small-star rounds: each re-hangs edges
    on the smallest neighbour, which halves the height of the trees, so few rounds are needed. The minimum per node is
    a map-side combined aggregate and the join back on a node with very many edges is one that AQE splits. Every
    round is written to the shared folder; only whether it was the last one reaches the driver.
    """
    current = written(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), name
    )
    for _ in range(max_rounds):
        if only_stars(current):
            break
        # Large star: larger neighbours of each node are hung on the smallest of the node and its neighbours.
        both = current.union(current.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("u"), F.least("a", "m").alias("m")
        )
        large = both.where("b > a").join(least, F.col("a") == F.col("u")).select(
            F.col("m").alias("a"), "b"
        )
        large = large.where("a <> b").distinct()
        # Small star: a node and its smaller neighbours are hung on the smallest of them.
        down = large.select(F.col("b").alias("u"), F.col("a").alias("v"))
        lowest = down.groupBy("u").agg(F.min("v").alias("m"))
        hung = down.join(lowest, "u")
        small = hung.select(F.col("m").alias("a"), F.col("v").alias("b")).union(
            lowest.select(F.col("m").alias("a"), F.col("u").alias("b"))
        )
        current = written(small.where("a <> b").distinct(), name)
    else:
        raise RuntimeError(f"{name}: components did not settle in {max_rounds} rounds")
    roots = current.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return roots.union(current.select(F.col("b").alias("node"), F.col("a").alias("component")))
