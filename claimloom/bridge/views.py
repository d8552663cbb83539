"""Raw text tables derived from the test data, whole tables in, faults seeded by key.

``lineitem`` plays the claims, reversals and price history, ``orders`` the lookups, ``supplier`` the pharmacies; the
partners are the order priorities and the market segments of the customers. Nothing is left out: what must not match is
made faulty. ``oracle.py`` states the same views in SQL.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.operators.joins import attach, parts_for
from claimloom.sources.arrays import CORRUPT

# Terms as they arrive, by the first character of a partner's name; others have none.
FLAT_FEES = {"1": "100", "5": "0", "A": "1.7", "B": " ", "H": "none"}
FEE_SHARES = {"2": "50.0", "3": "20", "F": "n/a", "H": "12.5"}
NO_PARTNER = "4-NOT SPECIFIED"
PIVOT_COLUMNS = {
    "1-URGENT": "p1_urgent",
    "2-HIGH": "p2_high",
    "3-MEDIUM": "p3_medium",
    "direct": "direct",
    "unknown": "unknown",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(rows: DataFrame, *by: str) -> DataFrame:
    """The rows dealt to all cores where the files are not: a test table may be one file with one row group, which one
    task would read and parse. Files whose rows are in enough parts are read as they are, without a shuffle.

    Rows are dealt by the hash of ``by``: a round-robin deal sorts whole rows first, in the one task that reads them.
    The parts grow in number with the files, eight to a split, so that their size does not.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    splits = rows.rdd.getNumPartitions()
    # How many splits hold rows is told by the footers, no column is read.
    if splits >= cores and rows.groupBy(F.spark_partition_id()).count().count() >= cores:
        return rows
    return rows.repartition(max(cores, 8 * splits if splits >= cores else 0), *by)


def _every(key: str, n: int) -> Column:
    return F.col(key) % n == 0


def _code(key: Column) -> Column:
    return F.lpad(key.cast("string"), 11, "0")


def _text(number: Column) -> Column:
    return number.cast("string")


def _cents_text(number: Column) -> Column:
    return _text(F.round(number * 100) / 100)


def _claim_id() -> Column:
    return F.concat_ws("-", "l_orderkey", "l_linenumber")


def claims(lineitem: DataFrame) -> DataFrame:
    quantity = F.col("l_quantity")
    return lineitem.select(
        _claim_id().alias("id"),
        _text(F.col("l_suppkey")).alias("npi"),
        F.when(~_every("l_suppkey", 71), _code(F.col("l_partkey"))).alias("ndc"),
        F.when(_every("l_partkey", 97), "one hundred").otherwise(_text(F.col("l_extendedprice"))).alias("price"),
        _text(F.when(_every("l_partkey", 89), -quantity).otherwise(quantity)).alias("quantity"),
        _cents_text(F.col("l_extendedprice") * F.col("l_tax")).alias("pbm_fee"),
        F.when(_every("l_orderkey", 83), "2025-02-31T27:61:00")
        .otherwise(_text(F.col("l_shipdate")))
        .alias("timestamp"),
        F.lit("lineitem").alias("_source_file"),
    )


def reverts(lineitem: DataFrame) -> DataFrame:
    reverted_at = F.timestamp_add("HOUR", F.col("l_partkey") % 700, F.col("l_shipdate"))
    return lineitem.where("l_returnflag = 'R'").select(
        F.concat(F.lit("R-"), _claim_id()).alias("id"),
        F.when(_every("l_partkey", 103), "  ").otherwise(_claim_id()).alias("claim_id"),
        F.when(_every("l_orderkey", 101), "not-a-date").otherwise(_text(reverted_at)).alias("timestamp"),
        F.lit("lineitem").alias("_source_file"),
    )


def lookups(orders: DataFrame) -> DataFrame:
    order = _text(F.col("o_orderkey"))
    channel = F.when(F.col("o_orderstatus") == "F", "integration").when(F.col("o_orderstatus") == "O", "website")
    fields = {
        "id": order,
        "claim_id": F.when(F.col("o_orderstatus") == "F", F.concat(order, F.lit("-1"))),
        "ndc": F.when(_every("o_orderkey", 107), "").otherwise(_code(F.col("o_custkey"))),
        "partner": F.when(F.col("o_orderpriority") != NO_PARTNER, F.col("o_orderpriority")),
        "channel": F.when(_every("o_orderkey", 113), " ").otherwise(channel.otherwise(" APP ")),
        "timestamp": F.when(_every("o_orderkey", 109), "not-a-date").otherwise(_text(F.col("o_orderdate"))),
    }
    # A record that breaks off has no field, only its text.
    broken = _every("o_orderkey", 131)
    return orders.select(
        *(F.when(~broken, value).alias(name) for name, value in fields.items()),
        F.lit("orders").alias("_source_file"),
        F.when(broken, F.concat(F.lit('{"id": "'), order, F.lit('", "ndc": '))).alias(CORRUPT),
    )


def pharmacies(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Suppliers; every tenth has a blank npi, some have a blank chain, some a second line under another name."""
    regions = region.withColumnRenamed("r_regionkey", "n_regionkey")
    places = attach(nation, regions, "n_regionkey", "inner", reference=True)
    by_nation = places.withColumnRenamed("n_nationkey", "s_nationkey")
    sites = attach(supplier, by_nation, "s_nationkey", "inner", reference=True)
    first = F.when(_every("s_suppkey", 17), " ").otherwise(F.col("r_name"))
    lines = F.when(_every("s_suppkey", 7), F.array(first, F.col("n_name"))).otherwise(F.array(first))
    return sites.select(
        F.when(_every("s_suppkey", 10), "  ").otherwise(_text(F.col("s_suppkey"))).alias("npi"),
        F.explode(lines).alias("chain"),
        F.lit("supplier").alias("_source_file"),
    )


def partners(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Every order priority and every market segment, with terms that are flat, shares, blank, unreadable or missing."""
    names = orders.select(F.col("o_orderpriority").alias("partner")).union(customer.select("c_mktsegment")).distinct()

    def by_initial(terms: Mapping[str, str]) -> Column:
        return F.create_map(*(F.lit(x) for pair in terms.items() for x in pair))[F.left("partner", F.lit(1))]

    return names.select(
        "partner",
        by_initial(FLAT_FEES).alias("fee_cents"),
        by_initial(FEE_SHARES).alias("fee_percentage"),
        F.lit("terms").alias("_source_file"),
    )


def price_history(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """A dated price per line item; every tenth item has no readable date, some no readable rate."""
    rate = F.round(F.col("l_extendedprice") / F.col("l_quantity") * 100) / 100
    named = attach(
        lineitem.withColumnRenamed("l_partkey", "p_partkey"), part.select("p_partkey", "p_name"), "p_partkey"
    )
    key = F.col("p_partkey")
    unit = (
        F.when(_every("p_partkey", 41), "0").when(_every("p_partkey", 43), "n/a").otherwise(_text(rate))
    )
    return named.select(
        _code(key).alias("ndc"),
        F.col("p_name").alias("ndc_description"),
        unit.alias("unit_price"),
        F.when(_every("p_partkey", 10), "on request")
        .otherwise(F.date_format(F.trunc("l_shipdate", "month"), "MM/dd/yyyy"))
        .alias("effective_date"),
        F.date_format(F.col("l_shipdate").cast("date"), "M/d/yyyy").alias("as_of_date"),
        F.when(key % 2 == 0, " ea").otherwise("Ml").alias("pricing_unit"),
        F.when(key % 3 == 0, "b").when(key % 3 == 1, "G").otherwise("").alias("classification"),
        F.when(key % 4 == 0, "y").otherwise("N").alias("otc"),
        F.when(_every("p_partkey", 6), _cents_text(rate * 0.4)).alias("generic_unit_price"),
    )


class RawTables(Mapping[str, DataFrame]):
    """The six raw tables; a test table is opened when a raw table over it is first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        def source(name: str) -> Callable[[], DataFrame]:
            return cache(lambda: table(spark, sf_dir, name))

        lineitem = self._lineitem = source("lineitem")
        # Each is dealt by columns that it reads anyway.
        by_line = cache(lambda: dealt(lineitem(), "l_orderkey", "l_linenumber"))
        orders = source("orders")
        part = source("part")
        supplier, nation, region = source("supplier"), source("nation"), source("region")
        customer = source("customer")
        self._build = {
            "claims": cache(lambda: claims(by_line())),
            "reverts": cache(lambda: reverts(by_line())),
            "lookups": cache(lambda: lookups(dealt(orders(), "o_orderkey"))),
            "pharmacies": cache(lambda: pharmacies(supplier(), nation(), region())),
            "partners": cache(lambda: partners(orders(), customer())),
            "price_history": cache(lambda: price_history(dealt(lineitem(), "l_partkey", "l_shipdate"), part())),
        }

    def parts(self) -> int:
        """The parts of the batch, by the rows of the line items as their footers tell them."""
        lineitem = self._lineitem()
        return parts_for(lineitem.count(), int(lineitem.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def __getitem__(self, name: str) -> DataFrame:
        return self._build[name]()

    def __iter__(self) -> Iterator[str]:
        return iter(self._build)

    def __len__(self) -> int:
        return len(self._build)
