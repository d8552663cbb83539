"""Mix sources to target weights on a low-discrepancy schedule (DataFrame functions only).

The documents of each source, in a hashed order, form a stream of words that is read at most twice. Streams are cut
into blocks of equally many words. Slot i of the schedule goes to the source under the golden-ratio point frac(i * g)
of the cumulative targets, slots are ranked per source, and the j-th slot of a source reads the j-th block of its
stream. After any number of slots each source is within a few blocks of its share. A source that the points give fewer
slots than its target fills, as those with targets below a block often are, gets the missing ones after the last point,
so that every source's target is read to its last word, whatever the other sources' sizes.

Defined results: a null text has size 0 and is never taken; a null source is a source of its own, last in order;
repeated rows are separate documents; equal hashes are ordered by id, size and text hash, so reruns agree; an empty table gives
an empty result. Only the given column names are read, extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimloom.llm.quality import words_of
from claimloom.llm.shared import spare_prefix, with_running_start, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2
GOLDEN = 0.6180339887498949
SLOTS_PER_SOURCE = 1000
"""Blocks are small enough for this many slots per source on average ..."""
MAX_BLOCK_WORDS = 4096
"""... and never larger than this."""
CELLS = 4096
"""Equal parts of the cumulative targets in which points look up their source."""
ORDER_BITS = 12
"""Documents of a source are accumulated in this many bits' worth of ranges of their hash, each in its own task."""


def sizes(docs: DataFrame) -> DataFrame:
    """(row, doc_id, source, size, print, place): words per document, and where its hash puts it in its source's stream.

    ``row`` tells rows apart once the result is written; ``print`` is a hash of the text.
    """
    n = F.size(words_of(F.col("text"))).cast("long")
    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        "source",
        n.alias("size"),
        F.xxhash64("text").alias("print"),
        F.xxhash64("doc_id", F.lit("mix")).alias("place"),
    )


def targets(sized: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """One row per source: source_size, weight, target and ``low``, the target total of the sources before it.

    Targets share ``share`` of all words by weight. A target stops at MAX_EPOCHS times its source, and what is cut is
    reshared by weight. With sources ordered by limit per weight, the cut ones are a prefix, so the fair level follows
    from running sums. Works on one row per source.
    """
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    named = Window.partitionBy(F.lit(1)).orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    limited = per_source.withColumn("__n", F.row_number().over(named)).select(
        "source",
        "source_size",
        "__n",
        F.get(cycle, (F.col("__n") - 1) % len(weights)).alias("weight"),
        (F.col("source_size") * F.lit(float(MAX_EPOCHS))).alias("limit"),
    )
    all_ = Window.partitionBy(F.lit(1))
    by_level = all_.orderBy(F.col("limit") / F.col("weight"), "__n")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_level.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(all_) * F.lit(float(share))
    level = (total - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    levelled = limited.withColumn("__level", level)
    cut = F.col("__level") * F.col("weight") >= F.col("limit")
    first = F.struct((-F.col("limit") / F.col("weight")).alias("a"), (-F.col("__n")).alias("b"), F.col("__level").alias("l"))
    fair = F.max(F.when(~cut, first)).over(all_)["l"]
    target = F.when(cut, F.col("limit")).otherwise(fair * F.col("weight"))
    running = Window.partitionBy(F.lit(1)).orderBy("__n").rowsBetween(Window.unboundedPreceding, -1)
    return levelled.withColumn("target", target).select(
        "source",
        "source_size",
        "weight",
        "target",
        F.coalesce(F.sum("target").over(running), F.lit(0.0)).alias("low"),
        F.sum("target").over(all_).alias("total"),
        F.count("*").over(all_).alias("sources"),
    )


def block_words(total: float, sources: int) -> int:
    return max(1, min(MAX_BLOCK_WORDS, int(total // (SLOTS_PER_SOURCE * max(1, sources)))))


def schedule(of_sources: DataFrame, total: float, block: int) -> DataFrame:
    """(slot, source, block): every slot's source and which block of its stream it reads.

    Every source has the slots for all blocks of its rounded target; surplus ones read nothing.
    """
    spark = of_sources.sparkSession
    n = -int(-total // block)
    # The point of a slot in (0, 1), scaled to the cumulative targets.
    points = spark.range(0, n).select(
        F.col("id").alias("slot"), (F.pmod((F.col("id") + 0.5) * F.lit(GOLDEN), F.lit(1.0)) * F.lit(total)).alias("x")
    )
    # Sources and points meet in equal cells of the axis, which the points fill evenly.
    cell = lambda x: F.least(F.lit(CELLS - 1), F.floor(x * F.lit(CELLS / total)))
    spans = of_sources.where("target > 0").select(
        "source",
        "low",
        F.coalesce(F.lead("low").over(Window.partitionBy(F.lit(1)).orderBy("low")), F.lit(total + 1)).alias("high"),
    )
    in_cells = spans.withColumn("__cell", F.explode(F.sequence(cell(F.col("low")), cell(F.col("high")))))
    placed = points.withColumn("__cell", cell(F.col("x"))).join(in_cells, "__cell").where("low <= x and x < high")
    flat = placed.select("slot", "source", F.shiftright("slot", 16).alias("__range"))
    ranked = written(with_running_start(flat, ["source"], "__range", ["slot"], F.lit(1), "block").drop("__range"), "mix-slots")
    have = ranked.groupBy(F.col("source").alias("__source")).agg(F.count("*").alias("have"))
    need = F.expr(f"(cast(round(target) as long) + {block - 1}) div {block}")
    short = of_sources.join(have, F.col("source").eqNullSafe(F.col("__source")), "left")
    short = short.select("source", F.coalesce("have", F.lit(0)).cast("long").alias("have"), need.alias("need"))
    missing = short.where("have < need").select("source", F.explode(F.expr("sequence(have, need - 1)")).alias("block"))
    # A source's points are off its share by a few slots only, so this is a few rows per source.
    late = Window.partitionBy(F.lit(1)).orderBy("block", F.col("source").asc_nulls_last())
    added = missing.select((F.row_number().over(late) + F.lit(n - 1)).cast("long").alias("slot"), "source", "block")
    return ranked.select("slot", "source", "block").unionByName(added)


def stream(sized: DataFrame) -> DataFrame:
    """Add ``start``: the words of the documents before this one in its source's hashed order."""
    ranged = sized.withColumn("__range", F.shiftright("place", 64 - ORDER_BITS))
    order = ["place", F.col("doc_id").asc_nulls_last(), "size", "print"]
    return with_running_start(ranged, ["source"], "__range", order, F.col("size"), "start").drop("__range")


def mix(docs: DataFrame) -> DataFrame:
    """One row per document: row, doc_id, source, size, print, source_size, target, taken, first_slot.

    ``taken`` counts the words that the schedule's slots read from the document, both passes together.
    """
    sized = written(sizes(docs), "mix-sizes")
    of_sources = written(targets(sized), "mix-targets")
    totals = of_sources.agg(F.max("total"), F.max("sources")).first()
    if not totals[0]:
        none = {"source_size": F.col("size"), "target": F.lit(0.0), "taken": F.col("size")}
        return sized.withColumns(none | {"first_slot": F.lit(None).cast("long")}).drop("place")
    block = block_words(float(totals[0]), int(totals[1]))
    slots = schedule(of_sources, float(totals[0]), block)
    placed = written(stream(sized), "mix-stream")
    known = of_sources.select(F.col("source").alias("__source"), "source_size", "target")
    rows = placed.join(known, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    # The pieces of a document in the blocks of both passes over its stream, up to the target.
    passes = rows.where("size > 0").withColumn("__pass", F.explode(F.sequence(F.lit(0), F.lit(MAX_EPOCHS - 1))))
    begin = F.col("start") + F.col("__pass") * F.col("source_size")
    pieces = (
        passes.withColumn("__begin", begin)
        .withColumn("__end", F.least(F.col("__begin") + F.col("size"), F.round("target").cast("long")))
        .where("__begin < __end")
        .withColumn("__block", F.explode(F.expr(f"sequence(__begin div {block}, (__end - 1) div {block})")))
    )
    words = F.least(F.col("__end"), (F.col("__block") + 1) * block) - F.greatest(
        F.col("__begin"), F.col("__block") * block
    )
    read = pieces.select("row", F.col("source").alias("__s"), "__block", words.alias("__words")).join(
        slots.select(F.col("source").alias("__t"), F.col("block").alias("__read"), "slot"),
        F.col("__s").eqNullSafe(F.col("__t")) & (F.col("__block") == F.col("__read")),
    )
    taken = read.groupBy("row").agg(F.sum("__words").alias("taken"), F.min("slot").alias("first_slot"))
    return rows.join(taken, "row", "left").select(
        "row",
        "doc_id",
        "source",
        "size",
        "print",
        "source_size",
        "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        "first_slot",
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents of the mix, each as often as the schedule reads at least half of it; the columns of the input.

    Slots cut streams inside documents; only the last document of a source's stream is affected, and it is taken
    whole or not at all.
    """
    copies = F.expr("(2 * taken + size) div (2 * size)")
    per_text = mix(docs).where("size > 0").groupBy("doc_id", "print").agg(F.array_sort(F.collect_list(copies)).alias("__n"))
    p = spare_prefix(docs.columns)
    id_, print_, key, each, times, copy = (p + n for n in ("id", "print", "key", "each", "times", "copy"))
    keyed = docs.withColumns({id_: F.col("doc_id"), print_: F.xxhash64("text")})
    same = F.col(id_).eqNullSafe(F.col(f"{key}.doc_id")) & (F.col(print_) == F.col(f"{key}.print"))
    found = keyed.join(per_text.select(F.struct("doc_id", "print").alias(key), F.col("__n").alias(each)), same)
    # Repeated rows share a list with one entry each.
    nth = F.row_number().over(Window.partitionBy(id_, print_).orderBy(print_))
    read = found.withColumn(times, F.element_at(each, nth)).where(F.col(times) > 0)
    copies = read.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times).cast("int"))))
    return copies.select(*(F.col(f"`{c}`") for c in docs.columns))
