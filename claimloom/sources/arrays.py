"""JSON array files read by many tasks, with damaged elements kept as text.

A JSON array has no place where a reader may start, unless one looks for it. Here the text source cuts the files after
every ``}``, which Spark can do from any byte range, so one large file is read by as many tasks as it has ranges. A
piece that is an object by itself and has an event field is an element, wherever it stands: inside of a string, the
first quote of a piece would end that string, and what follows it could not be a field name. All other pieces are few:
elements with a ``}`` in a string or an inner object, damaged ones, and the closing bracket. Runs of them are read in
the order of the file: a run starts between two elements, so where its strings and objects end is known, and each
element is put together from its pieces. What then cannot be read becomes a row of its own, with its text and the byte
it starts at; the next piece that is an element by itself ends the damage.

Events are flat objects; the text of an inner one has no spaces between its parts. Files whose elements all have inner objects are read as well, but put together in one task per
file, and an inner array whose objects carry event fields would be taken for events. An element of more than MAX_PIECES
pieces is cut into unreadable records, so that a file that is damaged from end to end doesn't meet in one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.operators.joins import attach

END = "}"
MAX_PIECES = 1000
CORRUPT = "_corrupt_record"
CORRUPT_AT = "_corrupt_at"
"""The columns of an unreadable record: its text, and the byte of the file at which it starts."""

_BEFORE = r"^[\s\[,\x{FEFF}]+"
_AFTER = r"[\s\],]+$"
# What is no quote; the rest of a string; a string, to its end or that of the text. Backslashes take the next character.
_NO_QUOTE = r'(?s)[^"\\]++|\\.|\\$'
_STRING_END = r'(?s)^[^"\\]*+(?:\\.[^"\\]*+)*+(?:"|\\?$)'
_STRING = r'(?s)"[^"\\]*+(?:\\.[^"\\]*+)*+(?:"|\\?$)'
_STRICT = {"allowSingleQuotes": "false"}
_PLACE = ["file", "block", "at"]


def pieces(spark: SparkSession, directory: str) -> DataFrame:
    """(file, block, size, at, value): the files cut after every END; ``at`` counts through the pieces of a byte range."""
    text = spark.read.option("lineSep", END).option("pathGlobFilter", "*.json").text(directory)
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("size"),
        F.monotonically_increasing_id().alias("at"),
        "value",
    )


def parsed(cut: DataFrame, schema: T.StructType) -> DataFrame:
    """Add ``element``, the piece as an object, and ``own``: whether it is an element by itself."""
    marked = T.StructType([*schema.fields, T.StructField("__bad", T.StringType())])
    body = F.concat(F.regexp_replace("value", _BEFORE, ""), F.lit(END))
    element = F.from_json(body, marked, _STRICT | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad"})
    has_field = F.coalesce(*(F.col(f"element.{f}") for f in schema.names)).isNotNull()
    own = F.col("element.__bad").isNull() & has_field & body.startswith("{")
    return cut.withColumn("element", element).withColumn("own", F.coalesce(own, F.lit(False)))


def blocks_of(spooled: DataFrame) -> DataFrame:
    """(file, block, first, last, number, start, unended): the byte ranges in order. ``start`` is the byte of the first
    piece; ``unended`` marks the last range of a file that doesn't end with END."""
    per_block = spooled.groupBy("file", "block").agg(
        F.min("at").alias("first"), F.max("at").alias("last"), F.sum("bytes").alias("__bytes"), F.max("size").alias("size")
    )
    in_file = Window.partitionBy("file").orderBy("block")
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    numbered = per_block.withColumns(
        {
            "number": F.row_number().over(in_file),
            "start": F.coalesce(F.sum("__bytes").over(before), F.lit(0)),
            "__next": F.lead("block").over(in_file),
            "__total": F.sum("__bytes").over(Window.partitionBy("file")),
        }
    )
    # Every piece was counted with an END after it, so a file without one at its end counts a byte too many. The text
    # source leaves out a byte order mark.
    mark = F.when(F.col("__total") < F.col("size"), 3).otherwise(0)
    unended = F.col("__next").isNull() & (F.col("__total") + mark > F.col("size"))
    placed = numbered.withColumns({"unended": unended, "start": F.col("start") + mark})
    return placed.drop("__bytes", "__next", "__total", "size")


def fragments(spooled: DataFrame, blocks: DataFrame) -> DataFrame:
    """(file, byte, text): runs of neighbouring pieces that are no elements by themselves, put together."""
    touched = spooled.where("value is not null").select("file", "block").distinct()
    near = spooled.join(touched, ["file", "block"], "left_semi")
    in_block = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    placed = near.withColumn("__before", F.coalesce(F.sum("bytes").over(in_block), F.lit(0)))
    rest = placed.where("value is not null").join(blocks, ["file", "block"])
    is_tail = F.col("unended") & (F.col("at") == F.col("last"))
    rest = rest.select(
        *_PLACE, "first", "last", "number", (F.col("start") + F.col("__before")).alias("byte"),
        F.when(is_tail, F.col("value")).otherwise(F.concat("value", F.lit(END))).alias("text"),
    )
    in_file = Window.partitionBy("file").orderBy("block", "at")

    def previous(c: str) -> F.Column:
        return F.lag(c).over(in_file)

    same_block = (previous("block") == F.col("block")) & (previous("at") + 1 == F.col("at"))
    over_the_cut = (
        (previous("number") + 1 == F.col("number"))
        & (previous("at") == previous("last"))
        & (F.col("at") == F.col("first"))
    )
    follows = F.coalesce(same_block | over_the_cut, F.lit(False))
    counted = rest.withColumns({"__n": F.row_number().over(in_file), "__starts": ~follows})
    run = counted.withColumn("__run", F.max(F.when(F.col("__starts"), F.col("__n"))).over(in_file))
    # A run starts between two elements, so from there on it is known where strings and objects end.
    so_far = Window.partitionBy("file", "__run").orderBy("__n").rowsBetween(Window.unboundedPreceding, 0)
    earlier = so_far.rowsBetween(Window.unboundedPreceding, -1)
    quotes = F.length(F.regexp_replace("text", _NO_QUOTE, ""))
    inside = F.coalesce(F.sum(quotes).over(earlier), F.lit(0)) % 2 == 1
    outside = F.regexp_replace(F.when(inside, F.regexp_replace("text", _STRING_END, "")).otherwise(F.col("text")), _STRING, "")
    bare = run.withColumn("__bare", outside)
    opened = F.length(F.regexp_replace("__bare", r"[^{]+", "")) - F.length(F.regexp_replace("__bare", r"[^}]+", ""))
    ends = (F.sum(opened).over(so_far) <= 0) & F.col("__bare").endswith(END)
    ended = bare.withColumn("__ends", ends.cast("int"))
    element = F.coalesce(F.sum("__ends").over(earlier), F.lit(0))
    part = ended.withColumn("__element", element)
    nth = F.row_number().over(Window.partitionBy("file", "__run", "__element").orderBy("__n"))
    part = part.withColumn("__part", F.floor((nth - 1) / MAX_PIECES))
    whole = part.groupBy("file", "__run", "__element", "__part").agg(
        F.min("byte").alias("byte"), F.array_sort(F.collect_list(F.struct("__n", "text"))).alias("__texts")
    )
    return whole.select("file", "byte", F.array_join(F.col("__texts.text"), "").alias("text"))


def read_arrays(spark: SparkSession, directory: str, schema: T.StructType, spool: str) -> DataFrame:
    """The elements of all arrays of a directory, with the columns of ``schema``, ``_source_file``, CORRUPT and CORRUPT_AT.

    ``spool`` is a folder for the places of the pieces, a few bytes for each, and the text of those that are no elements.
    """
    told = parsed(pieces(spark, directory), schema)
    narrow = told.select(
        *_PLACE, "size", "own", (F.octet_length("value") + 1).cast("long").alias("bytes"),
        F.when(~F.col("own"), F.col("value")).alias("value"),
    )
    narrow.write.mode("overwrite").parquet(spool)
    spooled = spark.read.schema(narrow.schema).parquet(spool)
    blocks = blocks_of(spooled)
    # An element that a file is cut off in looks whole if the cut comes after a value. There is one at most per file.
    tails = blocks.where("unended").select("file", "block", F.col("last").alias("at"))
    cut_off = spooled.where("own").join(tails, _PLACE, "left_semi").select(*_PLACE)
    whole = told.where("own")
    if not cut_off.isEmpty():
        whole = attach(whole, cut_off, _PLACE, "left_anti", reference=True)
        lost = told.where("own").join(tails, _PLACE, "left_semi").select(*_PLACE, F.col("value").alias("__text"))
        spooled = spooled.join(lost, _PLACE, "left").withColumn("value", F.coalesce("value", "__text")).drop("__text")
    nothing = [F.lit(None).cast("string").alias(CORRUPT), F.lit(None).cast("long").alias(CORRUPT_AT)]
    fields = [F.col(f"element.`{f}`").alias(f) for f in schema.names]
    source = F.col("file").alias("_source_file")
    good = whole.select(*fields, source, *nothing)

    text = F.regexp_replace(F.regexp_replace("text", _BEFORE, ""), _AFTER, "")
    runs = fragments(spooled, blocks).withColumn("text", text).where("text <> ''")
    listed = F.from_json(F.concat(F.lit("["), F.col("text"), F.lit("]")), T.ArrayType(schema), _STRICT)
    runs = runs.withColumn("elements", listed)
    # Text behind a bracket that ends the array would be passed over: then the array is empty.
    some = F.coalesce(F.size("elements") > 0, F.lit(False))
    unreadable = ~some | F.exists("elements", lambda e: e.isNull())
    mended = runs.where(~unreadable).select("file", F.explode("elements").alias("element")).select(*fields, source, *nothing)
    bad = runs.where(unreadable).select(
        *(F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields),
        source,
        F.col("text").alias(CORRUPT),
        F.col("byte").alias(CORRUPT_AT),
    )
    return good.unionByName(mended).unionByName(bad)
