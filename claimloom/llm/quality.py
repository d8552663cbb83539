"""Line-first quality rules (DataFrame functions only).

Every line is judged first, by its ending, as navigation and as boilerplate. Failing lines are removed, and a document
that loses too large a share of its words this way, or fails the base rules, is rejected.

Defined results: a null or empty text has no words and is rejected (fewer than ten words); blank lines are neither
judged nor removed; repeated rows are judged alike, each for itself; an empty table gives an empty result. All columns
of the input are kept; results are added under the names below, replacing input columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.llm.shared import WORD_SEPARATORS, set_aside, spare_prefix

MAX_LOST_SHARE = 0.5
"""A document losing more than this share of its words with its failing lines is rejected."""

WINDOW = 5
"""Words per window of the repetition rule."""

CLOSERS = " \t\r\v\f\"')]}»”’*_"
"""Skipped at the end of a line before its last character is judged."""

ENDINGS = [".", "!", "?", ":", ";", ",", "…", "。", "！", "？", "।", "؟", "۔"]

SEPARATORS = ["|", "»", "›", "•", "·", ">", "::"]
"""Words that stand between the entries of a navigation bar."""

NAVIGATION = (
    r"(?i)^\W*(home|menu|log ?in|sign ?(in|up)|register|next|previous|back|search|share|site ?map|contact( us)?|"
    r"about( us)?|read more|click here|skip to (main )?content|back to top|follow us)\W*$"
)

BOILERPLATE = (
    r"(?i)(all rights reserved|privacy policy|terms (of (use|service)|and conditions)|we use cookies|accept cookies|"
    r"enable javascript|javascript is (disabled|required)|subscribe to our newsletter|lorem ipsum)"
)
BOILERPLATE_WORDS = 30
"""Boilerplate phrases count against a line only up to this many words; a longer one is prose about them."""


def words_of(text: Column) -> Column:
    """The words of a text: runs of other characters than white space; none for a null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_SEPARATORS, -1), "")


def line_fails(line: Column) -> Column:
    """Whether a line is judged bad; blank lines are not."""
    end = F.right(F.rtrim(line, F.lit(CLOSERS)), F.lit(1))
    words = words_of(line)
    bars = F.size(F.filter(words, lambda w: w.isin(SEPARATORS)))
    many_bars = (bars >= 2) & (bars * 5 >= F.size(words))
    boilerplate = line.rlike(BOILERPLATE) & (F.size(words) <= BOILERPLATE_WORDS)
    return line.rlike(r"[^\x20\x09-\x0D]") & (~end.isin(ENDINGS) | many_bars | line.rlike(NAVIGATION) | boilerplate)


def judge(docs: DataFrame, text: str = "text", max_lost_share: float = MAX_LOST_SHARE) -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_lost_words, kept, cleaned."""
    source = F.coalesce(F.col(text), F.lit(""))
    base = [c for c in docs.columns if c.lower() not in RESULTS]
    keep = [F.col(f"`{c}`") for c in base]
    prefix = spare_prefix(docs.columns)
    words_, lines_, full_, bad_, hashes_, win_, pairs_, at_ = (
        prefix + n for n in ("words", "lines", "full", "bad", "hashes", "win", "pairs", "at")
    )
    split = docs.select(
        *keep,
        words_of(F.col(text)).alias(words_),
        F.split(source, "\n", -1).alias(lines_),
        F.length(F.regexp_replace(source, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
    )
    counted = split.select(
        *keep,
        "n_symbols",
        lines_,
        F.size(words_).cast("long").alias("n_words"),
        F.length(F.array_join(words_, "")).cast("long").alias("word_chars"),
        F.filter(lines_, lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias(full_),
        F.filter(lines_, line_fails).alias(bad_),
        F.transform(words_, lambda w: F.xxhash64(w)).alias(hashes_),
    )
    # Windows of five words as hashes; collisions could only matter inside one document, at 2^-64 a pair.
    windows = F.transform(
        F.sequence(F.lit(0), F.col("n_words").cast("int") - WINDOW),
        lambda i: F.xxhash64(*(F.get(hashes_, i + k) for k in range(WINDOW))),
    )
    windowed = counted.select(
        *keep,
        "n_symbols",
        "n_words",
        "word_chars",
        lines_,
        bad_,
        (F.size(full_) - F.size(F.array_distinct(full_))).cast("long").alias("n_dup_lines"),
        F.when(F.col("n_words") >= WINDOW, windows).otherwise(F.array().cast("array<bigint>")).alias(win_),
    )
    # Only texts with a repeated window sort their windows, to find the places of those that repeat.
    repeats = F.size(F.array_distinct(win_)) < F.size(win_)
    pairs = F.array_sort(F.transform(win_, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    sorted_ = windowed.withColumn(pairs_, F.when(repeats, pairs)).drop(win_)
    twice = F.filter(
        pairs_,
        lambda p, j: F.coalesce(F.get(pairs_, j - 1)["h"] == p["h"], F.lit(False))
        | F.coalesce(F.get(pairs_, j + 1)["h"] == p["h"], F.lit(False)),
    )
    places = sorted_.withColumn(at_, F.array_sort(F.transform(twice, lambda p: p["i"]))).drop(pairs_)
    covered = F.transform(
        at_, lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(at_, j + 1) - p, F.lit(WINDOW)))
    )
    lost = F.aggregate(bad_, F.lit(0), lambda n, x: n + F.size(words_of(x)))
    measured = places.select(
        *keep,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        F.coalesce(F.aggregate(covered, F.lit(0), lambda n, x: n + x), F.lit(0)).cast("long").alias("n_repeat_words"),
        lost.cast("long").alias("n_lost_words"),
        F.when(F.size(bad_) == 0, F.col(f"`{text}`"))
        .otherwise(F.array_join(F.filter(lines_, lambda x: ~line_fails(x)), "\n"))
        .alias("cleaned"),
    )
    failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    judged = measured.withColumn("base_failed", failed)
    return judged.withColumn("kept", ~failed & (F.col("n_lost_words") <= F.col("n_words") * F.lit(max_lost_share)))


RESULTS = [
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "base_failed",
    "n_lost_words",
    "kept",
    "cleaned",
]


def clean(docs: DataFrame) -> DataFrame:
    """The documents that are kept, without their failing lines; the columns of the input, whatever their names.
    ``n_chars``, if there is such a column, is counted anew where lines are gone."""
    p = spare_prefix(docs.columns)
    given, names = set_aside(docs, RESULTS, p)
    # A generator, not a filter: the optimizer would copy the rules into a filter below every step of the judgement.
    kept = judge(given).withColumn(f"{p}once", F.explode(F.when(F.col("kept"), F.array(F.lit(True)))))
    new = {"text": F.col("cleaned")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("n_lost_words") == 0, F.col("n_chars")).otherwise(F.length("cleaned")).cast("long")
    return kept.select(*(new.get(c, F.col(f"`{n}`")).alias(c) for c, n in names.items()))
