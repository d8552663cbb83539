"""Quality classifier: a sparse ensemble of rules over statistics of a text.

Boosted trees of small depth are grown on a bounded sample of labelled rows. Every path from a root to a node is a rule,
a conjunction of bounds on statistics. A logistic model with a lasso penalty weighs the rules, and most weights become
zero. What is left is compiled into one Spark column expression over the statistics, which are SQL functions themselves:
scoring is a projection over the scan, without a shuffle and without Python.

Fitting reads SAMPLE_PER_LABEL documents per label, those with the smallest hashes of their id, chosen on narrow columns
before any text is read; the counts of all labelled documents set the weights of the two labels. Statistics are of whole
texts, for fitting and for scoring.

Defined results: a null text is an empty one; texts without words get a score as well; repeated rows are scored alike and
count once in the sample, by id; labels other than 0 and 1 teach nothing; of several labels of one id the smallest
counts; without labels of both kinds every score is the share of label 1 among the labels there are (0.5 without any);
an empty table gives an empty result; input columns other than doc_id and text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add, and_

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_PER_LABEL = 2000
"""Most documents of each label that the model is fitted on."""
TREES = 40
DEPTH = 3
SHRINKAGE = 0.3
LEAST_ROWS = 8
"""Rows on each side of a split, at least."""
BINS = 32
PENALTIES = (0.03, 0.01, 0.003, 0.001, 0.0003)
LEAST_WEIGHT = 0.005
"""Smaller weights, which no score feels, are what the steps have not quite taken to zero."""
THRESHOLD = 0.7
"""Scores from here on predict label 1."""

WORD = r"[^\x20\x09-\x0D]+"
LETTER = r"\p{L}"
CLASSES = {
    "symbols": r"#*$%&|<>{}\[\]=_~^\\/@+",
    "calls": "!?¡¿",
    "stops": ".,;:",
    "digits": r"\p{Nd}",
    "capitals": r"\p{Lu}",
    "letters": LETTER,
}
"""Characters that are counted, as the inside of a character class."""


def share(part: Column, whole: Column) -> Column:
    """The ratio as a double, 0 where there is nothing to divide by."""
    return F.coalesce(part.cast("double") / F.nullif(whole, F.lit(0)), F.lit(0.0))


def with_statistics(docs: DataFrame, text: str = "text") -> tuple[DataFrame, list[str]]:
    """The rows with one double column ``__s_*`` per statistic of the whole text, and the columns' names."""
    whole = F.coalesce(F.col(text), F.lit(""))
    cut = docs.withColumn("__t", whole).withColumn("__w", F.regexp_extract_all("__t", F.lit(f"({WORD})")))
    cut = cut.withColumn("__l", F.filter(F.split("__t", "\n"), lambda line: line.rlike(WORD)))
    n, words, lines = F.length("__t"), F.size("__w"), F.size("__l")
    counts = {c: F.length(F.regexp_replace("__t", f"[^{inside}]+", "")) for c, inside in CLASSES.items()}
    in_words = F.aggregate("__w", F.lit(0), lambda total, w: total + F.length(w))
    short = F.size(F.filter("__w", lambda w: F.length(w) <= 3))
    ended = F.size(F.filter("__l", lambda line: line.rlike(r"[.!?:\"'”»…][\x20\x09-\x0D]*$")))
    known = {
        "words": F.log1p(words.cast("double")),
        "word_length": share(in_words, words),
        "short_words": share(short, words),
        "distinct_words": share(F.size(F.array_distinct("__w")), words),
        "repeated_lines": 1.0 - share(F.size(F.array_distinct("__l")), lines),
        "words_per_line": F.log1p(share(words, lines)),
        "ended_lines": share(ended, lines),
        "symbols": share(counts["symbols"], n),
        "digits": share(counts["digits"], n),
        "capitals": share(counts["capitals"], counts["letters"]),
        "letters": share(counts["letters"], n),
        "calls": share(counts["calls"], words),
        "stops": share(counts["stops"], words),
    }
    told = cut.select(*docs.columns, *(c.alias(f"__s_{name}") for name, c in known.items()))
    return told, [f"__s_{name}" for name in known]


@dataclass(frozen=True)
class Rule:
    """A conjunction: (statistic, is it above?, threshold) each; a statistic equal to a threshold is not above it."""

    bounds: tuple[tuple[int, bool, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        return reduce(and_, (((x[:, i] > at) == above) for i, above, at in self.bounds))

    def column(self, names: Sequence[str]) -> Column:
        return reduce(and_, (F.col(names[i]) > at if above else F.col(names[i]) <= at for i, above, at in self.bounds))


@dataclass
class Model:
    names: list[str]
    rules: list[Rule]
    weights: list[float]
    intercept: float

    def score(self) -> Column:
        """The probability of label 1 as one column expression over the statistics."""
        terms = (F.when(r.column(self.names), F.lit(w)).otherwise(0.0) for r, w in zip(self.rules, self.weights))
        return 1.0 / (1.0 + F.exp(-reduce(add, terms, F.lit(self.intercept))))

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for r, w in zip(self.rules, self.weights):
            total += w * r.holds(x)
        return 1.0 / (1.0 + np.exp(-total))


def best_split(x: np.ndarray, gradient: np.ndarray, hessian: np.ndarray, cuts: list[np.ndarray]):
    """(gain, statistic, threshold) of the cut that lowers the loss most, or None."""
    total, weight = gradient.sum(), hessian.sum()
    best = None
    for i, at in enumerate(cuts):
        if not len(at):
            continue
        bins = np.searchsorted(at, x[:, i], side="left")
        rows = np.bincount(bins, minlength=len(at) + 1).cumsum()[:-1]
        g = np.bincount(bins, gradient, len(at) + 1).cumsum()[:-1]
        h = np.bincount(bins, hessian, len(at) + 1).cumsum()[:-1]
        allowed = (rows >= LEAST_ROWS) & (len(x) - rows >= LEAST_ROWS)
        gain = g * g / (h + 1e-6) + (total - g) ** 2 / (weight - h + 1e-6) - total * total / (weight + 1e-6)
        gain = np.where(allowed, gain, -1.0)
        k = int(gain.argmax())
        if gain[k] > 1e-9 and (best is None or gain[k] > best[0]):
            best = (float(gain[k]), i, float(at[k]))
    return best


def grow(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[Rule]:
    """The distinct rules of boosted trees: every path to a node but the root's."""
    cuts = []
    for i in range(x.shape[1]):
        values = np.unique(np.quantile(x[:, i], np.linspace(0, 1, BINS + 1), method="lower"))
        cuts.append((values[1:] + values[:-1]) / 2)
    margin = np.full(len(y), math.log((weight @ y) / (weight @ (1 - y))))
    rules: dict[Rule, None] = {}

    def divide(rows: np.ndarray, path: tuple, gradient: np.ndarray, hessian: np.ndarray) -> None:
        split = best_split(x[rows], gradient[rows], hessian[rows], cuts) if len(path) < DEPTH else None
        if split is None:
            margin[rows] += SHRINKAGE * gradient[rows].sum() / (hessian[rows].sum() + 1e-6)
            return
        _, i, at = split
        for above in (False, True):
            deeper = (*path, (i, above, at))
            rules.setdefault(Rule(deeper))
            divide(rows[(x[rows, i] > at) == above], deeper, gradient, hessian)

    for _ in range(TREES):
        p = 1.0 / (1.0 + np.exp(-np.clip(margin, -30, 30)))
        divide(np.arange(len(y)), (), weight * (y - p), weight * p * (1 - p))
    return list(rules)


def lasso(holds: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float, steps: int = 400):
    """Weights and intercept of the penalised logistic model, by accelerated proximal gradient steps."""
    weight = weight / weight.sum()
    w, b = np.zeros(holds.shape[1]), math.log((weight @ y) / (weight @ (1 - y)))
    ahead, ahead_b, t = w, b, 1.0
    # A quarter of the largest eigenvalue of the weighted second moments bounds the curvature.
    design = np.column_stack([holds, np.ones(len(y))])
    step = 4.0 / max(1e-12, float(np.linalg.eigvalsh(design.T @ (design * weight[:, None]))[-1]))
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(holds @ ahead + ahead_b, -30, 30)))
        slope = weight * (p - y)
        new = ahead - step * (holds.T @ slope)
        new = np.sign(new) * np.maximum(0.0, np.abs(new) - step * penalty)
        new_b = ahead_b - step * slope.sum()
        t_new = (1 + math.sqrt(1 + 4 * t * t)) / 2
        ahead, ahead_b = new + (t - 1) / t_new * (new - w), new_b + (t - 1) / t_new * (new_b - b)
        w, b, t = new, new_b, t_new
    return w, b


def fit(names: list[str], x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Model:
    """Rules on all rows; the penalty is the one that does best on every fifth row when fitted on the others."""
    rules = grow(x, y, weight)
    holds = np.column_stack([r.holds(x) for r in rules]) if rules else np.zeros((len(x), 0), bool)
    _, first = np.unique(holds, axis=1, return_index=True)  # rules that hold for the same rows count once
    first = np.sort(first)
    rules, holds = [rules[i] for i in first], holds[:, first].astype("f8")
    test = np.arange(len(y)) % 5 == 4
    if len(set(y[test])) == 2 == len(set(y[~test])):
        losses = []
        for penalty in PENALTIES:
            w, b = lasso(holds[~test], y[~test], weight[~test], penalty)
            margin = holds[test] @ w + b
            losses.append(float(weight[test] @ np.logaddexp(0, np.where(y[test] == 1, -margin, margin))))
        penalty = PENALTIES[int(np.argmin(losses))]
    else:
        penalty = PENALTIES[0]
    w, b = lasso(holds, y, weight, penalty)
    kept = np.flatnonzero(np.abs(w) > LEAST_WEIGHT)
    return Model(names, [rules[i] for i in kept], [float(w[i]) for i in kept], float(b))


def train(docs: DataFrame, labels: DataFrame, label: str, per_label: int = SAMPLE_PER_LABEL) -> Model:
    """Fit on ``docs`` (doc_id, text) that ``labels`` (doc_id, a 0/1 column) knows. Bounded by ``per_label`` texts each."""
    told = labels.select(F.col("doc_id"), F.col(label).cast("int").alias("__y")).where("doc_id is not null and __y in (0, 1)")
    told = told.groupBy("doc_id").agg(F.min("__y").alias("__y"))
    ids = docs.select("doc_id").where("doc_id is not null").distinct().join(told, "doc_id")
    known = {r["__y"]: r["n"] for r in ids.groupBy("__y").agg(F.count("*").alias("n")).collect()}
    total = sum(known.values())
    if len(known) < 2:
        only = (known.get(1, 0) + 1e-9) / (total + 1e-9) if total else 0.5
        only = min(max(only, 1e-9), 1 - 1e-9)
        return Model([], [], [], math.log(only / (1 - only)))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = [ids.where(F.col("__y") == y).orderBy(*order).limit(per_label).collect() for y in (0, 1)]
    ys = {r["doc_id"]: r["__y"] for rows in chosen for r in rows}
    sample, names = with_statistics(docs.select("doc_id", "text").where(F.col("doc_id").isin(list(ys))))
    once = sample.groupBy("doc_id").agg(F.min(F.struct(*names)).alias("__s")).select("doc_id", "__s.*")
    rows = sorted((tuple(r) for r in once.collect()), key=lambda r: (hash_order(r[0]), r[0]))
    x = np.array([r[1:] for r in rows], "f8")
    y = np.array([ys[r[0]] for r in rows], "f8")
    share_of = {v: known[v] / total / max(1, int((y == v).sum())) for v in (0, 1)}
    weight = np.array([share_of[int(v)] for v in y])
    return fit(names, x, y, weight)


def hash_order(doc_id: int) -> int:
    """A fixed mixed order of ids, so that the rows held out for the penalty are of both labels."""
    return (int(doc_id) * 0x9E3779B97F4A7C15 >> 7) & 0xFFFFFFFF


def scored(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows with ``score`` and ``predicted``, which replace columns of these names."""
    told, names = with_statistics(docs)
    kept = [F.col(c) for c in docs.columns if c not in ("score", "predicted")]
    found = told.select(*kept, model.score().alias("score"))
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
