"""Quality rules whose cutoffs are chosen under a proven limit of false rejections.

For every stratum, rule and cutoff of a fixed grid, labelled good documents give an
exact binomial test of "the rule rejects more than its share of good
documents". The error level is divided by the number of tests (Bonferroni), so with
probability 1 - delta all cutoffs that pass hold at once; of those, each rule
takes the one that separates the labels best, or stays off.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from math import exp, lgamma, log

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.frames import written

_SPACE = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"

# Rules: the statistic, in thousandths, and the cutoffs tried; a document above is rejected.
RULES: dict[str, tuple[str, Sequence[int]]] = {
    "symbols": ("1000 * n_symbols div n_words", (50, 100, 200, 300, 500, 750, 1000, 1500, 2000, 3000)),
    "long_words": ("1000 * word_chars div n_words", (6000, 6500, 7000, 7500, 8000, 9000, 10000, 12000)),
    "short_words": ("-1000 * word_chars div n_words", (-5000, -4500, -4000, -3500, -3000, -2500, -2000)),
    "dup_lines": ("1000 * n_dup_lines div n_lines", (50, 100, 150, 200, 300, 400, 500, 700)),
    "repeats": ("1000 * n_repeat_words div n_words", (50, 100, 150, 200, 250, 300, 400)),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def text_counts(text: str | None) -> tuple[int, ...]:
    """The counts of COUNTS for a whole text; zeros for null and empty texts."""
    if not text:
        return (0,) * len(COUNTS)
    words = text.encode("utf-8", "surrogatepass").split()
    word_chars = len(text) - sum(text.count(c) for c in _SPACE)
    symbols = sum(text.count(c) for c in _SYMBOLS)
    lines = Counter(x for x in text.split("\n") if x.strip(_SPACE))
    n_lines = sum(lines.values())
    code: dict[bytes, int] = {}
    ids = np.fromiter((code.setdefault(w, len(code)) for w in words), np.int64, len(words))
    covered = 0
    if len(ids) >= 3:
        # number the pairs, then pairs with the third word: no product overflows
        _, pair = np.unique(ids[:-1] * len(code) + ids[1:], return_inverse=True)
        _, at, n = np.unique(pair[:-1] * len(code) + ids[2:], return_inverse=True, return_counts=True)
        twice = n[at] > 1
        marks = np.zeros(len(ids), bool)
        for shift in range(3):
            marks[shift : shift + len(twice)] |= twice
        covered = int(marks.sum())
    return len(words), word_chars, symbols, n_lines - len(lines), covered, n_lines


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` without their text, with the columns of COUNTS; none may clash."""
    rest = [c for c in docs.columns if c != text]
    schema = docs.select(*rest).schema
    for c in COUNTS:
        schema = schema.add(c, "long")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [text_counts(t.as_py()) for t in batch.column(text)]
            columns = [batch.column(c) for c in rest]
            columns += [pa.array([x[i] for x in found], pa.int64()) for i in range(len(COUNTS))]
            yield pa.RecordBatch.from_arrays(columns, names=[*rest, *COUNTS])

    return docs.select(*rest, text).mapInArrow(counted, schema)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _statistic(rule: str) -> Column:
    """The rule's statistic of a document that passed the base rules (so it has words)."""
    return F.expr(RULES[rule][0])


def binomial_tail(n: int, k: int, p: float) -> float:
    """P(X <= k) for X binomial(n, p), summed from its terms."""
    if k >= n:
        return 1.0
    terms = (
        exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * log(p) + (n - i) * log(1 - p))
        for i in range(k + 1)
    )
    return min(1.0, sum(terms))


def _chosen(alpha: float, delta: float):
    """For rows (stratum, tests, rule, cutoff, n, k, bad, caught): the cutoff of each stratum and rule."""

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            share = alpha / len(RULES)
            held = [
                n > 0 and binomial_tail(int(n), int(k), share) <= delta / tests
                for n, k, tests in zip(frame.n, frame.k, frame.tests)
            ]
            yield frame[np.array(held, bool)]

    return choose


def thresholds(
    counted: DataFrame, labels: DataFrame, doc_id: str, stratum: str, label: str, alpha: float, delta: float
) -> DataFrame:
    """(stratum, rule, cutoff) of the rules that are on, at most one per stratum and rule.

    ``counted`` has the columns of COUNTS. The holdout are documents with a
    label that pass the base rules; the good ones give each rule
    a share of ``alpha`` of false rejections. Rules choose in turn: of the cutoffs that hold,
    the one with the largest difference between the shares of bad holdouts it rejects anew and
    of good ones it rejects, the higher one among equals. A rule without a positive
    difference stays off. Since all cutoffs that hold do so at once, any choice among them is safe.
    """
    known = (
        labels.filter(F.col(doc_id).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(doc_id).alias("key"))
        .agg(F.min(F.col(label).cast("int")).alias("good"))
    )
    held = counted.filter(~base_failed()).join(known, counted[doc_id] == known["key"])
    grid = [(r, c) for r, (_, cutoffs) in RULES.items() for c in cutoffs]
    # sums per stratum come from the map side: a stratum of any size is a row per task
    sums = []
    for i, (r, c) in enumerate(grid):
        over = (_statistic(r) > c).cast("long")
        sums += [F.sum(over * F.col("good")).alias(f"k{i}"), F.sum(over * (1 - F.col("good"))).alias(f"c{i}")]
    by_stratum = held.groupBy(F.col(stratum).alias("stratum")).agg(
        F.sum("good").alias("n"), F.sum(1 - F.col("good")).alias("bad"), *sums
    )
    rows = written(
        by_stratum.select(
            "stratum",
            "n",
            "bad",
            F.inline(
                F.array(
                    *[
                        F.struct(
                            F.lit(r).alias("rule"), F.lit(c).alias("cutoff"),
                            F.col(f"k{i}").alias("k"), F.col(f"c{i}").alias("caught"),
                        )
                        for i, (r, c) in enumerate(grid)
                    ]
                )
            ),
        )
    )
    tests = rows.count()
    passed = rows.withColumn("tests", F.lit(tests).cast("long")).mapInPandas(
        _chosen(alpha, delta),
        "stratum string, n long, bad long, rule string, cutoff int, k long, caught long, tests long",
    )
    passed = written(passed)
    left, chosen = held.filter("good = 0").select(F.col(stratum).alias("stratum"), *COUNTS), None
    for rule, (_, cutoffs) in RULES.items():
        over = F.array(*[F.struct(F.lit(c).alias("at"), (_statistic(rule) > c).alias("over")) for c in cutoffs])
        fresh = (
            left.select(F.col("stratum").alias("s"), F.inline(over))
            .groupBy("s", "at")
            .agg(F.count_if("over").alias("fresh"))
        )
        gain = F.col("fresh") / F.col("bad") - F.col("k") / F.col("n")
        best = (
            passed.filter(F.col("rule") == rule)
            .join(fresh, F.col("stratum").eqNullSafe(F.col("s")) & (F.col("cutoff") == F.col("at")))
            .filter((F.col("fresh") > 0) & (gain > 0))
            .groupBy("stratum", "rule")
            .agg(F.max(F.struct(gain.alias("gain"), "cutoff")).alias("b"))
        )
        best = written(best.select("stratum", "rule", "b.cutoff"))
        found = best.select(F.col("stratum").alias("s"), "cutoff")
        left = (
            left.join(found, F.col("stratum").eqNullSafe(F.col("s")), "left")
            .filter(F.col("cutoff").isNull() | (_statistic(rule) <= F.col("cutoff")))
            .drop("s", "cutoff")
        )
        chosen = best if chosen is None else chosen.union(best)
    return chosen


def judged(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    stratum: str = "lang",
    label: str = "quality",
    alpha: float = 0.05,
    delta: float = 0.05,
) -> DataFrame:
    """doc_id, stratum, COUNTS, base_failed, rejected_by (a rule or null) and kept, per row.

    A document is kept when it passes the base rules and no rule that is on in its
    stratum rejects it. With probability 1 - ``delta`` over the labels, the rules together reject at
    most ``alpha`` of the good documents of each stratum. Null strata are a stratum;
    strata or rules with too few labels for a proof have no cutoff and reject nothing.
    Null and empty texts fail the base rules; repeated rows are judged alike.
    Ids labelled twice count as good only when all labels say so.
    """
    slim = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(stratum).cast("string").alias("stratum"), F.col(text).alias("text")
    )
    counted = written(with_counts(slim))
    cutoffs = thresholds(
        counted, labels.withColumnRenamed(doc_id, "doc_id"), "doc_id", "stratum", label, alpha, delta
    )
    # one row per stratum
    wide = written(
        cutoffs.groupBy("stratum").pivot("rule", list(RULES)).agg(F.min("cutoff"))
    ).withColumnRenamed("stratum", "s")
    rejects = [
        F.when(~F.col("base_failed") & (_statistic(r) > F.col(r)), F.lit(r)) for r in RULES
    ]
    return (
        counted.withColumn("base_failed", base_failed())
        .join(wide, F.col("stratum").eqNullSafe(F.col("s")), "left")
        .withColumn("rejected_by", F.coalesce(*rejects))
        .select(
            "doc_id", "stratum", *COUNTS, "base_failed", "rejected_by",
            (~F.col("base_failed") & F.col("rejected_by").isNull()).alias("kept"),
        )
    )
