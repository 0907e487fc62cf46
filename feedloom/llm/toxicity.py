"""Toxicity scores from a counterfactual-regularised linear classifier.

A logistic model over the distinct words of a text (each word, and its
beginnings of three to six letters, hashed). Besides the labels it sees
counterfactuals: labelled texts with their identity terms swapped for other
terms of the same kind. A change of the score under such a swap is
penalised, so that naming a group does not by itself raise the score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import lower_words

# Terms that name a group, by kind. Terms of one kind are swapped for each other.
IDENTITY_TERMS = (
    ("women", "men"),
    ("woman", "man"),
    ("girls", "boys"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "arab"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("germans", "frenchmen", "spaniards", "poles", "turks"),
    ("immigrants", "natives", "refugees"),
    ("disabled", "blind", "deaf"),
    ("frauen", "männer"),
    ("femmes", "hommes"),
    ("mujeres", "hombres"),
)
BUCKETS = 1 << 18
_EDGES = b".,;:!?\"'()[]{}<>|#*$%&@/\\-_=+~`"
_CACHE = 200_000


def word_features(word: bytes) -> list[int]:
    """Buckets of a word: the whole word and its beginnings (by character)."""
    found = [crc32(b"=" + word) % BUCKETS]
    letters = word.decode("utf-8", "replace")
    found += [
        crc32(letters[:n].encode("utf-8", "replace"), n) % BUCKETS
        for n in range(3, min(6, len(letters)) + 1)
    ]
    return found


def text_words(text: str | None) -> set[bytes]:
    """The distinct words of a whole text, lower-case, without marks at their ends."""
    return {w.strip(_EDGES) for w in lower_words(text)} - {b""}


def features(words: set[bytes]) -> dict[int, float]:
    """How many of the words fall into each bucket."""
    seen: dict[int, float] = {}
    for word in words:
        for f in word_features(word):
            seen[f] = seen.get(f, 0.0) + 1.0
    return seen


def counterfactuals(text: str, kinds: Sequence[Sequence[str]] = IDENTITY_TERMS) -> list[str]:
    """The text with its identity terms swapped: one text per step within the kinds.

    Step k replaces each term by the k-th next of its kind, so every term meets
    every other of its kind. Empty when the text names no term.
    """
    place = {t: (kind, i) for kind in kinds for i, t in enumerate(kind)}
    either = re.compile(r"(?<!\w)(" + "|".join(map(re.escape, place)) + r")(?!\w)", re.IGNORECASE)
    named = {m.lower() for m in either.findall(text)}
    found = []
    for step in range(1, max((len(place[t][0]) for t in named if t in place), default=1)):

        def swap(m: re.Match) -> str:
            kind, i = place.get(m[0].lower(), ((m[0],), 0))
            return kind[(i + step) % len(kind)]

        swapped = either.sub(swap, text)
        if swapped != text:
            found.append(swapped)
    return found


class _Rows:
    """Sparse rows, as (row, bucket, value) triples."""

    def __init__(self, lists: list[tuple[np.ndarray, np.ndarray]], width: int):
        sizes = [len(i) for i, _ in lists]
        self.row = np.repeat(np.arange(len(lists)), sizes)
        self.at = np.concatenate([i for i, _ in lists]) if lists else np.zeros(0, np.int64)
        self.value = np.concatenate([v for _, v in lists]) if lists else np.zeros(0)
        self.n, self.width = len(lists), width

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * w[self.at], self.n)

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.at, self.value * r[self.row], self.width)


def train(
    labels: np.ndarray,
    rows: list[tuple[np.ndarray, np.ndarray]],
    swaps: list[tuple[np.ndarray, np.ndarray]],
    penalty: float = 1.0,
    decay: float = 1e-4,
    steps: int = 200,
    rate: float = 0.1,
    evidence: float = 12.0,
) -> tuple[np.ndarray, np.ndarray, float]:
    """(buckets, weights, bias) of the logistic model; deterministic.

    ``rows`` are (buckets, counts) of labelled texts, ``swaps`` are differences
    of such rows between a text and its counterfactual. The loss is the mean log loss
    with both labels weighing alike, plus ``penalty`` times the mean squared
    change of the log-odds over swaps, plus decay. Only buckets whose presence goes
    with the label by a chi-square of ``evidence`` or more have a weight, which
    keeps chance words of long texts out. With one label only, the bias says so
    and no bucket weighs.
    """
    labels = np.asarray(labels, float)
    n, positive = len(labels), float(labels.sum()) if len(labels) else 0.0
    none = np.zeros(0, np.int64), np.zeros(0)
    if positive in (0.0, float(n)):
        return *none, float(np.log((positive + 0.5) / (n - positive + 0.5)))
    none_of, all_of = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for (i, _), y in zip(rows, labels):  # buckets of a row are distinct
        all_of[i] += 1
        none_of[i] += 1 - y
    some_of = all_of - none_of
    expected = all_of * positive / n
    spread = expected * (1 - positive / n) * (n - all_of) / max(n - 1, 1)
    chi = np.divide((some_of - expected) ** 2, spread, out=np.zeros(BUCKETS), where=spread > 0)
    buckets = np.flatnonzero(chi >= evidence)
    spot = np.full(BUCKETS, -1)
    spot[buckets] = np.arange(len(buckets))

    def packed(lists):
        return _Rows([(spot[i][spot[i] >= 0], v[spot[i] >= 0]) for i, v in lists], len(buckets))

    x, d = packed(rows), packed(swaps)
    share = np.where(labels > 0, 0.5 / positive, 0.5 / (n - positive))
    w, bias = np.zeros(len(buckets)), 0.0
    # Adam on the whole batch: no order of rows enters.
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(x.dot(w) + bias, -30, 30)))
        r = (p - labels) * share
        g = x.back(r) + decay * w
        if d.n:
            g += d.back(d.dot(w)) * (2 * penalty / d.n)
        gb = float(r.sum())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        fix = 1 - 0.9**t, 1 - 0.99**t
        w -= rate * (m / fix[0]) / (np.sqrt(v / fix[1]) + 1e-8)
        bias -= rate * (mb / fix[0]) / (np.sqrt(vb / fix[1]) + 1e-8)
    return buckets, w, bias


def _training_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sparse rows of labelled texts, and of the differences their counterfactuals make."""
    for batch in batches:
        for key, text, label in zip(*[batch.column(c).to_pylist() for c in ("key", "text", "label")]):
            own = features(text_words(text))
            made = [(False, own)]
            for other in counterfactuals(text or ""):
                theirs = features(text_words(other))
                change = {f: theirs.get(f, 0.0) - own.get(f, 0.0) for f in {*own, *theirs}}
                made.append((True, {f: v for f, v in change.items() if v}))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([key] * len(made), pa.int64()),
                    pa.array([label] * len(made), pa.int32()),
                    pa.array([swap for swap, _ in made]),
                    pa.array([sorted(f) for _, f in made], pa.list_(pa.int32())),
                    pa.array([[f[i] for i in sorted(f)] for _, f in made], pa.list_(pa.float32())),
                ],
                names=["key", "label", "swap", "buckets", "counts"],
            )


def fit(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    max_rows: int = 12_000,
    penalty: float = 1.0,
) -> pd.DataFrame:
    """The model of labelled documents: a small frame (bucket, weight); bucket -1 is the bias.

    The model is fitted on a bounded sample: at most about ``max_rows`` labelled
    ids, chosen by a hash of the id, so the same ids give the same model. Their texts
    become sparse rows where they lie; one task fits them. Ids labelled twice count as toxic when
    one label says so; null ids and null labels are left out.
    """
    known = (
        labels.filter(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
        .groupBy(F.col(doc_id).alias("key"))
        .agg(F.max(F.col(label).cast("int")).alias("label"))
    )
    total = max(known.count(), 1)
    grain = 1 << 30
    chosen = known.filter(
        F.pmod(F.xxhash64(F.lit("sample"), F.col("key")), F.lit(grain)) * F.lit(total)
        < F.lit(max_rows * grain)
    )
    texts = docs.select(F.col(doc_id).alias("key"), F.col(text).alias("text"))
    # about max_rows rows of two numbers
    rows = texts.join(F.broadcast(chosen), "key").select(F.col("key").cast("long"), "text", "label")
    sparse = rows.mapInArrow(
        _training_rows,
        "key long, label int, swap boolean, buckets array<int>, counts array<float>",
    )

    def fitted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frames = list(batches)
        if not frames:
            yield pd.DataFrame({"bucket": [-1], "weight": [float(np.log(0.5 / 0.5))]})
            return
        # the order in which rows arrive differs between runs
        frame = pd.concat(frames)
        frame["size"] = frame["buckets"].map(len)
        frame = frame.sort_values(["key", "swap", "size"], kind="stable")

        def lists(part):
            return [(np.asarray(b, np.int64), np.asarray(c, float)) for b, c in zip(part.buckets, part.counts)]

        own, swaps = frame[~frame.swap], frame[frame.swap]
        at, w, bias = train(own.label.to_numpy(), lists(own), lists(swaps), penalty)
        yield pd.DataFrame({"bucket": [-1, *at], "weight": [bias, *w]})

    return sparse.repartition(1).mapInPandas(fitted, "bucket long, weight double").toPandas()


def scored(docs: DataFrame, model: pd.DataFrame, text: str = "text", score: str = "score") -> DataFrame:
    """The rows of ``docs`` without their text, with a column of scores between 0 and 1.

    Whole texts are read; null and empty texts have the score of the bias alone.
    ``docs`` must not have a column of that name. The model is a bounded number of
    weights and travels with the function.
    """
    bias = float(model.loc[model.bucket == -1, "weight"].sum())
    known = model[model.bucket >= 0]
    weights = dict(zip(known.bucket.tolist(), known.weight.tolist()))
    rest = [c for c in docs.columns if c != text]
    schema = docs.select(*rest).schema.add(score, "double")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_word: dict[bytes, float] = {}
        for batch in batches:
            scores = []
            for value in batch.column(text):
                log_odds = bias
                # sorted: sums of floats depend on their order
                found = []
                for word in text_words(value.as_py()):
                    weight = of_word.get(word)
                    if weight is None:
                        if len(of_word) >= _CACHE:
                            of_word.clear()
                        weight = sum(weights.get(f, 0.0) for f in word_features(word))
                        of_word[word] = weight
                    if weight:
                        found.append(weight)
                log_odds += sum(sorted(found))
                scores.append(1 / (1 + np.exp(-min(30.0, max(-30.0, log_odds)))))
            columns = [batch.column(c) for c in rest] + [pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*rest, score])

    return docs.select(*rest, text).mapInArrow(each, schema)


def held_out(doc_id: str, folds: int, fold: int):
    """Whether crc32 of the id as text leaves ``fold``; null ids are not held out."""
    rest = F.crc32(F.col(doc_id).cast("string")) % F.lit(folds)
    return F.coalesce(rest == fold, F.lit(False))
