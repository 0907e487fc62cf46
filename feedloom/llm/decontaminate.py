"""Benchmark decontamination by greedy string tiling.

Seeds are runs of five tokens that a document shares with a benchmark item, or the whole
item where it is shorter. The tokens around seeds are kept, pairs of documents and items that share seeds are
joined, and each pair is tiled: the longest unmarked match first, found by
running Karp-Rabin over windows of falling length. The share of the item's tokens under tiles
does not depend on their order, so reordered passages are caught.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.functions.frames import written
from feedloom.llm.common import free_name, text_key

# Scripts written without spaces: Thai to Lao, Myanmar, Khmer, kana, ideographs.
_UNSPACED = (
    "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3041-\u30ff\u3400-\u4dbf\u4e00-\u9fff"
    "\uf900-\ufaff\U00020000-\U0003ffff"
)
_TOKEN = re.compile(r"\w+")
_TOKEN_OR_CHARACTER = re.compile(rf"[^\W{_UNSPACED}]+|\w")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_CACHE = 400_000


def tokens(text: str | None) -> list[str]:
    """Lower-case runs of letters, digits and underscores; none for null.

    In scripts without spaces every character is a token.
    """
    if not text:
        return []
    return (_TOKEN if text.isascii() else _TOKEN_OR_CHARACTER).findall(text.lower())


class _Codes(dict):
    """64-bit codes of tokens, kept for the ones seen lately."""

    def __missing__(self, token: str) -> int:
        from xxhash import xxh64_intdigest

        if len(self) >= _CACHE:
            self.clear()
        self[token] = code = xxh64_intdigest(token.encode("utf-8", "surrogatepass"))
        return code


def window_hashes(codes: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hashes modulo 2**64 of all windows of ``length`` codes."""
    n = len(codes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    found = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(length):
            found = found * _BASE + codes[i : i + n]
        # spread into the low bits, which the filter reads
        return found ^ (found >> np.uint64(29))


def _coded(words: list[str], codes: _Codes) -> np.ndarray:
    return np.fromiter(map(codes.__getitem__, words), np.uint64, len(words))


def tiles(item: Sequence[str], text: Sequence[str | None], least: int = 5) -> list[tuple[int, int, int]]:
    """Greedy tiles (place in item, place in text, length) of ``least`` tokens or more.

    None in ``text`` matches nothing; it parts pieces. No token is in two tiles. The
    longest match of unmarked tokens is taken first, the leftmost in the
    item and then in the text among equals.
    """
    used_i, used_t = [False] * len(item), [t is None for t in text]
    code: dict[str, int] = {}
    a = [code.setdefault(x, len(code) + 1) for x in item]
    b = [0 if x is None else code.get(x, -1) for x in text]
    prime, base = (1 << 61) - 1, 1_000_003

    def rolling(values: list[int], used: list[bool], s: int) -> Iterator[tuple[int, int]]:
        """(place, hash) of windows of s unmarked tokens."""
        top, h, run = pow(base, s, prime), 0, 0
        for i, v in enumerate(values):
            if used[i]:
                h, run = 0, 0
                continue
            h, run = (h * base + v + 2) % prime, run + 1
            if run > s:
                h = (h - (values[i - s] + 2) * top) % prime
            if run >= s:
                yield i - s + 1, h

    def scan(s: int) -> list[tuple[int, int, int]]:
        """Longest match from each pair of equal windows of length s."""
        at: dict[int, list[int]] = {}
        for j, h in rolling(b, used_t, s):
            at.setdefault(h, []).append(j)
        found = []
        for i, h in rolling(a, used_i, s):
            for j in at.get(h, ()):
                if i and j and a[i - 1] == b[j - 1] and not used_i[i - 1] and not used_t[j - 1]:
                    continue  # part of a match that began further left
                k = 0
                while (
                    i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k]
                    and not used_i[i + k] and not used_t[j + k]
                ):
                    k += 1
                if k >= s:
                    found.append((i, j, k))
        return found

    laid: list[tuple[int, int, int]] = []
    s = max(least, len(a))
    while s >= least:
        found = scan(s)
        if not found:
            # nothing as long as s: halve, but never pass the least length by
            s = max(least, s // 2) if s > least else least - 1
            continue
        longest = max(k for _, _, k in found)
        if longest > s:
            s = longest
        for i, j, k in sorted(found):
            if k == longest and not any(used_i[i : i + k]) and not any(used_t[j : j + k]):
                used_i[i : i + k] = used_t[j : j + k] = [True] * k
                laid.append((i, j, k))
    return laid


def _item_seeds(items: DataFrame, item_id: str, text: str, least: int) -> DataFrame:
    """(item, n, words, size, seeds): tokens of benchmark items that have any, and hashes of their windows.

    Windows have ``least`` tokens, or as many as the item where it has fewer: ``size``.
    """

    def seeded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = _Codes()
        for batch in batches:
            rows = [(i, tokens(t)) for i, t in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist())]
            rows = [(i, w, min(least, len(w))) for i, w in rows if w]
            hashes = [window_hashes(_coded(w, codes), size).view(np.int64).tolist() for _, w, size in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([i for i, _, _ in rows], pa.int64()),
                    pa.array([len(w) for _, w, _ in rows], pa.int32()),
                    pa.array([w for _, w, _ in rows], pa.list_(pa.string())),
                    pa.array([size for _, _, size in rows], pa.int32()),
                    pa.array(hashes, pa.list_(pa.int64())),
                ],
                names=["item", "n", "words", "size", "seeds"],
            )

    return items.select(F.col(item_id).cast("long").alias("item"), F.col(text).alias("text")).mapInArrow(
        seeded, "item long, n int, words array<string>, size int, seeds array<long>"
    )


def _filters(prepared: DataFrame, filter_bits: int | None) -> dict[int, np.ndarray]:
    """For each length of windows, which low hash bits its seeds have: one byte per value.

    Without ``filter_bits`` there are 16 values or more per seed, but no more than 2**24.
    """
    if filter_bits is None:
        n = prepared.agg(F.sum(F.size("seeds"))).first()[0] or 0
        filter_bits = min(24, max(20, (16 * n).bit_length()))
    used = prepared.select("size", F.explode("seeds").alias("seed"))
    slot = F.col("seed").bitwiseAND(F.lit((1 << filter_bits) - 1)).cast("int")
    found: dict[int, np.ndarray] = {}
    # at most 2**filter_bits numbers per length
    for size, at in used.select("size", slot.alias("slot")).distinct().toLocalIterator():
        found.setdefault(size, np.zeros(1 << filter_bits, bool))[at] = True
    return found


def _covered(docs: DataFrame, filters: dict[int, np.ndarray]) -> DataFrame:
    """Longest pieces of documents all of whose tokens are in windows that pass: (d, k, piece, words, seeds).

    The filters let all seeds of the benchmark through, and some others, which the join drops.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = _Codes()
        for batch in batches:
            out: list[tuple] = []
            for d, k, text in zip(*[batch.column(c) for c in ("d", "k", "text")]):
                words = tokens(text.as_py())
                coded = _coded(words, codes)
                edges, passed = np.zeros(len(words) + 1, np.int32), []
                for size, slots in filters.items():
                    hashes = window_hashes(coded, size)
                    hits = np.flatnonzero(slots[(hashes & np.uint64(len(slots) - 1)).astype(np.int64)])
                    edges[hits] += 1
                    edges[hits + size] -= 1
                    passed.append((hits, hashes[hits]))
                inside = np.concatenate(([0], np.cumsum(edges) > 0)).astype(np.int8)
                turns = np.flatnonzero(np.diff(inside))
                if not len(turns):
                    continue
                starts, places = turns[::2], np.concatenate([hits for hits, _ in passed])
                order = np.argsort(places, kind="stable")
                seeds = np.concatenate([hashes for _, hashes in passed])[order].view(np.int64)
                cuts = np.searchsorted(places[order], starts[1:])
                for number, (a, b, own) in enumerate(zip(starts, turns[1::2], np.split(seeds, cuts))):
                    out.append((d.as_py(), k.as_py(), number, words[a:b], own.tolist()))
            columns = list(zip(*out)) if out else [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds)], names=["d", "k", "piece", "words", "seeds"]
            )

    return docs.mapInArrow(pieces, "d long, k long, piece int, words array<string>, seeds array<long>")


def _tiled(least: int):
    def tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = []
            for item, pieces in zip(batch.column("words"), batch.column("pieces")):
                text: list[str | None] = []
                for piece in pieces.as_py():
                    text += [*piece["text"], None]
                words = item.as_py()
                lengths = [k for _, _, k in tiles(words, text, min(least, len(words)))]
                sums.append((sum(lengths), len(lengths), max(lengths, default=0)))
            columns = [batch.column(c) for c in ("d", "k", "item", "n")]
            columns += [pa.array([s[i] for s in sums], pa.int32()) for i in range(3)]
            names = ["d", "k", "item", "n", "covered", "tiles", "longest"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return tiled


def leaks(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    least: int = 5,
    coverage: float = 0.5,
    filter_bits: int | None = None,
) -> DataFrame:
    """Pairs of documents and benchmark items whose tiles cover ``coverage`` of the item or more.

    Columns: doc_id, text_key, item_id, item_tokens, covered_tokens, tiles,
    longest_tile, coverage. Items of fewer than ``least`` tokens match as a whole only;
    null and empty texts have no tokens and match nothing. Rows of equal id and text are
    one document, items of equal id are taken apart by their text. Null ids are kept.
    Documents meet items through a filter of 2**filter_bits bytes, by default as many as the
    seeds ask for up to 16 million, and a join on seeds. A pair is tiled only when its
    shared seeds can cover enough of the item: c seeds cover ``least * c`` tokens at most.
    """
    prepared = written(_item_seeds(items, item_id, item_text, least).distinct())
    filters = _filters(prepared, filter_bits)
    if not filters:
        docs = docs.limit(0)
    slim = docs.select(
        F.col(doc_id).cast("long").alias("d"), text_key(F.col(text)).alias("k"), F.col(text).alias("text")
    )
    pieces = _covered(slim.filter(F.col("text").isNotNull()), filters)
    pieces = written(pieces.dropDuplicates(["d", "k", "piece"]))

    item = F.struct("item", "words").alias("i")
    seeds = prepared.select(item, "n", F.explode("seeds").alias("seed")).groupBy("i", "n", "seed").agg(
        F.count("*").cast("int").alias("times")
    )
    asked = pieces.select("d", "k", F.explode(F.array_distinct("seeds")).alias("seed")).distinct()
    pairs = (
        asked.join(seeds, "seed")
        .groupBy("d", "k", "i", "n")
        .agg(F.sum("times").alias("shared"))
        .filter(F.col("shared") * F.lit(least) >= F.lit(coverage) * F.col("n"))
    )
    told = pieces.groupBy("d", "k").agg(
        # one document's own pieces
        F.sort_array(F.collect_list(F.struct("piece", F.col("words").alias("text")))).alias("pieces")
    )
    given = pairs.join(told, pairs["d"].eqNullSafe(told["d"]) & (pairs["k"] == told["k"])).select(
        pairs["d"], pairs["k"], "i.item", "n", "i.words", "pieces"
    )
    found = given.mapInArrow(
        _tiled(least), "d long, k long, item long, n int, covered int, tiles int, longest int"
    )
    share = F.col("covered") / F.col("n")
    return found.filter(share >= coverage).select(
        F.col("d").alias("doc_id"),
        F.col("k").alias("text_key"),
        F.col("item").alias("item_id"),
        F.col("n").alias("item_tokens"),
        F.col("covered").alias("covered_tokens"),
        "tiles",
        F.col("longest").alias("longest_tile"),
        share.alias("coverage"),
    )


def without_leaks(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **options
) -> DataFrame:
    """The input rows that hold no benchmark item, by ``leaks``."""
    found = written(
        leaks(docs, items, doc_id, text, **options)
        .select(F.col("doc_id").alias("_leak_id"), F.col("text_key").alias("_leak_key"))
        .distinct()
    )
    key = free_name(docs.columns, "text_key")
    keyed = docs.withColumn(key, text_key(F.col(text)))
    return keyed.join(
        found,
        keyed[doc_id].eqNullSafe(found["_leak_id"]) & (keyed[key] == found["_leak_key"]),
        "left_anti",
    ).drop(key)
