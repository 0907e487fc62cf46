"""SimHash near-duplicates by segment popcounts and a grid range join.

A 64-bit fingerprint is cut into 32 segments of two bits; the bit counts of the
segments (0, 1 or 2 each) are a point on a grid. Each differing bit moves one
coordinate by at most one, so the Manhattan distance of two points is a lower
bound of the Hamming distance of the fingerprints. The coordinates are dealt
into g blocks: two points within distance d differ in at most d blocks, so they
agree in g - d of them. Every fingerprint enters one grid cell per choice of
g - d blocks, only fingerprints of one cell are compared, and a pair counts when
the Manhattan bound and then the exact bit distance hold.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.functions.frames import written
from feedloom.llm.common import free_name, lower_words, text_key
from feedloom.llm.graph import components

SEGMENTS = 32
# Two random segments agree with probability 1/16 + 1/4 + 1/16.
AGREE = 3 / 8
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint_of(words: list[bytes], shingle: int = 4) -> int:
    """The SimHash of a word sequence as a signed 64-bit number; 0 without words.

    Every shingle occurrence votes with its XXH64 (seed 42); a bit is set when
    over half of the votes set it. A shorter text is one shingle.
    """
    from xxhash import xxh64_digest

    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return int.from_bytes(xxh64_digest(joined, 42), "big", signed=True)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - shingle + 1].tolist()
    votes = [xxh64_digest(joined[a:b], 42) for a, b in zip(starts, ends[shingle - 1 :].tolist())]
    columns = np.frombuffer(b"".join(votes), np.uint8).reshape(-1, 8)
    seen = np.bincount((columns + np.arange(8) * 256).ravel(), minlength=2048).reshape(8, 256)
    bits = (seen @ _BITS).ravel() * 2 > len(votes)
    return int.from_bytes(np.packbits(bits).tobytes(), "big", signed=True)


def with_fingerprint(docs: DataFrame, text: str = "text", shingle: int = 4) -> DataFrame:
    """The rows of ``docs`` without their text, with a long column ``fingerprint``.

    Null texts have fingerprint 0 as empty ones have. ``docs`` must not have a
    column of that name. Texts are hashed one at a time, so memory follows the
    longest text of a task.
    """
    rest = [c for c in docs.columns if c != text]
    schema = docs.select(*rest).schema.add("fingerprint", "long")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint_of(lower_words(t.as_py()), shingle) for t in batch.column(text)]
            columns = [batch.column(c) for c in rest] + [pa.array(prints, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*rest, "fingerprint"])

    return docs.select(*rest, text).mapInArrow(hashed, schema)


def _popcounts(fingerprint: Column) -> Column:
    """Bit counts of the 32 two-bit segments, each in unary: 00, 01 or 11."""
    low = F.lit(0x5555555555555555)
    high = F.shiftrightunsigned(fingerprint, 1)
    both = high.bitwiseAND(fingerprint).bitwiseAND(low)
    return F.shiftleft(both, 1).bitwiseOR(high.bitwiseOR(fingerprint).bitwiseAND(low))


def _manhattan(a: Column, b: Column) -> Column:
    """Manhattan distance of two popcount points: in unary, their differing bits."""
    return F.bit_count(a.bitwiseXOR(b))


def grid_blocks(n: int, distance: int) -> int:
    """How many blocks to cut the coordinates into for n distinct fingerprints.

    More blocks mean finer cells (fewer comparisons) but more cells per
    fingerprint. Any number above ``distance`` gives the same links; of those that
    leave two blocks or more to agree, this one costs least when a
    comparison costs a fiftieth of a copied row.
    """

    def cost(g: int) -> float:
        cells = comb(g, distance)
        shared = AGREE ** (SEGMENTS * (g - distance) / g)
        return cells * (1 + n * shared / 50)

    return min(range(distance + 2, distance + 9), key=cost)


def _cells(fingerprint: str, blocks: int, distance: int) -> Column:
    """The grid cells of a fingerprint, as an array of hashes of (grid, coordinates)."""
    masks = [0] * blocks
    for s in range(SEGMENTS):
        masks[s * blocks // SEGMENTS] |= 3 << (2 * s)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    points = _popcounts(F.col(fingerprint))
    return F.array(
        *[
            F.xxhash64(F.lit(i), *[points.bitwiseAND(F.lit(signed[b])) for b in chosen])
            for i, chosen in enumerate(combinations(range(blocks), blocks - distance))
        ]
    )


def _near_by_one_bit(prints: DataFrame) -> DataFrame:
    """Links between fingerprints that share a neighbour one bit away, without pairs.

    All fingerprints within one bit of the same value are within two bits of
    each other; each is tied to the smallest of them. Dense groups of near
    copies become few components here, so the grid join need not pair them.
    """
    flips = [F.lit(0)] + [F.lit(1 << b if b < 63 else -(1 << 63)) for b in range(64)]
    around = prints.select(
        "fingerprint", F.explode(F.array(*[F.col("fingerprint").bitwiseXOR(f) for f in flips])).alias("at")
    )
    hubs = around.groupBy("at").agg(F.min("fingerprint").alias("v"), F.max("fingerprint").alias("w"))
    hubs = hubs.filter("v <> w").select("at", "v")
    # Spark sizes exploded rows like those before the explode: unhinted it would broadcast all of them
    return around.join(hubs.hint("merge"), "at").filter("fingerprint <> v").select(F.col("fingerprint").alias("u"), "v").distinct()


def linked(prints: DataFrame, distance: int = 4) -> DataFrame:
    """(fingerprint, root) for distinct fingerprints joined by links of at most ``distance`` bits.

    ``prints`` has one row per distinct ``fingerprint``. root is the smallest
    fingerprint reachable. No pair within one component of the first step is
    emitted, so a group of near copies of any size makes no square of rows.
    """
    prints = prints.select("fingerprint")
    if distance >= 2:
        first = components(_near_by_one_bit(prints))
    else:
        first = prints.limit(0).select(F.col("fingerprint").alias("node"), F.col("fingerprint").alias("root"))
    known = written(
        prints.join(first.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
            "fingerprint", F.coalesce("root", "fingerprint").alias("root")
        )
    )
    blocks = grid_blocks(prints.count(), distance)
    placed = known.select(
        "fingerprint", "root", F.explode(_cells("fingerprint", blocks, distance)).alias("cell")
    )
    a, b = placed.alias("a"), placed.alias("b")
    fa, fb = F.col("a.fingerprint"), F.col("b.fingerprint")
    pairs = a.join(
        b.hint("merge"),  # Spark sizes the cells like the fingerprints before the explode
        (F.col("a.cell") == F.col("b.cell"))
        & (fa < fb)
        & (F.col("a.root") != F.col("b.root"))
        & (_manhattan(_popcounts(fa), _popcounts(fb)) <= distance)
        & (F.bit_count(fa.bitwiseXOR(fb)) <= distance),
    )
    links = pairs.select(F.col("a.root").alias("u"), F.col("b.root").alias("v"))
    # what a join looks up is written, so that it can split a hot root
    second = written(components(links).select(F.col("node").alias("root"), F.col("root").alias("top")))
    return known.join(second, "root", "left").select(
        "fingerprint", F.coalesce("top", "root").alias("root")
    )


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", distance: int = 4, shingle: int = 4
) -> DataFrame:
    """One row per document: doc_id, fingerprint (long), component_id, root, text_key.

    component_id is the smallest id reachable over links of at most
    ``distance`` bits, the row's own id included. Texts that are null or hold
    no word have fingerprint 0 and link like any other; exact copies share a
    fingerprint and are never paired. Rows of null id get a component as well;
    it is null only when no member has an id (root, a fingerprint, always names
    the component). Repeated rows stay repeated; other columns are ignored. The
    text key tells rows of equal id apart.
    """
    slim = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), text_key(F.col(text)).alias("text_key")
    )
    prints = written(with_fingerprint(slim, "text", shingle))
    firsts = written(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first")))
    roots = written(linked(firsts, distance))
    classes = written(firsts.join(roots, "fingerprint"))
    least = written(classes.groupBy("root").agg(F.min("first").alias("component_id")))
    named = written(classes.join(least, "root").select("fingerprint", "component_id", "root"))
    return prints.join(named, "fingerprint")


def deduplicated(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", distance: int = 4, shingle: int = 4
) -> DataFrame:
    """The input rows that stay when one document of each near-duplicate group is kept.

    The row of smallest id stays (null ids last; among equal ids the smallest
    text key); of rows that agree in both any one stays. All columns are kept, whatever their names.
    """
    found = near_duplicates(docs, doc_id, text, distance, shingle)
    rank = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("i"), F.col("text_key").alias("k"))
    best = found.groupBy("root").agg(F.min(rank).alias("r"))
    key, copy, keep_id, keep_key = (free_name(docs.columns, c) for c in ("text_key", "copy", "keep_id", "keep_key"))
    best = best.select(F.col("r.i").alias(keep_id), F.col("r.k").alias(keep_key)).distinct()
    keyed = docs.withColumn(key, text_key(F.col(text)))
    kept = keyed.join(
        best, keyed[doc_id].eqNullSafe(best[keep_id]) & (keyed[key] == best[keep_key])
    ).drop(keep_id, keep_key)
    first = Window.partitionBy(doc_id, key).orderBy(key)
    return kept.withColumn(copy, F.row_number().over(first)).filter(F.col(copy) == 1).drop(key, copy)
