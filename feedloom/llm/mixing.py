"""Mixing sources to target weights by systematic sampling. DataFrame functions only.

Within a source every document has the same expected number of copies, target
over size. Expected copies are whole numbers of 2**-24 so that prefix sums are
exact; a document is emitted once per whole number that its stretch of the
prefix sum, moved by the source's one random offset, steps over.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import lcm

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.functions.frames import written
from feedloom.llm.common import free_name, word_count

# One expected copy, in units of the prefix sum.
UNIT = 1 << 24


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: int = 2
) -> DataFrame:
    """(source, source_size, target) of a table (source, source_size), one row per source.

    Sources in code point order, null last, take the weights in turn and share
    ``share`` of all sizes by weight. No target exceeds ``most`` times its source's
    size; what is above goes to the others by weight until none is above. With sources in
    order of limit per weight that ends at the first one whose part of the rest
    is below its limit. The windows run over the list of sources, not over documents.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    whole = lcm(*weights)

    def in_turn(values: Sequence[int]) -> Column:
        at = F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1
        return F.element_at(F.array(*[F.lit(v) for v in values]), at.cast("int"))

    listed = sizes.withColumn("place", F.row_number().over(by_name)).withColumns(
        {
            "weight": in_turn(weights),
            "top": F.col("source_size") * F.lit(most),
            # Limit per weight in whole numbers, so that no rounding decides the order.
            "limit": F.col("source_size") * in_turn([whole // w for w in weights]),
        }
    )
    order = ["limit", "place"]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    level = (
        F.sum("source_size").over(everything) * F.lit(float(share))
        - F.coalesce(F.sum("top").over(before), F.lit(0)).cast("double")
    ) / F.sum("weight").over(after).cast("double")
    stepped = listed.withColumn("level", level).withColumn(
        "below", F.col("level") * F.col("weight") <= F.col("top")
    )
    # The first level that its source stays below holds for all that follow.
    held = stepped.withColumn(
        "final", F.first(F.when(F.col("below"), F.col("level")), True).over(everything)
    )
    target = F.when(
        F.col("final").isNotNull() & (F.col("final") * F.col("weight") <= F.col("top")),
        F.col("final") * F.col("weight"),
    ).otherwise(F.col("top").cast("double"))
    return held.select("source", "source_size", target.alias("target"))


def _offset(source: Column, seed: int) -> Column:
    """The source's random offset below UNIT: six hex digits of a keyed hash."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("="), source), F.lit("-")))
    return F.conv(F.substring(F.md5(name), 1, 6), 16, 10).cast("long")


def mixed(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    most: int = 2,
    seed: int = 42,
    keep_text: bool = True,
) -> DataFrame:
    """The input rows with size, source_size, target and copies (0 to ``most``) appended.

    Size is the number of words (null and empty texts: 0). Documents of a source are
    taken in order of size, then of a hash of the id: stepping through the
    sizes keeps the words taken within about one document's size of the
    target. A source without words has target 0 and no copies. Repeated rows
    are separate documents, null ids are like any id, null sources are one source.
    Columns of the input that are named like an appended one are replaced.
    A source of any share of the rows is numbered chunk by chunk: rows are
    sorted within (source, size, two hex digits of the hash), and running sums over
    the far fewer chunks and then sizes supply what comes before.
    """
    own = ("hash", "tile", "at", "before", "lower", "step", "move", "in_source", "in_size", "in_tile")
    n = {x: free_name(docs.columns, f"mix_{x}") for x in own}
    added = ("size", "source_size", "target", "copies")
    rest = [c for c in docs.columns if c not in added]
    rows = docs.select(
        *rest,
        word_count(F.col(text)).alias("size"),
        F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("-"))).alias(n["hash"]),
    ).withColumn(n["tile"], F.substring(n["hash"], 1, 2))
    if not keep_text:  # small rows: written once, instead of counting the words twice
        rest.remove(text)
        rows = written(rows.drop(text))

    # Sizes of chunks: all that the offsets need.
    tiles = written(
        rows.select(F.col(source).alias("source"), "size", n["tile"])
        .groupBy("source", "size", n["tile"])
        .agg(F.count("*").alias("n"))
    )
    sizes = tiles.groupBy("source", "size").agg(F.sum("n").alias("n"))
    totals = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = source_targets(totals, weights, share, most)
    along = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    inside = (
        Window.partitionBy("source", "size")
        .orderBy(n["tile"])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    lower = sizes.select(
        F.col("source").alias("s"),
        F.col("size").alias("z"),
        F.coalesce(F.sum("n").over(along), F.lit(0)).alias(n["lower"]),
    )
    step = F.when(
        F.col("source_size") > 0, F.round(F.col("target") / F.col("source_size") * F.lit(UNIT))
    ).otherwise(F.lit(0))
    steps = targets.select(
        F.col("source").alias("t"),
        F.col("source_size").alias("source_size"),
        "target",
        step.cast("long").alias(n["step"]),
        _offset(F.col("source"), seed).alias(n["move"]),
    )
    chunks = (
        tiles.withColumn(n["before"], F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .join(lower, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")))
        .join(steps, F.col("source").eqNullSafe(F.col("t")))
        .select(
            F.col("source").alias(n["in_source"]),
            F.col("size").alias(n["in_size"]),
            F.col(n["tile"]).alias(n["in_tile"]),
            (F.col(n["before"]) + F.col(n["lower"])).alias(n["before"]),
            "source_size",
            "target",
            n["step"],
            n["move"],
        )
    )
    chunk = Window.partitionBy(source, "size", n["tile"]).orderBy(n["hash"], F.col(doc_id))
    numbered = rows.withColumn(n["at"], F.row_number().over(chunk).cast("long"))
    end = (F.col(n["before"]) + F.col(n["at"])) * F.col(n["step"]) + F.col(n["move"])
    copies = F.floor(end / F.lit(UNIT)) - F.floor((end - F.col(n["step"])) / F.lit(UNIT))
    return (
        numbered.join(
            chunks,
            F.col(source).eqNullSafe(F.col(n["in_source"]))
            & (numbered["size"] == F.col(n["in_size"]))
            & (numbered[n["tile"]] == F.col(n["in_tile"])),
        )
        .withColumn("copies", copies.cast("int"))
        .select(*rest, *added)
    )


def emitted(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row as often as it was drawn, with ``copy`` counting from 1."""
    found = mixed(docs, **options)
    copy = free_name(found.columns, "copy")
    drawn = found.filter(F.col("copies") > 0)
    return drawn.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col("copies"))))
