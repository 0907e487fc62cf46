"""DataFrame helpers: ranks, quantiles and joins that hold when one key is very hot."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Only for sessions in local mode that name no shared folder; removed when Python ends.
_LOCAL_FOLDERS: dict[SparkSession, tempfile.TemporaryDirectory] = {}


def top_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank"
) -> DataFrame:
    """First n rows of each group with their rank.

    The filter on row_number lets Spark cut every group to n rows before the
    shuffle, so a hot group sends n rows per input partition.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= n)


def merged(df: DataFrame) -> DataFrame:
    """The side of a join that may be large though its files are small: it is shuffled, not sent through the driver.

    Spark sizes rows by the bytes of their files, or as before an explode; rows per user and item lie in
    files of a byte or two a row, and take fifty in the table that a broadcast makes of them.
    """
    return df.hint("merge")


def _fans(sizes: DataFrame, on: Sequence[str], rows_per_task: int, name: str) -> DataFrame:
    """Every key of over rows_per_task rows and the number of pieces to deal it into.

    Written, so that Spark knows the size and broadcasts the table while its size
    check allows: one row per rows_per_task rows of the log at most.
    """
    largest = sizes.filter(F.col("_n") > rows_per_task)
    return written(
        largest.select(*on, F.ceil(F.col("_n") / F.lit(rows_per_task)).cast("int").alias(name))
    )


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    rows_per_task: int = 100_000,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Inner equi-join on a many-to-many key where one key may hold much of either side.

    Rows of a hot key are dealt into pieces on the side where it is hot and
    repeated, for that key only, once per piece of the other side. Every pair of
    pieces meets in exactly one task; all other keys are joined as usual.
    ``sizes`` (the key and ``_n``) saves counting when both sides' sizes are known.
    """
    on = list(on)

    def counted(df: DataFrame) -> DataFrame:
        return df.groupBy(*on).agg(F.count("*").alias("_n")) if sizes is None else sizes

    left_fans = _fans(counted(left), on, rows_per_task, "_lf")
    right_fans = _fans(counted(right), on, rows_per_task, "_rf")

    def deal(df: DataFrame, own: str, own_salt: str, other: str, other_salt: str) -> DataFrame:
        fans = {n: F.coalesce(F.col(n), F.lit(1)) for n in ("_lf", "_rf")}
        rest = [c for c in df.columns if c not in on] or on
        return (
            df.join(left_fans, on, "left")
            .join(right_fans, on, "left")
            .withColumn(own_salt, F.pmod(F.xxhash64(*rest), fans[own]).cast("int"))
            .withColumn(other_salt, F.explode(F.sequence(F.lit(0), fans[other] - 1)))
            .drop("_lf", "_rf")
        )

    dealt_left = deal(left, "_lf", "_ls", "_rf", "_rs")
    dealt_right = deal(right, "_rf", "_rs", "_lf", "_ls")
    return dealt_left.join(merged(dealt_right), [*on, "_ls", "_rs"]).drop("_ls", "_rs")


def positions(
    df: DataFrame,
    group: Sequence[str],
    chunks: Sequence[Column],
    order: Sequence[Column],
    position: str = "position",
    size: str = "group_size",
) -> DataFrame:
    """Row number and group size without putting a whole group into one task.

    ``chunks`` are one or two expressions, coarse then fine, that do not
    decrease along ``order`` (for example ranges of the leading sort key). Rows
    are numbered inside the finest chunk; running counts over the far fewer
    chunks supply what comes before it.
    """
    group = list(group)
    levels = [f"_c{i}" for i in range(len(chunks))]
    # One struct as key: null parts compare equal, and window and join share a partitioning.
    key = F.struct(*group, *[c.alias(n) for n, c in zip(levels, chunks)])
    tagged = df.withColumn("_key", key)
    numbered = tagged.withColumn(
        "_at", F.row_number().over(Window.partitionBy("_key").orderBy(*order)).cast("long")
    )

    def offsets(sizes: DataFrame, parent: list[str], level: str) -> DataFrame:
        along = Window.partitionBy(*parent).orderBy(level)
        return sizes.withColumns(
            {
                f"_before{level}": F.sum("_n").over(along) - F.col("_n"),
                "_whole": F.sum("_n").over(Window.partitionBy(*parent)),
            }
        ).drop("_n")

    sizes = (
        tagged.groupBy("_key")
        .agg(F.count("*").alias("_n"))
        .select("_key", "_n", *[F.col("_key")[c].alias(c) for c in (*group, *levels)])
    )
    if len(levels) == 1:
        before = offsets(sizes, group, levels[0])
    else:
        coarse = sizes.groupBy(*group, levels[0]).agg(F.sum("_n").alias("_n"))
        fine = offsets(sizes, [*group, levels[0]], levels[1]).drop("_whole")
        before = _null_safe(fine, offsets(coarse, group, levels[0]), [*group, levels[0]])
    parts = [f"_before{c}" for c in levels]
    ahead = F.col("_at")
    for part in parts:
        ahead = ahead + F.col(part)
    return (
        numbered.join(merged(before.select("_key", "_whole", *parts)), "_key")
        .withColumns({position: ahead, size: F.col("_whole")})
        .drop("_key", "_at", "_whole", *parts)
    )


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join that also matches null keys."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & left[k].eqNullSafe(renamed[f"_r_{k}"])
    return left.join(renamed, on, "inner").drop(*[f"_r_{k}" for k in keys])


_SIGN, _MASK = 1 << 63, (1 << 64) - 1
_DIGIT = 16  # bits


def exact_quantiles(df: DataFrame, column: str, probabilities: Sequence[str]) -> DataFrame:
    """Exact discrete quantiles of a whole-number column, as a one-row frame q0, q1, ...

    Values are counted once. Then each quantile is narrowed down from its leading digits (of 16
    bits, after the bits that all values share): counts per next digit of the values that begin like it say
    which one it has. So no window has more than 65,536 rows per quantile, whatever the values.
    Probabilities are decimal strings, so that the rank ceil(p * n) has no rounding noise.
    Nulls do not count; without values the quantiles are null.
    """
    counts = written(
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("long").alias("v"))
        .agg(F.count("*").alias("n"))
    )
    names = [f"q{i}" for i in range(len(probabilities))]
    ends = counts.agg(F.min("v").alias("low"), F.max("v").alias("high"), F.sum("n").alias("n")).first()
    if ends["n"] is None:
        return df.sparkSession.range(1).select(*[F.lit(None).cast("long").alias(c) for c in names])
    # with the sign bit turned, digits order values like unsigned numbers
    low, high = ((end & _MASK) ^ _SIGN for end in (ends["low"], ends["high"]))
    levels = -(-(low ^ high).bit_length() // _DIGIT)
    ranks = [max(1, math.ceil(Fraction(p) * ends["n"])) for p in probabilities]
    begins = [low >> levels * _DIGIT] * len(ranks)
    turned = F.col("v").bitwiseXOR(F.lit(-_SIGN).cast("long"))
    for level in reversed(range(levels)):
        digit = F.shiftrightunsigned(turned, level * _DIGIT).bitwiseAND(F.lit((1 << _DIGIT) - 1))
        # a shift by 64 bits would be none
        beginning = F.shiftrightunsigned(turned, (level + 1) * _DIGIT) if level < 3 else F.lit(0).cast("long")
        rows = counts.select("n", digit.alias("digit"), beginning.alias("begins"))
        digits = rows.filter(F.col("begins").isin(*set(begins))).groupBy("begins", "digit").agg(F.sum("n").alias("n"))
        along = Window.partitionBy("begins").orderBy("digit")
        running = digits.select(
            "begins", "digit", (F.sum("n").over(along) - F.col("n")).alias("before"), F.sum("n").over(along).alias("upto")
        )
        asked = [
            F.struct(F.lit(i).alias("i"), F.lit(rank).cast("long").alias("rank"), F.lit(begin).cast("long").alias("own"))
            for i, (rank, begin) in enumerate(zip(ranks, begins))
        ]
        found = running.select("*", F.inline(F.array(*asked))).filter(
            (F.col("begins") == F.col("own"))
            & (F.col("before") < F.col("rank"))
            & (F.col("rank") <= F.col("upto"))
        )
        for row in found.collect():  # one row per quantile
            begins[row["i"]] = begins[row["i"]] << _DIGIT | row["digit"]
            ranks[row["i"]] -= row["before"]
    values = [begin - _SIGN for begin in begins]
    return df.sparkSession.range(1).select(*[F.lit(v).cast("long").alias(c) for c, v in zip(names, values)])


def approximate_quantiles(
    df: DataFrame, column: str, probabilities: Sequence[str], rel_error: float
) -> DataFrame:
    """One-pass quantiles with a relative rank error, as a one-row frame q0, q1, ..."""
    accuracy = max(1, round(1.0 / rel_error))
    ps = [float(p) for p in probabilities]
    sketch = df.agg(F.approx_percentile(column, ps, accuracy).alias("q"))
    return sketch.select(*[F.col("q")[i].alias(f"q{i}") for i in range(len(ps))])


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints.

    In local mode driver and executors are one process, so a folder of this
    machine will do there; a cluster must name one that all its machines see.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if spark not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[spark] = tempfile.TemporaryDirectory(prefix="feedloom-")
    return _LOCAL_FOLDERS[spark].name


# Tables written inside each open scratch block, the innermost last.
_OPEN: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the intermediate tables of a block when it ends.

    Results are read from those tables: write or collect them inside the block.
    """
    _OPEN.append([])
    try:
        yield
    finally:
        for path in _OPEN.pop():
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def written(df: DataFrame) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    For results that several later steps read: they are computed once, their
    lineage ends here, and a lost executor costs no replay. Parquet keeps
    column pruning for the readers. ``scratch`` deletes such tables.
    """
    path = f"{shared_folder(df.sparkSession)}/tables/{uuid.uuid4().hex}"
    if _OPEN:
        _OPEN[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
