"""Repeated runs of lines, found by prefix doubling over line ids. DataFrame functions only.

Every line with a word is a symbol (its id), every document a sequence of
them, every position the start of a suffix. Round k gives suffixes a name that
two of them share when they start with the same 2**k lines: the name of a
pair (own name, name of the suffix 2**(k-1) lines on) is the smallest member of its
group. A name stands for the longest-common-prefix interval of the suffix array
at that depth; the order of suffixes inside the array is never needed, so it is not
made. Intervals of one suffix repeat nothing and drop out.

A maximal repeated run of at least ``min_words`` words is the union of the
shortest stretches of ``min_words`` words in it that start or end at its lines. A
stretch of m lines is named by two overlapping names of the largest
2**k <= m. So no more rounds are needed than the logarithm of ``min_words``, and
the later members of each stretch's interval are the later copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.functions.frames import written
from feedloom.llm.common import free_name, text_key, word_count

_SPACE = " \t\n\x0b\x0c\r"
_DOC = ["d", "k"]


def _doc_key(doc_id: str, text: str) -> list[Column]:
    """A document's id (null: the largest, so that it comes last) and the hash of its text."""
    last = F.lit(2**63 - 1)
    return [F.coalesce(F.col(doc_id).cast("long"), last).alias("d"), text_key(F.col(text)).alias("k")]


def line_table(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per line that has a word: document (d, k), line number, id (h, g), words.

    Lines are cut at \\n, numbered from 0, and alike when they agree without white space at
    their ends; the id is a 128-bit hash. Rows that agree in id and text are one document.
    """
    lines = docs.select(
        *_doc_key(doc_id, text), F.posexplode(F.split(F.col(text), "\n")).alias("line", "content")
    ).select(
        *_DOC,
        "line",
        F.btrim("content", F.lit(_SPACE)).alias("content"),
        word_count(F.col("content")).alias("words"),
    )
    hashes = [F.xxhash64("content"), F.xxhash64(F.lit("second"), "content")]
    return lines.filter("words > 0").select(
        *_DOC, "line", hashes[0].alias("h"), hashes[1].alias("g"), "words"
    )


def _placed(lines: DataFrame) -> DataFrame:
    """Lines with their place in the document and the name of their id; written once.

    pos: place among the document's lines; ahead: words before it; lone: lines
    before it whose id occurs once; above: line number of the one before; name:
    the interval of suffixes that start with this line, null where there is one only.
    """
    # Rows of equal id and text are one document: their lines are the same, one of each stays.
    one = lines.groupBy(*_DOC, "line").agg(*[F.first(c).alias(c) for c in ("h", "g", "words")])
    base = written(one.withColumn("sid", F.monotonically_increasing_id()))
    shared = base.groupBy("h", "g").agg(F.min("sid").alias("name"), F.count("*").alias("n"))
    # Written, so that the join reads the lines by themselves and can split a hot id.
    shared = written(shared.filter("n > 1").select("h", "g", "name"))
    order = Window.partitionBy(*_DOC).orderBy("line")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    lone = F.sum(F.col("name").isNull().cast("long")).over(before)
    return written(
        base.join(shared, ["h", "g"], "left").select(
            *_DOC,
            "sid",
            "name",
            "line",
            "words",
            F.row_number().over(order).cast("long").alias("pos"),
            F.coalesce(F.sum("words").over(before), F.lit(0)).alias("ahead"),
            F.coalesce(lone, F.lit(0)).alias("lone"),
            F.lag("line").over(order).alias("above"),
        )
    )


def _stretches(lines: DataFrame, min_words: int) -> DataFrame:
    """Shortest stretches of ``min_words`` words that start or end at a line.

    Only those all of whose lines occur elsewhere too: (d, k, s, e, first_line,
    last_line, level), from place s to e, level the logarithm of its lines. Starts
    and questions are sorted together in a document, so each answer is
    one running last value: forward, the next start at ``ahead + min_words`` or
    beyond; backward, the last one far enough ahead of the line's end.
    """
    marks = F.array(
        F.struct(F.lit(0).alias("kind"), F.col("ahead").alias("at")),
        F.struct(F.lit(1).alias("kind"), (F.col("ahead") + min_words).alias("at")),
        F.struct(F.lit(2).alias("kind"), (F.col("ahead") + F.col("words") - min_words).alias("at")),
    )
    asked = lines.select("*", F.explode(marks).alias("q")).select("*", "q.kind", "q.at").drop("q")
    asked = asked.filter("kind = 0 or name is not null")
    start = F.when(F.col("kind") == 0, F.struct("pos", "lone", "line", "above"))
    up = Window.partitionBy(*_DOC).orderBy("at", "kind")
    down = Window.partitionBy(*_DOC).orderBy(F.desc("at"), "kind")
    running = (Window.unboundedPreceding, Window.currentRow)
    end = F.struct(
        F.col("line"),
        F.col("pos"),
        (F.col("ahead") + F.col("words")).alias("total"),
        (F.col("lone") + F.col("name").isNull().cast("long")).alias("lone"),
    )
    found = asked.select(
        "*",
        F.last(start, True).over(up.rowsBetween(*running)).alias("low"),
        F.last(start, True).over(down.rowsBetween(*running)).alias("high"),
        F.max(end).over(Window.partitionBy(*_DOC)).alias("end"),
    )
    far = F.col("high").isNotNull()
    forward = found.filter("kind = 1 and (high is not null or end.total >= at)").select(
        *_DOC,
        F.col("pos").alias("s"),
        F.when(far, F.col("high.pos") - 1).otherwise(F.col("end.pos")).alias("e"),
        F.col("line").alias("first_line"),
        F.when(far, F.col("high.above")).otherwise(F.col("end.line")).alias("last_line"),
        (F.when(far, F.col("high.lone")).otherwise(F.col("end.lone")) - F.col("lone")).alias("lone"),
    )
    back = found.filter("kind = 2 and low is not null").select(
        *_DOC,
        F.col("low.pos").alias("s"),
        F.col("pos").alias("e"),
        F.col("low.line").alias("first_line"),
        F.col("line").alias("last_line"),
        (F.col("lone") - F.col("low.lone")).alias("lone"),
    )
    level = F.floor(F.log2((F.col("e") - F.col("s") + 1).cast("double"))).cast("int")
    return forward.union(back).filter("lone = 0").drop("lone").distinct().withColumn("level", level)


def _doubled(names: DataFrame, step: int) -> DataFrame:
    """Names of twice as many lines: of suffixes that share them with another one."""
    there = Window.partitionBy(*_DOC).orderBy("pos").rangeBetween(step, step)
    pairs = written(names.withColumn("then", F.first("name").over(there)).filter("then is not null"))
    groups = pairs.groupBy("name", "then").agg(F.min("sid").alias("new"), F.count("*").alias("n"))
    groups = written(groups.filter("n > 1").drop("n"))
    return pairs.join(groups, ["name", "then"]).select(*_DOC, "pos", "sid", F.col("new").alias("name"))


def repeated_runs(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = 50
) -> DataFrame:
    """Spans of lines to delete: (d, k, first_line, last_line), disjoint and not adjacent.

    d and k are the document's id and text key. A line is deleted when it lies
    in a run of lines, of ``min_words`` words or more, that occurs
    earlier: in a document of smaller id (null last; among equal ids by text key), or
    further up in the same one. Lines without a word belong to no run; they go
    when the nearest lines with words on both sides go. Null and empty texts have no lines.
    """
    lines = _placed(line_table(docs, doc_id, text))
    stretches = written(_stretches(lines, min_words))
    deepest = stretches.agg(F.max("level")).first()[0]
    if deepest is None:
        return stretches.select(*_DOC, "first_line", "last_line")
    names = lines.filter("name is not null").select(*_DOC, "pos", "sid", "name")
    keyed = None
    for level in range(deepest + 1):
        if level:
            still = stretches.filter(F.col("level") >= level).select(*_DOC).distinct()
            names = written(_doubled(names.join(still, _DOC, "left_semi"), 1 << (level - 1)))
        own = names.select(*_DOC, F.col("pos").alias("s"), F.col("name").alias("n1"))
        # names are a row per line in small files: Spark would send them to the driver as a table to look up
        part = stretches.filter(F.col("level") == level).join(own.hint("merge"), [*_DOC, "s"])
        if level:
            rest = names.select(*_DOC, F.col("pos").alias("t"), F.col("name").alias("n2"))
            part = part.withColumn("t", F.col("e") - ((1 << level) - 1)).join(rest.hint("merge"), [*_DOC, "t"])
        else:
            part = part.withColumn("n2", F.col("n1"))
        part = part.select(
            *_DOC, "s", "e", "first_line", "last_line", (F.col("e") - F.col("s")).alias("m"), "n1", "n2"
        )
        keyed = part if keyed is None else keyed.union(part)
    key = ["m", "n1", "n2"]
    keyed = written(keyed)
    place = F.struct(*_DOC, "s")
    intervals = keyed.groupBy(*key).agg(F.min(place).alias("earliest"), F.count("*").alias("n"))
    repeated = written(intervals.filter("n > 1").drop("n"))
    later = keyed.join(repeated, key).filter(place != F.col("earliest"))
    return _merged(later.select(*_DOC, "s", "e", "first_line", "last_line"))


def _merged(spans: DataFrame) -> DataFrame:
    """Unions of spans of places that overlap or follow each other, within documents."""
    order = Window.partitionBy(*_DOC).orderBy("s", "e")
    upto = F.max("e").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = spans.withColumn("new", (F.col("s") > F.coalesce(upto, F.lit(-1)) + 1).cast("int"))
    opened = opened.withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return opened.groupBy(*_DOC, "run").agg(
        F.min("first_line").alias("first_line"), F.max("last_line").alias("last_line")
    ).drop("run")


def without_repeats(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_words: int = 50,
    removed: str = "removed_lines",
) -> DataFrame:
    """The input rows with later copies of repeated runs deleted, and the number of lines that went.

    All rows and columns stay; a text of which every line goes becomes empty,
    a null text stays null. ``docs`` must not have a column named like ``removed``.
    """
    spans = repeated_runs(docs, doc_id, text, min_words)
    # a document's spans: bounded by its lines
    span = F.sort_array(F.collect_list(F.struct("first_line", "last_line")))
    d, k, d2, k2, found = (free_name(docs.columns, c) for c in ("d", "k", "d2", "k2", "spans"))
    listed = spans.groupBy(*_DOC).agg(span.alias(found)).withColumnsRenamed({"d": d2, "k": k2})
    own = docs.select("*", *[c.alias(n) for c, n in zip(_doc_key(doc_id, text), (d, k))])
    joined = own.join(listed, (F.col(d) == F.col(d2)) & (F.col(k) == F.col(k2)), "left")
    lines, found = F.split(F.col(text), "\n"), F.col(found)
    n = F.size(found)

    def kept_before(i: Column) -> Column:
        """The lines between the span before the i-th and the i-th; after the last for i = n."""
        start = F.when(i == 0, 0).otherwise(F.get(found, i - 1)["last_line"] + 1)
        stop = F.when(i == n, F.size(lines)).otherwise(F.get(found, i)["first_line"])
        return F.slice(lines, start + 1, stop - start)

    kept = F.flatten(F.transform(F.sequence(F.lit(0), n), kept_before))
    gone = F.aggregate(found, F.lit(0), lambda a, x: a + x["last_line"] - x["first_line"] + 1)
    left = F.when(found.isNull(), F.col(text)).otherwise(F.array_join(kept, "\n")).alias(text)
    shown = [left if c == text else F.col(c) for c in docs.columns]
    return joined.select(*shown, F.coalesce(gone, F.lit(0)).alias(removed))
