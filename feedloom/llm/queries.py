"""The registered queries of the text operators, and their SQL where SQL can express them."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions.frames import written
from feedloom.llm import (
    conversation_trie,
    decontaminate,
    language_model,
    lines,
    mixing,
    periodic_runs,
    quality,
    simhash,
    suffix_buckets,
    surrogates,
    token_counts,
    toxicity,
    url_filters,
)
from feedloom.llm.common import word_count

# Where the rank files are on the machine that plans the job.
TOKENIZERS = os.environ.get("TOKENIZER_FILES", "/opt/tokenizers")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(f):
    QUERIES[f.__name__] = f
    return f


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_query
def op3_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, folder, "documents"))
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )


@_query
def op4_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    found = mixing.mixed(
        _table(spark, folder, "documents").select("doc_id", "text", "source"), keep_text=False
    )
    return found.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
        "copies",
    )


SQL["op4_mix_sources"] = r"""
WITH rows AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '-')) AS h
  FROM documents),
totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source IS NULL, source) AS place
  FROM rows GROUP BY source),
weighed AS (
  SELECT *, [3, 1, 2][(place - 1) % 3 + 1] AS weight, 2 * source_size AS top,
         source_size * [2, 6, 3][(place - 1) % 3 + 1] AS lim
  FROM totals),
levels AS (
  SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) * 1.5
             - CAST(coalesce(sum(top) OVER (ORDER BY lim, place
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
            / CAST(sum(weight) OVER (ORDER BY lim, place
                 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
  FROM weighed),
held AS (
  SELECT *, (SELECT level FROM levels WHERE level * weight <= top
             ORDER BY lim, place LIMIT 1) AS final
  FROM levels),
targets AS (
  SELECT source, source_size,
         CASE WHEN final IS NOT NULL AND final * weight <= top THEN final * weight
              ELSE CAST(top AS DOUBLE) END AS target
  FROM held),
steps AS (
  SELECT *, CASE WHEN source_size > 0
                 THEN CAST(round(target / source_size * 16777216) AS BIGINT) ELSE 0 END AS step,
         CAST('0x' || substr(md5('42:' || coalesce('=' || source, '-')), 1, 6) AS BIGINT) AS move
  FROM targets),
ends AS (
  SELECT r.doc_id, r.size, s.source_size, s.target, s.step,
         row_number() OVER (PARTITION BY r.source ORDER BY r.size, r.h, r.doc_id)
           * s.step + s.move AS upto
  FROM rows r JOIN steps s ON r.source IS NOT DISTINCT FROM s.source)
SELECT doc_id, size, source_size, target,
       CAST((upto // 16777216 - (upto - step) // 16777216) * size AS BIGINT) AS taken,
       CAST(upto // 16777216 - (upto - step) // 16777216 AS INTEGER) AS copies
FROM ends
"""


def _toxicity_model(spark: SparkSession, folder: str, docs: DataFrame):
    """Fitted on labels of other folds than the held-out one."""
    labels = _table(spark, folder, "labels").filter(~toxicity.held_out("doc_id", 3, 1))
    return toxicity.fit(docs, labels)


@_query
def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    found = toxicity.scored(docs, _toxicity_model(spark, folder, docs))
    return found.select(
        "doc_id",
        toxicity.held_out("doc_id", 3, 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


@_query
def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    found = lines.without_repeats(docs)
    return found.select(
        "doc_id",
        F.col("removed_lines").cast("long").alias("removed_lines"),
        F.length("text").cast("long").alias("kept_chars"),
        F.md5("text").alias("kept_md5"),
    )


# The same rule without suffix names: shortest stretches of 50 words from and to each line, compared as lists.
SQL["op6_line_dedup"] = r"""
WITH split AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS content,
         unnest(range(len(string_split(text, chr(10))))) AS line
  FROM documents),
worded AS (
  SELECT doc_id, line,
         trim(content, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS content,
         len(regexp_extract_all(content, '[^\x20\x09-\x0D]+')) AS words
  FROM split),
placed AS (
  SELECT *, row_number() OVER w AS pos,
         sum(words) OVER w - words AS ahead
  FROM worded WHERE words > 0 WINDOW w AS (PARTITION BY doc_id ORDER BY line)),
starts AS (
  SELECT a.doc_id, a.pos AS s, min(b.pos) AS e
  FROM placed a JOIN placed b ON a.doc_id = b.doc_id AND b.ahead + b.words >= a.ahead + 50
  GROUP BY 1, 2),
ends AS (
  SELECT b.doc_id, max(a.pos) AS s, b.pos AS e
  FROM placed a JOIN placed b ON a.doc_id = b.doc_id AND b.ahead + b.words >= a.ahead + 50
  GROUP BY 1, 3),
stretches AS (SELECT * FROM starts UNION SELECT * FROM ends),
spelled AS (
  SELECT t.doc_id, t.s, t.e, list(p.content ORDER BY p.pos) AS content
  FROM stretches t JOIN placed p ON p.doc_id = t.doc_id AND p.pos BETWEEN t.s AND t.e
  GROUP BY 1, 2, 3),
later AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY content ORDER BY doc_id, s) AS copy FROM spelled)
  WHERE copy > 1),
deleted AS (
  SELECT DISTINCT p.doc_id, p.line, p.pos
  FROM placed p JOIN later y ON p.doc_id = y.doc_id AND p.pos BETWEEN y.s AND y.e),
gone AS (
  SELECT doc_id, line FROM deleted
  UNION
  SELECT x.doc_id, x.line
  FROM split x JOIN deleted a ON x.doc_id = a.doc_id AND a.line < x.line
  JOIN deleted b ON b.doc_id = a.doc_id AND b.pos = a.pos + 1 AND b.line > x.line),
kept AS (
  SELECT x.doc_id, sum(CASE WHEN g.line IS NULL THEN 0 ELSE 1 END) AS removed_lines,
         coalesce(string_agg(CASE WHEN g.line IS NULL THEN x.content END, chr(10) ORDER BY x.line),
                  '') AS kept
  FROM split x LEFT JOIN gone g ON x.doc_id = g.doc_id AND x.line = g.line
  GROUP BY x.doc_id)
SELECT doc_id, CAST(removed_lines AS BIGINT) AS removed_lines,
       CAST(length(kept) AS BIGINT) AS kept_chars, md5(kept) AS kept_md5
FROM kept
"""


@_query
def op2_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return decontaminate.leaks(docs, _table(spark, folder, "benchmark")).drop("text_key")


@_query
def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = quality.judged(_table(spark, folder, "documents"), _table(spark, folder, "labels"))
    return found.drop("stratum", "n_lines")


def _quality_sql() -> str:
    rules = {r: e.replace(" div ", " // ") for r, (e, _) in quality.RULES.items()}
    # // rounds down in some versions; trunc as the engine's div does
    rules = {r: f"CAST(trunc(({a}) / ({b})) AS BIGINT)" for r, (a, b) in
             ((r, e.split(" // ")) for r, e in rules.items())}
    grid = ", ".join(f"('{r}', {c})" for r, (_, cutoffs) in quality.RULES.items() for c in cutoffs)
    case = " ".join(f"WHEN rule = '{r}' THEN {e}" for r, e in rules.items())
    first = " ".join(f"WHEN rule = '{r}' THEN {i}" for i, r in enumerate(rules))
    share = 0.05 / len(rules)
    # Rules choose in turn; each counts the bad documents that those before it leave.
    turns = "".join(
        f"""
fresh{i} AS (
  SELECT m.lang, g.cutoff, count(*) FILTER (m.statistic > g.cutoff) AS fresh
  FROM measured m JOIN known l ON l.doc_id = m.doc_id AND l.quality = 0
  JOIN (VALUES {grid}) g(rule, cutoff) ON g.rule = m.rule
  WHERE m.rule = '{r}' {f"AND m.doc_id NOT IN (SELECT doc_id FROM gone{i - 1})" if i else ""}
  GROUP BY 1, 2),
best{i} AS (
  SELECT lang, cutoff FROM (
    SELECT t.lang, t.cutoff, row_number() OVER (PARTITION BY t.lang
      ORDER BY f.fresh / t.bad - t.k / t.n DESC, t.cutoff DESC) AS place
    FROM tails t JOIN fresh{i} f ON t.lang IS NOT DISTINCT FROM f.lang AND t.cutoff = f.cutoff
    WHERE t.rule = '{r}' AND t.n > 0 AND t.k < t.n AND t.tail <= 0.05 / t.tests
      AND f.fresh > 0 AND f.fresh / t.bad - t.k / t.n > 0)
  WHERE place = 1),
gone{i} AS (
  SELECT m.doc_id FROM measured m JOIN best{i} b
    ON m.lang IS NOT DISTINCT FROM b.lang AND m.rule = '{r}' AND m.statistic > b.cutoff
  {f"UNION SELECT doc_id FROM gone{i - 1}" if i else ""}),"""
        for i, r in enumerate(rules)
    )
    return rf"""
WITH worded AS (
  SELECT doc_id, lang, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
windows AS (
  SELECT doc_id, i, w[i:i+2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM worded)),
twice AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows)
  WHERE n > 1),
repeats AS (
  SELECT doc_id, count(DISTINCT i + s) AS n_repeat_words
  FROM twice, (VALUES (0), (1), (2)) t(s) GROUP BY doc_id),
lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT x) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x FROM worded)
  WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY doc_id),
counted AS (
  SELECT d.doc_id, d.lang, len(w) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         coalesce(n_lines, 0) AS n_lines,
         len(w) < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * len(w) AS base_failed
  FROM worded d LEFT JOIN repeats r USING (doc_id) LEFT JOIN lines l USING (doc_id)),
measured AS (
  SELECT *, CASE {case} END AS statistic
  FROM counted, (SELECT DISTINCT rule FROM (VALUES {grid}) g(rule, cutoff))
  WHERE NOT base_failed),
known AS (
  SELECT doc_id, min(quality) AS quality FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
sums AS (
  SELECT m.lang, m.rule, g.cutoff, sum(l.quality) AS n, sum(1 - l.quality) AS bad,
         sum(CASE WHEN statistic > g.cutoff THEN l.quality ELSE 0 END) AS k,
         sum(CASE WHEN statistic > g.cutoff THEN 1 - l.quality ELSE 0 END) AS caught
  FROM measured m JOIN known l USING (doc_id)
  JOIN (VALUES {grid}) g(rule, cutoff) ON m.rule = g.rule
  GROUP BY 1, 2, 3),
terms AS (
  SELECT *, CAST(unnest(range(CAST(k AS BIGINT) + 1)) AS DOUBLE) AS i,
         (SELECT count(*) FROM sums) AS tests FROM sums),
tails AS (
  SELECT lang, rule, cutoff, n, bad, k, caught, tests,
         sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
                 + i * ln({share}) + (n - i) * ln(1 - {share}))) AS tail
  FROM terms GROUP BY ALL),
{turns}
best AS ({" UNION ALL ".join(f"SELECT lang, '{r}' AS rule, cutoff FROM best{i}" for i, r in enumerate(rules))}),
rejected AS (
  SELECT m.doc_id, min(CASE {first.replace('rule =', 'm.rule =')} END) AS first
  FROM measured m JOIN best b
    ON m.lang IS NOT DISTINCT FROM b.lang AND m.rule = b.rule AND m.statistic > b.cutoff
  GROUP BY m.doc_id)
SELECT c.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       {list(rules)}[first + 1] AS rejected_by, NOT base_failed AND first IS NULL AS kept
FROM counted c LEFT JOIN rejected r USING (doc_id)
"""


SQL["op9_quality_rules"] = _quality_sql()


@_query
def op7_language_model(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select(
        "doc_id",
        "text",
        toxicity.held_out("doc_id", 5, 1).alias("held_out"),
        (~toxicity.held_out("doc_id", 5, 1)).alias("training"),
    )
    return language_model.scores(docs, "training").drop("training")


@_query
def op10_pii_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return surrogates.with_surrogates(docs, key="op10")


def _number(text):
    """A number below 2**24 that SQL engines agree on."""
    return F.conv(F.substring(F.md5(text), 1, 6), 16, 10).cast("long")


def _after(days):
    return F.date_add(F.lit("2024-01-01").cast("date"), days.cast("int"))


def _drawn_entries(pages: DataFrame) -> DataFrame:
    """Dated list entries for some hosts, parent domains, folders and URLs of the pages."""
    urls = pages.select("url", url_filters.host_of(F.col("url")).alias("host")).filter("host is not null")
    hosts = urls.select("host").distinct()

    def draw(salt: str, column: str = "host"):
        return _number(F.concat(F.lit(salt), F.col(column)))

    def entry(name, kind, value, days, action):
        return F.struct(
            F.lit(name).alias("list"), F.lit(kind).alias("kind"), value.alias("value"),
            _after(days).alias("dated"), F.lit(action).alias("action"),
        )

    added = draw("1") % 200
    parent = F.regexp_replace("host", r"^[^.]*\.", "")
    own = [
        (draw("b") % 4 == 0, entry("spam", "host", F.col("host"), added, "add")),
        ((draw("b") % 4 == 0) & (draw("r") % 2 == 0), entry("spam", "host", F.col("host"), added + 40, "remove")),
        ((draw("b") % 4 == 0) & (draw("r") % 4 == 0), entry("spam", "host", F.col("host"), added + 110, "add")),
        ((draw("d") % 7 == 0) & (parent.contains(".")), entry("malware", "domain", parent, draw("2") % 300, "add")),
        ((draw("d") % 14 == 0) & (parent.contains(".")), entry("malware", "domain", parent, draw("3") % 366, "remove")),
        (draw("p") % 5 == 0, entry("adult", "folder", F.concat("host", F.lit("/en")), draw("4") % 300, "add")),
    ]
    entries = hosts.select(F.explode(F.array(*[F.when(on, e) for on, e in own])).alias("e")).filter("e is not null")
    rest = F.regexp_replace(F.regexp_replace("url", "#.*$", ""), "^[^:]*://[^/?]*", "")
    single = urls.filter(draw("u", "url") % 20 == 0).select(
        entry("takedown", "url", F.concat("host", rest), draw("5", "url") % 366, "add").alias("e")
    )
    return entries.union(single).select("e.*")


@_query
def op1_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched", _after(_number(F.concat(F.lit("f"), F.col("url"))) % 366))
    return url_filters.judged(captures, _drawn_entries(pages))


SQL["op1_url_filters"] = r"""
WITH p AS (
  SELECT page_id, url,
         nullif(rtrim(lower(regexp_extract(url,
           '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '.'), '') AS host,
         regexp_replace(regexp_replace(url, '#.*$', ''), '^[^:]*://[^/?]*', '') AS rest,
         DATE '2024-01-01' + CAST(CAST('0x' || substr(md5('f' || url), 1, 6) AS BIGINT) % 366 AS INTEGER) AS fetched
  FROM pages),
q AS (
  SELECT *, host || '/' || array_to_string(list_filter(
           string_split(regexp_replace(rest, '\?.*$', ''), '/'), lambda x: x <> ''), '/') || '/' AS place
  FROM p),
h AS (
  SELECT DISTINCT host, regexp_replace(host, '^[^.]*\.', '') AS parent,
    CAST('0x' || substr(md5('1' || host), 1, 6) AS BIGINT) AS h1,
    CAST('0x' || substr(md5('2' || host), 1, 6) AS BIGINT) AS h2,
    CAST('0x' || substr(md5('3' || host), 1, 6) AS BIGINT) AS h3,
    CAST('0x' || substr(md5('4' || host), 1, 6) AS BIGINT) AS h4,
    CAST('0x' || substr(md5('b' || host), 1, 6) AS BIGINT) AS hb,
    CAST('0x' || substr(md5('r' || host), 1, 6) AS BIGINT) AS hr,
    CAST('0x' || substr(md5('d' || host), 1, 6) AS BIGINT) AS hd,
    CAST('0x' || substr(md5('p' || host), 1, 6) AS BIGINT) AS hp
  FROM p WHERE host IS NOT NULL),
e AS (
  SELECT DISTINCT list, kind, value, DATE '2024-01-01' + CAST(days AS INTEGER) AS dated, action FROM (
    SELECT 'spam' AS list, 'host' AS kind, host AS value, h1 % 200 AS days, 'add' AS action FROM h WHERE hb % 4 = 0
    UNION ALL SELECT 'spam', 'host', host, h1 % 200 + 40, 'remove' FROM h WHERE hb % 4 = 0 AND hr % 2 = 0
    UNION ALL SELECT 'spam', 'host', host, h1 % 200 + 110, 'add' FROM h WHERE hb % 4 = 0 AND hr % 4 = 0
    UNION ALL SELECT 'malware', 'domain', parent, h2 % 300, 'add' FROM h WHERE hd % 7 = 0 AND contains(parent, '.')
    UNION ALL SELECT 'malware', 'domain', parent, h3 % 366, 'remove' FROM h WHERE hd % 14 = 0 AND contains(parent, '.')
    UNION ALL SELECT 'adult', 'folder', host || '/en', h4 % 300, 'add' FROM h WHERE hp % 5 = 0
    UNION ALL SELECT 'takedown', 'url', host || rest,
      CAST('0x' || substr(md5('5' || url), 1, 6) AS BIGINT) % 366, 'add'
      FROM p WHERE host IS NOT NULL AND CAST('0x' || substr(md5('u' || url), 1, 6) AS BIGINT) % 20 = 0)),
v AS (
  SELECT *, lead(dated) OVER (PARTITION BY list, kind, value ORDER BY dated, action DESC) AS stop FROM e),
hits AS (
  SELECT q.page_id, count(*) AS n, min(v.list) AS l
  FROM q JOIN v ON v.action = 'add' AND v.dated <= q.fetched AND (v.stop IS NULL OR q.fetched < v.stop)
    AND CASE v.kind WHEN 'host' THEN v.value = q.host
                    WHEN 'url' THEN v.value = q.host || q.rest
                    WHEN 'domain' THEN q.host = v.value OR ends_with(q.host, '.' || v.value)
                    ELSE starts_with(q.place, v.value || '/') END
  GROUP BY q.page_id)
SELECT q.page_id, q.url, q.fetched, q.host, coalesce(n, 0) AS n_entries, n IS NOT NULL AS blocked,
       l AS first_list
FROM q LEFT JOIN hits USING (page_id)
"""


@_query
def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    edits = token_counts.drawn_edits("doc_id", "text")
    ranks = token_counts.read_ranks(f"{TOKENIZERS}/byte_bpe_50k.tiktoken")
    trees = token_counts.stored_trees(docs, ranks).withColumn("edits", edits)
    return token_counts.edited_counts(trees, ranks, leaves="leaves")


def _with_periods(docs: DataFrame) -> DataFrame:
    """Texts as they are, but in every tenth document, by a hash of its id, a group of words repeats to the end."""
    space = " \t\n\x0b\x0c\r"
    words = F.split(F.btrim("text", F.lit(space)), r"[\x20\x09-\x0D]+")
    h = F.crc32(F.col("doc_id").cast("string"))
    n, g = F.size("_w"), F.expr("_h div 10")
    a = g % n
    period = F.expr("1").cast("long") + F.floor((n - F.col("_a")) / (g % 8 + 3))
    listed = docs.select("*", h.alias("_h")).withColumn(
        "_w", F.when((F.col("_h") % 10 == 0) & (word_count(F.col("text")) > 0), words)
    )
    placed = listed.withColumn("_a", a).withColumn("_p", period)
    turned = F.transform(
        F.sequence(F.lit(0).cast("long"), n.cast("long") - 1),
        lambda i: F.element_at(
            "_w", F.when(i < F.col("_a"), i + 1).otherwise(F.col("_a") + (i - F.col("_a")) % F.col("_p") + 1).cast("int")
        ),
    )
    text = F.when(F.col("_w").isNull(), F.col("text")).otherwise(F.array_join(turned, " "))
    return placed.select(*[text.alias(c) if c == "text" else F.col(c) for c in docs.columns])


@_query
def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    found = periodic_runs.periodic_runs(_with_periods(docs))
    first = F.array_sort(
        "runs",
        lambda x, y: F.when(x["length"] != y["length"], F.sign(y["length"] - x["length"]).cast("int"))
        .when(x["start"] != y["start"], F.sign(x["start"] - y["start"]).cast("int"))
        .otherwise(F.sign(x["period"] - y["period"]).cast("int")),
    )
    best = F.get(first, F.lit(0))
    line = F.transform("runs", lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[best[c].alias(c) for c in ("start", "length", "period")],
        F.expr("1000").cast("long").alias("_k"),
        F.sha2(F.array_join(F.transform(line, lambda t: F.concat(t, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select(
        "doc_id", "n_runs", "start", "length", "period",
        F.expr("_k * length div period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )


@_query
def op12_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    found = suffix_buckets.without_repeats(docs)
    return found.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "n_removed",
        "n_spans",
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def _rebuilt(turns: DataFrame) -> DataFrame:
    """Conversations that begin with some turns of every twentieth one."""
    base = turns.filter(F.col("conv_id") % 20 == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, 3).alias("lead")
    )
    h = (F.crc32(F.col("conv_id").cast("string")) % 4).cast("int")
    placed = turns.withColumn("base", F.col("conv_id") - F.col("conv_id") % 20).withColumn("h", h)
    own = F.expr("slice(turns, h + 1, greatest(size(turns) - h, 0))")
    lead = F.when(F.col("lead").isNull(), F.slice("turns", 1, 0)).otherwise(F.expr("slice(lead, 1, h)"))
    return placed.join(base, "base", "left").select("conv_id", F.concat(lead, own).alias("turns"))


@_query
def op13_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns = conversation_trie.sequences(_table(spark, folder, "conversations"))
    return conversation_trie.prefix_nodes(_rebuilt(written(turns)))


SQL["op13_conversation_trie"] = r"""
WITH own AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words,
         md5(md5(coalesce(role, '')) || md5(coalesce(text, ''))) AS said
  FROM conversations WHERE conv_id IS NOT NULL),
spelled AS (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS s FROM own),
ids AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base,
         xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)],
             list_transform(range(1, len(s) + 1), lambda i: CAST(ord(s[i]) AS BIGINT))),
           lambda c, b: list_reduce(list_concat([xor(c, b)], CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])),
             lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)),
           4294967295) % 4 AS h
  FROM spelled),
rebuilt AS (
  SELECT i.conv_id, b.pos, b.words, b.said FROM ids i JOIN own b ON b.conv_id = i.base WHERE b.pos <= i.h
  UNION ALL
  SELECT i.conv_id, o.pos, o.words, o.said FROM ids i JOIN own o ON o.conv_id = i.conv_id WHERE o.pos > i.h),
placed AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY pos) AS depth, words, said FROM rebuilt),
prefixes AS (
  SELECT conv_id, depth, words, list(said) OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM placed
  UNION ALL
  SELECT conv_id, 0, 0, [] FROM ids),
nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words
  FROM prefixes GROUP BY path, depth),
ended AS (
  SELECT path, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ends
  FROM (SELECT conv_id, path, depth, max(depth) OVER (PARTITION BY conv_id) AS last FROM prefixes)
  WHERE depth = last GROUP BY path),
below AS (
  SELECT list_slice(path, 1, depth - 1) AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
counted AS (
  SELECT n.*, coalesce(b.n_children, 0) AS n_children FROM nodes n LEFT JOIN below b ON b.path = n.path),
sums AS (
  SELECT p.path, sum((u.n_convs - 1) * u.words) AS saved_tokens,
         sum(CASE WHEN u.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves
  FROM counted u JOIN prefixes p ON p.conv_id = u.conv_id AND p.depth <= u.depth
  GROUP BY p.path)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, t.conv_id AS parent_conv_id, n.n_convs, n.n_children,
       CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens,
       sha256(coalesce(e.ends, '')) AS ends_sha256
FROM counted n JOIN sums s ON s.path = n.path
LEFT JOIN nodes t ON n.depth > 0 AND t.path = list_slice(n.path, 1, n.depth - 1)
LEFT JOIN ended e ON e.path = n.path
"""
