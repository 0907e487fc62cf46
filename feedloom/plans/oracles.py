"""The registered queries as plain SQL over the same tables.

Written independently of the Spark plans: joins and windows over whole tables,
no pre-aggregation, no pruning.
"""

from __future__ import annotations

from feedloom.functions.stopwords import ENGLISH
from feedloom.operators.segments import SEGMENT_FEATURES

def r(expr: str, digits: int = 6) -> str:
    """Round half up in double arithmetic, as the Spark side does."""
    return f"(floor(CAST({expr} AS DOUBLE) * 1e{digits} + 5e-1) / 1e{digits})"


# Named intermediate tables. Each may use the ones it lists.
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "olog": (
        (),
        """
        SELECT l_orderkey AS impression_id, o_custkey AS user_id, l_partkey AS news_id,
               CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label,
               CAST(floor(epoch(o_orderdate)) AS BIGINT) AS timestamp_unix,
               CAST(l_linenumber - 1 AS BIGINT) AS history_length
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        """,
    ),
    "elog": (
        (),
        """
        SELECT user_id * 100000 + CAST(floor(epoch_us(ts) / 86400e6) AS BIGINT) AS impression_id,
               user_id, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS news_id,
               CASE WHEN event_type IN ('click', 'purchase') THEN 1 ELSE 0 END AS label,
               ts, CAST(floor(epoch_us(ts) / 1e6) AS BIGINT) AS timestamp_unix
        FROM events
        """,
    ),
    "news": (
        (),
        """
        SELECT p_partkey AS news_id, p_type AS category, p_brand AS subcategory, p_name AS title,
               CASE WHEN p_size > 25 THEN p_name || ' ' || p_type || ' ' || p_brand
                    WHEN p_size > 20 THEN ' ' END AS abstract
        FROM part
        """,
    ),
    "packed": (
        (),
        """
        SELECT CAST(l_orderkey AS VARCHAR) AS impression_id, 'U' || o_custkey AS user_id,
               CASE WHEN l_linenumber <> 7 THEN CAST(floor(epoch(o_orderdate)) AS BIGINT) END
                   AS timestamp_unix,
               CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN ' '
                    ELSE 'N' || l_partkey || ' N' || l_suppkey END AS history,
               'N' || l_partkey || '-' || CASE WHEN l_returnflag = 'R' THEN '1' ELSE '0' END
               || ' ' || CASE l_linenumber WHEN 3 THEN 'bad' WHEN 4 THEN 'N1-' WHEN 5 THEN '-1'
                              WHEN 6 THEN 'X' || l_partkey || '-0' ELSE '' END
               || ' ' || 'N' || l_suppkey || '-'
               || CASE WHEN l_linestatus = 'F' THEN '1' ELSE '0' END AS impressions
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        """,
    ),
    "pieces": (
        ("packed",),
        """
        SELECT impression_id, user_id, timestamp_unix, history,
               unnest(string_split(impressions, ' ')) AS piece
        FROM packed
        """,
    ),
    "parsed": (
        ("pieces",),
        """
        SELECT impression_id, user_id, timestamp_unix,
               regexp_extract(piece, '^(.+)-[0-9]$', 1) AS news_id,
               CAST(regexp_extract(piece, '-([0-9])$', 1) AS BIGINT) AS label,
               CAST(CASE WHEN trim(coalesce(history, '')) = '' THEN 0
                         ELSE len(string_split(history, ' ')) END AS BIGINT) AS history_length,
               history
        FROM pieces WHERE regexp_matches(piece, '^.+-[0-9]$')
        """,
    ),
    "pnews": (("news",), "SELECT 'N' || news_id AS news_id, category FROM news"),
    "odedup": (
        ("olog",),
        """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (
                PARTITION BY user_id, news_id, impression_id
                ORDER BY timestamp_unix, label DESC, history_length) AS rn
            FROM olog) WHERE rn = 1
        """,
    ),
    "osplit": (
        ("odedup",),
        """
        SELECT d.*, CASE WHEN timestamp_unix <= b1 THEN 'train'
                         WHEN timestamp_unix <= b2 THEN 'val' ELSE 'test' END AS split
        FROM odedup d, (
            SELECT max(CASE WHEN rn = ceil(n * 0.7) THEN timestamp_unix END) AS b1,
                   max(CASE WHEN rn = ceil(n * 0.85) THEN timestamp_unix END) AS b2
            FROM (SELECT timestamp_unix, row_number() OVER (ORDER BY timestamp_unix) AS rn,
                         count(*) OVER () AS n FROM odedup)) b
        """,
    ),
    "otrain": (("osplit",), "SELECT * FROM osplit WHERE split = 'train'"),
}


def _user_features(name: str, log: str) -> dict[str, tuple[tuple[str, ...], str]]:
    """User feature tables over one log."""
    return {
        f"{name}_ustats": (
            (log,),
            f"""
            SELECT *, user_total_interactions / user_active_duration_days
                       AS user_interaction_frequency,
                   CASE WHEN user_total_clicks > 0
                        THEN user_unique_clicked_items / user_total_clicks ELSE 0 END
                       AS user_click_diversity
            FROM (
                SELECT user_id, count(*) AS user_total_interactions,
                       CAST(sum(label) AS BIGINT) AS user_total_clicks, avg(label) AS user_ctr,
                       count(DISTINCT news_id) AS user_unique_items,
                       max(timestamp_unix) AS user_last_interaction_ts,
                       min(timestamp_unix) AS user_first_interaction_ts,
                       first(history_length ORDER BY timestamp_unix DESC, history_length DESC)
                           AS user_history_length,
                       count(DISTINCT CASE WHEN label = 1 THEN news_id END)
                           AS user_unique_clicked_items,
                       greatest((max(timestamp_unix) - min(timestamp_unix)) / 86400e0, 1e0)
                           AS user_active_duration_days
                FROM {log} GROUP BY user_id)
            """,
        ),
        f"{name}_utop": (
            (log, "news"),
            f"""
            SELECT user_id, category AS user_top_category, n AS user_top_category_clicks FROM (
                SELECT user_id, category, count(*) AS n, row_number() OVER (
                    PARTITION BY user_id ORDER BY count(*) DESC, category NULLS FIRST) AS rn
                FROM {log} LEFT JOIN news USING (news_id) WHERE label = 1
                GROUP BY user_id, category) WHERE rn = 1
            """,
        ),
        f"{name}_udiv": (
            (log, "news"),
            f"""
            SELECT user_id,
                   count(DISTINCT CASE WHEN label = 1 THEN category END) AS user_category_diversity,
                   count(DISTINCT CASE WHEN label = 1 THEN subcategory END)
                       AS user_subcategory_diversity
            FROM {log} LEFT JOIN news USING (news_id) GROUP BY user_id
            """,
        ),
        f"{name}_usess": (
            (log,),
            f"""
            SELECT user_id, count(*) AS user_total_sessions, avg(n) AS user_avg_session_size,
                   avg(c) AS user_avg_session_clicks, max(n) AS user_max_session_size
            FROM (SELECT user_id, impression_id, count(*) AS n, sum(label) AS c
                  FROM {log} GROUP BY user_id, impression_id) GROUP BY user_id
            """,
        ),
        f"{name}_user": (
            (f"{name}_ustats", f"{name}_utop", f"{name}_udiv", f"{name}_usess"),
            f"""
            SELECT s.*, t.user_top_category, d.user_category_diversity,
                   d.user_subcategory_diversity, e.user_total_sessions, e.user_avg_session_size,
                   e.user_avg_session_clicks, e.user_max_session_size
            FROM {name}_ustats s LEFT JOIN {name}_utop t USING (user_id)
            LEFT JOIN {name}_udiv d USING (user_id) LEFT JOIN {name}_usess e USING (user_id)
            """,
        ),
        f"{name}_catpop": (
            (log, "news"),
            f"""
            SELECT category, count(*) AS category_total_impressions,
                   CAST(sum(label) AS BIGINT) AS category_total_clicks,
                   avg(label) AS category_avg_ctr
            FROM {log} JOIN news USING (news_id) GROUP BY category
            """,
        ),
        f"{name}_istats": (
            (log,),
            f"""
            SELECT news_id, count(*) AS item_total_impressions,
                   CAST(sum(label) AS BIGINT) AS item_total_clicks, avg(label) AS item_ctr,
                   count(DISTINCT user_id) AS item_unique_users,
                   min(timestamp_unix) AS item_first_seen_ts,
                   max(timestamp_unix) AS item_last_seen_ts,
                   CAST(count(*) - sum(label) AS BIGINT) AS item_non_clicks,
                   (sum(label) + 1) / (count(*) + 10) AS item_smoothed_ctr,
                   ((SELECT max(timestamp_unix) FROM {log}) - min(timestamp_unix)) / 3600e0
                       AS item_age_hours,
                   ((SELECT max(timestamp_unix) FROM {log}) - max(timestamp_unix)) / 3600e0
                       AS item_recency_hours,
                   exp(-(((SELECT max(timestamp_unix) FROM {log}) - min(timestamp_unix)) / 3600e0)
                       / 72e0) AS item_freshness_score
            FROM {log} GROUP BY news_id
            """,
        ),
        f"{name}_item": (
            (f"{name}_istats", f"{name}_catpop", "content"),
            f"""
            SELECT c.*,
                   coalesce(category_total_impressions, 0) AS category_total_impressions,
                   coalesce(category_total_clicks, 0) AS category_total_clicks,
                   coalesce(category_avg_ctr, 0) AS category_avg_ctr,
                   coalesce(item_total_impressions, 0) AS item_total_impressions,
                   coalesce(item_total_clicks, 0) AS item_total_clicks,
                   coalesce(item_ctr, 0) AS item_ctr,
                   coalesce(item_unique_users, 0) AS item_unique_users,
                   item_first_seen_ts, item_last_seen_ts,
                   coalesce(item_non_clicks, 0) AS item_non_clicks,
                   coalesce(item_smoothed_ctr, 1e-1) AS item_smoothed_ctr,
                   coalesce(item_age_hours, 0) AS item_age_hours,
                   coalesce(item_recency_hours, 0) AS item_recency_hours,
                   coalesce(item_freshness_score, 1) AS item_freshness_score
            FROM content c LEFT JOIN {name}_catpop USING (category)
            LEFT JOIN {name}_istats USING (news_id)
            """,
        ),
    }


CTES["content"] = (
    ("news",),
    """
    SELECT *, CASE WHEN title IS NULL THEN 0 ELSE len(string_split(title, ' ')) END
                  AS item_title_length,
           CASE WHEN abstract IS NULL THEN 0 ELSE len(string_split(abstract, ' ')) END
               AS item_abstract_length,
           CASE WHEN trim(coalesce(abstract, '')) = '' THEN 0 ELSE 1 END AS item_has_abstract
    FROM news
    """,
)
CTES.update(_user_features("olog", "olog"))
CTES.update(_user_features("otrain", "otrain"))


def _events_items() -> dict[str, tuple[tuple[str, ...], str]]:
    tables = _user_features("elog", "elog")
    return {k: v for k, v in tables.items() if not k.endswith(("_ustats", "_user", "_usess"))}


CTES.update(_events_items())


def _share(log: str, level: str) -> str:
    return f"""
        SELECT user_id, {level}, count(*) AS user_{level}_clicks,
               count(*) / t.total AS user_{level}_share
        FROM {log} JOIN news USING (news_id)
        JOIN (SELECT user_id, count(*) AS total FROM {log} JOIN news USING (news_id)
              WHERE label = 1 GROUP BY user_id) t USING (user_id)
        WHERE label = 1 GROUP BY user_id, {level}, t.total
    """


for _log in ("olog", "otrain"):
    for _level in ("category", "subcategory"):
        CTES[f"{_log}_{_level}"] = ((_log, "news"), _share(_log, _level))


def _turns(dow: str) -> str:
    return f"""
        hour(ts) AS ctx_hour, {dow} AS ctx_day_of_week,
        {r("sin(2 * pi() * hour(ts) / 24)")} AS ctx_hour_sin,
        {r("cos(2 * pi() * hour(ts) / 24)")} AS ctx_hour_cos,
        {r(f"sin(2 * pi() * {dow} / 7)")} AS ctx_dow_sin,
        {r(f"cos(2 * pi() * {dow} / 7)")} AS ctx_dow_cos,
        CAST(CASE WHEN {dow} >= 5 THEN 1 ELSE 0 END AS BIGINT) AS ctx_is_weekend
    """


CTES["escore"] = (
    ("elog_item",),
    """
    SELECT *, item_total_clicks * item_freshness_score AS popularity_score FROM elog_item
    """,
)
CTES["eglobal"] = (
    ("escore",),
    f"""
    SELECT * FROM (
        SELECT news_id, category, popularity_score, row_number() OVER (
            ORDER BY {r("popularity_score")} DESC, news_id) AS rank FROM escore)
    WHERE rank <= 100
    """,
)
CTES["ecategory"] = (
    ("escore",),
    f"""
    SELECT * FROM (
        SELECT category, news_id, popularity_score, row_number() OVER (
            PARTITION BY category ORDER BY {r("popularity_score")} DESC, news_id) AS rank
        FROM escore) WHERE rank <= 20
    """,
)
CTES["eclicks"] = (("elog",), "SELECT DISTINCT user_id, news_id FROM elog WHERE label = 1")
CTES["eusers"] = (("elog",), "SELECT DISTINCT user_id FROM elog")


def _popularity_picks(n: int) -> str:
    """Own-category picks first, then the global list, n in all."""
    return f"""
        SELECT user_id, news_id, source,
               row_number() OVER (PARTITION BY user_id ORDER BY source, rank) AS rank,
               1 - (row_number() OVER (PARTITION BY user_id ORDER BY source, rank) - 1)
                   / count(*) OVER (PARTITION BY user_id) AS candidate_score
        FROM (
            SELECT user_id, news_id, source, rank, row_number() OVER (
                PARTITION BY user_id ORDER BY source, rank) AS total
            FROM (SELECT user_id, news_id, 'popularity_category' AS source, rank FROM own
                  UNION ALL
                  SELECT user_id, news_id, 'popularity_global', rank
                  FROM eusers, eglobal
                  WHERE NOT EXISTS (SELECT 1 FROM eclicks s WHERE s.user_id = eusers.user_id
                                    AND s.news_id = eglobal.news_id)
                    AND NOT EXISTS (SELECT 1 FROM own o WHERE o.user_id = eusers.user_id
                                    AND o.news_id = eglobal.news_id)))
        WHERE total <= {n}
    """


def _own_picks(n: int) -> str:
    return f"""
        SELECT user_id, news_id, rank FROM (
            SELECT u.user_id, c.news_id, c.rank,
                   row_number() OVER (PARTITION BY u.user_id ORDER BY c.rank) AS rn
            FROM elog_utop u JOIN ecategory c ON u.user_top_category = c.category
            WHERE NOT EXISTS (SELECT 1 FROM eclicks s WHERE s.user_id = u.user_id
                              AND s.news_id = c.news_id))
        WHERE rn <= {n // 3}
    """


CTES["eoverlap"] = (
    ("eclicks",),
    """
    SELECT a.user_id, b.user_id AS other, count(*) AS common
    FROM eclicks a JOIN eclicks b ON a.news_id = b.news_id AND a.user_id <> b.user_id
    GROUP BY a.user_id, b.user_id HAVING count(*) >= 3
    """,
)
CTES["enear"] = (
    ("eoverlap", "eclicks"),
    """
    SELECT user_id, other, common, common / (x.n + y.n - common) AS jaccard
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY common DESC, other) AS rn
          FROM eoverlap)
    JOIN (SELECT user_id, count(*) AS n FROM eclicks GROUP BY user_id) x USING (user_id)
    JOIN (SELECT user_id AS other, count(*) AS n FROM eclicks GROUP BY user_id) y USING (other)
    WHERE rn <= 60
    """,
)
CTES["esimilar"] = (
    ("enear",),
    f"""
    SELECT * FROM (
        SELECT user_id, other, common, jaccard AS similarity, row_number() OVER (
            PARTITION BY user_id ORDER BY {r("jaccard", 9)} DESC, common DESC, other) AS rank
        FROM enear) WHERE rank <= 20
    """,
)
CTES["ecollab"] = (
    ("esimilar", "eclicks"),
    f"""
    SELECT *, row_number() OVER (
        PARTITION BY user_id ORDER BY {r("candidate_score")} DESC, news_id) AS rank
    FROM (SELECT s.user_id, c.news_id, sum(s.similarity) AS candidate_score
          FROM esimilar s JOIN eclicks c ON c.user_id = s.other
          WHERE NOT EXISTS (SELECT 1 FROM eclicks o WHERE o.user_id = s.user_id
                            AND o.news_id = c.news_id)
          GROUP BY s.user_id, c.news_id)
    """,
)
CTES["scored"] = (
    ("osplit", "otrain_item"),
    f"""
    SELECT t.impression_id, t.user_id, t.news_id, t.label, i.category, i.item_total_clicks,
           i.item_smoothed_ctr, i.item_age_hours,
           {r("coalesce((1 - 3e-1) * (i.item_total_clicks / (SELECT max(item_total_clicks) FROM otrain_item)) + 3e-1 * i.item_freshness_score, 0)")} AS score
    FROM osplit t LEFT JOIN otrain_item i USING (news_id) WHERE t.split = 'test'
    """,
)
CTES["scored_log"] = (CTES["scored"][0], CTES["scored"][1].replace("WHERE t.split = 'test'", ""))


def _metrics(scored: str, keys: str) -> str:
    """Metrics per group from full rankings."""
    columns = []
    for k in (5, 10):
        columns.append(
            f"""
            sum(CASE WHEN rk <= {k} THEN label ELSE 0 END) / least({k}, count(*))
                AS precision_at_{k},
            CASE WHEN sum(label) > 0 THEN sum(CASE WHEN rk <= {k} THEN label ELSE 0 END)
                / sum(label) ELSE 0 END AS recall_at_{k},
            CASE WHEN sum(label) > 0
                 THEN sum(CASE WHEN rk <= {k} THEN (2 ** label - 1) / log2(rk + 1) ELSE 0 END)
                    / sum(CASE WHEN ideal <= {k} THEN (2 ** label - 1) / log2(ideal + 1)
                          ELSE 0 END) ELSE 0 END AS ndcg_at_{k},
            CASE WHEN sum(label) > 0
                 THEN sum(CASE WHEN rk <= {k} AND label > 0 THEN hits / rk ELSE 0 END)
                    / least(sum(label), {k}, count(*)) ELSE 0 END AS map_at_{k}
            """
        )
    return f"""
        SELECT {keys}, count(*) AS group_rows, {", ".join(columns)},
               CASE WHEN sum(label) > 0
                    THEN sum(CASE WHEN label > 0 THEN hits / rk ELSE 0 END) / sum(label)
                    ELSE 0 END AS average_precision
        FROM (
            SELECT *, sum(label) OVER (PARTITION BY {keys} ORDER BY rk) AS hits FROM (
                SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY score DESC, news_id)
                           AS rk,
                       row_number() OVER (PARTITION BY {keys} ORDER BY label DESC, news_id)
                           AS ideal
                FROM {scored}))
        GROUP BY {keys}
    """


CTES["per_group"] = (("scored",), _metrics("scored", "impression_id"))
CTES["shown"] = (
    ("olog", "news"),
    "SELECT impression_id, coalesce(category, 'unknown') AS category "
    "FROM olog LEFT JOIN news USING (news_id)",
)
CTES["per_list"] = (
    ("shown", "news"),
    """
    SELECT impression_id, CAST(sum(n) AS BIGINT) AS list_size,
           sum(CASE WHEN category IN (SELECT category FROM news) THEN 1 ELSE 0 END)
               / (SELECT count(DISTINCT category) FROM news) AS category_coverage,
           CASE WHEN sum(n) > 1
                THEN sum(n * (total - n)) / (sum(n) * (sum(n) - 1)) ELSE 0 END
               AS intra_list_diversity
    FROM (SELECT impression_id, category, count(*) AS n,
                 sum(count(*)) OVER (PARTITION BY impression_id) AS total
          FROM shown GROUP BY impression_id, category)
    GROUP BY impression_id
    """,
)


def _terms(name: str, news: str, columns: str) -> dict[str, tuple[tuple[str, ...], str]]:
    """TF-IDF tables over one catalogue: words, then terms, vocabulary and weights."""
    stop = ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH)
    return {
        f"{name}_words": (
            (news,) if news in CTES else (),
            f"""
            SELECT news_id, w, row_number() OVER (PARTITION BY news_id ORDER BY i) AS i FROM (
                SELECT news_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM (
                    SELECT news_id,
                           regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS ws
                    FROM (SELECT {columns} FROM {news})))
            WHERE w NOT IN ({stop})
            """.replace("\\\\", "\\"),
        ),
        f"{name}_tf": (
            (f"{name}_words",),
            f"""
            SELECT news_id, term, count(*) AS tf FROM (
                SELECT news_id, w AS term FROM {name}_words
                UNION ALL
                SELECT a.news_id, a.w || ' ' || b.w FROM {name}_words a
                JOIN {name}_words b ON a.news_id = b.news_id AND b.i = a.i + 1)
            GROUP BY news_id, term
            """,
        ),
        f"{name}_vec": (
            (f"{name}_tf",),
            f"""
            SELECT news_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY news_id)) AS weight
            FROM (SELECT news_id, term, tf * (ln((1 + n) / (1 + df)) + 1) AS w
                  FROM {name}_tf
                  JOIN (SELECT term, sum(tf) AS total, count(*) AS df FROM {name}_tf
                        GROUP BY term ORDER BY total DESC, term LIMIT 5000) v USING (term),
                  (SELECT count(*) AS n FROM {news}) c)
            """,
        ),
    }


CTES.update(
    _terms("doc", "documents", "doc_id AS news_id, lang || ' ' || source || ' ' || text AS text")
)
CTES.update(
    _terms("part", "news", "news_id, category || ' ' || subcategory || ' ' || title AS text")
)
CTES["ecosine"] = (
    ("part_vec", "eclicks"),
    """
    SELECT user_id, news_id, sum(p.w * v.weight) / any_value(norm) AS candidate_score
    FROM (SELECT *, sqrt(sum(w * w) OVER (PARTITION BY user_id)) AS norm FROM (
              SELECT user_id, term, sum(weight) AS w FROM eclicks JOIN part_vec USING (news_id)
              GROUP BY user_id, term)) p
    JOIN part_vec v USING (term) GROUP BY user_id, news_id
    """,
)
CTES["econtent"] = (
    ("ecosine", "eclicks", "news"),
    f"""
    SELECT user_id, news_id, candidate_score, row_number() OVER (
        PARTITION BY user_id ORDER BY {r("candidate_score")} DESC, news_id) AS rank
    FROM (SELECT u.user_id, n.news_id, coalesce(c.candidate_score, 0) AS candidate_score
          FROM (SELECT DISTINCT user_id FROM eclicks) u, news n
          LEFT JOIN ecosine c ON c.user_id = u.user_id AND c.news_id = n.news_id)
    ANTI JOIN eclicks USING (user_id, news_id)
    """,
)


def boosted(score: str, age: str) -> str:
    return f"({score} + 1e-1 * exp(-ln(2) * greatest(coalesce({age}, 0), 0) / 24))"


def _mmr(cut: str, top_k: int = 10) -> tuple[str, str]:
    """Recursive greedy picks over a table (user_id, pos, news_id, category, score)."""
    state = f"""
        picks AS (
            SELECT DISTINCT user_id, 0 AS rank, CAST(NULL AS BIGINT) AS news_id,
                   CAST(NULL AS VARCHAR) AS category, CAST(NULL AS DOUBLE) AS score,
                   CAST([] AS BIGINT[]) AS taken, CAST([] AS VARCHAR[]) AS cats
            FROM {cut}
            UNION ALL
            SELECT user_id, rank + 1, news_id, category, score, list_append(taken, pos),
                   list_append(cats, category)
            FROM (
                SELECT p.user_id, p.rank, c.news_id, c.category, c.score, c.pos, p.taken, p.cats,
                       row_number() OVER (PARTITION BY p.user_id ORDER BY
                           {r('''
                           6e-1 * (c.score / c.peak) - 4e-1 * CASE WHEN p.rank = 0 THEN 0 ELSE
                           len(list_filter(p.cats, lambda x: x IS NOT DISTINCT FROM c.category))
                           / p.rank END''', 10)} DESC, c.pos) AS rn
                FROM picks p JOIN (
                    SELECT *, CASE WHEN max(score) OVER (PARTITION BY user_id) > 0
                              THEN max(score) OVER (PARTITION BY user_id) ELSE 1 END AS peak
                    FROM {cut}) c ON c.user_id = p.user_id
                WHERE p.rank < {top_k} AND NOT list_contains(p.taken, c.pos))
            WHERE rn = 1)
    """
    return state, "SELECT user_id, rank, news_id, category, score FROM picks WHERE rank > 0"


CTES["mmr_cut"] = (
    ("scored_log",),
    f"""
    SELECT * FROM (
        SELECT *, row_number() OVER (
            PARTITION BY user_id ORDER BY {r("score", 9)} DESC, news_id) AS pos
        FROM (SELECT user_id, news_id, category, {boosted("max(score)", "max(item_age_hours)")}
                         AS score
              FROM scored_log GROUP BY user_id, news_id, category))
    WHERE pos <= 50
    """,
)


# The pool: a third from each source in turn.
CTES["own66"] = (("elog_utop", "ecategory", "eclicks"), _own_picks(66))
CTES["pool_popular"] = (
    ("eusers", "eglobal", "eclicks", "own66"),
    _popularity_picks(66).replace("rank FROM own", "rank FROM own66").replace(" own o ", " own66 o "),
)
CTES["pool_content"] = (
    ("econtent", "pool_popular"),
    """
    SELECT * FROM (
        SELECT user_id, news_id, candidate_score,
               row_number() OVER (PARTITION BY user_id ORDER BY c.rank) AS nth
        FROM econtent c ANTI JOIN pool_popular p USING (user_id, news_id)) WHERE nth <= 66
    """,
)
CTES["pool_collab"] = (
    ("ecollab", "pool_popular", "pool_content"),
    """
    SELECT * FROM (
        SELECT user_id, news_id, candidate_score,
               row_number() OVER (PARTITION BY user_id ORDER BY c.rank) AS nth
        FROM ecollab c ANTI JOIN pool_popular p USING (user_id, news_id)
        ANTI JOIN pool_content q USING (user_id, news_id)) WHERE nth <= 66
    """,
)
CTES["pool"] = (
    ("pool_popular", "pool_content", "pool_collab"),
    """
    SELECT user_id, news_id, source, candidate_score,
           row_number() OVER (PARTITION BY user_id ORDER BY part, nth) AS rank
    FROM (SELECT user_id, news_id, source, candidate_score, 1 AS part, rank AS nth
          FROM pool_popular
          UNION ALL SELECT user_id, news_id, 'content_similarity', candidate_score, 2, nth
          FROM pool_content
          UNION ALL SELECT user_id, news_id, 'collaborative', candidate_score, 3, nth
          FROM pool_collab)
    """,
)
CTES["ebase"] = (
    ("elog_item",),
    """
    SELECT *, (1 - 3e-1) * item_total_clicks / (SELECT max(item_total_clicks) FROM elog_item)
              + 3e-1 * item_freshness_score AS base FROM elog_item
    """,
)
_CUT = """
    SELECT * FROM (
        SELECT user_id, news_id, category, score, row_number() OVER (
            PARTITION BY user_id ORDER BY {order} DESC, news_id) AS pos
        FROM (SELECT user_id, news_id, category, {boosted} AS score
              FROM {rows} JOIN ebase USING (news_id)))
    WHERE pos <= 50
"""
CTES["rec_cut"] = (
    ("pool", "ebase"),
    _CUT.format(
        order=r("score", 9),
        boosted=boosted("base", "item_age_hours"),
        rows="(SELECT user_id, news_id FROM pool SEMI JOIN customer ON c_custkey = user_id)",
    ),
)
for _log in ("elog",):
    CTES[f"{_log}_category"] = ((_log, "news"), _share(_log, "category"))
CTES["ranked_cut"] = (
    ("pool", "elog", "elog_item", "elog_category"),
    _CUT.replace("JOIN ebase USING (news_id)", "").format(
        order=r("score", 9),
        boosted=boosted("base", "item_age_hours"),
        rows="""(
            SELECT p.user_id, p.news_id, i.category, i.item_age_hours,
                   -125e-3 * (row_number() OVER (PARTITION BY p.user_id ORDER BY p.news_id)
                              / count(*) OVER (PARTITION BY p.user_id))
                   + 2e0 * i.item_smoothed_ctr + 5e-1 * coalesce(a.user_category_share, 0)
                   + 25e-2 * u.user_ctr AS base
            FROM pool p SEMI JOIN customer ON c_custkey = p.user_id
            JOIN elog_item i USING (news_id)
            JOIN (SELECT user_id, coalesce(avg(label), 0) AS user_ctr FROM elog GROUP BY user_id) u
              ON u.user_id = p.user_id
            LEFT JOIN elog_category a ON a.user_id = p.user_id AND a.category = i.category)""",
    ),
)
CTES["top_cut"] = (
    ("eusers", "ebase"),
    _CUT.format(
        order=r("score", 9),
        boosted=boosted("base", "item_age_hours"),
        rows="""(SELECT user_id, news_id
                 FROM (SELECT user_id FROM eusers SEMI JOIN customer ON c_custkey = user_id),
                      (SELECT news_id FROM elog_item
                       ORDER BY item_total_clicks DESC, news_id LIMIT 200))""",
    ),
)
CTES["cold"] = (
    ("eusers", "elog_item"),
    f"""
    SELECT c_custkey AS user_id, rank, news_id AS item_id, score,
           'cold_start_popular' AS source, category, true AS is_cold_start
    FROM customer ANTI JOIN eusers ON user_id = c_custkey, (
        SELECT news_id, category, {r("item_smoothed_ctr", 4)} AS score,
               row_number() OVER (ORDER BY item_total_clicks DESC, news_id) AS rank
        FROM elog_item) WHERE rank <= 10
    """,
)


def _needed(names: tuple[str, ...], done: list[str]) -> list[str]:
    for name in names:
        if name not in done:
            _needed(CTES[name][0], done)
            done.append(name)
    return done


def sql(uses: str, body: str, extra: str = "") -> str:
    """A statement with the intermediate tables it needs."""
    order = _needed(tuple(uses.split()), [])
    parts = [f"{name} AS MATERIALIZED ({CTES[name][1]})" for name in order]
    if extra:
        parts.append(extra)
    recursive = "RECURSIVE " if "picks AS" in extra else ""
    return f"WITH {recursive}" + ",\n".join(parts) + "\n" + body


_USER_ROUNDED = f"""
    {r("user_ctr")} AS user_ctr, {r("user_active_duration_days")} AS user_active_duration_days,
    {r("user_interaction_frequency")} AS user_interaction_frequency,
    {r("user_click_diversity")} AS user_click_diversity
"""
_USER_COUNTS = """
    user_id, user_total_interactions, user_total_clicks, user_unique_items,
    user_last_interaction_ts, user_first_interaction_ts, user_history_length,
    user_unique_clicked_items
"""
_ITEM_ALL = f"""
    news_id, category, subcategory, title, abstract,
    CAST(item_title_length AS BIGINT) AS item_title_length,
    CAST(item_abstract_length AS BIGINT) AS item_abstract_length,
    CAST(item_has_abstract AS BIGINT) AS item_has_abstract,
    category_total_impressions, category_total_clicks,
    {r("category_avg_ctr")} AS category_avg_ctr, item_total_impressions, item_total_clicks,
    {r("item_ctr")} AS item_ctr, item_unique_users, item_first_seen_ts, item_last_seen_ts,
    item_non_clicks, {r("item_smoothed_ctr")} AS item_smoothed_ctr,
    {r("item_age_hours")} AS item_age_hours, {r("item_recency_hours")} AS item_recency_hours,
    {r("item_freshness_score")} AS item_freshness_score
"""
_MEDIAN = """
    middle AS MATERIALIZED (
        SELECT max(timestamp_unix) AS t FROM (
            SELECT timestamp_unix, row_number() OVER (ORDER BY timestamp_unix) AS rn,
                   count(*) OVER () AS n FROM {log} WHERE timestamp_unix IS NOT NULL)
        WHERE rn = ceil(n * 0.5))
"""


def _mean_metrics(kinds: tuple[str, ...]) -> str:
    return ", ".join(
        f"{r(f'avg({m}_at_{k})')} AS {m}_at_{k}" for k in (5, 10) for m in kinds
    )


def _prepared() -> str:
    """Clean packed interactions with imputed time and split."""
    return f"""
        kept AS MATERIALIZED (
            SELECT * EXCLUDE (rn) FROM (
                SELECT p.*, row_number() OVER (
                    PARTITION BY user_id, news_id, impression_id
                    ORDER BY timestamp_unix NULLS FIRST, label DESC, history NULLS FIRST) AS rn
                FROM parsed p JOIN pnews USING (news_id)) WHERE rn = 1),
        {_MEDIAN.format(log="kept").strip()},
        timed AS MATERIALIZED (
            SELECT * EXCLUDE (t) REPLACE (coalesce(timestamp_unix, t) AS timestamp_unix)
            FROM kept, middle),
        prepared AS (
            SELECT d.*, CASE WHEN timestamp_unix <= b1 THEN 'train'
                             WHEN timestamp_unix <= b2 THEN 'val' ELSE 'test' END AS split
            FROM timed d, (
                SELECT max(CASE WHEN rn = ceil(n * 0.7) THEN timestamp_unix END) AS b1,
                       max(CASE WHEN rn = ceil(n * 0.85) THEN timestamp_unix END) AS b2
                FROM (SELECT timestamp_unix, row_number() OVER (ORDER BY timestamp_unix) AS rn,
                             count(*) OVER () AS n FROM timed)) b)
    """


def _statements() -> dict[str, str]:
    mmr_state, mmr_body = _mmr("mmr_cut")
    rec_state, rec_body = _mmr("rec_cut")
    top_state, top_body = _mmr("top_cut")
    ranked_state, ranked_body = _mmr("ranked_cut")
    warm = f"""
        SELECT user_id, CAST(rank AS BIGINT) AS rank, news_id AS item_id, {r("score", 4)} AS score,
               'personalized' AS source, category, false AS is_cold_start FROM ({{body}})
        UNION ALL SELECT * FROM cold
    """
    matrix_item = ", ".join(
        f"coalesce(i.{c}, 0) AS {c}"
        for c in (
            "category_total_impressions category_total_clicks item_total_impressions "
            "item_total_clicks item_unique_users item_first_seen_ts item_last_seen_ts "
            "item_non_clicks"
        ).split()
    )
    matrix_item_rounded = ", ".join(
        f"{r(f'coalesce(i.{c}, 0)')} AS {c}"
        for c in (
            "category_avg_ctr item_ctr item_smoothed_ctr item_age_hours item_recency_hours "
            "item_freshness_score"
        ).split()
    )
    matrix_user = ", ".join(
        f"coalesce(u.{c}, 0) AS {c}"
        for c in (
            "user_total_interactions user_total_clicks user_unique_items "
            "user_last_interaction_ts user_first_interaction_ts user_history_length "
            "user_unique_clicked_items user_category_diversity user_subcategory_diversity "
            "user_total_sessions user_max_session_size"
        ).split()
    )
    matrix_user_rounded = ", ".join(
        f"{r(f'coalesce(u.{c}, 0)')} AS {c}"
        for c in (
            "user_ctr user_active_duration_days user_interaction_frequency "
            "user_click_diversity user_avg_session_size user_avg_session_clicks"
        ).split()
    )
    dow = "((timestamp_unix // 86400 + 3) % 7)"  # 1970-01-01 was a Thursday, 0 = Monday
    return {
        "parse_impressions": sql(
            "parsed", "SELECT impression_id, user_id, news_id, label, timestamp_unix FROM parsed"
        ),
        "parse_history": sql(
            "packed",
            """
            SELECT impression_id, user_id,
                   CAST(CASE WHEN trim(coalesce(history, '')) = '' THEN 0
                             ELSE len(string_split(history, ' ')) END AS BIGINT) AS history_length,
                   CASE WHEN trim(coalesce(history, '')) = '' THEN ''
                        ELSE replace(history, ' ', '|') END AS history_items
            FROM packed
            """,
        ),
        "valid_items": sql(
            "parsed pnews",
            "SELECT impression_id, user_id, news_id, label FROM parsed JOIN pnews USING (news_id)",
        ),
        "invalid_items": sql(
            "parsed pnews",
            """
            SELECT impression_id, user_id, news_id, label FROM parsed
            WHERE news_id NOT IN (SELECT news_id FROM pnews)
            """,
        ),
        "dedup_interactions": sql(
            "odedup",
            """
            SELECT impression_id, user_id, news_id, CAST(label AS BIGINT) AS label,
                   timestamp_unix, history_length FROM odedup
            """,
        ),
        "impute_median_ts": sql(
            "parsed",
            f"""
            SELECT impression_id, user_id, news_id, label,
                   coalesce(timestamp_unix, t) AS timestamp_unix
            FROM parsed, middle
            """,
            _MEDIAN.format(log="parsed"),
        ),
        "time_split": sql(
            "olog",
            """
            SELECT impression_id, user_id, news_id, CAST(label AS BIGINT) AS label,
                   timestamp_unix,
                   CASE WHEN timestamp_unix <= quantile_disc_1 THEN 'train'
                        WHEN timestamp_unix <= quantile_disc_2 THEN 'val' ELSE 'test' END AS split
            FROM olog, (SELECT quantile_disc(timestamp_unix, 0.7) AS quantile_disc_1,
                               quantile_disc(timestamp_unix, 0.85) AS quantile_disc_2 FROM olog)
            """,
        ),
        "prepared_interactions": sql(
            "parsed pnews",
            """
            SELECT impression_id, user_id, news_id, label, history_length, timestamp_unix, split
            FROM prepared
            """,
            _prepared(),
        ),
        "prep_stats": sql(
            "packed parsed pnews",
            """
            SELECT count(*) AS total_interactions,
                   count(*) FILTER (label = 1) AS positive_interactions,
                   count(*) FILTER (label = 0) AS negative_interactions,
                   count(DISTINCT user_id) AS unique_users,
                   count(DISTINCT news_id) AS unique_items,
                   count(*) FILTER (split = 'train') AS train_size,
                   count(*) FILTER (split = 'val') AS val_size,
                   count(*) FILTER (split = 'test') AS test_size,
                   (SELECT count(*) FROM parsed WHERE user_id IS NULL) AS removed_malformed,
                   (SELECT count(*) FROM parsed WHERE news_id NOT IN (SELECT news_id FROM pnews))
                       AS removed_invalid_ids,
                   (SELECT count(*) FROM parsed JOIN pnews USING (news_id)) - count(*)
                       AS removed_duplicates,
                   (SELECT count(*) FROM pnews) AS raw_news,
                   (SELECT count(DISTINCT category) FROM pnews) AS categories,
                   (SELECT count(*) FROM packed) AS raw_behaviors,
                   (SELECT count(DISTINCT user_id) FROM parsed WHERE history_length = 0)
                       AS users_with_empty_history,
                   (SELECT count(*) FROM packed) AS total_impressions
            FROM prepared
            """,
            _prepared(),
        ),
        "user_stats": sql("olog_ustats", f"SELECT {_USER_COUNTS}, {_USER_ROUNDED} FROM olog_ustats"),
        "click_diversity": sql(
            "olog_ustats",
            f"""
            SELECT user_id, user_total_clicks, user_unique_clicked_items,
                   {r("user_click_diversity")} AS user_click_diversity FROM olog_ustats
            """,
        ),
        "category_diversity": sql("olog_udiv", "SELECT * FROM olog_udiv"),
        "session_stats": sql(
            "olog_usess",
            f"""
            SELECT user_id, user_total_sessions, {r("user_avg_session_size")}
                       AS user_avg_session_size, {r("user_avg_session_clicks")}
                       AS user_avg_session_clicks, user_max_session_size FROM olog_usess
            """,
        ),
        "user_top_category": sql("olog_utop", "SELECT * FROM olog_utop"),
        "build_user_features": sql(
            "olog_user",
            f"""
            SELECT {_USER_COUNTS}, {_USER_ROUNDED}, user_top_category, user_category_diversity,
                   user_subcategory_diversity, user_total_sessions, user_max_session_size,
                   {r("user_avg_session_size")} AS user_avg_session_size,
                   {r("user_avg_session_clicks")} AS user_avg_session_clicks
            FROM olog_user
            """,
        ),
        "item_stats": sql(
            "olog_istats",
            f"""
            SELECT news_id, item_total_impressions, item_total_clicks, {r("item_ctr")} AS item_ctr,
                   item_unique_users, item_first_seen_ts, item_last_seen_ts, item_non_clicks
            FROM olog_istats
            """,
        ),
        "smoothed_ctr": sql(
            "olog_istats",
            f"SELECT news_id, {r('item_smoothed_ctr')} AS item_smoothed_ctr FROM olog_istats",
        ),
        "item_freshness": sql(
            "elog_istats",
            f"""
            SELECT news_id, {r("item_age_hours")} AS item_age_hours,
                   {r("item_recency_hours")} AS item_recency_hours,
                   {r("item_freshness_score")} AS item_freshness_score FROM elog_istats
            """,
        ),
        "item_content": sql(
            "content",
            """
            SELECT news_id, CAST(item_title_length AS BIGINT) AS item_title_length,
                   CAST(item_abstract_length AS BIGINT) AS item_abstract_length,
                   CAST(item_has_abstract AS BIGINT) AS item_has_abstract FROM content
            """,
        ),
        "category_popularity": sql(
            "olog_catpop",
            f"""
            SELECT category, category_total_impressions, category_total_clicks,
                   {r("category_avg_ctr")} AS category_avg_ctr FROM olog_catpop
            """,
        ),
        "build_item_features": sql("elog_item", f"SELECT {_ITEM_ALL} FROM elog_item"),
        "user_category_share": sql(
            "olog_category",
            f"""
            SELECT user_id, category, user_category_clicks,
                   {r("user_category_share")} AS user_category_share FROM olog_category
            """,
        ),
        "user_subcategory_share": sql(
            "olog_subcategory",
            f"""
            SELECT user_id, subcategory, user_subcategory_clicks,
                   {r("user_subcategory_share")} AS user_subcategory_share
            FROM olog_subcategory
            """,
        ),
        "relational_features": sql(
            "olog news olog_category olog_subcategory",
            f"""
            SELECT o.impression_id, o.user_id, o.news_id, CAST(o.label AS BIGINT) AS label,
                   {r("coalesce(a.user_category_share, 0)")} AS user_category_share,
                   coalesce(a.user_category_clicks, 0) AS user_category_clicks,
                   {r("coalesce(b.user_subcategory_share, 0)")} AS user_subcategory_share
            FROM olog o LEFT JOIN news n USING (news_id)
            LEFT JOIN olog_category a ON a.user_id = o.user_id AND a.category = n.category
            LEFT JOIN olog_subcategory b
                   ON b.user_id = o.user_id AND b.subcategory = n.subcategory
            """,
        ),
        "context_time": sql(
            "elog", f"SELECT user_id, news_id, timestamp_unix, {_turns(dow)} FROM elog"
        ),
        "context_time_sunday_base": sql(
            "elog",
            "SELECT user_id, news_id, timestamp_unix, "
            f"{_turns('((timestamp_unix // 86400 + 4) % 7)')} FROM elog",
        ),
        "context_position": sql(
            "odedup",
            f"""
            SELECT impression_id, news_id, ctx_position_in_impression, ctx_impression_size,
                   {r("ctx_position_in_impression / ctx_impression_size")}
                       AS ctx_normalized_position
            FROM (SELECT impression_id, news_id, row_number() OVER (
                             PARTITION BY impression_id ORDER BY news_id)
                             AS ctx_position_in_impression,
                         count(*) OVER (PARTITION BY impression_id) AS ctx_impression_size
                  FROM odedup)
            """,
        ),
        "feature_matrix": sql(
            "osplit otrain_user otrain_item otrain_category otrain_subcategory news",
            f"""
            SELECT o.impression_id, o.user_id, o.news_id, CAST(o.label AS BIGINT) AS label,
                   o.timestamp_unix, o.history_length, o.split,
                   0 AS ctx_hour, {dow} AS ctx_day_of_week,
                   0e0 AS ctx_hour_sin, 1e0 AS ctx_hour_cos,
                   {r(f"sin(2 * pi() * {dow} / 7)")} AS ctx_dow_sin,
                   {r(f"cos(2 * pi() * {dow} / 7)")} AS ctx_dow_cos,
                   CAST(CASE WHEN {dow} >= 5 THEN 1 ELSE 0 END AS BIGINT) AS ctx_is_weekend,
                   o.ctx_position_in_impression, o.ctx_impression_size,
                   {r("o.ctx_position_in_impression / o.ctx_impression_size")}
                       AS ctx_normalized_position,
                   {r("coalesce(a.user_category_share, 0)")} AS user_category_share,
                   coalesce(a.user_category_clicks, 0) AS user_category_clicks,
                   {r("coalesce(b.user_subcategory_share, 0)")} AS user_subcategory_share,
                   {matrix_user}, {matrix_user_rounded}, u.user_top_category,
                   i.category, i.subcategory,
                   CAST(coalesce(i.item_title_length, 0) AS BIGINT) AS item_title_length,
                   CAST(coalesce(i.item_abstract_length, 0) AS BIGINT) AS item_abstract_length,
                   CAST(coalesce(i.item_has_abstract, 0) AS BIGINT) AS item_has_abstract,
                   {matrix_item}, {matrix_item_rounded}
            FROM (SELECT *, row_number() OVER (PARTITION BY impression_id ORDER BY news_id)
                             AS ctx_position_in_impression,
                         count(*) OVER (PARTITION BY impression_id) AS ctx_impression_size
                  FROM osplit) o
            LEFT JOIN news n ON n.news_id = o.news_id
            LEFT JOIN otrain_category a ON a.user_id = o.user_id AND a.category = n.category
            LEFT JOIN otrain_subcategory b
                   ON b.user_id = o.user_id AND b.subcategory = n.subcategory
            LEFT JOIN otrain_user u ON u.user_id = o.user_id
            LEFT JOIN otrain_item i ON i.news_id = o.news_id
            """,
        ),
        "popularity_score": sql(
            "escore",
            f"SELECT news_id, category, {r('popularity_score')} AS popularity_score FROM escore",
        ),
        "popular_global": sql(
            "eglobal",
            f"""
            SELECT rank, news_id, category, {r("popularity_score")} AS popularity_score
            FROM eglobal
            """,
        ),
        "popular_by_category": sql(
            "ecategory",
            f"""
            SELECT category, rank, news_id, {r("popularity_score")} AS popularity_score
            FROM ecategory
            """,
        ),
        "cand_popularity": sql(
            "eusers eglobal ecategory eclicks elog_utop",
            f"""
            SELECT user_id, rank, news_id, source, {r("candidate_score")} AS candidate_score
            FROM popular
            """,
            f"own AS ({_own_picks(100)}), popular AS ({_popularity_picks(100)})",
        ),
        "baseline_score": sql(
            "elog_item",
            f"""
            SELECT news_id, {r('''(1 - 3e-1) * item_total_clicks
                / (SELECT max(item_total_clicks) FROM elog_item)
                + 3e-1 * item_freshness_score''')} AS score
            FROM elog_item
            """,
        ),
        "baseline_rank": sql(
            "elog_item",
            f"""
            SELECT news_id, {r("score")} AS score FROM (
                SELECT s_suppkey AS news_id, coalesce((1 - 3e-1) * item_total_clicks
                           / (SELECT max(item_total_clicks) FROM elog_item)
                           + 3e-1 * item_freshness_score, 0) AS score
                FROM supplier LEFT JOIN elog_item ON news_id = s_suppkey)
            ORDER BY {r("score")} DESC, news_id LIMIT 10
            """,
        ),
        "user_jaccard": sql(
            "enear", f"SELECT user_id, other, common, {r('jaccard')} AS jaccard FROM enear"
        ),
        "similar_users": sql(
            "esimilar",
            f"""
            SELECT user_id, rank, other, common, {r("similarity")} AS similarity FROM esimilar
            """,
        ),
        "cand_collab": sql(
            "ecollab",
            f"""
            SELECT user_id, rank, news_id, 'collaborative' AS source,
                   {r("candidate_score")} AS candidate_score FROM ecollab WHERE rank <= 50
            """,
        ),
        "tfidf": sql("doc_vec", f"SELECT news_id, term, {r('weight')} AS weight FROM doc_vec"),
        "cand_content": sql(
            "econtent",
            f"""
            SELECT user_id, rank, news_id, 'content_similarity' AS source,
                   {r("candidate_score")} AS candidate_score FROM econtent WHERE rank <= 50
            """,
        ),
        "freshness_boost": sql(
            "scored_log",
            f"""
            SELECT impression_id, user_id, news_id,
                   {r(boosted("score", "item_age_hours"))} AS score,
                   {r("exp(-ln(2) * greatest(coalesce(item_age_hours, 0), 0) / 24)")}
                       AS freshness_score
            FROM scored_log
            """,
        ),
        "ranking_metrics": sql(
            "per_group",
            f"""
            SELECT impression_id, group_rows, {", ".join(
                f"{r(f'{m}_at_{k}')} AS {m}_at_{k}"
                for k in (5, 10) for m in ("precision", "recall", "ndcg", "map"))}
            FROM per_group
            """,
        ),
        "precision_recall": sql(
            "per_group",
            f"SELECT count(*) AS groups, {_mean_metrics(('precision', 'recall'))} FROM per_group",
        ),
        "ndcg": sql(
            "per_group", f"SELECT count(*) AS groups, {_mean_metrics(('ndcg',))} FROM per_group"
        ),
        "map": sql(
            "per_group", f"SELECT count(*) AS groups, {_mean_metrics(('map',))} FROM per_group"
        ),
        "average_precision": sql(
            "per_group",
            f"""
            SELECT impression_id, {r("average_precision")} AS average_precision FROM per_group
            """,
        ),
        "diversity_per_list": sql(
            "per_list",
            f"""
            SELECT impression_id, list_size, {r("category_coverage")} AS category_coverage,
                   {r("intra_list_diversity")} AS intra_list_diversity FROM per_list
            """,
        ),
        "diversity": sql(
            "per_list",
            f"""
            SELECT count(*) AS lists, {r("avg(category_coverage)")} AS avg_category_coverage,
                   {r("avg(intra_list_diversity)")} AS avg_intra_list_diversity FROM per_list
            """,
        ),
        "model_comparison": sql(
            "scored",
            f"""
            SELECT model, count(*) AS groups,
                   {_mean_metrics(("precision", "recall", "ndcg", "map"))}
            FROM per_model GROUP BY model
            """,
            f"""
            models AS (
                SELECT 'baseline' AS model, impression_id, news_id, label, score FROM scored
                UNION ALL
                SELECT 'clicks', impression_id, news_id, label, item_total_clicks FROM scored
                UNION ALL
                SELECT 'smoothed_ctr', impression_id, news_id, label, {r("item_smoothed_ctr")}
                FROM scored),
            per_model AS ({_metrics("models", "model, impression_id")})
            """,
        ),
        "model_comparison_ranked": sql(
            "scored otrain_category",
            f"""
            SELECT model, count(*) AS groups,
                   {_mean_metrics(("precision", "recall", "ndcg", "map"))}
            FROM per_model GROUP BY model
            """,
            f"""
            models AS (
                SELECT 'baseline' AS model, impression_id, news_id, label, score FROM scored
                UNION ALL
                SELECT 'linear', impression_id, news_id, label,
                       {r("2e0 * coalesce(item_smoothed_ctr, 0) + 5e-1 * coalesce(user_category_share, 0)")}
                FROM scored LEFT JOIN otrain_category USING (user_id, category)),
            per_model AS ({_metrics("models", "model, impression_id")})
            """,
        ),
        "group_sizes": sql(
            "olog", "SELECT impression_id, count(*) AS group_rows FROM olog GROUP BY impression_id"
        ),
        "pairwise_targets": sql(
            "olog",
            f"""
            SELECT target, count(*) AS rows, {r("sum(weight)")} AS weight,
                   {r("sum(weight * x * x)")} AS moment
            FROM (
                SELECT 0e0 AS target, 1 / n AS weight, history_length - m AS x FROM sides
                WHERE other > 0
                UNION ALL
                SELECT 1e0, 1e0, max(CASE WHEN label = 1 THEN m END)
                                 - max(CASE WHEN label = 0 THEN m END)
                FROM sides WHERE other > 0 GROUP BY impression_id)
            GROUP BY target
            """,
            """
            sides AS (
                SELECT *, count(*) OVER (PARTITION BY impression_id) - n AS other FROM (
                    SELECT impression_id, label, history_length,
                           count(*) OVER (PARTITION BY impression_id, label) AS n,
                           avg(history_length) OVER (PARTITION BY impression_id, label) AS m
                    FROM olog))
            """,
        ),
        "seeded_sample": sql(
            "odedup",
            """
            SELECT impression_id, news_id, user_id, CAST(label AS BIGINT) AS label FROM odedup
            ORDER BY md5('42|' || impression_id || '|' || news_id), impression_id, news_id
            LIMIT 1000
            """,
        ),
        "standardised_users": sql(
            "olog_user",
            " UNION ALL ".join(
                f"""
                SELECT user_id, '{c}' AS feature,
                       {r(f"CASE WHEN s = 0 THEN 0 ELSE ({c} - m) / s END")} AS z
                FROM olog_user, (SELECT avg({c}) AS m, stddev_pop({c}) AS s FROM olog_user)
                """
                for c in SEGMENT_FEATURES
            ),
        ),
        "group_profile": sql(
            "olog_user",
            f"""
            SELECT user_top_category, count(*) AS users,
                   {", ".join(f"{r(f'avg({c})')} AS {c}" for c in SEGMENT_FEATURES)},
                   {r("count(*) / (SELECT count(*) FROM olog_user)")} AS share
            FROM olog_user GROUP BY user_top_category
            """,
        ),
        "candidate_pool": sql(
            "pool",
            f"""
            SELECT user_id, rank, news_id, source, {r("candidate_score")} AS candidate_score
            FROM pool
            """,
        ),
        "source_counts": sql(
            "pool",
            "SELECT user_id, source, count(*) AS candidates FROM pool GROUP BY user_id, source",
        ),
        "recommend": sql("rec_cut cold", warm.format(body=rec_body), rec_state),
        "recommend_ranked": sql("ranked_cut cold", warm.format(body=ranked_body), ranked_state),
        "recommend_top_clicks": sql("top_cut cold", warm.format(body=top_body), top_state),
        "cold_start": sql("cold", "SELECT * FROM cold"),
        "mmr_rerank": sql(
            "mmr_cut",
            f"""
            SELECT user_id, CAST(rank AS BIGINT) AS rank, news_id, category,
                   {r("score")} AS score FROM ({mmr_body})
            """,
            mmr_state,
        ),
    }


def all_sql() -> dict[str, str]:
    """Every statement by query name."""
    found = _statements()
    matrix = found["feature_matrix"]
    others = ", ".join(
        c for c in ("impression_id", "user_id", "news_id", "label", "timestamp_unix", "history_length",
                    "split", "user_top_category", "category", "subcategory", "item_first_seen_ts",
                    "item_last_seen_ts", "user_first_interaction_ts", "user_last_interaction_ts")
    )
    found["feature_column_names"] = f"""
        SELECT feature, {r("avg(value)")} AS mean FROM (
            UNPIVOT (SELECT CAST(COLUMNS(* EXCLUDE ({others})) AS DOUBLE) FROM ({matrix})
                     WHERE split = 'train')
            ON COLUMNS(*) INTO NAME feature VALUE value)
        GROUP BY feature
    """
    found["attribution_fixed_weights"] = " UNION ALL ".join(
        f"""
        SELECT '{name}' AS feature, {r(f"avg(abs({weight} * (x - m)))")} AS mean_abs_contribution,
               {r(f"avg({weight} * (x - m))")} AS mean_contribution, count(*) AS rows
        FROM (SELECT CAST({name} AS DOUBLE) AS x, avg({name}) OVER () AS m FROM ({matrix})
              WHERE split = 'test')
        """
        for name, weight in (
            ("ctx_impression_size", "5e-1"),
            ("item_total_impressions", "-25e-2"),
            ("user_total_clicks", "2e0"),
        )
    )
    return found
