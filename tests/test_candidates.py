"""Candidates against brute force, with hot items, copies and small grids."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from feedloom.functions.frames import exact_quantiles, positions, salted_join
from feedloom.operators import collaborative, content, popularity, prep, rerank
from feedloom.operators.item_features import build_item_features
from feedloom.operators.pool import candidate_pool


@pytest.fixture(scope="module")
def skewed_clicks(spark):
    """Two items that nearly everybody clicks, a third of the users identical."""
    dice = random.Random(7)
    sets = {}
    for u in range(60):
        if u % 3 == 0:
            sets[u] = {1, 2, 3, 4}
        else:
            sets[u] = {1, 2} | {dice.randint(3, 25) for _ in range(dice.randint(0, 8))}
    sets[60] = set(range(1, 26))
    rows = [(u, i) for u, items in sets.items() for i in items]
    return sets, spark.createDataFrame(rows, "user_id long, news_id long")


def brute_similar(sets, min_common, limit):
    out = {}
    for u, mine in sets.items():
        near = [(len(mine & s), v) for v, s in sets.items() if v != u and mine & s]
        near = sorted(near, key=lambda x: (-x[0], x[1]))[: 3 * limit]
        scored = [(c / len(mine | sets[v]), c, v) for c, v in near if c >= min_common]
        out[u] = sorted(scored, key=lambda x: (-round(x[0], 9), -x[1], x[2]))[:limit]
    return out


@pytest.mark.parametrize("min_common", [1, 2, 3, 5])
def test_similar_users_equal_brute_force(spark, skewed_clicks, min_common):
    sets, clicks = skewed_clicks
    expected = brute_similar(sets, min_common, 6)
    found = defaultdict(list)
    for r in collaborative.similar_users(clicks, min_common, 6).orderBy("rank").collect():
        found[r["user_id"]].append((pytest.approx(r["similarity"]), r["common"], r["other"]))
    assert {u: v for u, v in expected.items() if v} == dict(found)


def drawn_profiles(spark, shape, seed=5, n=150):
    """Item sets of profiles: few hot items, many rare ones, a wide middle, or all of it."""
    dice = random.Random(seed)
    sets = {}
    for p in range(n):
        hot = {i for i in range(30) if dice.random() < (0.9 if shape == "hot" else 0.4)}
        rare = {1000 + dice.randrange(200) for _ in range(dice.randrange(6))}
        middle = {100 + dice.randrange(60) for _ in range(dice.randrange(12))}
        sets[p] = {"hot": hot | rare, "rare": rare, "middle": middle, "all": hot | rare | middle}[shape]
    if shape == "all":
        sets |= {n + i: set(range(25)) for i in range(40)}  # copies: ties everywhere
    rows = [(p, i) for p, own in sets.items() for i in own]
    return sets, spark.createDataFrame(rows, "profile long, news_id long")


@pytest.mark.parametrize("shape", ["hot", "rare", "middle", "all"])
@pytest.mark.parametrize(("keep", "min_common"), [(3, 3), (7, 1)])
def test_best_overlaps_equal_brute_force(spark, shape, keep, min_common):
    sets, items = drawn_profiles(spark, shape)
    found = defaultdict(list)
    for r in collaborative.best_overlaps(items, keep, min_common).collect():
        found[r["left"]].append((-r["common"], r["right"]))
    for p, own in sets.items():
        near = [(-len(own & s), v) for v, s in sets.items() if v != p and len(own & s) >= min_common]
        assert sorted(found[p])[:keep] == sorted(near)[:keep], p


@pytest.mark.parametrize("shape", ["hot", "middle", "all"])
@pytest.mark.parametrize(("keep", "min_common"), [(3, 3), (7, 1)])
def test_dense_profiles_are_compared_in_cells(spark, shape, keep, min_common, monkeypatch):
    """No row per shared item: each cell keeps the best of its profiles, and small cells agree with whole ones."""
    monkeypatch.setattr(collaborative, "CELL_RIGHT", 64)
    monkeypatch.setattr(collaborative, "ITEMS_PER_ROW", 1e9)
    sets, items = drawn_profiles(spark, shape)
    made: dict = {}
    found = defaultdict(list)
    for r in collaborative.best_overlaps(items, keep, min_common, made, pair_rows=0).collect():
        found[r["left"]].append((-r["common"], r["right"]))
    assert list(made) == ["compared"] and made["compared"] <= keep * len(sets)
    for p, own in sets.items():
        near = [(-len(own & s), v) for v, s in sets.items() if v != p and len(own & s) >= min_common]
        assert sorted(found[p]) == sorted(near)[:keep], p


def test_fifty_hot_items_make_few_pairs(spark):
    """All profiles share fifty items; all pairs would be 360,000, and 18 million rows of a join."""
    rows = [(p, i) for p in range(600) for i in [*range(50), 1000 + p // 2, 5000 + p]]
    items = spark.createDataFrame(rows, "profile long, news_id long")
    made: dict = {}
    found = defaultdict(list)
    for r in collaborative.best_overlaps(items, 5, 3, made).collect():
        found[r["left"]].append((-r["common"], r["right"]))
    assert sum(made.values()) < 600 * 20, made
    for p in (0, 1, 77, 599):
        twin = p ^ 1
        near = [(-51, twin)] + [(-50, v) for v in range(8) if v not in (p, twin)]
        assert sorted(found[p])[:5] == near[:5]


def test_equal_sets_are_one_profile(spark, skewed_clicks):
    _, clicks = skewed_clicks
    profiles = collaborative.click_profiles(clicks, 3)
    assert profiles.filter(F.col("user_id") % 3 == 0).select("profile").distinct().count() <= 2


def test_collaborative_candidates_equal_brute_force(spark, skewed_clicks):
    sets, clicks = skewed_clicks
    expected = {}
    for u, near in brute_similar(sets, 3, 20).items():
        scores = Counter()
        for sim, _, v in near:
            for i in sets[v] - sets[u]:
                scores[i] += sim
        best = sorted(scores.items(), key=lambda x: (-round(x[1], 6), x[0]))[:5]
        if best:
            expected[u] = [i for i, _ in best]
    found = defaultdict(list)
    rows = collaborative.collaborative_candidates(clicks, clicks, 5).orderBy("rank").collect()
    for r in rows:
        found[r["user_id"]].append(r["news_id"])
    assert dict(found) == expected


def test_unknown_user_has_no_candidates(spark, skewed_clicks):
    _, clicks = skewed_clicks
    assert collaborative.similar_users(clicks).filter("user_id = 999").count() == 0


def test_salted_join_equals_join(spark):
    left = spark.createDataFrame([(i % 3, i) for i in range(60)], "k int, a int")
    right = spark.createDataFrame([(0 if i % 2 else i % 5, i) for i in range(80)], "k int, b int")
    plain = sorted(map(tuple, left.join(right, "k").select("k", "a", "b").collect()))
    salted = salted_join(left, right, ["k"], rows_per_task=7).select("k", "a", "b")
    assert sorted(map(tuple, salted.collect())) == plain


def test_positions_in_one_hot_group(spark):
    dice = random.Random(3)
    ids = dice.sample(range(1_000_000), 500)
    df = spark.createDataFrame([("hot", i) for i in ids] + [("cold", 5)], "g string, id long")
    out = positions(df, ["g"], [F.floor(F.col("id") / 10_000)], [F.col("id")], "at", "n")
    ranks = {i: at for at, i in enumerate(sorted(ids), 1)}
    rows = out.collect()
    assert len(rows) == 501
    for r in rows:
        assert (r["at"], r["n"]) == ((ranks[r["id"]], 500) if r["g"] == "hot" else (1, 1))


def test_exact_quantiles(spark):
    dice = random.Random(4)
    values = [dice.randint(-500_000, 500_000) for _ in range(777)] + [7] * 300
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v long")
    row = exact_quantiles(df, "v", ["0.5", "0.7", "0.85", "1.0"]).first()
    ordered = sorted(values)
    for q, p in zip(row, (50, 70, 85, 100)):
        assert q == ordered[-(-len(ordered) * p // 100) - 1]


@pytest.mark.parametrize("low, high, n", [(-(2**63), 2**63 - 1, 3000), (0, 2**40, 900), (5, 5, 4), (-70_000, 70_000, 500), (-1, 0, 9)])
def test_exact_quantiles_of_any_range(spark, low, high, n):
    dice = random.Random(n)
    values = [low, high] + [dice.randint(low, high) for _ in range(n)]
    names = ["0.000001", "0.25", "0.5", "0.5001", "0.999999", "1"]
    row = exact_quantiles(spark.createDataFrame([(v,) for v in values], "v long"), "v", names).first()
    ordered = sorted(values)
    expected = [ordered[max(1, math.ceil(Fraction(p) * len(ordered))) - 1] for p in names]
    assert list(row) == expected


def test_exact_quantiles_without_values(spark):
    assert tuple(exact_quantiles(spark.createDataFrame([(None,)], "v long"), "v", ["0.5", "1"]).first()) == (None, None)


@pytest.mark.parametrize("room, n", [(6, 5), (40, 5), (300, 5), (6, 400), (5000, 5000)])
def test_frequent_terms_hold_the_first_ones(spark, room, n):
    dice = random.Random(room + n)
    rows = [(f"t{int(dice.paretovariate(0.7)) % 700}", dice.choice([1, 1, 1, 9])) for _ in range(6000)]
    rows += [(f"once{i}", 1) for i in range(900)]
    totals = Counter()
    for term, copies in rows:
        totals[term] += copies
    ordered = sorted(totals, key=lambda t: (-totals[t], t))
    df = spark.createDataFrame(rows, "term string, copies long").repartition(5)
    found = {r["term"] for r in content.frequent_terms(df, n, room).collect()}
    assert set(ordered[:n]) <= found <= set(ordered)
    if n == 5:
        assert len(found) < 100
    assert content.frequent_terms(df.limit(0), n, room).count() == 0


def test_vocabulary_does_not_depend_on_the_room(spark, news):
    plain = content.fit_tfidf(news, 7)[2].collect()
    small = content.fit_tfidf(news, 7, room=3)[2].collect()
    assert len(plain) == 7 and sorted(map(tuple, plain)) == sorted(map(tuple, small))


def test_tfidf_of_repeated_ids_and_odd_texts(spark):
    texts = {1: "One two, two_2 x TWO; a \u00c4pfel", 2: "one", 3: "the of a", 4: "\U0001d538\U0001d539 \U0001d538 two one"}
    rows = [(i, None, None, t) for i, t in texts.items()] + [(5, None, "", "two one")] * 2
    rows += [(6, None, None, "one two"), (6, None, None, "two three"), (None, None, None, "one"), (7, None, None, None)]
    news = spark.createDataFrame(rows, "news_id long, category string, subcategory string, title string")
    found = defaultdict(set)
    for r in content.tfidf(news).collect():
        found[r["news_id"]].add(r["term"])
    # the two texts of an id form no pair; one-letter and stop words are none
    assert found[6] == {"one", "two", "three", "one two", "two three"}
    assert found[1] == {"one", "two", "two_2", "\u00e4pfel", "one two", "two two_2", "two_2 two", "two \u00e4pfel"}
    assert found[4] >= {"\U0001d538\U0001d539", "two one"} and found[5] == {"two", "one", "two one"}
    assert 3 not in found and 7 not in found and found[2] == {"one"}


def test_texts_are_not_exploded_into_shuffled_terms(spark, monkeypatch, news):
    made = []
    plain = content.written
    monkeypatch.setattr(content, "written", lambda df: made.append(df.columns) or plain(df))
    content.tfidf(news).collect()
    # what is kept of texts is a row per text
    assert all("term" not in c for c in made if "text_id" in c)
    assert content.frequent_terms(
        spark.createDataFrame([(f"t{i}", 1) for i in range(3000)], "term string, copies long"), 5, 10_000
    ).count() == 5


def brute_tfidf(texts):
    import re

    from feedloom.functions.stopwords import ENGLISH

    counts = {}
    for key, text in texts.items():
        words = [w for w in re.findall(r"\w{2,}", text.lower()) if w not in ENGLISH]
        counts[key] = Counter(words + [f"{a} {b}" for a, b in zip(words, words[1:])])
    df = Counter(t for c in counts.values() for t in c)
    out = {}
    for key, c in counts.items():
        w = {t: n * (math.log((1 + len(texts)) / (1 + df[t])) + 1) for t, n in c.items()}
        length = math.sqrt(sum(x * x for x in w.values())) or 1.0
        out[key] = {t: x / length for t, x in w.items()}
    return out


@pytest.mark.parametrize("grid", [(8192, 65536), (2, 3)])
def test_content_candidates_equal_brute_force(spark, grid):
    dice = random.Random(5)
    words = ["ball", "goal", "chip", "code", "vote", "law", "film", "song"]
    texts = {i: " ".join(dice.choices(words, k=3)) for i in range(1, 25)}
    texts.update({i: "copied piece text" for i in range(25, 45)})  # copies
    texts.update({45: "the of a", 46: "unrelated otherwise"})  # no terms; no overlap
    news = spark.createDataFrame(
        [(i, None, None, t) for i, t in texts.items()],
        "news_id long, category string, subcategory string, title string",
    )
    history = {1: [1, 2, 3], 2: [25, 26, 4], 3: [45], 4: [46], 5: [999], 6: list(range(25, 45))}
    rows = spark.createDataFrame(
        [(u, i) for u, items in history.items() for i in items], "user_id long, news_id long"
    )
    vectors = brute_tfidf(texts)
    expected = {}
    for u, items in history.items():
        known = [i for i in items if i in texts]
        if not known:
            continue
        profile = Counter()
        for i in known:
            profile.update(vectors[i])
        length = math.sqrt(sum(x * x for x in profile.values())) or 1.0
        scored = [
            (math.floor(sum(profile[t] * w for t, w in v.items()) / length * 1e6 + 0.5), i)
            for i, v in vectors.items()
            if i not in items
        ]
        expected[u] = [i for _, i in sorted(scored, key=lambda x: (-x[0], x[1]))[:30]]
    found = defaultdict(list)
    out = content.content_candidates(rows, news, 30, chunk_users=grid[0], block_texts=grid[1])
    for r in out.orderBy("user_id", "rank").collect():
        found[r["user_id"]].append(r["news_id"])
    assert dict(found) == expected


def drawn_vectors(dice, n, terms):
    """Texts of a few topics, with unit vectors of some of the topic's terms and some others."""
    out = []
    for _ in range(n):
        topic = dice.randrange(40) * 20
        own = {topic + dice.randrange(20) for _ in range(6)} | {dice.randrange(terms) for _ in range(2)}
        weights = [dice.uniform(0.2, 1.0) for _ in own]
        length = math.sqrt(sum(w * w for w in weights))
        out.append((sorted(own), [w / length for w in weights]))
    return out


@pytest.mark.parametrize(("n_texts", "block_texts", "routes"), [(6000, 500, 512), (3000, 100, 4)])
def test_pruned_search_is_exact_and_compares_few(spark, monkeypatch, n_texts, block_texts, routes):
    monkeypatch.setattr(content, "ROUTES", routes)
    dice = random.Random(11)
    texts, users = drawn_vectors(dice, n_texts, 800), drawn_vectors(dice, 60, 800)
    kind = "terms array<int>, weights array<double>"
    vectors = spark.createDataFrame([(i, *v) for i, v in enumerate(texts)], f"text_id long, {kind}")
    asking = spark.createDataFrame([(i, i % 3, *v) for i, v in enumerate(users)], f"user_id long, texts int, {kind}")
    compared = spark.sparkContext.accumulator(0)
    found = defaultdict(list)
    rows = content.similar_texts(asking, vectors, 10, 16, block_texts, compared).collect()
    for r in rows:
        found[r["user_id"]].append((-math.floor(r["score"] * 1e6 + 0.5), r["text_id"]))
    for u, (terms, weights) in enumerate(users):
        own = dict(zip(terms, weights))
        scored = [
            (-math.floor(sum(own.get(t, 0.0) * w for t, w in zip(*v)) * 1e6 + 0.5), i)
            for i, v in enumerate(texts)
        ]
        assert sorted(found[u])[: 10 + u % 3] == sorted(scored)[: 10 + u % 3]
    assert compared.value < (0.15 if routes > 4 else 0.4) * len(users) * n_texts


def test_popularity_and_pool(spark, interactions, news):
    items = build_item_features(interactions, news)
    clicks = collaborative.user_clicks(interactions)
    users = spark.createDataFrame(
        [(f"U{i}", "sports", False) for i in range(1, 11)] + [("new", None, True)],
        "user_id string, user_top_category string, is_cold_start boolean",
    )
    rows = popularity.popularity_candidates(users, clicks, items, 10, 10).collect()
    seen = {(r["user_id"], r["news_id"]) for r in clicks.collect()}
    assert rows and not seen & {(r["user_id"], r["news_id"]) for r in rows}
    pool = candidate_pool(users, clicks, clicks, items, news, pool_size=15).collect()
    assert not seen & {(r["user_id"], r["news_id"]) for r in pool}
    assert len({(r["user_id"], r["news_id"]) for r in pool}) == len(pool)
    cold = [r for r in pool if r["user_id"] == "new"]
    assert len(cold) == 15 and {r["source"] for r in cold} == {"popularity_global"}
    for u in {r["user_id"] for r in pool}:
        ranks = sorted(r["rank"] for r in pool if r["user_id"] == u)
        assert ranks == list(range(1, len(ranks) + 1)) and len(ranks) <= 15


def test_exploded_lists_are_built_once(spark, interactions, news):
    """A plain explode adds a filter on the lists' sizes, which writes out and runs their expressions again."""
    items = build_item_features(interactions, news)
    clicks = collaborative.user_clicks(interactions)
    users = spark.createDataFrame([("U1", "sports"), ("U2", None)], "user_id string, user_top_category string")
    listed = popularity.popularity_candidates(users, clicks, items, 10, 10)
    shown = interactions.withColumn("score", F.lit(1.0)).withColumn("category", F.lit("x")).drop("timestamp_unix")
    packed = spark.createDataFrame([("1", "N1-0 N2-1 bad"), ("2", "")], "impression_id string, impressions string")
    for df in (
        listed,
        rerank.mmr_rerank(shown.withColumn("position", F.lit(1))),
        collaborative.similar_users(clicks),
        prep.parse_impressions(packed),
    ):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Generate" in plan and "Filter ((size(" not in plan and "Filter (size(" not in plan
    assert prep.parse_impressions(packed).count() == 2
    ranks = listed.groupBy("user_id").agg(F.max("rank").alias("last"), F.count("*").alias("n"))
    assert ranks.filter("last = n").count() == 2
