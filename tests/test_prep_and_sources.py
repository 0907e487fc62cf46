from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from feedloom.operators import context_features, prep, recommend
from feedloom.operators.feature_matrix import feature_columns, run_feature_pipeline
from feedloom.operators.item_features import build_item_features, item_content
from feedloom.operators.popularity import baseline_scores
from feedloom.sources import artifacts, logs

NEWS = [
    "N1\tsports\tgolf\tA \"quoted title\tabstract one\turl\t[]\t[]",
    "N2\ttech\tai\tSecond title\t\turl\t[]\t[]",
    "N2\ttech\tai\tSecond title again\t\turl\t[]\t[]",
    "N3\tpolitics\tvote\tThird title\tx y z\turl\t[]\t[]",
]
BEHAVIORS = [
    "1\tU1\t11/11/2019 9:05:58 AM\tN1 N2\tN1-1 N2-0",
    "2\tU2\t11/12/2019 6:11:30 PM\t\tN2-1 N3-0 bad N9-1 N1-",
    "3\tU1\t11/13/2019 12:00:01 AM\t \tN3-1 N3-1",
    "4\tU3\tnonsense\tN1\tN1-0",
    "5\tU4\t11/14/2019 1:00:00 PM\tN1\t ",
]


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    (folder / "news.tsv").write_text("\n".join(NEWS) + "\n")
    (folder / "behaviors.tsv").write_text("\n".join(BEHAVIORS) + "\n")
    return logs.read_dataset(spark, str(folder))


def test_raw_scans(raw):
    titles = {r["news_id"]: r["title"] for r in raw["news"].collect()}
    assert titles == {"N1": 'A "quoted title', "N2": "Second title", "N3": "Third title"}
    times = {r["impression_id"]: r["timestamp"] for r in raw["behaviors"].collect()}
    assert set(times) == {"1", "2", "3", "4"} and times["4"] is None
    assert (times["2"].hour, times["3"].hour) == (18, 0)


def test_parse_impressions_and_history(raw):
    parsed = prep.parse_history(prep.parse_impressions(raw["behaviors"]))
    rows = {(r["impression_id"], r["news_id"], r["label"]) for r in parsed.collect()}
    assert rows == {
        ("1", "N1", 1), ("1", "N2", 0), ("2", "N2", 1), ("2", "N3", 0), ("2", "N9", 1),
        ("3", "N3", 1), ("4", "N1", 0),
    }
    lengths = {r["impression_id"]: r["history_length"] for r in parsed.collect()}
    assert lengths == {"1": 2, "2": 0, "3": 0, "4": 1}


def test_preparation_and_statistics(raw):
    out = prep.prepare(raw["behaviors"], raw["news"])
    assert out.count() == 6 and out.filter("timestamp_unix IS NULL").count() == 0
    stats = prep.prep_statistics(raw["behaviors"], raw["news"]).first().asDict()
    assert stats["raw_behaviors"] == 4 and stats["raw_news"] == 3
    assert stats["removed_invalid_ids"] == 1 and stats["removed_duplicates"] == 1
    assert stats["total_interactions"] == 6 and stats["positive_interactions"] == 3
    assert stats["train_size"] + stats["val_size"] + stats["test_size"] == 6
    assert stats["users_with_empty_history"] == 2


def test_splits_are_ordered_and_whole(interactions):
    split = prep.time_split(interactions)
    spans = {
        r["split"]: (r["first"], r["last"], r["n"])
        for r in split.groupBy("split")
        .agg(
            F.min("timestamp_unix").alias("first"),
            F.max("timestamp_unix").alias("last"),
            F.count("*").alias("n"),
        )
        .collect()
    }
    assert spans["train"][1] < spans["val"][0] and spans["val"][1] < spans["test"][0]
    assert [spans[s][2] for s in ("train", "val", "test")] == [140, 30, 30]
    rough = prep.time_split(interactions, rel_error=0.01).filter("split = 'train'").count()
    assert abs(rough - 140) <= 4
    with pytest.raises(ValueError):
        prep.time_split(interactions, 0.5, 0.1, 0.1)


def test_pipeline_round_trip(spark, interactions, news, tmp_path):
    split = prep.time_split(interactions)
    logs.write_processed(news, split, f"{tmp_path}/processed")
    back = logs.read_processed(spark, f"{tmp_path}/processed")
    assert [back[s].count() for s in ("news", "train", "val", "test")] == [20, 140, 30, 30]
    features = run_feature_pipeline(split, news)
    logs.write_features(features, f"{tmp_path}/features")
    again = logs.read_features(spark, f"{tmp_path}/features")
    assert set(again) == set(logs.FEATURE_SETS)
    assert again["train"].count() == 140 and len(feature_columns(again["train"])) == 43
    assert again["item_features"].count() == 20
    assert logs.read_features(spark, f"{tmp_path}/nothing") == {}
    artifacts.save_comparison(again["val"].limit(1).select("user_ctr"), str(tmp_path))
    table = spark.read.option("header", True).csv(f"{tmp_path}/model_comparison")
    assert table.columns == ["user_ctr"]


def test_cold_items_and_content(spark, interactions, news):
    extra = news.unionByName(
        spark.createDataFrame([("N99", "sports", "sub", None, " ")], news.schema)
    )
    cold = build_item_features(interactions, extra).filter("news_id = 'N99'").first()
    assert (cold["item_smoothed_ctr"], cold["item_freshness_score"]) == (0.1, 1.0)
    assert cold["item_total_clicks"] == 0 and cold["category_total_impressions"] > 0
    text = item_content(extra).filter("news_id = 'N99'").first()
    assert (text["item_title_length"], text["item_has_abstract"]) == (0, 0)


def test_context_positions_of_text_ids(interactions):
    rows = context_features.build_context_features(interactions).collect()
    assert len(rows) == 200
    groups = {}
    for r in rows:
        groups.setdefault(r["impression_id"], []).append(r)
    for members in groups.values():
        ordered = sorted(members, key=lambda r: r["ctx_position_in_impression"])
        assert [r["ctx_position_in_impression"] for r in ordered] == list(range(1, 11))
        assert [r["news_id"] for r in ordered] == sorted(r["news_id"] for r in ordered)
        assert {r["ctx_impression_size"] for r in ordered} == {10}


def test_recommend_routes_and_guards(spark, interactions, news):
    items = build_item_features(interactions, news)
    scores = baseline_scores(items)
    users = interactions.select("user_id").distinct()
    asked = spark.createDataFrame([("U1",), ("nobody",), (" ",), (None,)], "user_id string")
    rows = recommend.recommend(asked, users, items, scores=scores, top_k=4).collect()
    assert {(r["user_id"], r["is_cold_start"], r["source"]) for r in rows} == {
        ("U1", False, "personalized"),
        ("nobody", True, "cold_start_popular"),
    }
    assert sorted(r["rank"] for r in rows) == [1, 1, 2, 2, 3, 3, 4, 4]
    scored = recommend.recommend(
        asked, users, items, scorer=lambda df: df.withColumn("score", F.col("item_ctr")), top_k=4
    ).filter("NOT is_cold_start")
    assert scored.count() == 4
    capped = recommend.recommend(
        asked, users, items, scores=scores, top_k=4, max_per_category=1
    ).filter("is_cold_start")
    assert capped.select("category").distinct().count() == 4
    for bad in (0, 101):
        with pytest.raises(ValueError):
            recommend.recommend(asked, users, items, scores=scores, top_k=bad)


def test_scratch_deletes_what_it_wrote(spark):
    from feedloom.functions.frames import scratch, shared_folder, written
    from feedloom.sources.logs import path_exists

    folder = f"{shared_folder(spark)}/tables"
    kept = written(spark.range(3))
    with scratch(spark):
        inside = written(spark.range(5))
        assert inside.count() == 5
        gone = inside.inputFiles()[0].rsplit("/", 1)[0]
    assert kept.count() == 3 and path_exists(spark, folder) and not path_exists(spark, gone)
