from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


@pytest.fixture(scope="session")
def spark():
    from oracle_check import session

    return session()


@pytest.fixture(scope="session")
def news(spark):
    categories = ["sports", "tech", "politics", "entertainment"]
    rows = [
        (f"N{i + 1}", categories[i // 5], f"sub_{i % 5}", f"Title of article {i + 1}", f"Text {i}")
        for i in range(20)
    ]
    return spark.createDataFrame(
        rows, "news_id string, category string, subcategory string, title string, abstract string"
    )


@pytest.fixture(scope="session")
def interactions(spark):
    import random

    dice = random.Random(42)
    rows = [
        (
            f"U{i % 10 + 1}",
            f"N{dice.randint(1, 20)}",
            dice.randint(0, 1),
            f"IMP{i // 10 + 1}",
            1572000000 + i * 3000,
            dice.randint(0, 19),
        )
        for i in range(200)
    ]
    return spark.createDataFrame(
        rows,
        "user_id string, news_id string, label int, impression_id string, timestamp_unix long, "
        "history_length int",
    )
