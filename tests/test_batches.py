import itertools
import random

import pytest

from starsift.operators import batches, trends, users

SCHEMA = "user_id STRING, year INT, rating DOUBLE, sentiment_star INT, asin STRING, batch INT"


def close(rows):
    return sorted(
        (tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows), key=repr
    )


@pytest.fixture(scope="module")
def landed(spark):
    draw = random.Random(3)
    some = lambda *values: draw.choice([*values, None])
    data = [
        (some("a", "a", "b", "c"), some(2001, 2002), some(1.0, 2.5, 5.0), some(1, 3, 5), some("x", "y", "z"), i % 3)
        for i in range(300)
    ]
    data += [("solo", 2001, 4.0, None, None, 1), ("steady", 2001, 4.5, 2, "x", 0), ("steady", 2002, 4.5, 2, "x", 2)]
    return spark.createDataFrame(data, SCHEMA).cache()


@pytest.mark.parametrize("order", list(itertools.permutations(range(3)))[::2])
def test_any_order_of_batches_equals_one_pass(spark, landed, tmp_path, order):
    path = str(tmp_path)
    for batch in (*order, order[0]):
        batches.add_batch(landed.filter(f"batch = {batch}"), path, batch)
    whole = users.user_stats(landed)
    merged = batches.merged_user_stats(spark, path).select(*whole.columns)
    assert merged.dtypes == whole.dtypes
    assert close(merged.collect()) == close(whole.collect())
    yearly = trends.yearly_trend(landed)
    again = batches.merged_yearly_trend(spark, path).select(*yearly.columns)
    assert close(again.collect()) == close(yearly.collect())


def test_an_empty_batch(spark, landed, tmp_path):
    batches.add_batch(landed.filter("false"), str(tmp_path), 0)
    assert batches.merged_user_stats(spark, str(tmp_path)).count() == 0
