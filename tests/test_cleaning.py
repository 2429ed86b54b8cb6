import datetime as dt

import pytest
from pyspark.sql import functions as F

from starsift.operators import cleaning
from starsift.schema import MissingColumns, with_review_id

RAW = "rating DOUBLE, text STRING, user_id STRING, timestamp BIGINT, asin STRING"


def raw(spark, *texts, timestamp=0):
    return spark.createDataFrame([(5.0, t, "u", timestamp, "a") for t in texts], RAW)


def test_missing_optional_columns_become_typed_nulls(spark):
    out = cleaning.standardize(raw(spark, "x"))
    assert dict(out.dtypes)["helpful_vote"] == "int"
    assert out.first()["title"] is None


def test_missing_required_column_is_named(spark):
    with pytest.raises(MissingColumns, match="asin"):
        cleaning.standardize(raw(spark, "x").drop("asin"))


def test_scoring_needs_the_product(spark):
    with pytest.raises(MissingColumns, match="asin"):
        cleaning.scoring_columns(cleaning.clean_reviews(raw(spark, "x")).drop("asin"))


def test_blank_texts(spark, rows):
    df = raw(spark, None, "", "   ", "\n\t ", " ok ")
    assert set(rows(cleaning.filter_nonblank(df), "text")) == {("\n\t ",), (" ok ",)}
    assert rows(cleaning.filter_nonblank(df, strict=True), "text") == [(" ok ",)]
    assert set(rows(cleaning.filter_nonempty(df), "text")) == {("\n\t ",), ("   ",), (" ok ",)}


@pytest.mark.parametrize(
    ("ms", "time", "year"),
    [
        (1_577_836_800_123, dt.datetime(2020, 1, 1), 2020),
        (-1500, dt.datetime(1969, 12, 31, 23, 59, 58), 1969),
        (10**18, None, None),
        (None, None, None),
    ],
)
def test_review_time(spark, ms, time, year):
    row = cleaning.add_review_time(raw(spark, "x", timestamp=ms)).first()
    assert row["review_time"] == time
    assert row["year"] == year


def test_year_does_not_depend_on_the_session_zone(spark):
    df = cleaning.add_review_time(raw(spark, "x", timestamp=1_577_836_800_000))
    spark.conf.set("spark.sql.session.timeZone", "America/Vancouver")
    try:
        assert df.select("year", "month").first() == (2020, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_text_length_counts_untrimmed_characters(spark):
    out = cleaning.with_text_length(raw(spark, " né "))
    assert out.first()["text_length"] == 4
    kept = cleaning.with_text_length(out.withColumn("text_length", F.lit(9)))
    assert kept.first()["text_length"] == 9


def test_review_id_comes_from_content(spark):
    a = with_review_id(raw(spark, "x", "y")).collect()
    b = with_review_id(raw(spark, "x", "y").repartition(3)).collect()
    assert {r["review_id"] for r in a} == {r["review_id"] for r in b}
    assert len({r["review_id"] for r in a}) == 2


def test_sample_is_repeatable_and_spread(spark, rows):
    df = raw(spark, *[f"text {i}" for i in range(200)])
    one = cleaning.sample_rows(df, 50, 4)
    two = cleaning.sample_rows(df.repartition(7), 50, 4)
    assert rows(one, "text") == rows(two, "text")
    assert one.count() == 50
    assert one.rdd.getNumPartitions() == 4


def test_preview_falls_back_to_all_columns(spark):
    df = raw(spark, "a", "b", "c")
    assert cleaning.preview(df, 2, ["text", "nothing"]).columns == ["text"]
    assert cleaning.preview(df, 2, ["nothing"]).columns == df.columns
    assert cleaning.preview(df, 2).count() == 2
