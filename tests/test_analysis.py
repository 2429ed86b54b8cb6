import hashlib

import pytest
from pyspark.sql import functions as F

from starsift.functions import grades
from starsift.operators import mismatch, products, quality, ratings, topk, trends, users
from starsift.schema import MissingColumns

SCORED = (
    "review_id BIGINT, user_id STRING, asin STRING, rating DOUBLE, sentiment_star INT, "
    "sentiment_conf FLOAT, text STRING, year INT, month INT"
)


def scored(spark, *rows):
    full = []
    for i, row in enumerate(rows):
        base = {
            "review_id": i, "user_id": "u", "asin": f"a{i}", "rating": 5.0, "sentiment_star": 5,
            "sentiment_conf": 0.5, "text": f"text {i}", "year": 2000, "month": 1,
        }
        full.append(tuple({**base, **row}.values()))
    return spark.createDataFrame(full, SCORED)


def test_mismatch_is_inclusive_and_skips_unknown(spark, rows):
    df = scored(
        spark,
        {"rating": 5.0, "sentiment_star": 2},
        {"rating": 5.0, "sentiment_star": 3},
        {"rating": 5.0, "sentiment_star": None},
        {"rating": None, "sentiment_star": 1},
    )
    assert rows(mismatch.mismatched(df), "review_id", "diff", "abs_diff") == [(0, -3.0, 3.0)]


def test_mismatch_needs_its_columns(spark):
    with pytest.raises(MissingColumns, match="sentiment_conf"):
        mismatch.mismatched(scored(spark, {}).drop("sentiment_conf"))


def test_ties_at_the_limit_go_to_the_smaller_id(spark):
    df = scored(spark, *[{"rating": 5.0, "sentiment_star": 1} for _ in range(9)]).repartition(4)
    got = [r["review_id"] for r in mismatch.top_mismatches(df, 4).collect()]
    assert got == [0, 1, 2, 3]


def test_top_k_per_group(spark, rows):
    df = spark.range(200).select("id", (F.col("id") % 3).alias("g")).repartition(5)
    got = topk.top_k(df, [("id", True)], 2, by=("g",))
    assert rows(got, "g", "id") == [(0, 195), (0, 198), (1, 196), (1, 199), (2, 194), (2, 197)]


@pytest.mark.parametrize("k", [1, 10, 2000])
def test_top_k_equals_a_plain_limit(spark, k):
    df = spark.range(1500).select("id", F.pmod(F.xxhash64("id"), F.lit(7)).alias("v"))
    order = [F.desc("v"), F.asc("id")]
    plain = df.orderBy(*order).limit(k).collect()
    got = topk.top_k(df.repartition(6), [("v", True), ("id", False)], k)
    assert got.collect() == plain


def test_top_k_moves_no_text_before_the_cut(spark):
    df = spark.range(50).select("id", F.repeat(F.lit("x"), 10).alias("text"))
    plan = topk.top_k(df.repartition(3), [("id", True)], 5)._jdf.queryExecution().optimizedPlan()
    sub = plan.toString().split("scalar-subquery")[-1]
    assert "repeat" not in sub.split("Range")[0].split("Repartition")[0]


def test_top_k_places_nulls_as_a_plain_sort(spark):
    df = spark.createDataFrame([(i, None if i % 4 == 0 else i % 3) for i in range(30)], "id INT, v INT")
    for falls, column in ((True, F.desc("v")), (False, F.asc("v"))):
        plain = df.orderBy(column, "id").limit(12).collect()
        assert topk.top_k(df, [("v", falls), ("id", False)], 12).collect() == plain


def test_explanations(spark):
    df = scored(
        spark,
        {"rating": 5.0, "sentiment_star": 1},
        {"rating": 1.0, "sentiment_star": 5},
        {"rating": 3.0, "sentiment_star": 3},
        {"rating": 5.0, "sentiment_star": 3},
        {"rating": None, "sentiment_star": 2},
    )
    got = mismatch.explain_mismatch(df).orderBy("review_id").collect()
    assert got[0]["explanation"] == (
        "User gave 5 stars but the text expresses negative sentiment (1.0 stars). "
        "This mismatch indicates potential fake review or rating error."
    )
    assert got[1]["explanation"] == (
        "User gave 1 stars but the text expresses positive sentiment (5.0 stars). "
        "Rating may not reflect actual product sentiment."
    )
    assert [r["polarity"] for r in got] == ["negative", "positive", None, "neutral", "negative"]
    assert got[2]["direction"] == "aligned"
    assert got[4]["direction"] == "under-rated"


def test_polarity_differs_at_the_limits_by_direction(spark):
    df = spark.createDataFrame(
        [(5.0, 2.5), (1.0, 2.5), (5.0, 3.5), (1.0, 3.5)], "rating DOUBLE, sentiment_star DOUBLE"
    )
    got = [r["polarity"] for r in mismatch.explain_mismatch(df).collect()]
    assert got == ["neutral", "negative", "positive", "neutral"]


@pytest.mark.parametrize(
    ("term", "ids"),
    [("", [0, 1, 2]), (" LOVE ", [0]), ("-4.0", [0]), ("4.5", [1]), ("n/a", [2]), ("3.5", [1])],
)
def test_search(spark, term, ids):
    df = mismatch.with_diff(
        scored(
            spark,
            {"rating": 5.0, "sentiment_star": 1, "text": "I love it"},
            {"rating": 4.5, "sentiment_star": 1, "text": "fine"},
            {"rating": 5.0, "sentiment_star": 2, "text": None},
        )
    )
    got = sorted(r["review_id"] for r in mismatch.search_reviews(df, term).collect())
    assert got == ids


def test_sort_by_size_of_difference(spark):
    df = mismatch.with_diff(
        scored(
            spark,
            {"rating": 5.0, "sentiment_star": 2},
            {"rating": 1.0, "sentiment_star": 5},
            {"rating": None},
        )
    )
    up = [r["review_id"] for r in mismatch.sort_reviews(df, "diff").collect()]
    down = [r["review_id"] for r in mismatch.sort_reviews(df, "diff", True).collect()]
    assert up == [2, 0, 1]
    assert down == [1, 0, 2]
    with pytest.raises(ValueError, match="text"):
        mismatch.sort_reviews(df, "text")


def test_top_examples_fall_back_to_diff(spark):
    df = spark.createDataFrame(
        [(1, "a", None, -4.0), (2, " \n\u00a0", 9.0, 9.0), (3, "c", 3.0, 3.0), (4, "d", None, None)],
        "review_id INT, text STRING, abs_diff DOUBLE, diff DOUBLE",
    )
    assert [r["review_id"] for r in mismatch.top_examples(df, 2).collect()] == [1, 3]


def test_histogram_sums_to_the_mismatches(spark):
    df = scored(spark, *[{"rating": 1.0 + i % 5, "sentiment_star": 1 + (i // 5) % 5} for i in range(60)])
    found = mismatch.mismatched(df)
    total = mismatch.mismatch_histogram(found).agg(F.sum("count")).first()[0]
    assert total == found.count()


def test_confidence_limits_follow_the_written_number(spark):
    df = spark.createDataFrame(
        [(c,) for c in (0.39, 0.4, 0.6, 0.7, 0.8, 1.0)] + [(None,)], "c FLOAT"
    )
    got = df.select(grades.conf_badge(F.col("c")), grades.conf_band(F.col("c"))).collect()
    assert [r[0] for r in got] == ["low", "medium", "medium", "high", "high", "high", None]
    assert [r[1] for r in got] == [
        "0.0-0.4", "0.4-0.6", "0.6-0.8", "0.6-0.8", "0.8-1.0", "0.8-1.0", None,
    ]


def test_mae_grades(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 0.5, 1.0, 2.0, 3.0, None)], "m DOUBLE")
    got = [r[0] for r in df.select(grades.mae_grade(F.col("m"))).collect()]
    assert got == ["excellent", "good", "moderate", "significant", "severe", None]


def test_rating_report_keeps_the_unrated_group_apart_from_the_total(spark):
    df = scored(
        spark,
        {"rating": 1.0, "sentiment_star": 2},
        {"rating": None, "sentiment_star": 4},
        {"rating": 1.0, "sentiment_star": None},
    )
    got = {(r["level"], r["rating"]): r for r in ratings.rating_report(df).collect()}
    assert got["rating", 1.0]["count"] == 2
    assert got["rating", 1.0]["scored_count"] == 1
    assert got["rating", None]["avg_abs_diff"] is None
    assert got["total", None]["count"] == 3
    assert got["total", None]["avg_abs_diff"] == ratings.global_mae(df).first()["mae"] == 1.0


def test_weighted_mae_equals_global_on_complete_data(spark):
    df = scored(spark, *[{"rating": 1.0 + i % 5, "sentiment_star": 1 + (i // 5) % 5} for i in range(50)])
    got = ratings.weighted_mae(ratings.rating_summary(df)).first()
    exact = ratings.global_mae(df).first()["mae"]
    assert got["avg_mae"] == pytest.approx(exact)
    assert got["exact_mae"] == pytest.approx(exact)
    empty = ratings.weighted_mae(ratings.rating_summary(df.limit(0))).first()
    assert tuple(empty) == (0.0, 0.0)


def test_overview_counts_all_mismatches(spark):
    df = scored(spark, *[{"rating": 5.0, "sentiment_star": 1} for _ in range(150)], {"rating": None})
    topics = spark.createDataFrame([(-1, 5), (0, 3), (1, 2)], "Topic INT, Count INT")
    got = ratings.overview(df, topics).first()
    assert (got["total_ratings"], got["mismatched_count"], got["topic_count"]) == (151, 150, 2)
    none = ratings.overview(df.limit(0), topics).first()
    assert (none["total_ratings"], none["mismatched_count"], none["avg_mae"]) == (0, 0, 0.0)


def test_users_of_both_cohorts_appear_twice(spark, rows):
    df = scored(spark, *[{"user_id": "x", "rating": 5.0, "sentiment_star": 1} for _ in range(5)])
    report = users.suspicious_users(users.user_stats(df))
    assert rows(report, "user_id", "reason") == [
        ("x", "Conflicted (High Rating, Low Sentiment)"),
        ("x", "Potential Spammer (High Vol, No Variance)"),
    ]


def test_one_pass_report_equals_the_union(spark):
    df = scored(
        spark,
        *[
            {"user_id": f"u{i % 9}", "rating": 5.0 if i % 9 < 5 else 1.0 + i % 5,
             "sentiment_star": 1 + i % 2 if i % 9 < 3 else 4}
            for i in range(120)
        ],
    )
    stats = users.user_stats(df)
    union = users.spammers(stats).unionByName(users.conflicted(stats))
    report = users.suspicious_users(stats)
    assert report.exceptAll(union).count() == union.exceptAll(report).count() == 0
    assert report.count() > 0


def test_unrated_reviews_make_a_spammer_by_the_null_branch(spark):
    df = scored(spark, *[{"user_id": "x", "rating": None} for _ in range(5)])
    stats = users.user_stats(df).first()
    assert stats["rating_stddev"] is None
    assert users.spammers(users.user_stats(df)).count() == 1


def test_null_users_form_a_group(spark):
    df = scored(spark, {"user_id": None}, {"user_id": None, "asin": None}, {"user_id": "x"})
    got = {r["user_id"]: r for r in users.user_stats(df).collect()}
    assert got[None]["review_count"] == 2
    assert got[None]["product_count"] == 1


def test_top_suspects_per_reason(spark):
    stats = spark.createDataFrame(
        [(f"u{i}", i, users.SPAMMER if i % 2 else users.CONFLICTED) for i in range(8)],
        "user_id STRING, review_count INT, reason STRING",
    )
    got = users.top_suspects(stats, 2).collect()
    assert sorted(r["user_id"] for r in got) == ["u4", "u5", "u6", "u7"]


def test_repeated_text_ignores_case_and_spacing(spark, rows):
    df = scored(
        spark, {"text": "Same  text"}, {"text": "same text "}, {"text": "other"}, {"text": None}
    )
    assert rows(users.repeated_text(df), "user_id", "copies", "first_review_id") == [("u", 2, 0)]


def test_bursts(spark, rows):
    df = spark.createDataFrame(
        [("a", "2020-01-01 01:00:00")] * 3 + [("a", "2020-01-03 02:00:00")] * 3
        + [("b", "2020-01-01 01:00:00")],
        "user_id STRING, t STRING",
    ).withColumn("review_time", F.to_timestamp("t"))
    out = users.burst_users(df, "day", 3)
    assert rows(out, "user_id", "peak_count", F.date_format("peak_bucket", "yyyy-MM-dd"), "burst_buckets") == [
        ("a", 3, "2020-01-01", 2)
    ]


def test_extreme_users(spark, rows):
    df = scored(
        spark,
        *[{"user_id": "x", "sentiment_star": s} for s in (1, 5, 5, 1, 3)],
        *[{"user_id": "y", "sentiment_star": s} for s in (2, 3, 4, 1, 3)],
        *[{"user_id": "z", "sentiment_star": 5} for _ in range(4)],
    )
    assert rows(users.extreme_users(df, 0.8, 5), "user_id", "extreme_share") == [("x", 0.8)]


def indicator(spark, *pairs):
    return spark.createDataFrame(list(pairs), "year INT, rate DOUBLE")


def yearly(spark, *triples):
    return spark.createDataFrame(
        [(y, s, r, 1) for y, s, r in triples],
        "year INT, avg_sentiment DOUBLE, avg_rating DOUBLE, review_count BIGINT",
    )


def test_yearly_keeps_the_unknown_year_and_charts_drop_it(spark):
    df = scored(spark, {"year": None}, {"year": 0}, {"year": 2001})
    out = trends.yearly_trend(df)
    assert out.count() == 3
    assert [r["year"] for r in trends.chart_years(out).collect()] == [2001]


def test_constant_series_and_few_years_give_null(spark):
    rates = indicator(spark, (1, 2.0), (2, 3.0), (3, 4.0))
    flat = trends.macro_corr(yearly(spark, (1, 1.0, 1.0), (2, 1.0, 2.0), (3, 1.0, 3.0)), rates).first()
    assert flat["corr_sentiment"] is None
    assert flat["corr_rating"] == pytest.approx(1.0)
    few = trends.macro_corr(yearly(spark, (1, 1.0, 1.0), (2, 2.0, 2.0)), rates).first()
    assert tuple(few) == (2, None, None)


def test_correlation_equals_spark_corr(spark):
    points = [(y, (y * 7 % 5) / 3, (y * 11 % 7) / 2) for y in range(12)]
    rates = indicator(spark, *[(y, (y * 5 % 9) / 4) for y in range(12)])
    frame = yearly(spark, *points)
    joined = frame.join(rates, "year").agg(F.corr("avg_sentiment", "rate"), F.corr("avg_rating", "rate"))
    got = trends.macro_corr(frame, rates).first()
    assert (got["corr_sentiment"], got["corr_rating"]) == pytest.approx(tuple(joined.first()))


def test_incomplete_years_do_not_count(spark):
    frame = yearly(spark, (None, 1.0, 1.0), (1, None, 1.0), (2, 2.0, 3.0), (9, 2.0, 3.0))
    assert trends.macro_corr(frame, indicator(spark, (1, 1.0), (2, 2.0))).first()["years"] == 1


def test_lag_shifts_the_indicator(spark):
    frame = yearly(spark, *[(y, float(y % 3), float(y % 4)) for y in range(10, 20)])
    rates = indicator(spark, *[(y - 1, float(y % 3)) for y in range(10, 20)])
    got = {r["lag"]: r["corr_sentiment"] for r in trends.lagged_corr(frame, rates).collect()}
    assert got[1] == pytest.approx(1.0)
    assert got[0] < 0.9


def test_monthly_change_within_groups(spark):
    df = scored(
        spark,
        {"asin": "p", "month": 1, "sentiment_star": 2},
        {"asin": "p", "month": 2, "sentiment_star": 5},
        {"asin": "q", "month": 2, "sentiment_star": 1},
    )
    got = {(r["asin"], r["month"]): r["sentiment_change"] for r in trends.monthly_trend(df, ("asin",)).collect()}
    assert got == {("p", 1): None, ("p", 2): 3.0, ("q", 2): None}


def test_grouping_sets_keep_null_values(spark, rows):
    df = scored(spark, {"asin": "p"}, {"asin": None}, {"asin": None})
    out = products.group_sentiment(df, ["asin", "user_id"])
    assert rows(out, "key", "value", "review_count") == [
        ("asin", "p", 1), ("asin", None, 2), ("user_id", "u", 3),
    ]
    one = products.product_sentiment(df).first()
    assert (one["asin"], one["star_5"]) == ("p", 1)


def test_completeness_is_measured(spark):
    df = spark.createDataFrame([("a", None), (None, None), ("b", 1.0), ("c", 2.0)], "text STRING, rating DOUBLE")
    got = quality.completeness(df).first()
    assert (got["rows"], got["null_text"], got["null_rating"], got["completeness"]) == (4, 1, 2, 62.5)
    assert quality.completeness(df.drop("rating")).first()["completeness"] == 75.0
    assert quality.completeness(df.limit(0)).first()["completeness"] is None


def test_retention_and_reduction_add_up(spark):
    stages = {"raw": spark.range(200), "cleaned": spark.range(150), "sentiment": spark.range(30)}
    got = quality.retention(quality.stage_counts(stages)).first()
    assert got["retention_rate"] + got["data_reduction"] == 100.0
    assert got["sentiment_retention"] == 15.0


def test_stage_profile_counts_rows_and_bytes(spark, tmp_path):
    path = str(tmp_path / "stage")
    spark.range(300_000).repartition(3).write.parquet(path)
    size = sum(f.stat().st_size for f in (tmp_path / "stage").glob("*.parquet"))
    got = quality.stage_profile(spark, {"raw": path}).first()
    assert (got["stage"], got["count"], got["files"]) == ("raw", 300_000, 3)
    assert got["size_mb"] == round(size / 1024 / 1024, 2)


def test_inspect_lists_columns(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a INT, b STRING")
    got = [tuple(r) for r in quality.inspect(df).collect()]
    assert got == [(0, "a", "int", 2, 0), (1, "b", "string", 2, 1)]


def test_monthly_change_is_against_the_calendar_month_before(spark):
    rows = [(2000, 1, 2.0), (2000, 2, 3.0), (2000, 5, 4.0), (2000, 12, 1.0), (2001, 1, 5.0), (None, None, 5.0)]
    df = spark.createDataFrame(
        [(y, m, s, s) for y, m, s in rows], "year INT, month INT, sentiment_star DOUBLE, rating DOUBLE"
    )
    got = {(r["year"], r["month"]): r["sentiment_change"] for r in trends.monthly_trend(df).collect()}
    assert got == {(2000, 1): None, (2000, 2): 1.0, (2000, 5): None, (2000, 12): None,
                   (2001, 1): 4.0, (None, None): None}


def test_repeated_text_strips_each_distinct_text_once(spark, monkeypatch):
    split = spark.sparkContext.accumulator(0)

    def lowered(text):
        @F.udf("string")
        def once(text):
            split.add(1)
            return " ".join(text.lower().split())

        return once(F.col(text))

    monkeypatch.setattr(users, "normalized", lowered)
    rows = [(i, f"u{i % 3}", "A  b" if i % 2 else "a b") for i in range(60)] + [(60, "u1", None), (61, None, "z")]
    df = spark.createDataFrame(rows, "review_id INT, user_id STRING, text STRING").repartition(4)
    got = sorted((r["user_id"], r["copies"], r["first_review_id"]) for r in users.repeated_text(df).collect())
    assert got == [("u0", 20, 0), ("u1", 20, 1), ("u2", 20, 2)]
    assert split.value <= 2 * 3


def test_repeated_text_reads_its_input_once(spark):
    rows = [(1, "u", "A  b", "x"), (2, "u", "a b ", "x"), (2, "u", "a b ", "x"), (3, "u", "a b", None),
            (4, "u", "a B", None), (5, None, "a b", "x"), (6, None, "a b", "x"), (7, "u", None, "x"),
            (8, "u", None, "x"), (9, "v", "", "x"), (9, "v", " \t", "x"), (None, "v", "a b", "x"),
            (10, "v", "a b", "x"), (11, "w", "alone", "x"), (None, None, "n", None), (None, None, "N", None)]
    schema = "review_id INT, user_id STRING, text STRING, category STRING"
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    df = spark.createDataFrame(rows, schema).repartition(4).mapInArrow(counted, schema)
    found = users.repeated_text(df, by=("category",))
    assert found.columns == ["category", "user_id", "text_hash", "copies", "first_review_id"]
    got = {(r["category"], r["user_id"], r["text_hash"][:4], r["copies"], r["first_review_id"])
           for r in found.collect()}
    short = {t: hashlib.sha256(t.encode()).hexdigest()[:4] for t in ("a b", "", "n")}
    assert got == {("x", "u", short["a b"], 3, 1), (None, "u", short["a b"], 2, 3),
                   ("x", None, short["a b"], 2, 5), ("x", "v", short[""], 2, 9),
                   ("x", "v", short["a b"], 2, 10), (None, None, short["n"], 2, None)}
    assert read.value == len(rows)
