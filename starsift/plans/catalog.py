"""Every operator as a query over the star-schema tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starsift.functions import grades
from starsift.operators import (
    batches,
    bursts,
    classifier,
    cleaning,
    copies,
    mismatch,
    polarity,
    products,
    quality,
    ratings,
    scoring,
    topics,
    trends,
    users,
)
from starsift.plans import views
from starsift.plans.views import clean, conflicting, documents, indicator, reviews, table
from starsift.sources import reviews as review_source
from starsift.sources import sinks
from starsift.sources.workspace import materialize, table_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


def conf4():
    return F.round(F.col("sentiment_conf").cast("double"), 4).alias("sentiment_conf")


# Sources and sinks


@query
def read_and_write_stage(spark, sf_dir):
    path = table_path(spark, "clean")
    sinks.write_parquet(clean(spark, sf_dir), path, ["category", "year"])
    stage = review_source.read_reviews(spark, path)
    return stage.groupBy("category", "year").agg(
        F.count("*").alias("review_count"), F.sum("text_length").alias("text_chars")
    )


@query
def ingest_jsonl(spark, sf_dir):
    path = table_path(spark, "landing")
    rows = reviews(spark, sf_dir).withColumn("category", F.coalesce("category", F.lit("NONE")))
    line = F.to_json(F.struct(*[c for c in rows.columns if c != "category"]))
    broken = F.concat(F.lit("not json "), F.col("review_id").cast("string"))
    text = F.when(F.col("review_id") % 101 == 0, broken).otherwise(line).alias("value")
    sinks.write_lines(rows.select("category", text), path, ["category"])
    landed = review_source.ingest_jsonl(spark, path)
    return landed.groupBy("category").agg(
        F.count("*").alias("lines"),
        F.count("_corrupt_record").alias("broken"),
        F.count("text").alias("texts"),
        F.sum(F.length("text")).alias("text_chars"),
        F.round(F.avg("rating"), 6).alias("avg_rating"),
        F.sum("helpful_vote").alias("helpful_votes"),
        F.max("timestamp").alias("last_timestamp"),
    )


@query
def read_indicator(spark, sf_dir):
    return indicator(spark, sf_dir)


@query
def write_report(spark, sf_dir):
    path = table_path(spark, "report")
    summary = ratings.rating_summary(clean(spark, sf_dir))
    sinks.write_report(summary, path, order_by=["rating"])
    schema = (
        "rating DOUBLE, avg_sentiment_star DOUBLE, avg_abs_diff DOUBLE, "
        "count BIGINT, scored_count BIGINT"
    )
    back = spark.read.schema(schema).option("header", True).csv(path)
    return rounded(back, "avg_sentiment_star", "avg_abs_diff")


@query
def write_topics(spark, sf_dir):
    path = table_path(spark, "topic_info")
    sinks.write_topics(_brand_info(spark, sf_dir), path)
    return _flat(spark.read.parquet(path))


@query
def inspect_stage(spark, sf_dir):
    kept = clean(spark, sf_dir).drop("title", "parent_asin")
    return quality.inspect(kept).select("column", "rows", "nulls")


# Cleaning


@query
def standardize(spark, sf_dir):
    out = cleaning.standardize(reviews(spark, sf_dir))
    digest = F.sha2("text", 256).alias("text_hash")
    return out.select(
        "review_id", "rating", "title", digest, "asin", "parent_asin", "user_id", "timestamp",
        "verified_purchase", "helpful_vote",
    )


@query
def clean_reviews(spark, sf_dir):
    return clean(spark, sf_dir).select(
        "review_id",
        "rating",
        "asin",
        "user_id",
        "timestamp",
        "verified_purchase",
        "helpful_vote",
        F.date_format("review_time", "yyyy-MM-dd HH:mm:ss").alias("review_time"),
        "year",
        "month",
        "text_length",
        F.sha2("text", 256).alias("text_hash"),
    )


@query
def clean_reviews_strict(spark, sf_dir):
    kept = cleaning.clean_reviews(reviews(spark, sf_dir), strict=True)
    return kept.groupBy("year", "month").agg(
        F.count("*").alias("review_count"), F.sum("text_length").alias("text_chars")
    )


@query
def filter_nonempty(spark, sf_dir):
    kept = cleaning.filter_nonempty(reviews(spark, sf_dir))
    return kept.select("review_id", F.length("text").alias("text_length"))


@query
def scoring_columns(spark, sf_dir):
    out = cleaning.scoring_columns(cleaning.filter_nonempty(clean(spark, sf_dir)))
    return out.select(
        "asin", "rating", F.sha2("text", 256).alias("text_hash"), "year", "month", "user_id",
        "verified_purchase", "review_id",
    )


@query
def sample_rows(spark, sf_dir):
    return cleaning.sample_rows(clean(spark, sf_dir), 1000).select("review_id", "rating", "year")


@query
def preview(spark, sf_dir):
    top = mismatch.top_mismatches(clean(spark, sf_dir))
    names = ["review_id", "rating", "sentiment_star", "abs_diff"]
    return cleaning.preview(top, 10, names)


# Ratings against scores


@query
def global_mae(spark, sf_dir):
    return rounded(ratings.global_mae(clean(spark, sf_dir)), "mae")


@query
def global_mae_by_category(spark, sf_dir):
    return rounded(ratings.global_mae(clean(spark, sf_dir), by=("category",)), "mae")


@query
def rating_summary(spark, sf_dir):
    return rounded(
        ratings.rating_summary(clean(spark, sf_dir)), "avg_sentiment_star", "avg_abs_diff"
    )


@query
def rating_summary_by_category(spark, sf_dir):
    return rounded(
        ratings.rating_summary(clean(spark, sf_dir), by=("category",)),
        "avg_sentiment_star",
        "avg_abs_diff",
    )


@query
def rating_report(spark, sf_dir):
    return rounded(
        ratings.rating_report(clean(spark, sf_dir)), "avg_sentiment_star", "avg_abs_diff"
    )


@query
def weighted_mae(spark, sf_dir):
    summary = ratings.rating_summary(clean(spark, sf_dir))
    return rounded(ratings.weighted_mae(summary), "avg_mae", "exact_mae")


@query
def rating_distribution(spark, sf_dir):
    summary = ratings.rating_summary(clean(spark, sf_dir))
    return rounded(ratings.rating_distribution(summary), "share", "mae")


@query
def mae_grade(spark, sf_dir):
    summary = ratings.rating_summary(clean(spark, sf_dir), by=("brand",))
    return rounded(
        summary.select(
            "brand", "rating", "avg_abs_diff", grades.mae_grade(F.col("avg_abs_diff")).alias("grade")
        ),
        "avg_abs_diff",
    )


@query
def overview(spark, sf_dir):
    scored = clean(spark, sf_dir)
    info = topics.topic_counts(topics.relabel(scored, "brand"))
    return rounded(ratings.overview(scored, info), "avg_mae")


# Mismatched reviews


@query
def with_diff(spark, sf_dir):
    return mismatch.with_diff(clean(spark, sf_dir)).select("review_id", "diff", "abs_diff")


@query
def mismatched(spark, sf_dir):
    return conflicting(spark, sf_dir).select(
        "review_id", "rating", "sentiment_star", conf4(), "diff", "abs_diff",
        F.sha2("text", 256).alias("text_hash"),
    )


@query
def mismatch_total(spark, sf_dir):
    return conflicting(spark, sf_dir).agg(F.count("*").alias("mismatched_count"))


@query
def top_mismatches(spark, sf_dir):
    return mismatch.top_mismatches(clean(spark, sf_dir), 5000).select(
        "review_id", "rating", "sentiment_star", conf4(), "diff", "abs_diff",
        F.sha2("text", 256).alias("text_hash"),
    )


@query
def top_mismatches_by_category(spark, sf_dir):
    top = mismatch.top_mismatches(clean(spark, sf_dir), 100, by=("category",))
    return top.select("category", "review_id", "abs_diff", conf4())


@query
def first_mismatches(spark, sf_dir):
    report = mismatch.top_mismatches(clean(spark, sf_dir), 100)
    return report.select("review_id", "rating", "sentiment_star", conf4(), "diff")


@query
def top_examples(spark, sf_dir):
    shown = mismatch.top_examples(conflicting(spark, sf_dir), 20)
    return shown.select("review_id", "rating", "sentiment_star", "abs_diff")


@query
def explain_mismatch(spark, sf_dir):
    told = mismatch.explain_mismatch(clean(spark, sf_dir))
    return told.select("review_id", "direction", "polarity", "explanation")


@query
def search_text(spark, sf_dir):
    found = mismatch.search_reviews(conflicting(spark, sf_dir), "  Worthless ")
    return found.select("review_id", "rating", "sentiment_star", "diff")


@query
def search_number(spark, sf_dir):
    found = mismatch.search_reviews(conflicting(spark, sf_dir), "-4.0")
    return found.select("review_id", "rating", "sentiment_star", "diff")


@query
def sort_reviews(spark, sf_dir):
    ordered = mismatch.sort_reviews(conflicting(spark, sf_dir), "diff", descending=True)
    return ordered.select("review_id", "rating", "sentiment_star", conf4(), "diff")


@query
def mismatch_histogram(spark, sf_dir):
    return mismatch.mismatch_histogram(conflicting(spark, sf_dir))


@query
def confidence_bands(spark, sf_dir):
    conf = F.col("sentiment_conf")
    return clean(spark, sf_dir).select(
        "review_id", grades.conf_badge(conf).alias("badge"), grades.conf_band(conf).alias("band")
    )


# Users


def _stats(spark, sf_dir):
    return users.user_stats(clean(spark, sf_dir))


def _rounded_stats(df):
    return rounded(df, "avg_rating", "rating_stddev", "avg_sentiment")


@query
def user_stats(spark, sf_dir):
    return _rounded_stats(_stats(spark, sf_dir))


@query
def user_stats_by_category(spark, sf_dir):
    return _rounded_stats(users.user_stats(clean(spark, sf_dir), by=("category",)))


@query
def spammers(spark, sf_dir):
    return _rounded_stats(users.spammers(_stats(spark, sf_dir)))


@query
def conflicted_users(spark, sf_dir):
    return _rounded_stats(users.conflicted(_stats(spark, sf_dir)))


@query
def suspicious_users(spark, sf_dir):
    return _rounded_stats(users.suspicious_users(_stats(spark, sf_dir)))


@query
def top_suspects(spark, sf_dir):
    report = users.suspicious_users(_stats(spark, sf_dir))
    return users.top_suspects(report, 10).select("user_id", "review_count", "reason")


@query
def repeated_text(spark, sf_dir):
    return users.repeated_text(clean(spark, sf_dir))


@query
def near_copies(spark, sf_dir):
    return copies.near_copies(documents(spark, sf_dir), "doc_id")


@query
def burst_users(spark, sf_dir):
    found = users.burst_users(clean(spark, sf_dir), per="month", min_reviews=2)
    day = F.date_format("peak_bucket", "yyyy-MM-dd").alias("peak_bucket")
    return found.select("user_id", "peak_count", day, "burst_buckets")


@query
def burst_events(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    found = users.burst_users(events, per="day", min_reviews=3, time="ts")
    day = F.date_format("peak_bucket", "yyyy-MM-dd").alias("peak_bucket")
    return found.select("user_id", "peak_count", day, "burst_buckets")


@query
def burst_windows(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    found = bursts.burst_windows(events, 86_400, 3, time="ts")
    end = F.date_format("peak_end", "yyyy-MM-dd HH:mm:ss").alias("peak_end")
    return found.select("user_id", "peak_count", end, "burst_ends")


@query
def burst_sessions(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    found = bursts.burst_sessions(events, 43_200, 3, time="ts", period=7 * 86_400)
    start, end = (
        F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("session_start", "session_end")
    )
    return found.select("user_id", start, end, "review_count")


def _landed(spark, sf_dir):
    """Three batches of reviews by year, the second of them landed twice."""
    scored = materialize(
        clean(spark, sf_dir).select("user_id", "year", "rating", "sentiment_star", "asin"), "scored"
    )
    path = table_path(spark, "states")
    for batch in (1, 0, 2, 1):
        batches.add_batch(
            scored.filter(F.coalesce("year", F.lit(0)) % 3 == batch), path, batch
        )
    return path


@query
def user_stats_batches(spark, sf_dir):
    merged = batches.merged_user_stats(spark, _landed(spark, sf_dir))
    return rounded(merged, "avg_rating", "rating_stddev", "avg_sentiment")


@query
def yearly_trend_batches(spark, sf_dir):
    merged = batches.merged_yearly_trend(spark, _landed(spark, sf_dir))
    return rounded(merged, "avg_sentiment", "avg_rating")


@query
def extreme_users(spark, sf_dir):
    return rounded(users.extreme_users(clean(spark, sf_dir), 0.6, 5), "extreme_share")


# Trends


@query
def yearly_trend(spark, sf_dir):
    return rounded(trends.yearly_trend(clean(spark, sf_dir)), "avg_sentiment", "avg_rating")


@query
def yearly_trend_by_category(spark, sf_dir):
    return rounded(
        trends.yearly_trend(clean(spark, sf_dir), by=("category",)), "avg_sentiment", "avg_rating"
    )


@query
def yearly_with_indicator(spark, sf_dir):
    yearly = trends.chart_years(trends.yearly_trend(clean(spark, sf_dir)))
    joined = trends.with_indicator(yearly, indicator(spark, sf_dir))
    return rounded(joined, "avg_sentiment", "avg_rating", "inflation_rate")


@query
def macro_corr(spark, sf_dir):
    yearly = trends.yearly_trend(clean(spark, sf_dir))
    found = trends.macro_corr(yearly, indicator(spark, sf_dir))
    return rounded(found, "corr_sentiment", "corr_rating")


@query
def macro_corr_by_category(spark, sf_dir):
    yearly = trends.yearly_trend(clean(spark, sf_dir), by=("category",))
    found = trends.macro_corr(yearly, indicator(spark, sf_dir), by=("category",))
    return rounded(found, "corr_sentiment", "corr_rating")


@query
def lagged_corr(spark, sf_dir):
    yearly = trends.yearly_trend(clean(spark, sf_dir))
    found = trends.lagged_corr(yearly, indicator(spark, sf_dir), (0, 1, 2))
    return rounded(found, "corr_sentiment", "corr_rating")


@query
def monthly_trend(spark, sf_dir):
    return rounded(
        trends.monthly_trend(clean(spark, sf_dir)),
        "avg_sentiment", "avg_rating", "sentiment_change", "rating_change",
    )


# Products, brands, categories


@query
def product_sentiment(spark, sf_dir):
    return rounded(
        products.product_sentiment(clean(spark, sf_dir), 2), "avg_sentiment", "avg_rating"
    )


@query
def group_sentiment(spark, sf_dir):
    return rounded(
        products.group_sentiment(clean(spark, sf_dir), ["brand", "category"]),
        "avg_sentiment", "avg_rating",
    )


# Stage quality


@query
def stage_profile(spark, sf_dir):
    names = ("orders", "documents", "lineitem")
    profile = quality.stage_profile(spark, {n: f"{sf_dir}/{n}.parquet" for n in names})
    return profile.select("stage", "count")


@query
def stage_counts(spark, sf_dir):
    names = ("orders", "documents", "lineitem")
    return quality.stage_counts({n: table(spark, sf_dir, n) for n in names})


@query
def completeness(spark, sf_dir):
    return quality.completeness(reviews(spark, sf_dir), ["text", "rating", "asin"])


@query
def completeness_by_category(spark, sf_dir):
    return quality.completeness(reviews(spark, sf_dir), ["text", "rating"], by=("category",))


@query
def retention(spark, sf_dir):
    raw = reviews(spark, sf_dir)
    kept = cleaning.clean_reviews(raw)
    scored = kept.filter(F.col("sentiment_conf") > 0)
    return quality.retention(
        quality.stage_counts({"raw": raw, "cleaned": kept, "sentiment": scored})
    )


# Scoring


@query
def polarity_terms(spark, sf_dir):
    docs, labels = documents(spark, sf_dir), table(spark, sf_dir, "labels")
    return rounded(polarity.term_polarity(docs, labels), "p")


@query
def score_polarity(spark, sf_dir):
    docs, labels = documents(spark, sf_dir), table(spark, sf_dir, "labels")
    model = polarity.fit_hashed(docs, labels)
    scored = polarity.score_polarity(clean(spark, sf_dir), model)
    return scored.select("review_id", "sentiment_star", conf4())


@query
def score_udf(spark, sf_dir):
    # Whole texts: Spark's ten thousand rows of them at once take much of a Python worker.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2000)
    docs, labels = documents(spark, sf_dir), table(spark, sf_dir, "labels")
    load = scoring.hashed_model(polarity.fit_hashed(docs, labels))
    scored = scoring.score_reviews(clean(spark, sf_dir), load)
    return scored.select("review_id", "sentiment_star", conf4())


def _classified(kept):
    train, calibrate, _ = classifier.split_rated(kept)
    return classifier.score_classifier(
        kept, classifier.fit_classifier(train, calibration=calibrate)
    )


@query
def score_classifier(spark, sf_dir):
    kept = clean(spark, sf_dir).select("review_id", "text", "rating")
    held = (F.col("fold") == 0).alias("held_out")
    return classifier.classify(kept).select("review_id", "sentiment_star", conf4(), held)


@query
def classifier_report(spark, sf_dir):
    docs, labels = documents(spark, sf_dir), table(spark, sf_dir, "labels")
    rating = (1.0 + 4 * F.col("quality")).alias("rating")
    rated = materialize(docs.join(labels, "doc_id").select("doc_id", "text", rating), "rated")
    return rounded(
        classifier.classifier_report(_classified(rated)), "accuracy", "confidence", "gap"
    )


@query
def scored_rating_report(spark, sf_dir):
    docs, labels = documents(spark, sf_dir), table(spark, sf_dir, "labels")
    model = polarity.fit_hashed(docs, labels)
    scored = polarity.score_polarity(clean(spark, sf_dir), model)
    return rounded(ratings.rating_report(scored), "avg_sentiment_star", "avg_abs_diff")


@query
def score_bayes(spark, sf_dir):
    docs, labels = documents(spark, sf_dir), table(spark, sf_dir, "labels")
    model = classifier.fit_bayes(docs.join(labels, "doc_id"), "text", "quality")
    scored = classifier.score_bayes(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", "label", F.round("margin", 4).alias("margin"))


# Topics


def _brand_topics(spark, sf_dir):
    return topics.relabel(clean(spark, sf_dir), "brand")


def _brand_rows(spark, sf_dir):
    # Whole texts, as in score_udf.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2000)
    return clean(spark, sf_dir).select("review_id", "text", "brand")


def _brand_info(spark, sf_dir):
    return topics.labelled_info(_brand_rows(spark, sf_dir), "brand")


def _vector_axes(spark, sf_dir):
    """Two fixed projections of each embedding, all dimensions in each."""
    vector = F.transform(F.col("embedding"), lambda x: x.cast("double"))
    ups = F.zip_with(
        vector, F.sequence(F.lit(0), F.size("embedding") - 1),
        lambda x, i: F.when(i % 2 == 0, x).otherwise(-x),
    )
    total = lambda v: F.round(F.aggregate(v, F.lit(0.0), lambda a, x: a + x), 3)
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("review_id"), F.array(total(vector), total(ups)).alias("coords")
    )


def _flat(info):
    return info.select(
        "Topic", "Count", "Name", F.concat_ws("|", "Representation").alias("Representation")
    )


@query
def topic_counts(spark, sf_dir):
    return topics.topic_counts(_brand_topics(spark, sf_dir))


@query
def class_tfidf(spark, sf_dir):
    weights = topics.class_tfidf(documents(spark, sf_dir), "lang")
    return rounded(weights, "weight")


@query
def topic_terms(spark, sf_dir):
    weights = topics.class_tfidf(documents(spark, sf_dir), "lang")
    return rounded(topics.top_terms(weights, "lang", 10), "weight")


@query
def topic_info(spark, sf_dir):
    return _flat(_brand_info(spark, sf_dir))


@query
def top_topics(spark, sf_dir):
    return _flat(topics.top_topics(topics.drop_outliers(_brand_info(spark, sf_dir)), 10))


@query
def topic_bars(spark, sf_dir):
    return rounded(topics.labelled_bars(_brand_rows(spark, sf_dir), "brand", 8), "weight")


@query
def find_topics(spark, sf_dir):
    info = topics.find_topics(conflicting(spark, sf_dir))
    return info.select(
        "Topic", "Count", "Name",
        F.concat_ws("|", "Representation").alias("Representation"),
        F.concat_ws("|", "Representative_Docs").alias("Representative_Docs"),
    )


@query
def assign_topics(spark, sf_dir):
    return topics.assign_topics(_vector_axes(spark, sf_dir), 2, width=0.5)


@query
def representative_docs(spark, sf_dir):
    coords = _vector_axes(spark, sf_dir)
    assigned = topics.assign_topics(coords, 2, width=0.5)
    named = coords.select("review_id", F.concat(F.lit("v"), "review_id").alias("text"))
    shown = topics.representative_docs(named, materialize(assigned, "topics"), coords, 2)
    return shown.select("topic", F.concat_ws("|", "Representative_Docs").alias("docs"))


@query
def embedded_topics(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    assigned = topics.embedded_topics(vectors, "vec_id", "embedding")
    return topics.topic_counts(assigned)


# Every analysis per category


_BY = ("category",)


@query
def rating_report_by_category(spark, sf_dir):
    report = ratings.rating_report(clean(spark, sf_dir), _BY)
    return rounded(report, "avg_sentiment_star", "avg_abs_diff")


@query
def weighted_mae_by_category(spark, sf_dir):
    summary = ratings.rating_summary(clean(spark, sf_dir), _BY)
    return rounded(ratings.weighted_mae(summary, _BY), "avg_mae", "exact_mae")


@query
def rating_distribution_by_category(spark, sf_dir):
    summary = ratings.rating_summary(clean(spark, sf_dir), _BY)
    return rounded(ratings.rating_distribution(summary, _BY), "share", "mae")


@query
def overview_by_category(spark, sf_dir):
    scored = clean(spark, sf_dir)
    brands = scored.filter(F.col("brand").isNotNull()).groupBy("category", "brand").agg(
        F.count("*").alias("Count")
    )
    return rounded(ratings.overview(scored, brands.withColumn("Topic", F.lit(0)), by=_BY), "avg_mae")


@query
def top_suspects_by_category(spark, sf_dir):
    report = users.suspicious_users(
        users.user_stats(clean(spark, sf_dir), _BY), spam_reviews=3, conflict_reviews=2
    )
    return users.top_suspects(report, 3, _BY).select("category", "user_id", "review_count", "reason")


@query
def mismatch_histogram_by_category(spark, sf_dir):
    return mismatch.mismatch_histogram(conflicting(spark, sf_dir), _BY)


@query
def monthly_trend_by_category(spark, sf_dir):
    return rounded(
        trends.monthly_trend(clean(spark, sf_dir), _BY),
        "avg_sentiment", "avg_rating", "sentiment_change", "rating_change",
    )


@query
def lagged_corr_by_category(spark, sf_dir):
    yearly = trends.yearly_trend(clean(spark, sf_dir), _BY)
    found = trends.lagged_corr(yearly, indicator(spark, sf_dir), (0, 1, 2), by=_BY)
    return rounded(found, "corr_sentiment", "corr_rating")


@query
def product_sentiment_by_category(spark, sf_dir):
    return rounded(
        products.product_sentiment(clean(spark, sf_dir), 2, _BY), "avg_sentiment", "avg_rating"
    )


@query
def repeated_text_by_category(spark, sf_dir):
    return users.repeated_text(clean(spark, sf_dir), by=_BY)


@query
def burst_users_by_category(spark, sf_dir):
    found = users.burst_users(clean(spark, sf_dir), per="year", min_reviews=2, by=_BY)
    day = F.date_format("peak_bucket", "yyyy-MM-dd").alias("peak_bucket")
    return found.select("category", "user_id", "peak_count", day, "burst_buckets")


@query
def extreme_users_by_category(spark, sf_dir):
    return rounded(users.extreme_users(clean(spark, sf_dir), 0.6, 2, _BY), "extreme_share")


@query
def retention_by_category(spark, sf_dir):
    raw = reviews(spark, sf_dir)
    stages = {"raw": raw, "cleaned": cleaning.clean_reviews(raw)}
    return quality.retention(quality.stage_counts(stages, _BY))
