"""SQL that gives the same rows as each query of the catalog, over whole tables."""

from __future__ import annotations

from starsift.plans.views import BLANK_YEAR, COUNTRY

# Named relations; each may use those it lists.
RELATIONS: dict[str, tuple[tuple[str, ...], str]] = {
    "first_line": ((), "SELECT l_orderkey, min(l_partkey) AS pk FROM lineitem GROUP BY l_orderkey"),
    "doc_count": ((), "SELECT count(*) AS c FROM documents"),
    "reviews": (
        ("first_line", "doc_count"),
        """
SELECT o.o_orderkey AS review_id,
  CASE WHEN o.o_orderkey % 83 = 0 THEN NULL WHEN o.o_custkey % 50 = 0 THEN CAST(5.0 AS DOUBLE)
       ELSE CAST(substr(o.o_orderpriority, 1, 1) AS DOUBLE) END AS rating,
  CASE WHEN o.o_orderkey % 97 = 0 THEN NULL WHEN o.o_orderkey % 89 = 0 THEN '   '
       ELSE d.text END AS text,
  CAST(f.pk AS VARCHAR) AS asin, p.p_brand AS brand, p.p_type AS category,
  CASE WHEN o.o_orderkey % 73 <> 0 THEN CAST(o.o_custkey AS VARCHAR) END AS user_id,
  CASE WHEN o.o_orderkey % 71 <> 0
       THEN epoch_ms(o.o_orderdate) + (o.o_orderkey * 7919) % 86400000 END AS timestamp,
  o.o_orderstatus <> 'P' AS verified_purchase,
  CAST(o.o_orderkey % 13 AS INTEGER) AS helpful_vote,
  CAST(CASE WHEN o.o_orderkey % 79 = 0 THEN NULL
            WHEN o.o_custkey % 100 = 0 THEN 1 + o.o_orderkey % 2
            ELSE 1 + (o.o_orderkey * 31 + o.o_custkey) % 5 END AS INTEGER) AS sentiment_star,
  CAST(((o.o_orderkey * 7919) % 1000) / CAST(1000.0 AS DOUBLE) AS FLOAT) AS sentiment_conf
FROM orders o
LEFT JOIN first_line f ON f.l_orderkey = o.o_orderkey
LEFT JOIN part p ON p.p_partkey = f.pk
LEFT JOIN documents d ON d.doc_id = o.o_orderkey % (SELECT c FROM doc_count)""",
    ),
    "clean": (
        ("reviews",),
        """
SELECT *, date_trunc('second', make_timestamp(timestamp * 1000)) AS review_time,
  CAST(year(make_timestamp(timestamp * 1000)) AS INTEGER) AS year,
  CAST(month(make_timestamp(timestamp * 1000)) AS INTEGER) AS month,
  CAST(length(text) AS INTEGER) AS text_length,
  sentiment_star - rating AS diff, abs(sentiment_star - rating) AS abs_diff
FROM reviews WHERE text IS NOT NULL AND length(trim(text)) > 0""",
    ),
    "found": (("clean",), "SELECT * FROM clean WHERE abs_diff >= 3.0"),
    "summary": (
        ("clean",),
        """
SELECT rating, avg(sentiment_star) AS avg_sentiment_star, avg(abs_diff) AS avg_abs_diff,
  count(*) AS count, count(abs_diff) AS scored_count FROM clean GROUP BY rating""",
    ),
    "stats": (
        ("clean",),
        """
SELECT user_id, count(*) AS review_count, avg(rating) AS avg_rating,
  stddev_samp(rating) AS rating_stddev, avg(sentiment_star) AS avg_sentiment,
  count(DISTINCT asin) AS product_count FROM clean GROUP BY user_id""",
    ),
    "spam": (
        ("stats",),
        """
SELECT *, 'Potential Spammer (High Vol, No Variance)' AS reason FROM stats
WHERE review_count >= 5 AND (rating_stddev IS NULL OR rating_stddev < 0.1)""",
    ),
    "conflict": (
        ("stats",),
        """
SELECT *, 'Conflicted (High Rating, Low Sentiment)' AS reason FROM stats
WHERE review_count >= 3 AND avg_rating > 4.5 AND avg_sentiment < 2.5""",
    ),
    "yearly": (
        ("clean",),
        """
SELECT year, avg(sentiment_star) AS avg_sentiment, avg(rating) AS avg_rating,
  count(*) AS review_count FROM clean GROUP BY year""",
    ),
    "indicator": (
        (),
        f"""
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, round(avg(l_discount) * 100, 4) AS rate
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE n_name = '{COUNTRY}' AND year(o_orderdate) <> {BLANK_YEAR} GROUP BY 1""",
    ),
    # Topics by brand: brands ranked by size, no brand is the outlier.
    "ranked": (
        ("clean",),
        """
SELECT brand, CAST(row_number() OVER (ORDER BY count(*) DESC, min(review_id)) - 1 AS INTEGER)
  AS topic FROM clean WHERE brand IS NOT NULL GROUP BY brand""",
    ),
    "topics": (
        ("clean", "ranked"),
        """
SELECT c.review_id, c.text, coalesce(r.topic, -1) AS topic
FROM clean c LEFT JOIN ranked r ON r.brand = c.brand""",
    ),
    "topic_words": (
        ("topics",),
        """
SELECT topic, unnest(string_split_regex(lower(text), '[^\\p{L}\\p{N}_]+')) AS term FROM topics""",
    ),
    "topic_weights": (
        ("topic_words",),
        """
SELECT topic, term, tf, tf * ln(1 + a / f) AS weight FROM (
  SELECT *, sum(tf) OVER (PARTITION BY term) AS f,
    (sum(tf) OVER ()) / (SELECT count(DISTINCT topic) FROM topic_words) AS a
  FROM (SELECT topic, term, count(*) AS tf FROM topic_words
        WHERE length(term) >= 2 GROUP BY topic, term))""",
    ),
    "topic_places": (
        ("topic_weights",),
        """
SELECT * FROM (SELECT topic, term, weight, CAST(row_number() OVER
  (PARTITION BY topic ORDER BY round(weight, 6) DESC, term) AS INTEGER) AS place
  FROM topic_weights) WHERE place <= 10""",
    ),
    "brand_info": (
        ("topics", "topic_places"),
        """
SELECT t.topic AS "Topic", t.n AS "Count",
  t.topic || '_' || string_agg(p.term, '_' ORDER BY p.place) FILTER (p.place <= 4) AS "Name",
  string_agg(p.term, '|' ORDER BY p.place) AS "Representation"
FROM (SELECT topic, count(*) AS n FROM topics GROUP BY topic) t
JOIN topic_places p ON p.topic = t.topic GROUP BY t.topic, t.n""",
    ),
    # Near copies of documents: shingle sets, edges between all similar pairs.
    "copy_texts": (
        (),
        """
SELECT doc_id, sha256(trim(regexp_replace(lower(text), '\\s+', ' ', 'g'))) AS digest,
  list_filter(string_split_regex(lower(text), '[^\\p{L}\\p{N}_]+'), lambda w: w <> '') AS words
FROM documents WHERE text IS NOT NULL""",
    ),
    "copy_reps": (
        ("copy_texts",),
        "SELECT digest, min(doc_id) AS rep, any_value(words) AS words FROM copy_texts GROUP BY digest",
    ),
    "copy_grams": (
        ("copy_reps",),
        """
SELECT DISTINCT rep, CAST('0x' || substr(md5(array_to_string(words[i:i + 4], ' ')), 1, 15) AS BIGINT) AS g
FROM (SELECT rep, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i
      FROM copy_reps WHERE len(words) > 0)""",
    ),
    "copy_edges": (
        ("copy_grams",),
        """
SELECT x.rep AS a, y.rep AS b
FROM (SELECT *, count(*) OVER (PARTITION BY rep) AS n FROM copy_grams) x
JOIN (SELECT *, count(*) OVER (PARTITION BY rep) AS n FROM copy_grams) y
  ON y.g = x.g AND y.rep < x.rep
GROUP BY x.rep, y.rep, x.n, y.n HAVING count(*) / (x.n + y.n - count(*)) >= 0.8""",
    ),
    "copy_groups": (
        ("copy_texts", "copy_reps", "copy_edges"),
        """
SELECT t.doc_id, m.low AS group_id FROM copy_texts t JOIN copy_reps r ON r.digest = t.digest
JOIN (WITH RECURSIVE reach AS (
        SELECT rep AS v, rep AS low FROM copy_reps
        UNION SELECT e.v, r.low FROM reach r
        JOIN (SELECT a AS u, b AS v FROM copy_edges UNION ALL SELECT b, a FROM copy_edges) e
          ON e.u = r.v)
      SELECT v, min(low) AS low FROM reach GROUP BY v) m ON m.v = r.rep""",
    ),
    # Hills of the density of two fixed projections of each embedding.
    "axes": (
        (),
        """
SELECT vec_id AS review_id, round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 3)
    AS x,
  round(list_sum(list_transform(embedding, lambda x, i:
    CASE WHEN i % 2 = 1 THEN CAST(x AS DOUBLE) ELSE -CAST(x AS DOUBLE) END)), 3) AS y
FROM embeddings""",
    ),
    "cells": (
        ("axes",),
        """
SELECT review_id, CAST(floor(x / sx) AS BIGINT) AS i, CAST(floor(y / sy) AS BIGINT) AS j FROM axes
CROSS JOIN (SELECT stddev_pop(x) * 0.5 AS sx, stddev_pop(y) * 0.5 AS sy
            FROM axes)""",
    ),
    "full_cells": (
        ("cells",),
        "SELECT i, j, count(*) AS n, min(review_id) AS id FROM cells GROUP BY i, j",
    ),
    "climbs": (
        ("full_cells",),
        """
SELECT a.id AS a, arg_min(b.id, {'less': -b.n, 'id': b.id}) AS b FROM full_cells a
JOIN full_cells b ON abs(a.i - b.i) + abs(a.j - b.j) = 1
  AND (b.n > a.n OR (b.n = a.n AND b.id < a.id)) GROUP BY a.id""",
    ),
    "hills": (
        ("climbs", "full_cells"),
        """
SELECT id, top FROM (
  WITH RECURSIVE walk AS (
    SELECT id, id AS top FROM full_cells
    UNION ALL SELECT w.id, c.b FROM walk w JOIN climbs c ON c.a = w.top)
  SELECT id, top FROM walk WHERE top NOT IN (SELECT a FROM climbs))""",
    ),
    "hill_sizes": (
        ("hills", "full_cells"),
        """
SELECT h.top, CAST(row_number() OVER (ORDER BY sum(f.n) DESC, min(h.id)) - 1 AS INTEGER) AS topic
FROM hills h JOIN full_cells f ON f.id = h.id GROUP BY h.top
HAVING sum(f.n) >= 2 AND max(f.n) FILTER (f.id = h.top) >= 2""",
    ),
    "hill_topics": (
        ("cells", "full_cells", "hills", "hill_sizes"),
        """
SELECT c.review_id, coalesce(s.topic, -1) AS topic FROM cells c
JOIN full_cells f ON f.i = c.i AND f.j = c.j JOIN hills h ON h.id = f.id
LEFT JOIN hill_sizes s ON s.top = h.top""",
    ),
    "lang_words": (
        (),
        """
SELECT lang, unnest(string_split_regex(lower(text), '[^\\p{L}\\p{N}_]+')) AS term
FROM documents""",
    ),
    "lang_weights": (
        ("lang_words",),
        """
SELECT lang, term, tf, tf * ln(1 + a / f) AS weight FROM (
  SELECT *, sum(tf) OVER (PARTITION BY term) AS f,
    (sum(tf) OVER ()) / (SELECT count(DISTINCT lang) FROM lang_words) AS a
  FROM (SELECT lang, term, count(*) AS tf FROM lang_words
        WHERE length(term) >= 2 GROUP BY lang, term))""",
    ),
    # Polarity: terms of the labelled documents, then a price for each review.
    "training": (
        (),
        """
SELECT doc_id, quality, term FROM (
  SELECT d.doc_id, l.quality, unnest(string_split_regex(lower(d.text), '[^\\p{L}]+')) AS term
  FROM documents d JOIN labels l ON l.doc_id = d.doc_id) WHERE term <> ''""",
    ),
    "totals": (
        ("training",),
        """
SELECT (SELECT ln(count(*) FILTER (quality <> 1) + 65536) - ln(count(*) FILTER (quality = 1) + 65536)
        FROM training) AS base,
  (SELECT ln(count(*) FILTER (quality = 1) + 1) - ln(count(*) FILTER (quality <> 1) + 1)
   FROM documents JOIN labels USING (doc_id)) AS prior""",
    ),
    "terms": (
        ("training",),
        """
SELECT term, ln((n1 + 1) / (t1 + v)) - ln((n0 + 1) / (t0 + v)) AS p, n1 + n0 AS n FROM (
  SELECT *, sum(n1) OVER () AS t1, sum(n0) OVER () AS t0, count(*) OVER () AS v FROM (
    SELECT term, count(*) FILTER (quality = 1) AS n1, count(*) FILTER (quality <> 1) AS n0
    FROM training GROUP BY term))""",
    ),
    "review_words": (
        ("clean",),
        """
SELECT review_id, term FROM (
  SELECT review_id, unnest(string_split_regex(lower(text), '[^\\p{L}]+')) AS term FROM clean)
WHERE term <> ''""",
    ),
    # The same over 65536 buckets of terms.
    "hashed_terms": (
        ("training",),
        """
SELECT b, ln((n1 + 1) / (t1 + v)) - ln((n0 + 1) / (t0 + v)) AS p FROM (
  SELECT *, sum(n1) OVER () AS t1, sum(n0) OVER () AS t0, count(*) OVER () AS v FROM (
    SELECT substr(md5(term), 1, 4) AS b, count(*) FILTER (quality = 1) AS n1,
      count(*) FILTER (quality <> 1) AS n0 FROM training GROUP BY 1))""",
    ),
    "hashed_scale": (
        ("training", "hashed_terms"),
        """
SELECT avg(m) AS mu, stddev_pop(m) AS sigma FROM (
  SELECT doc_id, avg(p) AS m FROM training JOIN hashed_terms ON b = substr(md5(term), 1, 4)
  GROUP BY doc_id)""",
    ),
    "hashed_scores": (
        ("clean", "review_words", "hashed_terms", "hashed_scale"),
        """
SELECT *, CAST(CASE WHEN z < -1.5 THEN 1 WHEN z < -0.5 THEN 2 WHEN z < 0.5 THEN 3
                    WHEN z < 1.5 THEN 4 ELSE 5 END AS INTEGER) AS star,
  CAST(1 / (1 + exp(-abs(m))) AS FLOAT) AS conf
FROM (SELECT c.review_id, c.rating, coalesce(p.m, 0) AS m, (coalesce(p.m, 0)
             - (SELECT mu FROM hashed_scale)) / (SELECT sigma FROM hashed_scale) AS z
      FROM clean c LEFT JOIN (
        SELECT review_id, avg(coalesce(p, 0)) AS m FROM review_words
        LEFT JOIN hashed_terms ON b = substr(md5(term), 1, 4) GROUP BY review_id
      ) p ON p.review_id = c.review_id)""",
    ),
}


def _needed(names: tuple[str, ...], seen: list[str]) -> list[str]:
    for name in names:
        if name not in seen:
            _needed(RELATIONS[name][0], seen)
            seen.append(name)
    return seen


def sql(uses: str, body: str) -> str:
    """``body`` behind the named relations it uses and what those need."""
    names = _needed(tuple(uses.split()), [])
    parts = ",\n".join(f"{n} AS ({RELATIONS[n][1].strip()})" for n in names)
    return f"WITH {parts}\n{body.strip()}" if names else body.strip()


_SUMMARY = """round(avg(sentiment_star), 6) AS avg_sentiment_star,
  round(avg(abs_diff), 6) AS avg_abs_diff, count(*) AS count, count(abs_diff) AS scored_count"""
_TREND = """round(avg(sentiment_star), 6) AS avg_sentiment, round(avg(rating), 6) AS avg_rating,
  count(*) AS review_count"""
_STATS = """review_count, round(avg_rating, 6) AS avg_rating,
  round(rating_stddev, 6) AS rating_stddev, round(avg_sentiment, 6) AS avg_sentiment,
  product_count"""
_STARS = """count(*) FILTER (sentiment_star = 1) AS star_1,
  count(*) FILTER (sentiment_star = 2) AS star_2, count(*) FILTER (sentiment_star = 3) AS star_3,
  count(*) FILTER (sentiment_star = 4) AS star_4, count(*) FILTER (sentiment_star = 5) AS star_5"""
_CONF = "round(CAST(sentiment_conf AS DOUBLE), 4) AS sentiment_conf"
_MISMATCH = f"""review_id, rating, sentiment_star, {_CONF}, diff, abs_diff,
  sha256(text) AS text_hash"""
_CORR = """CASE WHEN count(*) >= 3 AND stddev_pop({0}) * stddev_pop(rate) > 0
  THEN round(covar_pop({0}, rate) / (stddev_pop({0}) * stddev_pop(rate)), 6) END"""
_CORRS = f"""count(*) AS years, {_CORR.format("avg_sentiment")} AS corr_sentiment,
  {_CORR.format("avg_rating")} AS corr_rating"""
_GRADE = """CASE WHEN {0} < 0.5 THEN 'excellent' WHEN {0} < 1 THEN 'good'
  WHEN {0} < 2 THEN 'moderate' WHEN {0} < 3 THEN 'significant' WHEN {0} >= 3 THEN 'severe' END"""

ORACLE: dict[str, str] = {
    "read_and_write_stage": sql(
        "clean",
        """SELECT category, year, count(*) AS review_count,
  CAST(sum(text_length) AS BIGINT) AS text_chars FROM clean GROUP BY category, year""",
    ),
    "ingest_jsonl": sql(
        "reviews",
        """SELECT coalesce(category, 'NONE') AS category, count(*) AS lines,
  count(*) FILTER (review_id % 101 = 0) AS broken,
  count(text) FILTER (review_id % 101 <> 0) AS texts,
  CAST(sum(length(text)) FILTER (review_id % 101 <> 0) AS BIGINT) AS text_chars,
  round(avg(rating) FILTER (review_id % 101 <> 0), 6) AS avg_rating,
  CAST(sum(helpful_vote) FILTER (review_id % 101 <> 0) AS BIGINT) AS helpful_votes,
  max(timestamp) FILTER (review_id % 101 <> 0) AS last_timestamp
FROM reviews GROUP BY 1""",
    ),
    "read_indicator": sql("indicator", "SELECT year, rate FROM indicator"),
    "write_report": sql("clean", f"SELECT rating, {_SUMMARY} FROM clean GROUP BY rating"),
    "write_topics": sql("brand_info", "SELECT * FROM brand_info"),
    "inspect_stage": sql(
        "clean",
        "\nUNION ALL ".join(
            f"""SELECT '{c}' AS "column", count(*) AS rows, count(*) - count({c}) AS nulls FROM clean"""
            for c in (
                "rating", "text", "asin", "user_id", "timestamp", "verified_purchase",
                "helpful_vote", "review_id", "brand", "category", "sentiment_star",
                "sentiment_conf", "review_time", "year", "month", "text_length",
            )
        ),
    ),
    "standardize": sql(
        "reviews",
        """SELECT review_id, rating, CAST(NULL AS VARCHAR) AS title, sha256(text) AS text_hash, asin,
  CAST(NULL AS VARCHAR) AS parent_asin, user_id, timestamp, verified_purchase, helpful_vote
FROM reviews""",
    ),
    "clean_reviews": sql(
        "clean",
        """SELECT review_id, rating, asin, user_id, timestamp, verified_purchase, helpful_vote,
  strftime(review_time, '%Y-%m-%d %H:%M:%S') AS review_time, year, month, text_length,
  sha256(text) AS text_hash FROM clean""",
    ),
    "clean_reviews_strict": sql(
        "clean",
        """SELECT year, month, count(*) AS review_count, CAST(sum(text_length) AS BIGINT) AS text_chars
FROM clean WHERE regexp_matches(text, '\\S') GROUP BY year, month""",
    ),
    "filter_nonempty": sql(
        "reviews",
        """SELECT review_id, CAST(length(text) AS INTEGER) AS text_length FROM reviews
WHERE text IS NOT NULL AND text <> ''""",
    ),
    "scoring_columns": sql(
        "clean",
        """SELECT asin, rating, sha256(text) AS text_hash, year, month, user_id, verified_purchase,
  review_id FROM clean WHERE text <> ''""",
    ),
    "sample_rows": sql(
        "clean",
        """SELECT review_id, rating, year FROM clean
ORDER BY md5(CAST(review_id AS VARCHAR)), CAST(review_id AS VARCHAR) LIMIT 1000""",
    ),
    "preview": sql(
        "found",
        """SELECT review_id, rating, sentiment_star, abs_diff FROM found
ORDER BY abs_diff DESC, sentiment_conf DESC, review_id LIMIT 10""",
    ),
    "global_mae": sql("clean", "SELECT round(avg(abs_diff), 6) AS mae FROM clean"),
    "global_mae_by_category": sql(
        "clean", "SELECT category, round(avg(abs_diff), 6) AS mae FROM clean GROUP BY category"
    ),
    "rating_summary": sql("clean", f"SELECT rating, {_SUMMARY} FROM clean GROUP BY rating"),
    "rating_summary_by_category": sql(
        "clean", f"SELECT category, rating, {_SUMMARY} FROM clean GROUP BY category, rating"
    ),
    "rating_report": sql(
        "clean",
        f"""SELECT rating, 'rating' AS level, {_SUMMARY} FROM clean GROUP BY rating
UNION ALL SELECT NULL, 'total', {_SUMMARY} FROM clean""",
    ),
    "weighted_mae": sql(
        "summary",
        """SELECT round(coalesce(sum(avg_abs_diff * count) / sum(count), 0), 6) AS avg_mae,
  round(coalesce(sum(avg_abs_diff * scored_count) / sum(scored_count), 0), 6) AS exact_mae
FROM summary""",
    ),
    "rating_distribution": sql(
        "summary",
        f"""SELECT rating, count, round(count / sum(count) OVER (), 6) AS share,
  round(avg_abs_diff, 6) AS mae, {_GRADE.format("avg_abs_diff")} AS grade FROM summary""",
    ),
    "mae_grade": sql(
        "clean",
        f"""SELECT brand, rating, round(avg(abs_diff), 6) AS avg_abs_diff,
  {_GRADE.format("avg(abs_diff)")} AS grade FROM clean GROUP BY brand, rating""",
    ),
    "overview": sql(
        "summary found ranked",
        """SELECT CAST(sum(count) AS BIGINT) AS total_ratings,
  (SELECT count(*) FROM found) AS mismatched_count, (SELECT count(*) FROM ranked) AS topic_count,
  round(sum(avg_abs_diff * count) / sum(count), 6) AS avg_mae FROM summary""",
    ),
    "with_diff": sql("clean", "SELECT review_id, diff, abs_diff FROM clean"),
    "mismatched": sql("found", f"SELECT {_MISMATCH} FROM found"),
    "mismatch_total": sql("found", "SELECT count(*) AS mismatched_count FROM found"),
    "top_mismatches": sql(
        "found",
        f"""SELECT {_MISMATCH} FROM (SELECT * FROM found
ORDER BY abs_diff DESC, sentiment_conf DESC, review_id LIMIT 5000)""",
    ),
    "top_mismatches_by_category": sql(
        "found",
        f"""SELECT category, review_id, abs_diff, {_CONF} FROM (SELECT *, row_number() OVER
  (PARTITION BY category ORDER BY abs_diff DESC, sentiment_conf DESC, review_id) AS place
  FROM found) WHERE place <= 100""",
    ),
    "first_mismatches": sql(
        "found",
        f"""SELECT review_id, rating, sentiment_star, {_CONF}, diff FROM (SELECT * FROM found
ORDER BY abs_diff DESC, sentiment_conf DESC, review_id LIMIT 100)""",
    ),
    "top_examples": sql(
        "found",
        """SELECT review_id, rating, sentiment_star, abs_diff FROM found
WHERE regexp_matches(text, '[^\\s\\p{Z}]') ORDER BY abs_diff DESC, review_id LIMIT 20""",
    ),
    "explain_mismatch": sql(
        "clean",
        """SELECT review_id, direction, polarity, CASE direction
  WHEN 'over-rated' THEN printf('User gave %d stars but the text expresses %s sentiment (%.1f stars). This mismatch indicates potential fake review or rating error.', r, polarity, s)
  WHEN 'under-rated' THEN printf('User gave %d stars but the text expresses %s sentiment (%.1f stars). Rating may not reflect actual product sentiment.', r, polarity, s)
  ELSE 'Rating and sentiment are aligned, but this review was flagged for further analysis.'
  END AS explanation
FROM (SELECT *, CASE WHEN r > s THEN 'over-rated' WHEN r < s THEN 'under-rated' ELSE 'aligned' END
    AS direction,
  CASE WHEN r > s THEN CASE WHEN s < 2.5 THEN 'negative' WHEN s < 3.5 THEN 'neutral' ELSE 'positive' END
       WHEN r < s THEN CASE WHEN s > 3.5 THEN 'positive' WHEN s > 2.5 THEN 'neutral' ELSE 'negative' END
  END AS polarity
  FROM (SELECT review_id, coalesce(CAST(trunc(rating) AS INTEGER), 0) AS r,
          coalesce(CAST(sentiment_star AS DOUBLE), 0) AS s FROM clean))""",
    ),
    "search_text": sql(
        "found",
        """SELECT review_id, rating, sentiment_star, diff FROM found
WHERE contains(lower(text), 'worthless')""",
    ),
    "search_number": sql(
        "found",
        """SELECT review_id, rating, sentiment_star, diff FROM found
WHERE contains(lower(text), '-4.0') OR contains(CAST(CAST(rating AS INTEGER) AS VARCHAR), '-4.0')
  OR contains(CAST(sentiment_star AS VARCHAR), '-4.0') OR contains(printf('%.1f', diff), '-4.0')""",
    ),
    "sort_reviews": sql(
        "found",
        f"""SELECT review_id, rating, sentiment_star, {_CONF}, diff FROM found
ORDER BY abs(diff) DESC, review_id""",
    ),
    "mismatch_histogram": sql(
        "found", "SELECT abs(diff) AS size, count(*) AS count FROM found GROUP BY 1 ORDER BY 1"
    ),
    "confidence_bands": sql(
        "clean",
        """SELECT review_id,
  CASE WHEN c < 0.4 THEN 'low' WHEN c < 0.7 THEN 'medium' ELSE 'high' END AS badge,
  CASE WHEN c < 0.4 THEN '0.0-0.4' WHEN c < 0.6 THEN '0.4-0.6' WHEN c < 0.8 THEN '0.6-0.8'
       ELSE '0.8-1.0' END AS band
FROM (SELECT review_id, CAST(CAST(sentiment_conf AS VARCHAR) AS DOUBLE) AS c FROM clean)""",
    ),
    "user_stats": sql("stats", f"SELECT user_id, {_STATS} FROM stats"),
    "user_stats_by_category": sql(
        "clean",
        """SELECT category, user_id, count(*) AS review_count, round(avg(rating), 6) AS avg_rating,
  round(stddev_samp(rating), 6) AS rating_stddev, round(avg(sentiment_star), 6) AS avg_sentiment,
  count(DISTINCT asin) AS product_count FROM clean GROUP BY category, user_id""",
    ),
    "spammers": sql("spam", f"SELECT user_id, {_STATS}, reason FROM spam"),
    "conflicted_users": sql("conflict", f"SELECT user_id, {_STATS}, reason FROM conflict"),
    "suspicious_users": sql(
        "spam conflict",
        f"""SELECT user_id, {_STATS}, reason FROM spam
UNION ALL SELECT user_id, {_STATS}, reason FROM conflict""",
    ),
    "top_suspects": sql(
        "spam conflict",
        """(SELECT user_id, review_count, reason FROM spam ORDER BY review_count DESC, user_id NULLS FIRST LIMIT 10)
UNION ALL
(SELECT user_id, review_count, reason FROM conflict ORDER BY review_count DESC, user_id NULLS FIRST LIMIT 10)""",
    ),
    "repeated_text": sql(
        "clean",
        """SELECT user_id, sha256(trim(regexp_replace(lower(text), '\\s+', ' ', 'g'))) AS text_hash,
  count(*) AS copies, min(review_id) AS first_review_id FROM clean GROUP BY 1, 2
HAVING count(*) >= 2""",
    ),
    "burst_users": sql(
        "clean",
        """SELECT user_id, max(n) AS peak_count,
  strftime(min(bucket) FILTER (n = top), '%Y-%m-%d') AS peak_bucket, count(*) AS burst_buckets
FROM (SELECT *, max(n) OVER (PARTITION BY user_id) AS top FROM (
  SELECT user_id, date_trunc('month', review_time) AS bucket, count(*) AS n FROM clean
  WHERE review_time IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 2)) GROUP BY user_id""",
    ),
    "burst_events": """SELECT user_id, max(n) AS peak_count,
  strftime(min(bucket) FILTER (n = top), '%Y-%m-%d') AS peak_bucket, count(*) AS burst_buckets
FROM (SELECT *, max(n) OVER (PARTITION BY user_id) AS top FROM (
  SELECT user_id, date_trunc('day', ts) AS bucket, count(*) AS n FROM events
  GROUP BY 1, 2 HAVING count(*) >= 3)) GROUP BY user_id""",
    "burst_windows": """SELECT user_id, max(c) AS peak_count,
  strftime(min(ts) FILTER (c = top), '%Y-%m-%d %H:%M:%S') AS peak_end, count(*) AS burst_ends
FROM (SELECT *, max(c) OVER (PARTITION BY user_id) AS top FROM (
  SELECT user_id, ts, count(*) OVER (PARTITION BY user_id ORDER BY ts
    RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND CURRENT ROW) AS c FROM events WHERE ts IS NOT NULL)
  WHERE c >= 3) GROUP BY user_id""",
    "burst_sessions": """SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS session_start,
  strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS session_end, count(*) AS review_count
FROM (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts) AS session FROM (
  SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts)
    <= INTERVAL 12 HOUR THEN 0 ELSE 1 END AS opens FROM events WHERE ts IS NOT NULL))
GROUP BY user_id, session HAVING count(*) >= 3""",
    "user_stats_batches": sql("stats", f"SELECT user_id, {_STATS} FROM stats"),
    "yearly_trend_batches": sql("clean", f"SELECT year, {_TREND} FROM clean GROUP BY year"),
    "extreme_users": sql(
        "clean",
        """SELECT user_id, scored_count, one_star, five_star,
  round((one_star + five_star) / scored_count, 6) AS extreme_share
FROM (SELECT user_id, count(sentiment_star) AS scored_count,
  count(*) FILTER (sentiment_star = 1) AS one_star, count(*) FILTER (sentiment_star = 5) AS five_star
  FROM clean GROUP BY user_id)
WHERE scored_count >= 5 AND (one_star + five_star) / scored_count >= 0.6""",
    ),
    "yearly_trend": sql("clean", f"SELECT year, {_TREND} FROM clean GROUP BY year"),
    "yearly_trend_by_category": sql(
        "clean", f"SELECT category, year, {_TREND} FROM clean GROUP BY category, year"
    ),
    "yearly_with_indicator": sql(
        "yearly indicator",
        """SELECT y.year, round(avg_sentiment, 6) AS avg_sentiment, round(avg_rating, 6) AS avg_rating,
  review_count, round(rate, 6) AS inflation_rate
FROM yearly y LEFT JOIN indicator i ON i.year = y.year WHERE y.year IS NOT NULL AND y.year <> 0""",
    ),
    "macro_corr": sql(
        "yearly indicator",
        f"SELECT {_CORRS} FROM yearly y JOIN indicator i ON i.year = y.year",
    ),
    "macro_corr_by_category": sql(
        "clean indicator",
        f"""SELECT category, {_CORRS} FROM (
  SELECT category, year, avg(sentiment_star) AS avg_sentiment, avg(rating) AS avg_rating
  FROM clean GROUP BY category, year) y JOIN indicator i ON i.year = y.year GROUP BY category""",
    ),
    "lagged_corr": sql(
        "yearly indicator",
        f"""SELECT CAST(lag AS INTEGER) AS lag, {_CORRS} FROM yearly y
JOIN (SELECT year + lag AS year, rate, lag FROM indicator, (VALUES (0), (1), (2)) AS l(lag)) i
  ON i.year = y.year GROUP BY lag""",
    ),
    "monthly_trend": sql(
        "clean",
        """SELECT year, month, round(s, 6) AS avg_sentiment, round(r, 6) AS avg_rating,
  n AS review_count,
  CASE WHEN lag(m) OVER w = m - 1 THEN round(s - lag(s) OVER w, 6) END AS sentiment_change,
  CASE WHEN lag(m) OVER w = m - 1 THEN round(r - lag(r) OVER w, 6) END AS rating_change
FROM (SELECT year, month, year * 12 + month AS m, avg(sentiment_star) AS s, avg(rating) AS r,
        count(*) AS n FROM clean GROUP BY year, month) WINDOW w AS (ORDER BY m NULLS FIRST)""",
    ),
    "product_sentiment": sql(
        "clean",
        f"""SELECT asin, count(*) AS review_count, round(avg(sentiment_star), 6) AS avg_sentiment,
  round(avg(rating), 6) AS avg_rating, {_STARS} FROM clean WHERE asin IS NOT NULL GROUP BY asin
HAVING count(*) >= 2""",
    ),
    "group_sentiment": sql(
        "clean",
        "\nUNION ALL ".join(
            f"""SELECT '{k}' AS key, {k} AS value, count(*) AS review_count,
  round(avg(sentiment_star), 6) AS avg_sentiment, round(avg(rating), 6) AS avg_rating, {_STARS}
FROM clean GROUP BY {k}"""
            for k in ("brand", "category")
        ),
    ),
    "stage_counts": """SELECT (SELECT count(*) FROM orders) AS orders_count,
  (SELECT count(*) FROM documents) AS documents_count,
  (SELECT count(*) FROM lineitem) AS lineitem_count""",
    "completeness": sql(
        "reviews",
        """SELECT rows, null_text, null_rating, null_asin,
  round((1 - (null_text + null_rating + null_asin) / (rows * 3)) * 100, 2) AS completeness
FROM (SELECT count(*) AS rows, count(*) - count(text) AS null_text,
  count(*) - count(rating) AS null_rating, count(*) - count(asin) AS null_asin FROM reviews)""",
    ),
    "completeness_by_category": sql(
        "reviews",
        """SELECT category, rows, null_text, null_rating,
  round((1 - (null_text + null_rating) / (rows * 2)) * 100, 2) AS completeness
FROM (SELECT category, count(*) AS rows, count(*) - count(text) AS null_text,
  count(*) - count(rating) AS null_rating FROM reviews GROUP BY category)""",
    ),
    "retention": sql(
        "reviews clean",
        """SELECT *, round(cleaned_count * 100.0 / raw_count, 2) AS retention_rate,
  round((raw_count - cleaned_count) * 100.0 / raw_count, 2) AS data_reduction,
  round(sentiment_count * 100.0 / raw_count, 2) AS sentiment_retention
FROM (SELECT (SELECT count(*) FROM reviews) AS raw_count,
  (SELECT count(*) FROM clean) AS cleaned_count,
  (SELECT count(*) FROM clean WHERE sentiment_conf > 0) AS sentiment_count)""",
    ),
    "polarity_terms": sql("terms", "SELECT term, round(p, 6) AS p, CAST(n AS BIGINT) AS n FROM terms"),
    "score_polarity": sql(
        "hashed_scores",
        """SELECT review_id, star AS sentiment_star, round(CAST(conf AS DOUBLE), 4) AS sentiment_conf
FROM hashed_scores""",
    ),
    "score_udf": sql(
        "hashed_scores",
        """SELECT review_id, star AS sentiment_star, round(CAST(conf AS DOUBLE), 4) AS sentiment_conf
FROM hashed_scores""",
    ),
    "scored_rating_report": sql(
        "hashed_scores",
        """SELECT rating, CASE WHEN grouping(rating) = 1 THEN 'total' ELSE 'rating' END AS level,
  round(avg(star), 6) AS avg_sentiment_star, round(avg(abs(rating - star)), 6) AS avg_abs_diff,
  count(*) AS count, count(rating) AS scored_count FROM hashed_scores
GROUP BY ROLLUP (rating)""",
    ),
    "topic_counts": sql(
        "topics", """SELECT topic AS "Topic", count(*) AS "Count" FROM topics GROUP BY topic"""
    ),
    "class_tfidf": sql(
        "lang_weights", "SELECT lang, term, tf, round(weight, 6) AS weight FROM lang_weights"
    ),
    "topic_terms": sql(
        "lang_weights",
        """SELECT * FROM (SELECT lang, term, tf, round(weight, 6) AS weight, CAST(row_number() OVER
  (PARTITION BY lang ORDER BY round(weight, 6) DESC, term) AS INTEGER) AS place
  FROM lang_weights) WHERE place <= 10""",
    ),
    "topic_info": sql("brand_info", "SELECT * FROM brand_info"),
    "top_topics": sql(
        "brand_info",
        """SELECT * FROM brand_info WHERE "Topic" <> -1 ORDER BY "Topic" LIMIT 10""",
    ),
    "topic_bars": sql(
        "topic_places",
        """SELECT topic, place, term, round(weight, 6) AS weight FROM topic_places
WHERE topic BETWEEN 0 AND 7 AND place <= 5""",
    ),
    "stage_profile": "\nUNION ALL ".join(
        f"SELECT '{t}' AS stage, count(*) AS count FROM {t}"
        for t in ("orders", "documents", "lineitem")
    ),
    "rating_report_by_category": sql(
        "clean",
        f"""SELECT category, rating, 'rating' AS level, {_SUMMARY} FROM clean GROUP BY category, rating
UNION ALL SELECT category, NULL, 'total', {_SUMMARY} FROM clean GROUP BY category""",
    ),
    "weighted_mae_by_category": sql(
        "clean",
        """SELECT category,
  round(coalesce(sum(avg_abs_diff * count) / sum(count), 0), 6) AS avg_mae,
  round(coalesce(sum(avg_abs_diff * scored_count) / nullif(sum(scored_count), 0), 0), 6) AS exact_mae
FROM (SELECT category, rating, avg(abs_diff) AS avg_abs_diff, count(*) AS count,
        count(abs_diff) AS scored_count FROM clean GROUP BY category, rating) GROUP BY category""",
    ),
    "rating_distribution_by_category": sql(
        "clean",
        f"""SELECT category, rating, count,
  round(count / sum(count) OVER (PARTITION BY category), 6) AS share,
  round(avg_abs_diff, 6) AS mae, {_GRADE.format("avg_abs_diff")} AS grade
FROM (SELECT category, rating, avg(abs_diff) AS avg_abs_diff, count(*) AS count
      FROM clean GROUP BY category, rating)""",
    ),
    "overview_by_category": sql(
        "clean",
        """SELECT s.category, CAST(sum(n) AS BIGINT) AS total_ratings,
  CAST(sum(bad) AS BIGINT) AS mismatched_count, coalesce(max(t.topics), 0) AS topic_count,
  round(coalesce(sum(mae * n) / sum(n), 0), 6) AS avg_mae
FROM (SELECT category, rating, count(*) AS n, count(*) FILTER (abs_diff >= 3) AS bad,
        avg(abs_diff) AS mae FROM clean GROUP BY category, rating) s
LEFT JOIN (SELECT category, count(DISTINCT brand) AS topics FROM clean
           WHERE brand IS NOT NULL GROUP BY category) t
  ON t.category IS NOT DISTINCT FROM s.category GROUP BY s.category""",
    ),
    "top_suspects_by_category": sql(
        "clean",
        """SELECT category, user_id, review_count, reason FROM (
  SELECT *, row_number() OVER (PARTITION BY category, reason
    ORDER BY review_count DESC, user_id NULLS FIRST) AS place
  FROM (SELECT *, unnest(list_filter([
      CASE WHEN review_count >= 3 AND (dev IS NULL OR dev < 0.1)
           THEN 'Potential Spammer (High Vol, No Variance)' END,
      CASE WHEN review_count >= 2 AND avg_rating > 4.5 AND avg_sentiment < 2.5
           THEN 'Conflicted (High Rating, Low Sentiment)' END],
      lambda x: x IS NOT NULL)) AS reason
    FROM (SELECT category, user_id, count(*) AS review_count, avg(rating) AS avg_rating,
            stddev_samp(rating) AS dev, avg(sentiment_star) AS avg_sentiment
          FROM clean GROUP BY category, user_id))) WHERE place <= 3""",
    ),
    "mismatch_histogram_by_category": sql(
        "found", "SELECT category, abs(diff) AS size, count(*) AS count FROM found GROUP BY 1, 2"
    ),
    "monthly_trend_by_category": sql(
        "clean",
        """SELECT category, year, month, round(s, 6) AS avg_sentiment, round(r, 6) AS avg_rating,
  n AS review_count,
  CASE WHEN lag(m) OVER w = m - 1 THEN round(s - lag(s) OVER w, 6) END AS sentiment_change,
  CASE WHEN lag(m) OVER w = m - 1 THEN round(r - lag(r) OVER w, 6) END AS rating_change
FROM (SELECT category, year, month, year * 12 + month AS m, avg(sentiment_star) AS s,
        avg(rating) AS r, count(*) AS n FROM clean GROUP BY category, year, month)
WINDOW w AS (PARTITION BY category ORDER BY m NULLS FIRST)""",
    ),
    "lagged_corr_by_category": sql(
        "clean indicator",
        f"""SELECT category, CAST(lag AS INTEGER) AS lag, {_CORRS} FROM (
  SELECT category, year, avg(sentiment_star) AS avg_sentiment, avg(rating) AS avg_rating
  FROM clean GROUP BY category, year) y
JOIN (SELECT year + lag AS year, rate, lag FROM indicator, (VALUES (0), (1), (2)) AS l(lag)) i
  ON i.year = y.year
WHERE avg_sentiment IS NOT NULL AND avg_rating IS NOT NULL GROUP BY category, lag""",
    ),
    "product_sentiment_by_category": sql(
        "clean",
        f"""SELECT category, asin, count(*) AS review_count,
  round(avg(sentiment_star), 6) AS avg_sentiment, round(avg(rating), 6) AS avg_rating, {_STARS}
FROM clean WHERE asin IS NOT NULL GROUP BY category, asin HAVING count(*) >= 2""",
    ),
    "repeated_text_by_category": sql(
        "clean",
        """SELECT category, user_id,
  sha256(trim(regexp_replace(lower(text), '\\s+', ' ', 'g'))) AS text_hash, count(*) AS copies,
  min(review_id) AS first_review_id FROM clean GROUP BY 1, 2, 3 HAVING count(*) >= 2""",
    ),
    "burst_users_by_category": sql(
        "clean",
        """SELECT category, user_id, max(n) AS peak_count,
  strftime(min(bucket) FILTER (n = top), '%Y-%m-%d') AS peak_bucket, count(*) AS burst_buckets
FROM (SELECT *, max(n) OVER (PARTITION BY category, user_id) AS top FROM (
  SELECT category, user_id, date_trunc('year', review_time) AS bucket, count(*) AS n FROM clean
  WHERE review_time IS NOT NULL GROUP BY 1, 2, 3 HAVING count(*) >= 2)) GROUP BY category, user_id""",
    ),
    "extreme_users_by_category": sql(
        "clean",
        """SELECT category, user_id, scored_count, one_star, five_star,
  round((one_star + five_star) / scored_count, 6) AS extreme_share
FROM (SELECT category, user_id, count(sentiment_star) AS scored_count,
  count(*) FILTER (sentiment_star = 1) AS one_star, count(*) FILTER (sentiment_star = 5) AS five_star
  FROM clean GROUP BY category, user_id)
WHERE scored_count >= 2 AND (one_star + five_star) / scored_count >= 0.6""",
    ),
    "retention_by_category": sql(
        "reviews clean",
        """SELECT category, raw_count, cleaned_count,
  round(cleaned_count * 100.0 / raw_count, 2) AS retention_rate,
  round((raw_count - cleaned_count) * 100.0 / raw_count, 2) AS data_reduction
FROM (SELECT r.category, r.n AS raw_count, coalesce(c.n, 0) AS cleaned_count
  FROM (SELECT category, count(*) AS n FROM reviews GROUP BY category) r
  LEFT JOIN (SELECT category, count(*) AS n FROM clean GROUP BY category) c
    ON c.category IS NOT DISTINCT FROM r.category)""",
    ),
    "assign_topics": sql("hill_topics", "SELECT review_id, topic FROM hill_topics"),
    "representative_docs": sql(
        "hill_topics axes",
        """SELECT topic, string_agg('v' || review_id, '|' ORDER BY place) AS docs FROM (
  SELECT topic, review_id, row_number() OVER (PARTITION BY topic ORDER BY gap, review_id) AS place
  FROM (SELECT t.topic, t.review_id,
      round((x - avg(x) OVER w) * (x - avg(x) OVER w) + (y - avg(y) OVER w) * (y - avg(y) OVER w), 9)
        AS gap
    FROM hill_topics t JOIN axes a ON a.review_id = t.review_id WINDOW w AS (PARTITION BY topic)))
WHERE place <= 3 GROUP BY topic""",
    ),
    "score_bayes": sql(
        "training totals",
        """SELECT doc_id, round(m, 4) AS margin, CAST(m >= 0 AS INTEGER) AS label
FROM (SELECT d.doc_id, coalesce(sum(w), 0) + count(t.term) * (SELECT base FROM totals)
        + (SELECT prior FROM totals) AS m
  FROM documents d
  LEFT JOIN (SELECT doc_id, unnest(string_split_regex(lower(text), '[^\\p{L}]+')) AS term
             FROM documents) t ON t.doc_id = d.doc_id AND t.term <> ''
  LEFT JOIN (SELECT substr(md5(term), 1, 4) AS b, ln(count(*) FILTER (quality = 1) + 1)
               - ln(count(*) FILTER (quality <> 1) + 1) AS w FROM training GROUP BY 1) v
    ON v.b = substr(md5(t.term), 1, 4)
  GROUP BY d.doc_id)""",
    ),
    "near_copies": sql(
        "copy_groups",
        """SELECT doc_id, group_id, group_size FROM (
  SELECT *, count(*) OVER (PARTITION BY group_id) AS group_size FROM copy_groups)
WHERE group_size > 1""",
    ),
}
