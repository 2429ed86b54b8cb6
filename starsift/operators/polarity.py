"""Sentiment stars from term polarity learned on labelled texts."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starsift.functions.text import LETTERS, distinct, exploded, letter_words
from starsift.sources.workspace import materialize

# Upper limits of the standard score for one to four stars.
STAR_LIMITS = (-1.5, -0.5, 0.5, 1.5)
BUCKETS = 65536
# Terms whose price a task remembers, and bytes of texts that it splits at once.
KEPT_TERMS, _PIECE_BYTES = 120_000, 1 << 20


@dataclass(frozen=True)
class Polarity:
    """A fitted model: a row (term, p, n) for each bucket of terms, and one row (mu, sigma)."""

    terms: DataFrame
    scale: DataFrame


def log_odds(labelled: DataFrame, term: str = "term") -> DataFrame:
    """Smoothed log-odds ``p`` of each term between positive and negative texts.

    ``labelled`` holds (term, positive), a row for each occurrence. Totals and
    vocabulary size are scalar subqueries over the term counts.
    """
    counts = materialize(
        labelled.groupBy(term).agg(
            F.count_if("positive").alias("n1"), F.count_if(~F.col("positive")).alias("n0")
        ),
        "term_counts",
    )
    totals = counts.agg(
        F.sum("n1").alias("t1"), F.sum("n0").alias("t0"), F.count("*").alias("v")
    )

    def total(name):
        return totals.select(F.col(name) + F.col("v")).scalar()

    return counts.select(
        term,
        (F.ln((F.col("n1") + 1) / total("t1")) - F.ln((F.col("n0") + 1) / total("t0"))).alias("p"),
        (F.col("n1") + F.col("n0")).alias("n"),
    )


def term_polarity(docs: DataFrame, labels: DataFrame, target: str = "quality") -> DataFrame:
    """(term, p, n): the polarity of each term of the labelled texts."""
    return materialize(log_odds(_training_words(docs, labels, target)), "terms")


def _training_words(docs: DataFrame, labels: DataFrame, target: str) -> DataFrame:
    marks = labels.select("doc_id", (F.col(target) == 1).alias("positive"))
    training = docs.select("doc_id", "text").join(marks, "doc_id")
    return exploded(training, "text", LETTERS, 1, "positive")


def stars(m: Column, mu: Column, sigma: Column) -> Column:
    """One to five stars by the standard score of a mean polarity."""
    z = F.try_divide(m - mu, sigma)
    star = F.lit(5)
    for limit, value in reversed(list(zip(STAR_LIMITS, (1, 2, 3, 4), strict=True))):
        star = F.when(z < limit, value).otherwise(star)
    return F.when(z.isNotNull(), star).cast("int")


def confidence(m: Column) -> Column:
    """Logistic confidence in a mean polarity, from 0.5 up."""
    return (1 / (1 + F.exp(-F.abs(m)))).cast("float")


def bucket(term: Column) -> Column:
    """Bucket 0 to 65535 of a term: the first four hex digits of its MD5."""
    return F.conv(F.substring(F.md5(term), 1, 4), 16, 10).cast("int")


def bucket_weights(model: Polarity) -> list[float]:
    """The price of each bucket, 0 for those no training text has."""
    weights = [0.0] * BUCKETS
    for row in model.terms.select("term", "p").toLocalIterator():
        weights[row["term"]] = row["p"]
    return weights


class Prices:
    """Prices of terms by bucket, for lower-cased texts of a task."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights.tolist()
        self.known: dict[str, float] = {}

    def price(self, term: str) -> float:
        found = self.known.get(term)
        if found is None:
            if len(self.known) >= KEPT_TERMS:
                self.known.clear()
            digest = hashlib.md5(term.encode(), usedforsecurity=False).hexdigest()
            found = self.known[term] = self.weights[int(digest[:4], 16)]
        return found

    def sums(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Sum of prices and number of terms of each text, pieces of distinct texts at a time."""
        texts, place = distinct(texts)
        totals, counts = [np.empty(0)], [np.empty(0, np.int64)]
        for size, owner, words in letter_words(texts, _PIECE_BYTES):
            coded = pc.dictionary_encode(words)
            worth = np.array([self.price(t) for t in coded.dictionary.to_pylist()], dtype=np.float64)
            counts.append(np.bincount(owner, minlength=size))
            totals.append(np.bincount(owner, worth[coded.indices.to_numpy()], minlength=size))
        return np.concatenate(totals)[place], np.concatenate(counts)[place]


def mean_price(text: Column, weights: list[float]) -> Column:
    """Mean weight of the tokens of a text, null for a text without any.

    Arrow batches of texts go through Python tasks, which hash each distinct term once:
    the same sum as an expression is interpreted token by token. The 65536 weights
    reach the tasks as one broadcast variable.
    """
    shared = SparkSession.getActiveSession().sparkContext.broadcast(np.array(weights))
    kept: list[Prices] = []

    @F.arrow_udf("double")
    def price(texts: pa.Array) -> pa.Array:
        if not kept:
            kept.append(Prices(shared.value))
        total, count = kept[0].sums(texts.cast(pa.large_string()))
        # A worker does not hold between batches what Arrow keeps for later.
        pa.default_memory_pool().release_unused()
        return pa.array(total / np.maximum(count, 1), mask=count == 0)

    return price(F.lower(text))


def fit_hashed(docs: DataFrame, labels: DataFrame, target: str = "quality") -> Polarity:
    """Learn the polarity of term buckets from ``docs`` (doc_id, text) and 0/1 ``labels``.

    The model is two tables on shared storage: at most 65536 buckets whatever the
    vocabulary, and the mean and deviation of the polarity of the training texts, by
    which scores are scaled. A review's stars thus never depend on the other reviews
    of its batch.
    """
    words = _training_words(docs, labels, target)
    terms = materialize(log_odds(words.withColumn("term", bucket(F.col("term")))), "buckets")
    known = labels.select("doc_id").distinct()
    weights = bucket_weights(Polarity(terms, terms))
    means = docs.select("doc_id", "text").join(known, "doc_id").select(
        mean_price(F.col("text"), weights).alias("m")
    )
    scale = means.agg(F.avg("m").alias("mu"), F.stddev_pop("m").alias("sigma"))
    return Polarity(terms, materialize(scale, "scale"))


def score_polarity(df: DataFrame, model: Polarity) -> DataFrame:
    """Add ``sentiment_star`` and ``sentiment_conf`` to every review with a text.

    A text without tokens counts as neutral evidence, polarity 0. Map-only.
    """
    scale = model.scale.first()
    mu, sigma = F.lit(scale["mu"]).cast("double"), F.lit(scale["sigma"]).cast("double")
    mean = mean_price(F.col("text"), bucket_weights(model))
    m = F.when(F.col("text").isNotNull(), F.coalesce(mean, F.lit(0.0)))
    base = df.drop("sentiment_star", "sentiment_conf")
    priced = base.withColumn("_m", m)
    return priced.select(
        *base.columns,
        stars(F.col("_m"), mu, sigma).alias("sentiment_star"),
        confidence(F.col("_m")).alias("sentiment_conf"),
    )
