import math
import sys
import types

import pytest
from pyspark.sql import functions as F

from starsift.functions.text import LETTERS, tokens
from starsift.operators import classifier, cleaning, polarity, scoring

DOCS = [
    (0, "good good great fine"),
    (1, "good nice product"),
    (2, "bad awful bad thing"),
    (3, "awful broken product"),
    (4, "great great product é"),
    (5, "no label here"),
]
LABELS = [(0, 1), (1, 1), (2, 0), (3, 0), (4, 1)]


@pytest.fixture
def training(spark):
    docs = spark.createDataFrame(DOCS, "doc_id BIGINT, text STRING")
    return docs, spark.createDataFrame(LABELS, "doc_id BIGINT, quality INT")


def review_frame(spark, *texts):
    return spark.createDataFrame(
        [(i, 5.0, t, f"u{i}", 0, "a") for i, t in enumerate(texts)],
        "review_id BIGINT, rating DOUBLE, text STRING, user_id STRING, timestamp BIGINT, asin STRING",
    )


def by_hand(texts):
    """Plain-Python polarity: term prices, then the mean of each text."""
    n1, n0 = {}, {}
    for (_, text), (_, label) in zip(DOCS, LABELS, strict=False):
        for w in text.split():
            side = n1 if label else n0
            side[w] = side.get(w, 0) + 1
    vocabulary = set(n1) | set(n0)
    t1, t0, v = sum(n1.values()), sum(n0.values()), len(vocabulary)
    price = {
        w: math.log((n1.get(w, 0) + 1) / (t1 + v)) - math.log((n0.get(w, 0) + 1) / (t0 + v))
        for w in vocabulary
    }

    def mean(text):
        words = text.split()
        return sum(price.get(w, 0.0) for w in words) / len(words) if words else 0.0

    train = [mean(t) for (i, t) in DOCS if i in dict(LABELS)]
    mu = sum(train) / len(train)
    sigma = math.sqrt(sum((m - mu) ** 2 for m in train) / len(train))
    out = []
    for text in texts:
        m = mean(text)
        z = (m - mu) / sigma
        star = 1 + sum(z >= x for x in (-1.5, -0.5, 0.5, 1.5))
        out.append((star, pytest.approx(1 / (1 + math.exp(-abs(m))), abs=1e-6)))
    return out


def test_polarity_equals_the_formula(spark, training):
    texts = ["good great great", "awful bad", "unknown words", "product", "123 !!"]
    model = polarity.fit_hashed(*training)
    got = polarity.score_polarity(review_frame(spark, *texts), model).orderBy("review_id").collect()
    want = by_hand([*texts[:4], ""])
    assert [(r["sentiment_star"], r["sentiment_conf"]) for r in got] == want


def test_bucketed_model_in_python_equals_the_one_in_spark(spark, training):
    texts = ["good great GREAT", "awful, bad", "unknown", "é product", "42"]
    model = polarity.fit_hashed(*training)
    df = review_frame(spark, *texts)
    got = scoring.score(df, scoring.hashed_model(model)).orderBy("review_id").collect()
    prices = {r["term"]: r["p"] for r in model.terms.collect()}
    words = df.select("review_id", F.explode(tokens("text", LETTERS)).alias("t"))
    bucketed = words.select("review_id", polarity.bucket(F.col("t")).alias("b")).collect()
    scale = model.scale.first()
    for row in got:
        mine = [prices.get(r["b"], 0.0) for r in bucketed if r["review_id"] == row["review_id"]]
        m = sum(mine) / len(mine) if mine else 0.0
        z = (m - scale["mu"]) / scale["sigma"]
        assert row["sentiment_star"] == 1 + sum(z >= x for x in (-1.5, -0.5, 0.5, 1.5))
        assert row["sentiment_conf"] == pytest.approx(1 / (1 + math.exp(-abs(m))), abs=1e-6)


def test_a_score_does_not_depend_on_its_batch(spark, training):
    model = polarity.fit_hashed(*training)
    alone = polarity.score_polarity(review_frame(spark, "good product"), model).first()
    among = polarity.score_polarity(
        review_frame(spark, "good product", *["awful bad"] * 30), model
    ).filter("review_id = 0").first()
    assert alone == among


def test_score_contract(spark):
    def load():
        def predict(texts):
            labels = ["4 stars", "9 stars", "LABEL_1", "1 star", "2 stars"]
            return labels[: len(texts)], [0.5] * len(texts)

        return predict

    df = review_frame(spark, "a", "b", "c", "d", None).coalesce(1)
    out = scoring.score(df, load)
    assert dict(out.dtypes)["sentiment_star"] == "int"
    assert dict(out.dtypes)["sentiment_conf"] == "float"
    got = out.orderBy("review_id").collect()
    assert [r["sentiment_star"] for r in got] == [4, None, None, 1, None]
    assert [r["sentiment_conf"] for r in got] == [0.5, 0.5, 0.5, 0.5, None]


def test_scoring_stage_drops_empty_texts_and_samples(spark):
    def load():
        return lambda texts: (["3 stars"] * len(texts), [0.4] * len(texts))

    df = cleaning.add_review_time(review_frame(spark, "a", "", None, *"bcdefgh"))
    assert scoring.score_reviews(df, load).count() == 8
    sampled = scoring.score_reviews(df, load, rows=3)
    assert sampled.count() == 3
    assert sampled.columns[:3] == ["asin", "review_time", "rating"]


def test_transformer_contract(monkeypatch):
    calls = []

    def make(task, model, device):
        calls.append((task, model, device))
        return lambda texts, truncation, batch_size: [
            {"label": f"{len(t)} stars", "score": 0.25} for t in texts
        ]

    torch = types.ModuleType("torch")
    torch.cuda = types.SimpleNamespace(is_available=lambda: False)
    library = types.ModuleType("transformers")
    library.pipeline = make
    monkeypatch.setitem(sys.modules, "torch", torch)
    monkeypatch.setitem(sys.modules, "transformers", library)
    load = scoring.transformer_model("/models/x")
    assert load()(["ab", "abc"]) == (["2 stars", "3 stars"], [0.25, 0.25])
    load()
    assert calls == [("text-classification", "/models/x", -1)]


def test_classifier_learns_its_training_texts(spark):
    df = review_frame(spark, *["great love wonderful"] * 6, *["awful broken refund"] * 6, None)
    df = df.withColumn("rating", F.when(F.col("review_id") < 6, 5.0).otherwise(1.0))
    model = classifier.fit_classifier(df, features=256)
    got = classifier.score_classifier(df, model).orderBy("review_id").collect()
    assert [r["sentiment_star"] for r in got] == [5] * 6 + [1] * 6 + [None]
    assert all(0.5 < r["sentiment_conf"] <= 1 for r in got[:12])


def test_equal_texts_of_a_batch_are_scored_once(spark):
    """A model sees each distinct text once, in parts of bounded size, and rows keep their order."""
    seen = spark.sparkContext.accumulator(0)

    def load():
        def model(texts):
            seen.add(len(texts))
            return [f"{len(t) % 5 + 1} stars" if len(t) != 3 else "none" for t in texts], [0.5] * len(texts)

        return model

    texts = ["a", "bb", "ccc", None, "", "dddd" * 300_000] * 30
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "review_id INT, text STRING").coalesce(1)
    got = [tuple(r) for r in scoring.score(df, load).select("sentiment_star", "sentiment_conf").collect()]
    want = [(None, None) if t is None else (None if len(t) == 3 else len(t) % 5 + 1, 0.5) for t in texts]
    assert got == want and seen.value == 6


def test_terms_of_equal_texts_are_priced_once():
    import numpy as np
    import pyarrow as pa

    prices = polarity.Prices(np.arange(polarity.BUCKETS, dtype=float))
    split = []
    plain = polarity.letter_words
    texts = ["good bad", None, "", "bad"] * 50

    def counted(array, *args):
        split.append(len(array))
        return plain(array, *args)

    polarity.letter_words, kept = counted, plain
    try:
        total, count = prices.sums(pa.array(texts, pa.large_string()))
    finally:
        polarity.letter_words = kept
    good, bad = prices.price("good"), prices.price("bad")
    assert split == [4] and count.tolist() == [2, 0, 0, 1] * 50
    assert total.tolist() == [good + bad, 0.0, 0.0, bad] * 50


def test_large_batches_are_scored_in_parts(spark, monkeypatch):
    monkeypatch.setattr(scoring, "_BATCH_BYTES", 40)
    rows = [(i, None if i % 7 == 0 else "" if i % 5 == 0 else f"text {i % 3} " * 3) for i in range(50)]
    most = spark.sparkContext.accumulator(0)

    def load():
        def model(texts):
            most.add(int(sum(map(len, texts)) > 60))
            return [f"{1 + len(t) % 5} stars" for t in texts], [0.5] * len(texts)

        return model

    df = spark.createDataFrame(rows, "review_id INT, text STRING").coalesce(1)
    got = {r["review_id"]: r["sentiment_star"] for r in scoring.score(df, load).collect()}
    assert got == {i: None if t is None else 1 + len(t) % 5 for i, t in rows}
    assert most.value == 0
    assert scoring.score(df.limit(0), load).collect() == []


def test_pricing_takes_little_memory_at_once():
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from starsift.operators.polarity import Prices

    texts = pa.array([f"good {'fine bad ' * 30_000}{i % 10}x" + "a" * i for i in range(30)], pa.large_string())
    prices = Prices(np.ones(65536))
    prices.sums(texts[:1])
    tracemalloc.start()
    total, count = prices.sums(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert total.tolist() == count.tolist() and count.min() > 60_000
    assert peak < 25 << 20
