"""Scoring review texts with a model inside vectorised Python tasks."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starsift.functions.text import distinct, pieces
from starsift.operators.cleaning import filter_nonempty, sample_rows, scoring_columns
from starsift.operators.polarity import STAR_LIMITS, Polarity, Prices, bucket_weights
from starsift.schema import SCORE_SCHEMA

# A model maps texts to labels such as "4 stars" and confidences in 0..1.
Model = Callable[[list[str]], tuple[list[str], list[float]]]

# Bytes of a batch whose equal texts are found at once, bytes of texts that a model gets at
# once, and the first characters of a label.
_BATCH_BYTES, _PIECE_BYTES, _STARS = 1 << 23, 1 << 20, frozenset("12345")

# Transformers that this Python worker has loaded, by path.
_kept: dict[str, object] = {}


def score(df: DataFrame, load: Callable[[], Model], text: str = "text") -> DataFrame:
    """Add ``sentiment_star`` (1-5) and ``sentiment_conf`` to every row.

    ``load`` runs once for each task, then the distinct whole texts of every Arrow batch
    go through the model, about a megabyte at a time. Equal texts are found in about 8
    megabytes of a batch at once, and over all of it by digest. The star is the first
    character of the label; a label of any other form gives a null star rather than a
    failed job, and a null text gives nulls. Map-only: no text is shuffled.
    """

    @F.arrow_udf(SCORE_SCHEMA)
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = load()
        for batch in batches:
            seen = {}
            found = [judged(model, part, seen) for part in pieces(batch, _BATCH_BYTES)]
            yield pa.concat_arrays(found) if found else judged(model, batch, seen)
            # A worker does not hold between batches what Arrow keeps for later.
            pa.default_memory_pool().release_unused()

    def judged(model: Model, batch: pa.Array, seen: dict) -> pa.Array:
        texts, place = distinct(batch.cast(pa.large_string()))
        keys = [hashlib.sha256(t.as_buffer()).digest() if t.is_valid else None for t in texts]
        new = [i for i, key in enumerate(keys) if key not in seen]
        at = 0
        for part in pieces(texts.take(pa.array(new, pa.int64())), _PIECE_BYTES):
            labels, sure = model(["" if t is None else t for t in part.to_pylist()])
            stars = [int(s[0]) if s[:1] in _STARS else None for s in map(str, labels)]
            seen.update(zip([keys[i] for i in new[at:at + len(part)]], zip(stars, sure, strict=True), strict=True))
            at += len(part)
        stars, confs = [seen[key][0] for key in keys], [seen[key][1] for key in keys]
        known = pc.is_valid(texts)
        values = [
            pc.if_else(known, pa.array(stars, pa.int32()), None),
            pc.if_else(known, pa.array(confs, pa.float32(), from_pandas=True), None),
        ]
        names = ["sentiment_star", "sentiment_conf"]
        return pa.StructArray.from_arrays([v.take(pa.array(place)) for v in values], names)

    base = df.drop("sentiment_star", "sentiment_conf")
    return base.withColumn("_p", predict(F.col(text))).select(
        *base.columns, "_p.sentiment_star", "_p.sentiment_conf"
    )


def score_reviews(df: DataFrame, load: Callable[[], Model], rows: int | None = None) -> DataFrame:
    """The scoring stage: project, drop empty texts, maybe sample, score."""
    texts = filter_nonempty(scoring_columns(df))
    return score(texts if rows is None else sample_rows(texts, rows), load)


def hashed_model(model: Polarity) -> Callable[[], Model]:
    """Scorer over the bucketed polarity model, at most 65536 weights.

    The weights are the model's parameters, bounded by the number of buckets; they
    reach the tasks as one broadcast variable. Tokens of a batch are split and counted
    by Arrow; only its distinct ones are hashed one by one.
    """
    spark = model.terms.sparkSession
    scale = model.scale.first()
    shared = spark.sparkContext.broadcast(np.array(bucket_weights(model)))
    mu, sigma = scale["mu"] or 0.0, scale["sigma"] or 0.0
    limits = np.array(STAR_LIMITS)

    def load() -> Model:
        prices = Prices(shared.value)

        def predict(texts: list[str]) -> tuple[list[str], list[float]]:
            total, count = prices.sums(pc.utf8_lower(pa.array(texts, pa.large_string())))
            m = total / np.maximum(count, 1)
            z = (m - mu) / sigma if sigma else np.zeros(len(texts))
            star = 1 + (z[:, None] >= limits[None, :]).sum(axis=1)
            labels = [f"{s} stars" if s > 1 else "1 star" for s in star.tolist()]
            return labels, (1 / (1 + np.exp(-np.abs(m)))).tolist()

        return predict

    return load


def transformer_model(path: str, batch_size: int = 8) -> Callable[[], Model]:
    """Scorer over a text-classification transformer stored at ``path``.

    Needs the ``transformers`` and ``torch`` packages and the weights on every
    worker (``--archives`` or a shared folder); it raises where they are absent.
    Over-long texts are truncated by the model, a GPU is used where present, and
    a loaded model stays with its Python worker for the tasks that follow.
    """

    def load() -> Model:
        import torch
        import transformers

        if path not in _kept:
            _kept[path] = transformers.pipeline(
                "text-classification",
                model=path,
                device=0 if torch.cuda.is_available() else -1,
            )
        classifier = _kept[path]

        def predict(texts: list[str]) -> tuple[list[str], list[float]]:
            found = classifier(texts, truncation=True, batch_size=batch_size)
            return [p["label"] for p in found], [float(p["score"]) for p in found]

        return predict

    return load
