"""Sentiment stars from a classifier trained on rated reviews, with calibrated confidence."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starsift.functions.text import LETTERS, distinct, exploded, letter_words
from starsift.operators.polarity import BUCKETS, KEPT_TERMS, bucket, mean_price
from starsift.operators.skew import lookup_join
from starsift.sources.workspace import materialize

CLASSES = 5
FOLDS = 5
# Rows that a learner goes over again, and those of one gradient.
_BLOCK, _BATCH, _RUN = 2048, 128, 10_000
_FAN = 32


@dataclass(frozen=True)
class Classifier:
    """Weights by feature and class, and confidence by least raw score (both rising)."""

    weights: np.ndarray
    scores: np.ndarray
    confidences: np.ndarray

    def calibrated(self, raw: np.ndarray) -> np.ndarray:
        """The measured accuracy of reviews outside the training with scores like these."""
        if not len(self.scores):
            return raw
        place = np.searchsorted(self.scores, raw, side="right") - 1
        return self.confidences[np.maximum(place, 0)]


def fold(text: str = "text") -> Column:
    """Fold 0 to 4 of a text, the same for equal texts."""
    return F.crc32(F.col(text)) % FOLDS


def held_out(text: str = "text") -> Column:
    """True for texts that :func:`split_rated` keeps for measuring."""
    return fold(text) == 0


def split_rated(df: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Reviews to train on (folds 2 to 4), to calibrate on (1) and to measure on (0).

    Equal texts are in one fold, so no measured text was trained on in another review.
    Rows without a text are in none.
    """
    return df.filter(fold() > 1), df.filter(fold() == 1), df.filter(fold() == 0)


class Places(dict):
    """Feature of each term in UTF-8, the same in every process; about ``KEPT_TERMS`` are remembered."""

    def __init__(self, features: int):
        self.features = features

    def __missing__(self, term: bytes) -> int:
        if len(self) >= KEPT_TERMS:
            self.clear()
        digest = hashlib.blake2b(term, digest_size=8).digest()
        place = self[term] = int.from_bytes(digest, "little") % self.features
        return place


_places: dict[int, Places] = {}


def _sparse(texts: pa.Array, features: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(starts, places, values) of lower-cased texts, in pieces of bounded size.

    A value is one plus the logarithm of a count, each row of length one; the last
    place is the same for all texts.
    """
    known = _places.setdefault(features, Places(features))
    for rows, owner, words in letter_words(texts):
        coded = pc.dictionary_encode(words)
        terms = coded.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False)
        at = np.array([known[t] for t in terms], dtype=np.int64)[coded.indices.to_numpy()]
        cell = owner * (features + 1) + at
        cells, counts = np.unique(cell, return_counts=True)
        worth = 1.0 + np.log(counts)
        row = cells // (features + 1)
        worth /= np.sqrt(np.bincount(row, worth * worth, minlength=rows))[row]
        # One constant feature ends each row.
        ends = np.cumsum(np.bincount(row, minlength=rows)) + np.arange(rows)
        place = np.full(len(cells) + rows, features)
        value = np.ones(len(cells) + rows)
        own = np.arange(len(cells)) + row
        place[own], value[own] = cells % (features + 1), worth
        yield np.append(0, ends[:-1] + 1)[:rows], place, value


def _probabilities(weights, starts, place, value) -> np.ndarray:
    logits = np.add.reduceat(weights[place] * value[:, None], starts, axis=0)
    odds = np.exp(logits - logits.max(axis=1, keepdims=True))
    return odds / odds.sum(axis=1, keepdims=True)


_COUNTS = [f"n{c}" for c in range(CLASSES)]
_VECTOR = {
    "mark": pa.binary(), "digest": pa.int64(), "fold": pa.int32(), "copies": pa.int64(),
    **{c: pa.int64() for c in _COUNTS},
    "places": pa.binary(), "values": pa.binary(),
}
_VECTOR_SCHEMA = (
    "mark BINARY, digest BIGINT, fold INT, copies BIGINT, "
    + ", ".join(f"{c} BIGINT" for c in _COUNTS) + ", places BINARY, values BINARY"
)


def _packed(bounds: np.ndarray, numbers: np.ndarray) -> pa.Array:
    """Rows of numbers as bytes, which Spark moves whole."""
    cuts = pa.py_buffer((bounds * numbers.itemsize).astype(np.int32))
    return pa.BinaryArray.from_buffers(pa.binary(), len(bounds) - 1, [None, cuts, pa.py_buffer(numbers)])


def _unpacked(rows: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """(bounds, numbers) of rows of :func:`_packed`."""
    numbers = b"".join(rows.to_pylist())
    sizes = pc.binary_length(rows).to_numpy(zero_copy_only=False) // np.dtype(kind).itemsize
    return np.append(0, np.cumsum(sizes, dtype=np.int64)), np.frombuffer(numbers, kind)


def _vectors(batch: pa.RecordBatch, features: int) -> tuple[list[pa.RecordBatch], pa.Array]:
    """Vectors of the distinct texts of a batch (digest, label, text), and each row's mark.

    Texts lose case only after equal ones are folded. A null text has no vector and no mark;
    a null label counts as a copy alone.
    """
    texts, own = distinct(batch.column("text").cast(pa.large_string()))
    first = np.unique(own, return_index=True)[1]
    label = batch.column("label")
    rated = pc.is_valid(label).to_numpy(zero_copy_only=False)
    cell = own[rated].astype(np.int64) * CLASSES + pc.fill_null(label, 0).to_numpy()[rated]
    counts = np.bincount(cell, minlength=len(texts) * CLASSES).reshape(-1, CLASSES)
    copies = np.bincount(own, minlength=len(texts))
    digests = batch.column("digest").take(pa.array(first))
    raw = texts.cast(pa.large_binary()).to_pylist()
    marks = pa.array(
        [t if t is None else hashlib.blake2b(t, digest_size=16).digest() for t in raw], pa.binary()
    )
    folds = pa.array([t if t is None else zlib.crc32(t) % FOLDS for t in raw], pa.int32())
    known = pc.is_valid(texts)
    lowered = pa.array([t if t is None else t.lower() for t in texts.to_pylist()], pa.large_string())
    found, done = [], 0
    for starts, place, value in _sparse(lowered, features):
        bounds = np.append(starts, len(place))
        here = slice(done, done + len(starts))
        done += len(starts)
        columns = [marks[here], digests[here], folds[here], pa.array(copies[here])]
        columns += [pa.array(counts[here, c]) for c in range(CLASSES)]
        columns += [
            _packed(bounds, place.astype(np.int32)), _packed(bounds, value.astype(np.float64)),
        ]
        vectors = pa.RecordBatch.from_arrays(columns, names=list(_VECTOR))
        found.append(vectors.filter(known[here]))
    return found, marks.take(pa.array(own))


def _coded_rows(batch: pa.RecordBatch, features: int) -> Iterator[pa.RecordBatch]:
    """Vectors of a batch of (digest, label, text), one for each text and label, with its copies."""
    for vectors in _vectors(batch, features)[0]:
        counts = _csr(vectors)[3]
        text, label = np.nonzero(counts)
        rows = vectors.take(pa.array(text))
        bounds, places = _unpacked(rows.column("places"), np.int32)
        cuts = pa.array(bounds.astype(np.int32))
        values = _unpacked(rows.column("values"), np.float64)[1]
        yield pa.RecordBatch.from_pydict({
            "digest": rows.column("digest"), "label": pa.array(label.astype(np.int32)),
            "copies": pa.array(counts[text, label]),
            "places": pa.ListArray.from_arrays(cuts, pa.array(places)),
            "values": pa.ListArray.from_arrays(cuts, pa.array(values)),
        })


def _labelled(df: DataFrame, *rest: str) -> DataFrame:
    """(rest, digest, label, text): the label is null for rows without a rating of 1 to 5."""
    label = F.when(F.col("rating").between(1, 5), (F.round("rating") - 1).cast("int"))
    return df.select(
        *rest, F.xxhash64("text").alias("digest"), label.alias("label"), F.col("text").alias("text")
    )


def _folded(vectors: DataFrame) -> DataFrame:
    """One row for each text, with its copies, and those of each label."""
    sums = [F.sum(c).alias(c) for c in ("copies", *_COUNTS)]
    firsts = [F.first(c).alias(c) for c in ("digest", "fold", "places", "values")]
    return materialize(vectors.groupBy("mark").agg(*sums, *firsts), "coded")


def _coded(df: DataFrame, features: int) -> DataFrame:
    """The vectors of rated texts, equal ones folded, no text in it."""
    rated = df.filter(F.col("rating").between(1, 5) & F.col("text").isNotNull())

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from _vectors(batch, features)[0]

    return _folded(_labelled(rated).mapInArrow(code, _VECTOR_SCHEMA))


def _csr(batch: pa.RecordBatch):
    """(starts, places, values, counts by label) of a batch of vectors."""
    bounds, places = _unpacked(batch.column("places"), np.int32)
    return (
        bounds[:-1],
        places.astype(np.int64),
        _unpacked(batch.column("values"), np.float64)[1],
        np.stack([batch.column(c).to_numpy() for c in _COUNTS], 1),
    )


def fit_classifier(
    df: DataFrame,
    features: int = 1 << 12,
    passes: int = 3,
    calibration: DataFrame | None = None,
    rate: float = 0.5,
    learner_rows: int = 50_000,
    max_learners: int = 1024,
) -> Classifier:
    """Train a multinomial logistic model from text to star rating on all rated rows of ``df``.

    Texts become hashed term vectors once, equal ones with equal stars folded into one
    with a weight, so that one text in a third of all reviews is one row. Learners, one
    for each ``learner_rows`` vectors up to ``max_learners``, read a part each in the
    order of the digests, block by block (``passes`` gradient passes over a block of 2048
    while it is in memory); their models are averaged in a tree. A model is ``features``
    times five numbers, whatever the vocabulary or the rows.

    With ``calibration`` (rated reviews not trained on), confidence is the accuracy
    measured there by isotonic regression, else the raw probability.
    """
    measured = None if calibration is None else _coded(calibration, features)
    return _fit(_coded(df, features), measured, features, passes, rate, learner_rows, max_learners)


def _fit(
    coded: DataFrame, calibration: DataFrame | None, features: int = 1 << 12, passes: int = 3,
    rate: float = 0.5, learner_rows: int = 50_000, max_learners: int = 1024,
) -> Classifier:
    """:func:`fit_classifier` on vectors; a row of training is a text with one of its labels."""
    many = sum((F.col(c) > 0).cast("long") for c in _COUNTS)
    learners = min(max_learners, 1 + (coded.agg(F.sum(many)).first()[0] or 0) // learner_rows)
    shape = (features + 1, CLASSES)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, squares, seen = np.zeros(shape), np.full(shape, 1e-8), 0
        for batch, skip, rows in _pair_blocks(batches):
            starts, place, value, counts = _csr(batch)
            value = value.astype(np.float32).astype(np.float64)
            bounds = np.append(starts, len(place))
            text, label = (x[skip:skip + rows] for x in np.nonzero(counts))
            copies = counts[text, label].astype(np.float64)
            for _ in range(passes):
                for low in range(0, rows, _BATCH):
                    high = min(low + _BATCH, rows)
                    top, end = text[low], text[high - 1] + 1
                    cut = slice(bounds[top], bounds[end])
                    own = bounds[top:end] - bounds[top]
                    share = np.zeros((end - top, CLASSES))
                    share[text[low:high] - top, label[low:high]] = copies[low:high] / copies[low:high].sum()
                    miss = _probabilities(weights, own, place[cut], value[cut])
                    miss = miss * share.sum(axis=1)[:, None] - share
                    lengths = np.diff(np.append(own, len(place[cut])))
                    touched, where = np.unique(place[cut], return_inverse=True)
                    pull = np.repeat(miss, lengths, axis=0) * value[cut][:, None]
                    step = np.stack(
                        [np.bincount(where, pull[:, c], minlength=len(touched)) for c in range(CLASSES)], 1
                    )
                    squares[touched] += step * step
                    weights[touched] -= rate * step / np.sqrt(squares[touched])
            seen += rows
        if seen:
            node = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_pydict(
                {"node": [node], "seen": [seen], "model": [weights.tobytes()]}
            )

    def merge(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        return _mean_model(part, int(key[0]))

    partial = (
        coded.select("digest", "mark", *_COUNTS, "places", "values")
        .repartition(learners, "digest")
        .sortWithinPartitions("digest", "mark")
        .mapInArrow(learn, "node BIGINT, seen BIGINT, model BINARY")
    )
    halved = partial.groupBy((F.col("node") % _FAN).alias("node")).applyInPandas(
        merge, "node BIGINT, seen BIGINT, model BINARY"
    )
    last = _mean_model(halved.toPandas(), 0)
    weights = (
        np.frombuffer(last["model"].iloc[0]).reshape(shape) if last["seen"].iloc[0] else np.zeros(shape)
    )
    empty = np.empty(0)
    model = Classifier(weights, empty, empty)
    return model if calibration is None else _calibrate(model, calibration)


def _pair_blocks(
    batches: Iterator[pa.RecordBatch],
) -> Iterator[tuple[pa.RecordBatch, int, int]]:
    """(vectors, skip, rows): blocks of texts with one label each, whatever batches they come in.

    A block has the ``rows`` such pairs of its vectors that follow the first ``skip``;
    the labels of one text may be in two blocks.
    """
    done, skip, kept = 0, 0, None
    for batch in batches:
        table = pa.Table.from_batches([batch] if kept is None else [kept, batch])
        batch = table.combine_chunks().to_batches()[0] if table.num_rows else batch
        pairs = np.cumsum(sum(batch.column(c).to_numpy() > 0 for c in _COUNTS))
        at = 0
        total = int(pairs[-1]) if len(pairs) else 0
        used = skip
        while total - used >= (rows := _block_rows(done)):
            end = int(np.searchsorted(pairs, used + rows)) + 1
            before = int(pairs[at - 1]) if at else 0
            yield batch.slice(at, end - at), used - before, rows
            done, used = done + rows, used + rows
            at = int(np.searchsorted(pairs, used, side="right"))
        kept = batch.slice(at)
        skip = used - (int(pairs[at - 1]) if at else 0)
    if kept is not None and kept.num_rows:
        rows = int(sum((kept.column(c).to_numpy() > 0).sum() for c in _COUNTS)) - skip
        if rows:
            yield kept, skip, rows


def _block_rows(done: int) -> int:
    """Rows of the block that begins after ``done``: a run of blocks ends every ``_RUN`` rows."""
    return min(_BLOCK, _RUN - done % _RUN)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, batch.num_rows, _BLOCK):
            yield batch.slice(low, _BLOCK)


def _mean_model(part: pd.DataFrame, node: int) -> pd.DataFrame:
    """Mean of models by the rows each has seen, added in a fixed order."""
    part = part.sort_values(["node", "seen", "model"])
    total = int(part["seen"].sum())
    mean = sum(
        (np.frombuffer(m) * (n / total) for m, n in zip(part["model"], part["seen"], strict=True)),
        np.zeros(1),
    )
    return pd.DataFrame({"node": [node], "seen": [total], "model": [mean.tobytes()]})


def pool(score: np.ndarray, hits: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, ...]:
    """Adjacent violators pooled: (least score, hits, rows) of each step, accuracies rising.

    Pools of parts of a sorted series, put one after the other and pooled again, are
    those of the whole series.
    """
    low, hit, count = [], [], []
    for s, h, n in zip(score.tolist(), hits.tolist(), rows.tolist(), strict=True):
        while hit and hit[-1] * n >= h * count[-1]:
            s, h, n = low.pop(), h + hit.pop(), n + count.pop()
        low.append(s)
        hit.append(h)
        count.append(n)
    return np.array(low), np.array(hit), np.array(count)


def _calibrate(model: Classifier, coded: DataFrame) -> Classifier:
    """Isotonic regression of being right on the raw score, over all rows of ``coded``.

    Scores are folded, ranges of them pooled each by one task; n rows leave at most about
    n^(2/3) pools, since accuracies of pools are rising fractions of whole numbers.
    """
    shared = coded.sparkSession.sparkContext.broadcast(model.weights)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            starts, place, value, counts = _csr(batch)
            value = value.astype(np.float32).astype(np.float64)
            odds = _probabilities(shared.value, starts, place, value)
            hits = np.take_along_axis(counts, odds.argmax(axis=1)[:, None], 1)[:, 0]
            yield pa.RecordBatch.from_pydict(
                {"score": odds.max(axis=1), "hits": hits, "rows": counts.sum(axis=1)}
            )

    def pooled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = (np.empty(0), np.empty(0, np.int64), np.empty(0, np.int64))
        for batch in batches:
            if batch.num_rows:
                new = [batch.column(c).to_numpy() for c in ("score", "hits", "rows")]
                kept = pool(*[np.concatenate(pair) for pair in zip(kept, new, strict=True)])
        yield pa.RecordBatch.from_pydict(dict(zip(("score", "hits", "rows"), kept, strict=True)))

    schema = "score DOUBLE, hits BIGINT, rows BIGINT"
    scored = coded.mapInArrow(judge, schema).groupBy("score").agg(
        F.sum("hits").alias("hits"), F.sum("rows").alias("rows")
    )
    pools = (
        scored.repartitionByRange("score")
        .sortWithinPartitions("score")
        .mapInArrow(pooled, schema)
        .toPandas()
        .sort_values("score")
    )
    low, hits, rows = pool(*[pools[c].to_numpy() for c in ("score", "hits", "rows")])
    return Classifier(model.weights, low, hits / np.maximum(rows, 1))


def score_classifier(df: DataFrame, model: Classifier) -> DataFrame:
    """Star of the likeliest class and its confidence; map-only.

    A null text has nulls; a text without words has the star of the labels alone.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    kind = pa.struct([("sentiment_star", pa.int32()), ("sentiment_conf", pa.float32())])

    @F.arrow_udf("sentiment_star INT, sentiment_conf FLOAT")
    def judge(text: pa.Array) -> pa.Array:
        told = shared.value
        texts, row = distinct(text.cast(pa.large_string()))
        lowered = pa.array([t if t is None else t.lower() for t in texts.to_pylist()], pa.large_string())
        stars, confs = [np.empty(0, np.int32)], [np.empty(0, np.float32)]
        for starts, place, value in _sparse(lowered, len(told.weights) - 1):
            odds = _probabilities(told.weights, starts, place, value)
            stars.append((odds.argmax(axis=1) + 1).astype(np.int32))
            confs.append(told.calibrated(odds.max(axis=1)).astype(np.float32))
        unknown = texts.is_null().to_numpy(zero_copy_only=False)
        return pa.StructArray.from_arrays(
            [
                pa.array(np.concatenate(stars)[row], pa.int32(), mask=unknown[row]),
                pa.array(np.concatenate(confs)[row], pa.float32(), mask=unknown[row]),
            ],
            fields=list(kind),
        )

    base = df.drop("sentiment_star", "sentiment_conf")
    return base.withColumn("_p", judge(F.col("text"))).select(
        *base.columns, "_p.sentiment_star", "_p.sentiment_conf"
    )


def classify(df: DataFrame, features: int = 1 << 12) -> DataFrame:
    """Fold, star and confidence of every review, by a model learned from the same reviews.

    The result of :func:`score_classifier` with a model fitted and calibrated on the parts of
    :func:`split_rated`, in a single pass over the texts: every distinct text of a batch
    becomes a vector once, on which the model is learned, calibrated and judged; a review
    meets its judgement by a digest of its text. The columns but the text are kept,
    ``fold`` (null for a null text), ``sentiment_star`` and ``sentiment_conf`` are added.
    """
    given = ("text", "fold", "sentiment_star", "sentiment_conf")
    rest = [c for c in df.columns if c not in given]
    kinds = df.select(*rest).schema
    hidden = [f"_c{i}" for i in range(len(rest))]
    labelled = _labelled(
        df.select(*[F.col(c).alias(h) for c, h in zip(rest, hidden, strict=True)], "rating", "text"),
        *hidden,
    )

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            found, marks = _vectors(batch, features)
            names = [*hidden, *_VECTOR]
            for v in found:
                blank = [pa.nulls(v.num_rows, batch.column(h).type) for h in hidden]
                yield pa.RecordBatch.from_arrays([*blank, *v.columns], names=names)
            own = [batch.column(h) for h in hidden]
            empty = [pa.nulls(batch.num_rows, k) for c, k in _VECTOR.items() if c != "mark"]
            yield pa.RecordBatch.from_arrays([*own, marks, *empty], names=names)

    schema = T.StructType(
        [T.StructField(h, f.dataType) for h, f in zip(hidden, kinds.fields, strict=True)]
    )
    for field in T.StructType.fromDDL(_VECTOR_SCHEMA).fields:
        schema = schema.add(field)
    parts = materialize(labelled.mapInArrow(part, schema), "parts")
    coded = _folded(parts.filter(F.col("places").isNotNull()).select(*_VECTOR))
    rated = coded.filter(sum(F.col(c) for c in _COUNTS) > 0)
    model = _fit(rated.filter("fold > 1"), rated.filter("fold = 1"), features)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told = shared.value
        for batch in _blocks(batches):
            if not batch.num_rows:
                continue
            odds = _probabilities(told.weights, *_csr(batch)[:3])
            yield pa.RecordBatch.from_pydict({
                "mark": batch.column("mark"), "copies": batch.column("copies"), "fold": batch.column("fold"),
                "sentiment_star": pa.array((odds.argmax(axis=1) + 1).astype(np.int32)),
                "sentiment_conf": pa.array(told.calibrated(odds.max(axis=1)).astype(np.float32)),
            })

    judged = materialize(
        coded.mapInArrow(
            judge, "mark BINARY, copies BIGINT, fold INT, sentiment_star INT, sentiment_conf FLOAT"
        ),
        "judged",
    )
    rows = parts.filter(F.col("places").isNull()).select(*hidden, "mark")
    return lookup_join(rows, judged, "mark", "copies", "left").select(
        *[F.col(h).alias(c) for c, h in zip(rest, hidden, strict=True)],
        "fold", "sentiment_star", "sentiment_conf",
    )


def classifier_report(scored: DataFrame, bins: int = 10) -> DataFrame:
    """Accuracy and confidence of measured reviews by tenths of confidence, and over all.

    Only rated reviews of the held-out fold count. The row with a null ``bin`` is that of
    all; ``gap`` is there the expected calibration error, the mean gap over its reviews.
    """
    place = F.least(F.floor(F.col("sentiment_conf") * bins), F.lit(bins - 1)).cast("int")
    right = (F.col("sentiment_star") == F.round("rating")).cast("int")
    judged = scored.filter(
        held_out() & F.col("rating").between(1, 5) & F.col("sentiment_star").isNotNull()
    )
    by_bin = judged.groupBy(place.alias("bin")).agg(
        F.count("*").alias("reviews"),
        F.sum(F.col("sentiment_conf").cast("double")).alias("_conf"),
        F.sum(right).alias("_right"),
    ).withColumn("_gap", F.abs(F.col("_conf") - F.col("_right")))
    return by_bin.rollup("bin").agg(
        F.sum("reviews").alias("reviews"),
        (F.sum("_right") / F.sum("reviews")).alias("accuracy"),
        (F.sum("_conf") / F.sum("reviews")).alias("confidence"),
        (F.sum("_gap") / F.sum("reviews")).alias("gap"),
    )


@dataclass(frozen=True)
class Bayes:
    """Log-odds of the label by term bucket, and of the label itself."""

    weights: list[float]
    prior: float


def fit_bayes(df: DataFrame, text: str, label: str) -> Bayes:
    """Multinomial naive Bayes of a 0/1 label over 65536 buckets of terms.

    Closed form with one added to every bucket's count; the model is as large as the
    buckets, whatever the vocabulary.
    """
    known = df.filter(F.col(label).isNotNull() & F.col(text).isNotNull())
    one = F.col(label) == 1
    rows = known.agg(F.count_if(one).alias("one"), F.count_if(~one).alias("zero")).first()
    words = exploded(known.select(F.col(text).alias("text"), one.alias("one")), "text", LETTERS, 1, "one")
    counts = words.groupBy(bucket(F.col("term")).alias("bucket")).agg(
        F.count_if("one").alias("one"), F.count_if(~F.col("one")).alias("zero")
    )
    ones, zeros = [1.0] * BUCKETS, [1.0] * BUCKETS
    for r in counts.toLocalIterator():
        ones[r["bucket"]] += r["one"]
        zeros[r["bucket"]] += r["zero"]
    base = math.log(sum(zeros)) - math.log(sum(ones))
    weights = [math.log(a) - math.log(b) + base for a, b in zip(ones, zeros, strict=True)]
    return Bayes(weights, math.log(rows["one"] + 1) - math.log(rows["zero"] + 1))


def score_bayes(df: DataFrame, model: Bayes, text: str = "text") -> DataFrame:
    """Add ``margin``, the log-odds of label 1, and ``label``; map-only.

    A text without tokens has the margin of the labels alone; a null text has nulls.
    """
    words = F.size(F.filter(F.split(F.lower(F.col(text)), LETTERS), lambda t: F.length(t) >= 1))
    told = F.coalesce(mean_price(F.col(text), model.weights) * words, F.lit(0.0))
    margin = F.when(F.col(text).isNotNull(), told + model.prior)
    return df.withColumn("margin", margin).withColumn(
        "label", F.when(F.col("margin").isNotNull(), (F.col("margin") >= 0).cast("int"))
    )
