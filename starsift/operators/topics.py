"""Topics among conflicting reviews."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from functools import reduce
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF, PCA, HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starsift.functions.text import WORDS, distinct, normalized, pieces, tokens
from starsift.operators.components import connected_components
from starsift.operators.numbering import numbered
from starsift.operators.skew import lookup_join
from starsift.operators.topk import top_k
from starsift.schema import require, with_review_id
from starsift.sources.workspace import materialize, spread

OUTLIER = -1
# Classes of a text that go to a task in one row, words that are counted at a time, counters
# (terms by classes) and pairs of a term and a class that are added at a time.
_CLASSES, _TOKENS, _COUNTERS, _PAIRS = 256, 1 << 20, 1 << 23, 1 << 22
# Terms of texts and classes that are added side by side, and how many classes may be added
# for one that a text has.
_CELLS, _WIDE, _DENSE = 1 << 14, 32, 16
# Bytes of texts and their labels, and counters of terms, that a task holds before it passes
# them on, and bytes of texts that it passes on at a time.
_TEXTS, _HELD, _PIECE = 1 << 25, 1 << 22, 1 << 23
# Weights nearer than this may be equal to six places.
_TIE = 4e-6


class TooFewDocuments(ValueError):
    """Fewer documents than topics can be found in."""


def topic_input(df: DataFrame, min_docs: int = 5, cap: int | None = None) -> DataFrame:
    """Documents for topic finding; raises for fewer than ``min_docs``.

    All rows take part. ``cap`` keeps the strongest mismatches only, for results
    like those of a capped run.
    """
    require(df, ("text", "rating", "sentiment_star"))
    out = with_review_id(df).select("review_id", "text", "rating", "sentiment_star")
    if cap is not None:
        size = F.abs(F.col("sentiment_star") - F.col("rating"))
        out = top_k(out, [(size, True), ("review_id", False)], cap)
    found = out.limit(min_docs).count()
    if found < min_docs:
        raise TooFewDocuments(f"topics need {min_docs} documents, found {found}")
    return out


def topic_words(text: str | Column = "text") -> Column:
    """Words of two or more characters, lower-cased; no stop words are removed."""
    return tokens(text, WORDS, 2)


def vectorize(df: DataFrame, features: int = 512) -> DataFrame:
    """(review_id, vector): hashed TF-IDF of the whole text, scaled to length one.

    The texts are split once, into a written table of hashed counts; weighting and
    every later pass read that.
    """
    words = df.select("review_id", topic_words().alias("_words"))
    hashing = HashingTF(inputCol="_words", outputCol="_tf", numFeatures=features)
    counts = materialize(hashing.transform(words).select("review_id", "_tf"), "hashed")
    weigh = Pipeline(
        stages=[
            IDF(inputCol="_tf", outputCol="_tfidf"),
            Normalizer(inputCol="_tfidf", outputCol="vector"),
        ]
    )
    return weigh.fit(counts).transform(counts).select("review_id", "vector")


def reduce_dimensions(df: DataFrame, k: int = 5) -> DataFrame:
    """(review_id, coords): ``vector`` projected on ``k`` principal components.

    The components come from the covariance matrix, whose size is the vector's
    dimension squared and does not grow with the rows.
    """
    model = PCA(k=k, inputCol="vector", outputCol="_pc").fit(df)
    return model.transform(df).select("review_id", vector_to_array("_pc").alias("coords"))


def assign_topics(
    coords: DataFrame,
    k: int = 5,
    width: float | None = None,
    min_points: int = 2,
    min_topic_size: int = 2,
) -> DataFrame:
    """(review_id, topic): the hills of the points' density, -1 for outliers.

    ``coords`` may have ``n``, how many documents a point stands for. Space is cut into
    cells ``width`` standard deviations wide. Each cell points to the fullest of its
    neighbours over a face if that is fuller than itself (of equals, the one with the
    smaller id counts as fuller), so that cells climb to the top of their hill. A hill
    is a topic if its top holds at least ``min_points`` documents and all of it
    ``min_topic_size``. Topics are numbered by size from 0.

    Without a ``width`` the cells narrow as points get more, like those of a histogram
    that keeps both its noise and its coarseness down, so the hills stay those of the
    density whatever the number of rows. All work after the first aggregate is on cells.
    """
    n = F.col("n") if "n" in coords.columns else F.lit(1)
    points = coords.select("review_id", "coords", n.cast("long").alias("n"))
    figures = points.agg(
        F.count("*").alias("points"),
        F.array(*[F.stddev_pop(F.get("coords", F.lit(i))) for i in range(k)]).alias("s"),
    ).first()
    if width is None:
        width = round(2.5 * max(1, figures["points"]) ** (-1 / (k + 4)), 6)
    steps = [(s or 0.0) * width for s in figures["s"] or [0.0] * k]
    cell = [
        F.floor(F.get("coords", F.lit(i)) / step).cast("long") if step else F.lit(0).cast("long")
        for i, step in enumerate(steps)
    ]
    placed = materialize(points.select("review_id", "n", F.array(*cell).alias("cell")), "cells")
    full = materialize(
        placed.groupBy("cell").agg(
            F.sum("n").alias("n"), F.count("*").alias("points"), F.min("review_id").alias("cell_id")
        ),
        "full",
    )
    sides = F.array(
        *[
            F.array(*[F.get("cell", F.lit(j)) + F.lit(d if i == j else 0) for j in range(k)])
            for i in range(k)
            for d in (-1, 1)
        ]
    )
    rank = F.struct((-F.col("n")).alias("less"), F.col("cell_id").alias("id"))
    faces = full.select(F.col("cell_id").alias("a"), rank.alias("own"), F.explode(sides).alias("cell"))
    above = faces.join(full.select("cell", rank.alias("other")), "cell").filter(
        F.col("other") < F.col("own")
    )
    climbs = materialize(
        above.groupBy("a").agg(F.min("other")["id"].alias("b")), "climbs"
    )
    linked = connected_components(climbs).withColumnRenamed("vertex", "cell_id")
    tops = full.join(climbs, F.col("cell_id") == F.col("a"), "left").select(
        "cell_id", "cell", full["n"], "points", F.col("a").isNull().alias("top")
    )
    merged = materialize(
        tops.join(linked, "cell_id", "left").withColumn(
            "component", F.coalesce("component", "cell_id")
        ),
        "merged",
    )
    groups = merged.groupBy("component").agg(
        F.sum("n").alias("size"), F.min("cell_id").alias("first_id"), F.count("*").alias("cells"),
        F.max(F.when(F.col("top"), F.col("n"))).alias("height"),
    )
    ranked = relabel_sizes(
        groups.filter((F.col("size") >= min_topic_size) & (F.col("height") >= min_points))
    )
    named = lookup_join(merged, ranked.select("component", "topic", "cells"), "component", "cells")
    named = materialize(named.select("cell", "points", "topic"), "named")
    return lookup_join(placed, named, "cell", "points", "left").select(
        "review_id", F.coalesce("topic", F.lit(OUTLIER)).cast("int").alias("topic")
    )


def relabel_sizes(groups: DataFrame) -> DataFrame:
    """Number groups (size, first_id) 0, 1, ... from the largest, ties by first_id.

    The result is a written table.
    """
    ranked = numbered(groups, [F.desc("size"), F.asc("first_id")], "topic")
    return materialize(ranked.withColumn("topic", F.col("topic").cast("int")), "ranked")


def relabel(df: DataFrame, label: str) -> DataFrame:
    """(review_id, text, topic) for groups that are known already.

    Groups are ranked by size; rows without a label are outliers.
    """
    groups = df.filter(F.col(label).isNotNull()).groupBy(label).agg(
        F.count("*").alias("size"), F.min("review_id").alias("first_id")
    )
    ranked = relabel_sizes(groups).select(label, "topic", "size")
    return lookup_join(df.select("review_id", "text", label), ranked, label, "size", "left").select(
        "review_id", "text", F.coalesce("topic", F.lit(OUTLIER)).cast("int").alias("topic")
    )


def fold_classes(
    df: DataFrame, class_col: str, text_col: str = "text", copies: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(digest, class, n), how many rows of a class have a text, and the texts (digest, text)."""
    rows = df.filter(F.col(text_col).isNotNull())
    times = F.lit(1) if copies is None else F.col(copies)
    held = rows.groupBy(
        F.sha2(F.col(text_col), 256).alias("digest"), F.col(class_col).alias("class")
    ).agg(F.sum(times).cast("long").alias("n"))
    texts = rows.select(F.col(text_col).alias("text")).distinct()
    return held, texts.select(F.sha2("text", 256).alias("digest"), "text")


def fold_labels(df: DataFrame, label: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Like :func:`fold_classes` for the topics of :func:`relabel`, and (Topic, Count).

    One pass over the rows writes the texts of :func:`fold_rows`; topics are ranked and
    counted from their labels. A text then moves once for each task that met it, whatever
    the number of its rows, and what does not fit a broadcast moves without texts. A text and
    class that several tasks met have a row of ``held`` for each.
    """
    rows = with_review_id(df).select("text", F.col(label).alias("label"), "review_id")
    folded = materialize(fold_rows(rows), "folded")
    counts = folded.select("digest", F.inline("classes"))
    groups = counts.filter(F.col("label").isNotNull()).groupBy("label").agg(
        F.sum("n").alias("size"), F.min("first_id").alias("first_id")
    )
    ranked = relabel_sizes(groups).select("label", "topic", "size")
    topic = F.coalesce("topic", F.lit(OUTLIER)).cast("int")
    named = lookup_join(counts.select("digest", "label", "n"), ranked, "label", "size", "left")
    held = named.select("digest", topic.alias("class"), "n")
    sizes = held.groupBy(F.col("class").alias("Topic")).agg(F.sum("n").alias("Count"))
    known = F.col("digest").isNotNull()
    # Dealt by digest before they are made distinct, texts are where the join needs them.
    texts = folded.filter(known).select("digest", "text").repartition("digest").dropDuplicates(["digest"])
    return held.filter(known), texts, sizes


def fold_rows(rows: DataFrame) -> DataFrame:
    """(digest, text, classes) of rows (text, label, review_id), in about one row for each text.

    ``classes`` has the labels of a text, at most 256 in a row, with the rows ``n`` of each and
    the smallest id ``first_id``. Tasks fold what they read, as much at a time as they may
    hold, and nothing is shuffled; a text that is met again later has further rows. Labels
    and ids that Arrow cannot group or compare as Spark does stay one to a row.
    """
    one = F.lit(1).cast("long").alias("n")
    digest = F.unhex(F.sha2("text", 256)).alias("digest")
    classes = F.array(F.struct("label", one, F.col("review_id").alias("first_id"))).alias("classes")
    single = rows.select(digest, "text", classes)
    kinds = rows.schema["label"].dataType, rows.schema["review_id"].dataType
    if not all(isinstance(kind, T.AtomicType) for kind in kinds) or isinstance(kinds[1], T.FractionalType):
        return single

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = (_folded([_unfolded(batch)]) for batch in batches if batch.num_rows)
        size = lambda part: part[0].nbytes + part[1].nbytes
        for texts, cells in _gathered(parts, size, _folded, _TEXTS):
            yield from _folded_rows(texts, cells)

    return rows.mapInArrow(fold, single.schema)


def _gathered(
    parts: Iterable, size: Callable, merged: Callable, limit: int, split: Callable | None = None
) -> Iterator:
    """The parts merged, and passed on where merging leaves more than half of ``limit``.

    ``split`` cuts off what stays, a quarter of ``limit`` at most, if there is any.
    """
    kept, held = [], 0
    for part in parts:
        kept.append(part)
        held += size(part)
        if held > limit:
            kept = [merged(kept)]
            held = size(kept[0])
            if held > limit // 2:
                passed, *kept = split(kept[0], limit // 4) if split else kept
                yield passed
                held = sum(map(size, kept))
    if kept:
        yield merged(kept) if len(kept) > 1 else kept[0]


def _unfolded(batch: pa.RecordBatch) -> tuple[pa.Array, pa.Table]:
    """Texts, and (place, label, n, first_id) of them, from rows (text, label, review_id)."""
    size = batch.num_rows
    columns = [pa.array(np.arange(size)), batch.column("label"), pa.array(np.ones(size, np.int64)),
               batch.column("review_id")]
    cells = pa.Table.from_arrays(columns, names=["place", "label", "n", "first_id"])
    return batch.column("text").cast(pa.large_string()), cells


def _folded(parts: list[tuple[pa.Array, pa.Table]]) -> tuple[pa.Array, pa.Table]:
    """The distinct texts of some parts, and one row (place, label, n, first_id) for each label."""
    texts, places = distinct(pa.concat_arrays([texts for texts, _ in parts]))
    starts = np.cumsum([0, *[len(texts) for texts, _ in parts]])
    cells = pa.concat_tables(
        [
            cells.set_column(0, "place", pa.array(places[cells["place"].to_numpy() + start]))
            for start, (_, cells) in zip(starts, parts, strict=False)
        ]
    )
    found = cells.group_by(["place", "label"], use_threads=False).aggregate(
        [("n", "sum"), ("first_id", "min")]
    )
    found = found.select(["place", "label", "n_sum", "first_id_min"])
    return texts, found.rename_columns(["place", "label", "n", "first_id"])


def _folded_rows(texts: pa.Array, cells: pa.Table) -> Iterator[pa.RecordBatch]:
    """(digest, text, classes) of what :func:`_folded` gives, about ``_PIECE`` bytes at a time."""
    place = cells["place"].to_numpy()
    cells = cells.take(pa.array(np.argsort(place, kind="stable")))
    sizes = np.bincount(place, minlength=len(texts))
    times = -(-sizes // _CLASSES)
    owner = np.repeat(np.arange(len(texts)), times)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(times) - times, times)
    cuts = np.append((np.cumsum(sizes) - sizes)[owner] + nth * _CLASSES, len(cells)).astype(np.int32)
    names = ["label", "n", "first_id"]
    held = pa.StructArray.from_arrays([cells[c].combine_chunks() for c in names], names=names)
    lists = pa.ListArray.from_arrays(pa.array(cuts), held)
    digests = pa.array(
        [None if t is None else hashlib.sha256(t).digest() for t in texts.cast(pa.large_binary()).to_pylist()],
        pa.binary(),
    ).take(pa.array(owner))
    at = 0
    for part in pieces(texts.take(pa.array(owner)), _PIECE):
        yield pa.RecordBatch.from_arrays(
            [digests.slice(at, len(part)), part.cast(pa.string()), lists.slice(at, len(part))],
            names=["digest", "text", "classes"],
        )
        at += len(part)


def class_counts(
    df: DataFrame, class_col: str, text_col: str = "text", copies: str | None = None
) -> DataFrame:
    """(class, term, tf, f): how often a class has a term, and how often all classes do.

    Rows are counted by text and class, without the text (see :func:`term_lists`).
    """
    return _flat_counts(term_lists(*fold_classes(df, class_col, text_col, copies)), class_col)


def term_lists(held: DataFrame, texts: DataFrame) -> DataFrame:
    """(term, classes, n, f), a row for each term: the classes that have it and how often.

    ``held`` counts the rows of a text and class (digest, class, n), ``texts`` has each
    text once (digest, text); it is split once and meets the list of its classes, at most
    256 in a row. A task leaves one row for each term, with the classes that have it, as often
    as its counters are more than it may hold; these rows are sorted by term and merged.
    What moves grows with the distinct texts, not with the words of all rows. ``f`` is the
    sum over the classes.
    """
    lists = held.groupBy("digest").agg(F.collect_list(F.struct("class", "n")).alias("all"))
    starts = F.sequence(F.lit(1), F.size("all"), F.lit(_CLASSES))
    slices = lists.select("digest", "all", F.explode(starts).alias("at")).select(
        "digest", F.slice("all", F.col("at"), _CLASSES).alias("classes")
    )
    counted = texts.join(slices, "digest").select(topic_words().alias("words"), "classes")
    one, term = F.lit(0).cast("long"), F.lit("").alias("term")
    listed = held.select(term, F.array("class").alias("classes"), F.array(one).alias("n"))
    told = listed.select("*", one.alias("f")).schema

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = (part for batch in batches for part in _counters(batch))
        yield from _gathered(parts, _width, _merged, _HELD, _by_use)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = _merged([batch] if last is None else [last, batch])
            last = whole.slice(whole.num_rows - 1)
            yield _with_sums(whole.slice(0, whole.num_rows - 1))
        if last is not None:
            yield _with_sums(last)

    return (
        counted.mapInArrow(count, listed.schema).repartition("term").sortWithinPartitions("term")
        .mapInArrow(merge, told)
    )


def _flat_counts(lists: DataFrame, class_col: str) -> DataFrame:
    """(class, term, tf, f) of the rows of :func:`term_lists`."""
    each = F.explode(F.arrays_zip("classes", "n")).alias("c")
    return lists.select("term", "f", each).select(
        F.col("c.classes").alias(class_col), "term", F.col("c.n").alias("tf"), "f"
    )


def _listed(
    terms: pa.Array, kinds: pa.Array, cell: np.ndarray, n: np.ndarray
) -> pa.RecordBatch:
    """(term, classes, n), a row for each term, of sorted cells (term's place, class's place)."""
    term, kind = np.divmod(cell, cell.dtype.type(len(kinds)))
    starts = np.flatnonzero(np.diff(term, prepend=cell.dtype.type(-1)))
    cuts = pa.array(np.append(starts, len(cell)).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [
            terms.take(pa.array(term[starts])),
            pa.ListArray.from_arrays(cuts, kinds.take(pa.array(kind))),
            pa.ListArray.from_arrays(cuts, pa.array(n)),
        ],
        names=["term", "classes", "n"],
    )


def _counters(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """(term, classes, n) of rows (words, classes), about ``_TOKENS`` words at a time."""
    ends = np.cumsum(pc.list_value_length(batch.column("words")).to_numpy(), dtype=np.int64)
    cuts = np.flatnonzero(np.diff(ends // _TOKENS)) + 1
    for low, high in pairwise([0, *cuts.tolist(), batch.num_rows]):
        size = high - low
        words, lists = (batch.column(c).slice(low, size) for c in ("words", "classes"))
        terms = pc.dictionary_encode(pc.list_flatten(words))
        owner = pc.list_parent_indices(words).to_numpy()
        held = pc.list_flatten(lists)
        kinds = pc.dictionary_encode(pc.struct_field(held, "class"), null_encoding="encode")
        if not len(owner) or not len(held):
            continue
        # Each term of a text once, with the times it occurs there, in order of the terms.
        cell = terms.indices.to_numpy().astype(np.int64) * size + owner
        cell, times = np.unique(cell, return_counts=True)
        term, row = cell // size, cell % size
        sizes = pc.list_value_length(lists).to_numpy()
        kind = kinds.indices.to_numpy().astype(np.int64)
        n = pc.struct_field(held, "n").to_numpy()
        many = len(kinds.dictionary)
        if many * len(cell) <= _DENSE * sizes[row].sum(dtype=np.int64):
            held_by = np.zeros((size, many), np.int64)
            np.add.at(held_by, (np.repeat(np.arange(size), sizes), kind), n)
            found = _by_matrix(term, row, times, held_by, len(terms.dictionary))
        else:
            found = _by_pairs(term, row, times, sizes, kind, n, many)
        for cells, total in found:
            yield _listed(terms.dictionary, kinds.dictionary, cells, total)


def _by_matrix(term, row, times, held, wide) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sums by cell (term's place, class's place), from how often each row has each class."""
    many = held.shape[1]
    width = min(_WIDE, max(1, _COUNTERS // wide))
    for first in range(0, many, width):
        own = np.ascontiguousarray(held[:, first:first + width])
        total = np.zeros((wide, own.shape[1]), np.int64)
        for low in range(0, len(term), _CELLS):
            part = slice(low, low + _CELLS)
            starts = np.flatnonzero(np.diff(term[part], prepend=-1))
            sums = np.add.reduceat(own[row[part]] * times[part, None], starts, axis=0)
            total[term[part][starts]] += sums
        total = total.ravel()
        at = np.flatnonzero(total)
        place, kind = np.divmod(at, own.shape[1])
        yield place * many + first + kind, total[at]


def _by_pairs(term, row, times, sizes, kind, n, many) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The same sums, from the classes of each row alone, some pairs at a time."""
    begins = np.cumsum(sizes) - sizes
    ends = np.cumsum(sizes[row], dtype=np.int64)
    cuts = np.searchsorted(ends, np.arange(_PAIRS, ends[-1] + _PAIRS, _PAIRS), side="right")
    for low, high in pairwise(np.unique([0, *cuts.tolist(), len(row)]).tolist()):
        own = row[low:high]
        each = sizes[own]
        if not each.any():
            continue
        place = np.arange(each.sum()) + np.repeat(begins[own] - (np.cumsum(each) - each), each)
        cell = np.repeat(term[low:high] * many, each) + kind[place]
        order = np.argsort(cell, kind="stable")
        cell, total = cell[order], (np.repeat(times[low:high], each) * n[place])[order]
        starts = np.flatnonzero(np.diff(cell, prepend=-1))
        yield cell[starts], np.add.reduceat(total, starts)


def _width(part: pa.RecordBatch) -> int:
    """Counters of rows (term, classes, n)."""
    return len(pc.list_flatten(part.column("n")))


def _by_use(part: pa.RecordBatch, most: int) -> list[pa.RecordBatch]:
    """Rows (term, classes, n) of the rarer terms, and of the most frequent, with ``most`` counters at most."""
    sizes = pc.list_value_length(part.column("n")).to_numpy()
    use = np.add.reduceat(pc.list_flatten(part.column("n")).to_numpy(), np.cumsum(sizes) - sizes)
    order = np.argsort(-use, kind="stable")
    fits = np.cumsum(sizes[order], dtype=np.int64) <= most
    return [part.take(pa.array(np.sort(order[which]))) for which in (~fits, fits) if which.any()]


def _merged(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    """One row for each term of rows (term, classes, n)."""
    def flat(name: str) -> pa.Array:
        return pa.concat_arrays([pc.list_flatten(part.column(name)) for part in parts])

    terms = pc.dictionary_encode(pa.concat_arrays([part.column("term") for part in parts]))
    sizes = np.concatenate([pc.list_value_length(part.column("n")).to_numpy() for part in parts])
    kinds = pc.dictionary_encode(flat("classes"), null_encoding="encode")
    many = len(kinds.dictionary)
    # Narrow numbers and few copies: this is the peak of a task's memory.
    kind = np.int32 if len(terms.dictionary) * many < 1 << 31 else np.int64
    cell = np.repeat(terms.indices.to_numpy().astype(kind) * kind(many), sizes)
    cell += kinds.indices.to_numpy()
    terms, kinds = terms.dictionary, kinds.dictionary
    order = np.argsort(cell, kind="stable")
    cell, n = cell[order], flat("n").to_numpy()[order]
    del order
    starts = np.flatnonzero(np.diff(cell, prepend=kind(-1)))
    n, cell = np.add.reduceat(n, starts), cell[starts]
    del starts
    return _listed(terms, kinds, cell, n)


def _with_sums(batch: pa.RecordBatch) -> pa.RecordBatch:
    """(term, classes, n, f) of whole terms."""
    lists = batch.column("n")
    n, owner = pc.list_flatten(lists).to_numpy(), pc.list_parent_indices(lists).to_numpy()
    every = np.zeros(batch.num_rows, np.int64)
    np.add.at(every, owner, n)
    return pa.RecordBatch.from_arrays(
        [*batch.columns, pa.array(every)], names=["term", "classes", "n", "f"]
    )


def class_tfidf(
    df: DataFrame, class_col: str, text_col: str = "text", copies: str | None = None
) -> DataFrame:
    """(class, term, tf, weight) by class-based TF-IDF.

    ``copies`` names a column that counts how many documents a row stands for.

    weight = tf * ln(1 + A / f), where tf counts the term in the class, f counts it
    everywhere and A is the mean number of words in a class. Equal texts are split once
    (see :func:`class_counts`); everything after works on the term counts.
    """
    lists = materialize(term_lists(*fold_classes(df, class_col, text_col, copies)), "tf")
    return _weights(_flat_counts(lists, class_col), class_col, _mean_words(lists))


def _mean_words(lists: DataFrame) -> float:
    """Mean number of words in a class that has any."""
    kinds = lists.select(F.explode("classes")).distinct().count()
    return (lists.agg(F.sum("f")).first()[0] or 0) / max(1, kinds)


def _weights(counts: DataFrame, class_col: str, mean: float) -> DataFrame:
    weight = F.col("tf") * F.log1p(F.lit(mean) / F.col("f"))
    return counts.select(class_col, "term", "tf", weight.alias("weight"))


def heavy_terms(held: DataFrame, texts: DataFrame, class_col: str, k: int) -> DataFrame:
    """The rows of :func:`class_tfidf` that :func:`top_terms` can choose, and few others.

    Tasks leave out the terms that are lighter, by more than the rounding of ties, than
    ``k`` others of their class in the same batch.
    """
    lists = materialize(term_lists(held, texts), "tf")
    mean = _mean_words(lists)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield _heaviest(batch, class_col, mean, k)

    schema = lists.select(F.explode("classes").alias(class_col), "term", F.col("f").alias("tf"), "f").schema
    return _weights(lists.mapInArrow(choose, schema), class_col, mean)


def _heaviest(batch: pa.RecordBatch, class_col: str, mean: float, k: int) -> pa.RecordBatch:
    """(class, term, tf, f) of the ``k`` heaviest terms of each class, near ties included."""
    classes, lists = pc.list_flatten(batch.column("classes")), batch.column("n")
    owner, n = pc.list_parent_indices(lists).to_numpy(), pc.list_flatten(lists).to_numpy()
    f = batch.column("f").to_numpy()[owner]
    weight = n * np.log1p(mean / f)
    kind = pc.dictionary_encode(classes, null_encoding="encode").indices.to_numpy()
    order = np.lexsort((-weight, kind))
    starts = np.flatnonzero(np.diff(kind[order], prepend=-1))
    sizes = np.diff(np.append(starts, len(order)))
    least = weight[order][starts + np.minimum(sizes, k) - 1]
    kept = pa.array(np.sort(order[weight[order] >= np.repeat(least, sizes) - _TIE]))
    return pa.RecordBatch.from_arrays(
        [classes.take(kept), batch.column("term").take(pa.array(owner).take(kept)),
         pa.array(n).take(kept), pa.array(f).take(kept)],
        names=[class_col, "term", "tf", "f"],
    )


def top_terms(weights: DataFrame, class_col: str = "topic", k: int = 10) -> DataFrame:
    """(class, term, weight, place): the ``k`` heaviest terms of each class.

    Weights equal to six places are ties and go by term. Terms are counted by class and
    power of two of their weight first; those under the power that holds the ``k``-th are
    not sorted.
    """
    shown = F.round("weight", 6)
    step = F.when(shown > 0, F.floor(4 * F.log2(shown))).otherwise(-1000)
    steps = weights.groupBy(F.col(class_col).alias("_class"), step.alias("_step")).agg(F.count("*").alias("_n"))
    falling = Window.partitionBy("_class").orderBy(F.desc("_step"))
    above = F.sum("_n").over(falling) - F.col("_n")
    least = (
        steps.withColumn("_above", above).filter(F.col("_above") < k)
        .groupBy("_class").agg(F.min("_step").alias("_least"))
    )
    near = weights.join(least, F.col(class_col).eqNullSafe(F.col("_class"))).filter(step >= F.col("_least"))
    order = Window.partitionBy(class_col).orderBy(shown.desc(), "term")
    placed = near.select(*weights.columns, F.row_number().over(order).alias("place"))
    return placed.filter(F.col("place") <= k)


def topic_terms(weights: DataFrame, class_col: str = "topic", k: int = 10) -> DataFrame:
    """(class, Name, Representation): ``k`` terms, and a name from the first four."""
    ranked = F.array_sort(F.collect_list(F.struct("place", "term")))
    return (
        top_terms(weights, class_col, k)
        .groupBy(class_col)
        .agg(F.transform(ranked, lambda t: t["term"]).alias("Representation"))
        .select(
            class_col,
            F.concat_ws(
                "_", F.col(class_col).cast("string"), F.slice("Representation", 1, 4)
            ).alias("Name"),
            "Representation",
        )
    )


def representative_docs(
    docs: DataFrame, assigned: DataFrame, coords: DataFrame, dims: int = 5, k: int = 3
) -> DataFrame:
    """(topic, Representative_Docs): the ``k`` distinct texts nearest a topic's centre.

    ``docs`` holds distinct texts. Distances are taken in the reduced space, and texts
    are fetched for the few documents that were picked.
    """
    axes = [f"_x{i}" for i in range(dims)]
    weight = F.col("n") if "n" in coords.columns else F.lit(1)
    points = assigned.join(
        coords.select(
            "review_id", weight.alias("_n"),
            *[F.get("coords", F.lit(i)).alias(x) for i, x in enumerate(axes)],
        ),
        "review_id",
    )
    points = materialize(points.select("review_id", "topic", "_n", *axes), "points")
    centres = points.groupBy("topic").agg(
        F.count("*").alias("_rows"),
        *[(F.sum(F.col(x) * F.col("_n")) / F.sum("_n")).alias(f"{x}c") for x in axes],
    )
    centres = materialize(centres, "centres")
    square = reduce(
        lambda a, b: a + b, [(F.col(x) - F.col(f"{x}c")) * (F.col(x) - F.col(f"{x}c")) for x in axes]
    )
    near = lookup_join(points, centres, "topic", "_rows").select(
        "review_id", "topic", F.round(square, 9).alias("gap")
    )
    order = Window.partitionBy("topic").orderBy("gap", "review_id")
    picked = near.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)
    picked = materialize(picked, "picked").withColumn("_one", F.lit(1))
    shown = lookup_join(docs.select("review_id", "text"), picked, "review_id", "_one")
    ranked = F.array_sort(F.collect_list(F.struct("place", "text")))
    return shown.groupBy("topic").agg(
        F.transform(ranked, lambda t: t["text"]).alias("Representative_Docs")
    )


def topic_info(
    documents: DataFrame,
    representatives: DataFrame | None = None,
    terms: int = 10,
    counts: DataFrame | None = None,
) -> DataFrame:
    """The topic table: Topic, Count, Name, Representation, Representative_Docs.

    ``documents`` holds (text, topic), and ``n`` where a row stands for several equal
    texts; the outlier row comes first. ``counts`` (Topic, Count) saves a second reading
    where the sizes are known.
    """
    copies = "n" if "n" in documents.columns else None
    if counts is None:
        counts = topic_counts(documents)
    heavy = heavy_terms(*fold_classes(documents, "topic", copies=copies), "topic", terms)
    return _info(counts, heavy, terms, representatives)


def labelled_info(df: DataFrame, label: str, terms: int = 10) -> DataFrame:
    """:func:`topic_info` of the groups of :func:`relabel`, from counts by text and label."""
    held, texts, counts = fold_labels(df, label)
    return _info(counts, heavy_terms(held, texts, "topic", terms), terms)


def _info(
    counts: DataFrame, weights: DataFrame, terms: int, representatives: DataFrame | None = None
) -> DataFrame:
    named = topic_terms(weights, "topic", terms).withColumnRenamed("topic", "_topic")
    out = counts.join(named, F.col("Topic") == F.col("_topic"), "left").select(
        "Topic",
        "Count",
        F.coalesce("Name", F.col("Topic").cast("string")).alias("Name"),
        F.coalesce("Representation", F.array().cast("array<string>")).alias("Representation"),
    )
    if representatives is not None:
        docs = representatives.withColumnRenamed("topic", "_topic")
        out = out.join(docs, F.col("Topic") == F.col("_topic"), "left").drop("_topic")
    return out.orderBy("Topic")


def topic_counts(documents: DataFrame) -> DataFrame:
    """Documents of each topic; ``n`` counts those a row stands for, if it is there."""
    size = F.sum("n") if "n" in documents.columns else F.count("*")
    return documents.groupBy(F.col("topic").alias("Topic")).agg(size.alias("Count"))


def drop_outliers(info: DataFrame) -> DataFrame:
    """The table without its outlier row."""
    return info.filter(F.col("Topic") != OUTLIER)


def top_topics(info: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` rows by topic number, which is by size."""
    return info.orderBy("Topic").limit(n)


def topic_bars(documents: DataFrame, n: int = 8, terms: int = 5) -> DataFrame:
    """Bar-chart rows (topic, place, term, weight) of the ``n`` largest topics.

    Weights are those of the whole topic set, outliers included.
    """
    return _bars(heavy_terms(*fold_classes(documents, "topic"), "topic", terms), n, terms)


def labelled_bars(df: DataFrame, label: str, n: int = 8, terms: int = 5) -> DataFrame:
    """:func:`topic_bars` of the groups of :func:`relabel`, from counts by text and label."""
    held, texts, _ = fold_labels(df, label)
    return _bars(heavy_terms(held, texts, "topic", terms), n, terms)


def _bars(weights: DataFrame, n: int, terms: int) -> DataFrame:
    ranked = top_terms(weights.filter(F.col("topic").between(0, n - 1)), "topic", terms)
    return ranked.select("topic", "place", "term", "weight")


def fold_texts(docs: DataFrame) -> DataFrame:
    """(review_id, text, n): each text once, up to case and spacing, with its copies.

    The smallest id of a text stands for it. Case and spacing go once for each distinct text.
    """
    exact = docs.groupBy("text").agg(
        F.min("review_id").alias("review_id"), F.count("*").alias("n"),
        F.count_if(F.col("review_id").isNull()).alias("_no_id"),
    )
    smallest = F.when(F.col("_no_id") == 0, F.col("review_id")).alias("review_id")
    first = F.min(F.struct("review_id", "text"))
    return (
        exact.select(smallest, "text", "n")
        .groupBy(F.sha2(normalized("text"), 256).alias("digest"))
        .agg(first.alias("first"), F.sum("n").alias("n"))
        .select("first.review_id", "first.text", "n")
    )


def find_topics(
    df: DataFrame,
    width: float | None = None,
    min_points: int = 2,
    min_topic_size: int = 2,
    dims: int = 5,
) -> DataFrame:
    """The whole topic stage: mismatched reviews in, the topic table out.

    Equal texts are one document with a count from the start, so repeated reviews cost
    nothing and every review is counted once.
    """
    wanted = with_review_id(df).select("review_id", "text", "rating", "sentiment_star")
    docs = materialize(fold_texts(topic_input(materialize(wanted, "documents"))), "folded")
    docs = spread(docs)
    reduced = reduce_dimensions(vectorize(docs), dims)
    coords = materialize(reduced.join(docs.select("review_id", "n"), "review_id"), "coords")
    found = assign_topics(coords, dims, width, min_points, min_topic_size)
    assigned = materialize(found.withColumn("_one", F.lit(1)), "topics")
    shown = representative_docs(docs, assigned.drop("_one"), coords, dims)
    placed = lookup_join(docs, assigned, "review_id", "_one").drop("_one")
    counts = topic_counts(assigned.join(coords.select("review_id", "n"), "review_id"))
    return topic_info(placed, shown, counts=counts)


def embedded_topics(
    vectors: DataFrame,
    id_col: str,
    vector_col: str,
    dims: int = 5,
    width: float | None = None,
    min_points: int = 2,
    min_topic_size: int = 2,
) -> DataFrame:
    """(review_id, topic) from embeddings computed elsewhere."""
    from pyspark.ml.functions import array_to_vector

    ready = vectors.select(
        F.col(id_col).alias("review_id"),
        array_to_vector(F.col(vector_col).cast("array<double>")).alias("vector"),
    )
    coords = materialize(reduce_dimensions(ready, dims), "coords")
    return assign_topics(coords, dims, width, min_points, min_topic_size)
