"""Ranked lexical search: summed short lists as one iterator beside long lists.

The documents are indexed in one pass: a task turns some thousand documents into a block,
with a posting list for each term that a query has. Corpus statistics and the weights of
terms come from sums over the blocks. The search reads blocks only, one after the other,
and each query keeps its best k over the blocks of a task.

In a block a query's terms fall in two classes. Short lists are taken term at a time:
their contributions are summed into accumulators, and these, in document order and with
the largest sum of each window of documents, are from then on one bounded iterator. Long
lists have the largest contribution of each window. A window can give at most the sum of
those bounds; windows under the k-th score so far are skipped in all lists at once. What
is left is scored document at a time, in windows of falling bound: long lists in order of
falling bound, and a document leaves as soon as its sum and the bounds of the lists to
come stay under the k-th score. A score equal to the k-th one still counts, as ties go to
the smaller id, so the result is that of scoring everything.

Queries are taken in groups of bounded size, each with its own index, so what reaches a
task does not grow with the queries. Null texts have no terms; a query without terms, or
whose terms no document has, gives no rows. Equal documents are ranked each by itself,
null ids last; rows with equal or null item ids are queries of their own. Other columns
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starsift.llm.common import by_bytes
from starsift.sources.workspace import materialize, spread

# Documents of a window, whose bounds are kept together.
WINDOW = 32
# Occurrences of query terms after which a block is full.
_WORDS = 1 << 21
_NONE = -1
# Stands for a null id; real ids never reach it in practice.
_NO_ID = np.iinfo(np.int64).max
_BLOCK = (
    "docs binary, sizes binary, terms array<int>, lists array<int>, at binary, tf binary, "
    "n long, total long"
)


def _letters() -> bytes:
    """Maps bytes: capital letters to small ones, separators to spaces, others to themselves."""
    keep = {*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)}
    return bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in keep else 32 for b in range(256))


_LETTERS = _letters()


def terms_of(raw: bytes, piece: int = 1 << 20) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text in lists, each from about ``piece`` bytes."""
    low = 0
    while low < len(raw):
        part = raw[low:low + piece].translate(_LETTERS)
        if low + piece < len(raw):
            cut = part.rfind(b" ") + 1
            if not cut:
                # A term longer than a piece: take the text up to its end.
                part = raw[low:].translate(_LETTERS)
                cut = part.find(b" ") + 1 or len(part)
            part = part[:cut]
        low += len(part)
        yield part.split()


def _binary(column) -> list[bytes]:
    return [t if t is not None else b"" for t in column.cast(pa.binary()).to_pylist()]


def _indexed(vocabulary, block_docs: int):
    """Blocks of documents with posting lists for the terms of ``vocabulary``."""

    def block(ids: list, sizes: list[int], parts: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
        where = np.repeat([p[0] for p in parts], [len(p[1]) for p in parts]).astype(np.int64)
        what = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, np.int64)
        keys, tf = np.unique(what * block_docs + where, return_counts=True)
        terms, first = np.unique(keys // block_docs, return_index=True)
        size = np.array(sizes, np.int64)
        return pa.RecordBatch.from_pydict({
            "docs": pa.array([np.array(ids, np.int64).tobytes()], pa.binary()),
            "sizes": pa.array([size.tobytes()], pa.binary()),
            "terms": pa.array([terms.astype(np.int32)], pa.list_(pa.int32())),
            "lists": pa.array([np.diff(np.append(first, len(keys))).astype(np.int32)],
                              pa.list_(pa.int32())),
            "at": pa.array([(keys % block_docs).astype(np.uint16).tobytes()], pa.binary()),
            "tf": pa.array([tf.astype(np.int32).tobytes()], pa.binary()),
            "n": pa.array([len(size)], pa.int64()),
            "total": pa.array([int(size.sum())], pa.int64()),
        })

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value.get
        ids, sizes, parts, held_words = [], [], [], 0
        for batch in by_bytes(batches, "text"):
            held = batch.column("doc_id").cast(pa.int64()).to_pylist()
            for doc, raw in zip(held, _binary(batch.column("text")), strict=True):
                size = 0
                for words in terms_of(raw):
                    size += len(words)
                    found = np.fromiter(map(number, words, repeat(_NONE)), np.int32, len(words))
                    found = found[found >= 0].astype(np.int64)
                    if len(found):
                        parts.append((len(ids), found))
                        held_words += len(found)
                if size:
                    ids.append(doc if doc is not None else _NO_ID)
                    sizes.append(size)
                if len(ids) == block_docs or held_words >= _WORDS:
                    yield block(ids, sizes, parts)
                    ids, sizes, parts, held_words = [], [], [], 0
        if ids:
            yield block(ids, sizes, parts)

    return index


class _Best:
    """The best k documents of one query so far."""

    def __init__(self, k: int):
        self.k = k
        self.score = np.zeros(0, np.int64)
        self.doc = np.zeros(0, np.int64)

    @property
    def floor(self) -> int:
        """A score below this one is not wanted."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def take(self, score: np.ndarray, doc: np.ndarray) -> None:
        score = np.concatenate([self.score, score])
        doc = np.concatenate([self.doc, doc])
        order = np.lexsort((doc, -score))[:self.k]
        self.score, self.doc = score[order], doc[order]


class _Lists:
    """The posting lists of a block, with the contribution of each posting."""

    def __init__(self, row: dict, corpus: tuple[int, int]):
        docs, total = corpus
        self.docs = np.frombuffer(row["docs"], np.int64)
        size = np.frombuffer(row["sizes"], np.int64)
        length = 75 + 25 * size * docs // total
        self.at = np.frombuffer(row["at"], np.uint16)
        tf = np.frombuffer(row["tf"], np.int32).astype(np.int64)
        self.worth = 1_000_000_000 * tf // (1000 * tf + 12 * length[self.at])
        ends = np.cumsum(row["lists"]).tolist()
        starts = [0, *ends][:-1]
        self.place = dict(zip(row["terms"], zip(starts, ends, strict=True), strict=True))
        self.windows = -(-len(self.docs) // WINDOW)
        self.bounds: dict[int, np.ndarray] = {}

    def bound(self, term: int) -> np.ndarray:
        """The largest contribution in each window."""
        held = self.bounds.get(term)
        if held is None:
            low, high = self.place[term]
            held = np.zeros(self.windows, np.int64)
            np.maximum.at(held, self.at[low:high] // WINDOW, self.worth[low:high])
            self.bounds[term] = held
        return held

    def search(self, query: list[tuple[int, int]], best: _Best, short: float) -> int:
        """Take the block's documents in for (term, weight) pairs; how many were scored."""
        lists = [(self.place[t][1] - self.place[t][0], t, w) for t, w in query if t in self.place]
        if not lists:
            return 0
        lists.sort()
        n = len(self.docs)
        # Short lists, as many as hold no more postings than a share of the block together.
        held = np.cumsum([many for many, _, _ in lists])
        few = max(1, int(np.searchsorted(held, short * n, side="right")))
        sums = np.zeros(n, np.int64)
        for _, term, weight in lists[:few]:
            low, high = self.place[term]
            sums[self.at[low:high]] += weight * self.worth[low:high]
        edges = np.arange(0, n, WINDOW)
        limit = np.maximum.reduceat(sums, edges)
        long = sorted(
            ((weight * self.bound(term), term, weight) for _, term, weight in lists[few:]),
            key=lambda x: -int(x[0].max()),
        )
        for bound, _, _ in long:
            limit = limit + bound
        order = np.argsort(-limit, kind="stable")
        scored = 0
        # Few windows first, to raise the k-th score, then more at a time.
        low, step = 0, 4
        while low < len(order):
            part = order[low:low + step]
            part = part[limit[part] >= best.floor]
            if not len(part):
                break
            scored += self._score(np.sort(part), sums, long, best)
            low, step = low + step, step * 2
        return scored

    def _score(self, windows, sums, long, best: _Best) -> int:
        """Score the documents of some windows, dropping those that cannot reach the floor."""
        docs = (windows[:, None] * WINDOW + np.arange(WINDOW)).ravel()
        docs = docs[docs < len(self.docs)]
        score = sums[docs]
        rest = np.zeros(len(docs), np.int64)
        for bound, _, _ in long:
            rest += bound[docs // WINDOW]
        floor, scored = best.floor, len(docs)
        for bound, term, weight in long:
            alive = score + rest >= floor
            if not alive.all():
                docs, score, rest = docs[alive], score[alive], rest[alive]
            if not len(docs):
                return scored
            low, high = self.place[term]
            at = self.at[low:high]
            found = np.searchsorted(at, docs)
            hit = at[np.minimum(found, len(at) - 1)] == docs
            score = score + np.where(hit, weight * self.worth[low + np.minimum(found, len(at) - 1)], 0)
            rest = rest - bound[docs // WINDOW]
        alive = score >= floor
        if alive.any():
            best.take(score[alive], self.docs[docs[alive]])
        return scored


def _searched(queries, corpus: tuple[int, int], k: int, short: float):
    """The best k of each query over the blocks of a task."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [_Best(k) for _ in queries.value]
        for batch in batches:
            for i in range(batch.num_rows):
                lists = _Lists(batch.slice(i, 1).to_pylist()[0], corpus)
                for query, mine in zip(queries.value, best, strict=True):
                    lists.search(query, mine, short)
        doc = np.concatenate([b.doc for b in best] or [np.zeros(0, np.int64)])
        yield pa.RecordBatch.from_pydict({
            "query": pa.array(
                np.repeat(np.arange(len(best)), [len(b.doc) for b in best]), pa.int32()
            ),
            "doc_id": pa.array(doc, pa.int64(), mask=doc == _NO_ID),
            "score": pa.array(np.concatenate(
                [b.score for b in best] or [np.zeros(0, np.int64)]), pa.int64()),
        })

    return search


def _searched_group(
    docs: DataFrame, items: list[tuple], k: int, block_docs: int, short: float
) -> DataFrame:
    """(item_id, rank, doc_id, score) of some queries (item_id, terms with their counts)."""
    context = docs.sparkSession.sparkContext
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, own in items for t in own}))}
    numbers = context.broadcast(vocabulary)
    blocks = materialize(docs.mapInArrow(_indexed(numbers, block_docs), _BLOCK), "blocks")
    corpus = tuple(blocks.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))
    ).first())
    listed = blocks.select(F.explode(F.arrays_zip("terms", "lists")).alias("t"))
    held = listed.groupBy(F.col("t.terms").alias("term")).agg(F.sum("t.lists").alias("df"))
    # One row for each term of the queries of this group.
    weight = {
        r["term"]: math.floor(1000 * math.log((2 * corpus[0] + 2) / (2 * r["df"] + 1)))
        for r in held.collect()
    }
    asked = [
        [(vocabulary[t], n * weight[vocabulary[t]]) for t, n in own.items()
         if weight.get(vocabulary[t])]
        for _, own in items
    ]
    found = blocks.mapInArrow(
        _searched(context.broadcast(asked), corpus, k, short), "query int, doc_id long, score long"
    )
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    names = docs.sparkSession.createDataFrame(
        [(i, item) for i, (item, _) in enumerate(items)], "query int, item_id long"
    )
    return ranked.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score")


def lexical_search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 20,
    group_bytes: int = 1 << 20,
    group_items: int = 2000,
    block_docs: int = 4096,
    short: float = 0.25,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents with the highest score of each item.

    ``docs`` has (doc_id, text), ``items`` (item_id, text). Queries are read one after the
    other on the driver, and searched in groups of at most ``group_items`` and about
    ``group_bytes`` of text. Lists are short as long as they hold no more than ``short``
    times as many postings together as the block has documents.
    """
    if not 0 < block_docs <= 1 << 16:
        raise ValueError("block_docs must be from 1 to 65536")
    rows = spread(docs.select("doc_id", "text"))
    parts, group, size = [], [], 0

    def close() -> None:
        nonlocal group, size
        if group:
            parts.append(_searched_group(rows, group, k, block_docs, short))
        group, size = [], 0

    for item in items.select("item_id", "text").toLocalIterator():
        raw = (item["text"] or "").encode("utf-8")
        own: dict[bytes, int] = {}
        for words in terms_of(raw):
            for word in words:
                own[word] = own.get(word, 0) + 1
        if own:
            group.append((item["item_id"], own))
            size += len(raw)
        if len(group) == group_items or size >= group_bytes:
            close()
    close()
    if not parts:
        return docs.sparkSession.createDataFrame(
            [], "item_id long, rank int, doc_id long, score long"
        )
    return reduce(DataFrame.unionByName, parts)
