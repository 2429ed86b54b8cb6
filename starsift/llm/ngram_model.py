"""Language-model scoring with a weighted backoff automaton.

The model interpolates n-grams, ``P(w | u) = k * c(u w) / c(u) + (1 - k) * P(w)``, down
to single tokens with half a count added to each, the unknown token among them. As an
automaton: a state for each n-gram that can go on, an arc for each n-gram counted in
training with its log-probability, and from each state a failure arc to the state of
the shorter context with the weight of what its arcs leave. Reading a text takes one
traversal from left to right that carries the state and adds up the weights.

The automaton of a large corpus fits no task, so none holds it. Texts are cut into
blocks of a few megabytes. A block sends the distinct n-grams it holds, with their
training counts, to buckets by the hash of the n-gram; a bucket adds up what all
blocks sent and returns the totals to each of them. A block then has the part of the
automaton that its own texts can reach, whatever the size of the whole, and every
count is that of all training rows. A frequent n-gram costs one entry a block.

Tokens are lower-cased (A-Z) words and one end for each text, empty and null texts
included. N-grams are told apart by 64-bit hashes. Rows with equal or null ids are
rows of their own, a null id is in training. Without training tokens every token is
unknown and counts 1 / 1 of the mass that is left, so its log-probability is that of
``0.5 / 0.5``. Columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starsift.llm.common import held_out, text_batch
from starsift.sources.workspace import materialize, spread

_END, _BEGIN = b" end", b" begin"
_REQUEST = "bucket int, block long, level int, keys binary, counts binary"
_ANSWER = "block long, level int, bucket int, counts binary, distinct long"
_ROOT = 0


def _squeezed(values: np.ndarray) -> bytes:
    """Unsigned numbers as compressed planes of their bytes."""
    values = values.astype("<u8")
    width = max(1, -(-int(values.max(initial=0)).bit_length() // 8))
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, :width].T)
    packed = zstandard.ZstdCompressor(level=1).compress(planes.tobytes())
    return bytes([width]) + len(values).to_bytes(8, "little") + packed


def _restored(raw: bytes) -> np.ndarray:
    width, n = raw[0], int.from_bytes(raw[1:9], "little")
    planes = np.frombuffer(
        zstandard.ZstdDecompressor().decompress(raw[9:], max_output_size=max(1, width * n)),
        np.uint8,
    )
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = planes.reshape(width, n).T
    return out.view("<u8").reshape(n)


def _sorted_bytes(values: np.ndarray) -> bytes:
    """Ascending numbers by their differences."""
    return _squeezed(np.diff(values, prepend=np.uint64(0)))


def _sorted_values(raw: bytes) -> np.ndarray:
    return np.cumsum(_restored(raw), dtype=np.uint64)


def _hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


def _mixed(context: np.ndarray, token: np.ndarray) -> np.ndarray:
    """Hashes of n-grams from those of their context and last token."""
    x = context * np.uint64(0x9E3779B97F4A7C15) + (token ^ (token >> np.uint64(29)))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _blocked(block_chars: int):
    """Blocks of texts as sorted token hashes and the place of each token in them."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        places, ids, rows, size = {_END: 0}, [], [], 0

        def block(doc_type) -> pa.RecordBatch:
            hashes = np.fromiter(map(_hash, places), np.uint64, len(places))
            order = np.argsort(hashes)
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            tokens = rank[np.concatenate(ids)] if ids else np.zeros(0, np.int64)
            return pa.RecordBatch.from_pydict({
                "block": pa.array([(part << 32) + number], pa.int64()),
                "tokens": pa.array([len(tokens)], pa.int64()),
                "training": pa.array([sum(r[2] for r in rows if not r[1])], pa.int64()),
                "doc_ids": pa.array([[r[0] for r in rows]], pa.list_(doc_type)),
                "held": pa.array([[r[1] for r in rows]], pa.list_(pa.bool_())),
                "lengths": pa.array([[r[2] for r in rows]], pa.list_(pa.int64())),
                "vocabulary": pa.array([_sorted_bytes(hashes[order])], pa.binary()),
                "sequence": pa.array([_squeezed(tokens)], pa.binary()),
            })

        for batch in batches:
            doc_type = batch.schema.field("doc_id").type
            for doc, held, text in zip(batch.column("doc_id").to_pylist(),
                                       batch.column("held").to_pylist(),
                                       text_batch(batch.column("text")), strict=True):
                words = text.encode("utf-8").lower().split()
                put = places.setdefault
                ids.append(np.array([put(w, len(places)) for w in words] + [0], np.int32))
                rows.append((doc, held, len(words) + 1))
                size += len(text) + 16
                if size >= block_chars:
                    yield block(doc_type)
                    number, size = number + 1, 0
                    places, ids, rows = {_END: 0}, [], []
        if rows:
            yield block(doc_type)

    return pack


class _Block:
    """The n-grams of one block.

    For each order n up to ``order``: ``codes[n]``, the distinct n-grams in ascending
    order of (context, token); ``which[n]``, for each position of ``at[n]`` the n-gram
    that ends there; ``keys[n]``, their hashes. Order 1 has the begin mark last.
    """

    def __init__(self, vocabulary: np.ndarray, sequence: np.ndarray, lengths: np.ndarray,
                 order: int):
        self.words = len(vocabulary)
        self.sequence = sequence.astype(np.int64)
        self.lengths = lengths
        self.starts = np.cumsum(lengths) - lengths
        self.width = self.words + 1
        place = np.arange(len(sequence)) - np.repeat(self.starts, lengths)
        self.keys = {1: np.concatenate([vocabulary, np.array([_hash(_BEGIN)], np.uint64)])}
        self.at = {1: np.arange(len(sequence))}
        self.which = {1: self.sequence}
        self.codes = {1: np.arange(self.width)}
        last = self.sequence
        for n in range(2, order + 1):
            before = np.roll(last, 1)
            if n == 2:
                before[self.starts] = self.words
                at = self.at[1]
            else:
                at = np.flatnonzero(place >= n - 2)
            context = before[at]
            codes, which = np.unique(context * self.width + self.sequence[at],
                                     return_inverse=True)
            self.codes[n], self.at[n], self.which[n] = codes, at, which
            self.keys[n] = _mixed(self.keys[n - 1][codes // self.width],
                                  self.keys[1][codes % self.width])
            last = np.zeros(len(sequence), np.int64)
            last[at] = which

    def training(self, n: int, trained: np.ndarray) -> np.ndarray:
        """How often each n-gram occurs in training rows of the block."""
        used = np.repeat(trained, self.lengths)[self.at[n]]
        counts = np.bincount(self.which[n][used], minlength=len(self.codes[n]))
        if n == 1:
            counts[-1] = trained.sum()
        return counts


def _unblocked(batch: pa.RecordBatch, k: int, order: int) -> tuple[_Block, np.ndarray]:
    lengths = np.array(batch.column("lengths")[k].as_py(), np.int64)
    held = np.array(batch.column("held")[k].as_py(), bool)
    block = _Block(_sorted_values(batch.column("vocabulary")[k].as_py()),
                   _restored(batch.column("sequence")[k].as_py()), lengths, order)
    return block, ~held


def _buckets(keys: np.ndarray, n: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)


def _asked(order: int, buckets: int):
    """What a block asks of each bucket: sorted n-gram hashes with their own counts."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                block, trained = _unblocked(batch, k, order)
                out = []
                for n in range(1, order + 1):
                    line = np.argsort(block.keys[n])
                    keys, counts = block.keys[n][line], block.training(n, trained)[line]
                    numbers, starts = np.unique(_buckets(keys, buckets), return_index=True)
                    ends = [*starts[1:].tolist(), len(keys)] if len(keys) else []
                    for b, s, e in zip(numbers.tolist(), starts.tolist(), ends, strict=True):
                        out.append((b, n, _sorted_bytes(keys[s:e]), _squeezed(counts[s:e])))
                number = batch.column("block")[k].as_py()
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array([r[0] for r in out], pa.int32()),
                    "block": pa.array([number] * len(out), pa.int64()),
                    "level": pa.array([r[1] for r in out], pa.int32()),
                    "keys": pa.array([r[2] for r in out], pa.binary()),
                    "counts": pa.array([r[3] for r in out], pa.binary()),
                })

    return ask


def _added(table: pa.Table) -> pa.Table:
    """Totals of one bucket and order, for each block that asked; distinct ones counted."""
    blocks = table.column("block").to_pylist()
    level, bucket = table.column("level")[0].as_py(), table.column("bucket")[0].as_py()
    keys = [_sorted_values(r.as_py()) for r in table.column("keys")]
    counts = np.concatenate([_restored(r.as_py()) for r in table.column("counts")])
    every, which = np.unique(np.concatenate(keys), return_inverse=True)
    totals = np.zeros(len(every), np.int64)
    np.add.at(totals, which, counts.astype(np.int64))
    distinct = int(((totals > 0) & (every != np.uint64(_hash(_BEGIN)))).sum())
    ends = np.cumsum([len(k) for k in keys])
    answers = [
        _squeezed(totals[which[e - len(k):e]]) for k, e in zip(keys, ends.tolist(), strict=True)
    ]
    n = len(blocks)
    return pa.table({
        "block": pa.array([*blocks, None], pa.int64()),
        "level": pa.array([level] * (n + 1), pa.int32()),
        "bucket": pa.array([bucket] * (n + 1), pa.int32()),
        "counts": pa.array([*answers, None], pa.binary()),
        "distinct": pa.array([0] * n + [distinct], pa.int64()),
    })


class _Automaton:
    """The states and arcs that one block's texts can reach.

    State 0 is the root. The state of an n-gram is its number in the block's list of
    that order, after the states of lower orders.
    """

    def __init__(self, block: _Block, totals: dict, trained: int, distinct: int,
                 order: int, weight: float):
        self.width = block.width
        half = trained + 0.5 * (distinct + 1)
        self.unigram = np.log10((totals[1] + 0.5) / half)
        first = {n: 1 + sum(len(block.codes[m]) for m in range(1, n)) for n in range(1, order + 1)}
        prob = {1: (totals[1] + 0.5) / half}
        self.arcs: dict[int, int] = {}
        arc_weight, arc_to = [self.unigram], [
            np.where(totals[1] > 0, first[1] + np.arange(block.width), _ROOT)
            if order > 1 else np.zeros(block.width, np.int64)
        ]
        self.fail, back = [np.zeros(1 + block.width, np.int64)], [np.zeros(1)]
        short = prob[1]
        used = len(self.unigram)
        for n in range(2, order + 1):
            context, token = block.codes[n] // self.width, block.codes[n] % self.width
            seen = totals[n - 1]
            lower = short[token] if n == 2 else self._lower(block, prob, n, weight, totals)
            share = totals[n] / np.maximum(seen[context], 1)
            p = np.where(seen[context] > 0, weight * share + (1 - weight) * lower, lower)
            prob[n] = p
            real = np.flatnonzero(totals[n] > 0)
            states = first[n - 1] + context[real]
            self.arcs.update(zip((states * self.width + token[real]).tolist(),
                                 range(used, used + len(real)), strict=True))
            used += len(real)
            arc_weight.append(np.log10(p[real]))
            if n < order:
                arc_to.append(first[n] + real)
            else:
                arc_to.append(self._suffix(block, n, real, first, totals))
            back.append(np.where(seen > 0, np.log10(1 - weight), 0.0))
            if n < order:
                self.fail.append(self._suffix(block, n, np.arange(len(block.codes[n])), first,
                                              totals))
        if order == 1:
            back.append(np.zeros(block.width))
        self.back = np.concatenate(back).tolist()
        self.fail = np.concatenate(self.fail).tolist()
        self.weights = np.concatenate(arc_weight).tolist()
        self.to = np.concatenate(arc_to).tolist()
        self.begin = first[1] + block.words if order > 1 and totals[1][block.words] > 0 else _ROOT

    @staticmethod
    def _shorter(block: _Block, n: int) -> np.ndarray:
        """For each n-gram the (n - 1)-gram without its first token."""
        out = np.zeros(len(block.codes[n]), np.int64)
        last = np.zeros(len(block.sequence), np.int64)
        last[block.at[n - 1]] = block.which[n - 1]
        out[block.which[n]] = last[block.at[n]]
        return out

    def _lower(self, block, prob, n, weight, totals) -> np.ndarray:
        return prob[n - 1][self._shorter(block, n)]

    def _suffix(self, block, n, which, first, totals) -> np.ndarray:
        """The state of the longest counted proper suffix of n-grams."""
        shorter = self._shorter(block, n)[which]
        state, m = np.full(len(which), -1), n - 1
        while m >= 1:
            found = (state < 0) & (totals[m][shorter] > 0)
            state[found] = first[m] + shorter[found]
            if m > 1:
                shorter = self._shorter(block, m)[shorter]
            m -= 1
        return np.where(state < 0, _ROOT, state)

    def score(self, tokens: list[int]) -> float:
        """Log-probability of a text: one traversal from the begin state."""
        arcs, width, weights, to = self.arcs, self.width, self.weights, self.to
        back, fail = self.back, self.fail
        state, total = self.begin, 0.0
        for token in tokens:
            while state:
                arc = arcs.get(state * width + token)
                if arc is not None:
                    break
                total += back[state]
                state = fail[state]
            else:
                arc = token
            total += weights[arc]
            state = to[arc]
        return total


def _scored(order: int, weight: float, trained: int, distinct: int):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                block, in_training = _unblocked(batch, k, order)
                answers = sorted(batch.column("answers")[k].as_py(),
                                 key=lambda a: (a["level"], a["bucket"]))
                totals = {}
                for n in range(1, order + 1):
                    mine = [_restored(a["counts"]) for a in answers if a["level"] == n]
                    line = np.argsort(block.keys[n])
                    totals[n] = np.zeros(len(line), np.int64)
                    if mine:
                        totals[n][line] = np.concatenate(mine).astype(np.int64)
                automaton = _Automaton(block, totals, trained, distinct, order, weight)
                known = totals[1][block.sequence] > 0
                base = automaton.unigram[block.sequence]
                ends = block.starts + block.lengths
                scores = [automaton.score(block.sequence[s:e].tolist())
                          for s, e in zip(block.starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("doc_ids")[k].values,
                    "held_out": pa.array(~in_training),
                    "n_tokens": pa.array(block.lengths, pa.int64()),
                    "n_known": pa.array(np.add.reduceat(known.astype(np.int64), block.starts)),
                    "train_tokens": pa.array([trained] * len(scores), pa.int64()),
                    "base_score": pa.array(np.add.reduceat(base, block.starts)),
                    "score": pa.array(scores, pa.float64()),
                })

    return score


def score_documents(
    docs: DataFrame,
    fold: int = 1,
    order: int = 2,
    weight: float = 0.4,
    block_chars: int = 2_000_000,
    bucket_keys: int = 2_000_000,
) -> DataFrame:
    """Log10 probabilities of all texts under a model of the rows outside ``fold``.

    (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score):
    ``base_score`` is that of single tokens, ``score`` that of the automaton of n-grams
    up to ``order``, each order with ``weight`` against the shorter ones. A block of
    ``block_chars`` characters and a bucket of ``bucket_keys`` n-grams are what a task
    holds at a time.
    """
    if order < 1 or not 0 < weight < 1:
        raise ValueError("order is at least 1 and weight between 0 and 1")
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = spread(docs.select("doc_id", held_out("doc_id", fold).alias("held"), "text"))
    blocks = materialize(
        rows.mapInArrow(
            _blocked(block_chars),
            f"block long, tokens long, training long, doc_ids array<{kind}>, held array<boolean>, "
            "lengths array<long>, vocabulary binary, sequence binary",
        ),
        "blocks",
    )
    size, trained = blocks.agg(
        F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("training"), F.lit(0))
    ).first()
    buckets = max(1, -(-order * size // bucket_keys))
    held = blocks.select("block", "lengths", "held", "vocabulary", "sequence")
    asked = held.mapInArrow(_asked(order, buckets), _REQUEST)
    answers = materialize(
        asked.groupBy("bucket", "level").applyInArrow(_added, _ANSWER), "answers"
    )
    distinct = answers.filter("level = 1").agg(
        F.coalesce(F.sum("distinct"), F.lit(0))
    ).first()[0]
    given = answers.filter(F.col("block").isNotNull()).groupBy("block").agg(
        F.collect_list(F.struct("level", "bucket", "counts")).alias("answers")
    )
    met = blocks.drop("tokens", "training").join(given, "block")
    return met.mapInArrow(
        _scored(order, weight, trained, distinct),
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double",
    )
