"""Toxicity by weak supervision.

Lexicon and pattern voters say "toxic" of a text or nothing. A generative label model
estimates, by expectation maximisation over the votes on all training rows, how often
each voter speaks on toxic and on clean texts, and from the correlations of voters
given the label how much of what each says is its own. Rows with a label, where there
are any, keep it. Its posterior labels train a linear classifier over the terms of a
text, which then scores every text.

The lexicon has a few fixed insults and what labelled texts show: words and beginnings
of words whose texts are toxic far more often than chance explains, given how many
terms there are to choose from. That choice reads at most ``sample`` labelled texts of
either label, those of the smallest id hashes; all else reads all training rows. Rows
of the held-out fold are never read in training. Labels, language, source and id are
no inputs of a score.

Null texts are empty; a text without any term gets the score of such texts. Without
labels the fixed insults decide; without training rows the label model's start does.
Repeated rows count as rows; the label of an id is 1 if any of its labels is. Columns
other than ``doc_id`` and ``text`` (and ``toxic`` of the labels) are ignored, or kept
by :func:`without_toxic`.
"""

from __future__ import annotations

import math
import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starsift.llm.common import held_out, sliced, text_batch
from starsift.sources.workspace import materialize, spread

# Insults that are known without any label.
INSULTS = (
    "clown coward creep disgusting dumb fool freak garbage hideous idiot imbecile jerk "
    "loser lowlife moron pathetic scum stupid trash vermin worthless"
).split()
# How often words of a text must begin with a term, by its mark.
TIMES = {"^": 1, "+": 2, "*": 4}
_SIGNS = string.punctuation + "¡¿«»“”‘’„…–—"
_SHORTEST, _LONGEST = 3, 6
_SINGLE, _SHARED = 40, 8
_MEMO = 100_000


class Lexicon(dict):
    """Term numbers by word.

    A term is a word ("=word") or a beginning that words of the text have once, twice
    or four times ("^begin", "+begin", "*begin"). Looked up with a lower-cased word,
    signs around it included. Forgets everything when it has grown to ``_MEMO`` words.
    """

    def __init__(self, terms: list[str]):
        self.whole = {t[1:]: n for n, t in enumerate(terms) if t[0] == "="}
        self.begin = {t[1:]: i for i, t in enumerate({t[1:]: t for t in terms if t[0] != "="}.values())}
        self.steps: list[list[tuple[int, int]]] = [[] for _ in self.begin]
        for n, t in enumerate(terms):
            if t[0] in TIMES:
                self.steps[self.begin[t[1:]]].append((TIMES[t[0]], n))

    def __missing__(self, word: str) -> tuple[int, ...]:
        """Places of the beginnings of a word; of a whole word its number, negative."""
        if len(self) >= _MEMO:
            self.clear()
        core = word.strip(_SIGNS)
        found = [-1 - self.whole[core]] if core in self.whole else []
        for n in range(_SHORTEST, min(_LONGEST, len(core)) + 1):
            place = self.begin.get(core[:n])
            if place is not None:
                found.append(place)
        self[word] = out = tuple(found)
        return out

    def hits(self, text: str) -> list[int]:
        """Numbers of the terms in a text, in order."""
        counts: dict[int, int] = {}
        for places in map(self.__getitem__, text.lower().split()):
            for p in places:
                counts[p] = counts.get(p, 0) + 1
        found = []
        for place, n in counts.items():
            if place < 0:
                found.append(-1 - place)
            else:
                found += [number for times, number in self.steps[place] if n >= times]
        return sorted(found)


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts of either label each term stands."""
    both = (Counter(), Counter())

    def rows() -> pa.RecordBatch:
        terms = list(both[0] | both[1])
        out = pa.RecordBatch.from_pydict({
            "term": pa.array(terms, pa.string()),
            "clean": pa.array([both[0][t] for t in terms], pa.int64()),
            "toxic": pa.array([both[1][t] for t in terms], pa.int64()),
        })
        both[0].clear()
        both[1].clear()
        return out

    for batch in batches:
        for text, toxic in zip(text_batch(batch.column("text")),
                               batch.column("toxic").to_pylist(), strict=True):
            words, begins = Counter(), Counter()
            for word, n in Counter(text.lower().split()).items():
                words[word.strip(_SIGNS)] += n
            del words[""]
            for word, n in words.items():
                for size in range(_SHORTEST, min(_LONGEST, len(word)) + 1):
                    begins[word[:size]] += n
            both[toxic].update(["=" + w for w in words])
            for mark, times in TIMES.items():
                both[toxic].update([mark + b for b, n in begins.items() if n >= times])
            if len(both[0]) + len(both[1]) > 300_000:
                yield rows()
    if both[0] or both[1]:
        yield rows()


def _labelled(docs: DataFrame, labels: DataFrame, fold: int, sample: int) -> DataFrame:
    """(text, toxic) of at most ``sample`` labelled ids of either label, none held out."""
    known = _labels(labels, fold)
    order = (F.xxhash64("doc_id"), "doc_id")
    picked = known.filter("toxic = 1").orderBy(*order).limit(sample).unionByName(
        known.filter("toxic = 0").orderBy(*order).limit(sample)
    )
    return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("text", "toxic")


def _labels(labels: DataFrame, fold: int) -> DataFrame:
    return (
        labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .filter(~held_out("doc_id", fold))
        .groupBy("doc_id").agg((F.max("toxic") >= 1).cast("int").alias("toxic"))
    )


def learn_lexicon(
    docs: DataFrame, labels: DataFrame, fold: int = 0, sample: int = 20_000,
    max_terms: int = 1024, chance: float = 0.5, loose: float = 50.0,
) -> tuple[list[str], int]:
    """Terms that mark toxic texts, surest first, and how many of them are sure.

    Of all terms of the sample, fewer than ``chance`` would look as telling as a sure
    one if labels were dealt at random, and fewer than ``loose`` as any that is kept.
    """
    rows = materialize(_labelled(docs, labels, fold, sample), "labelled")
    dealt = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = dealt.get(1, 0), dealt.get(0, 0)
    fixed = [f"={w}" for w in INSULTS]
    if not toxic or not clean:
        return fixed, len(fixed)
    counts = spread(rows).mapInArrow(_term_counts, "term string, clean long, toxic long")
    counts = materialize(
        counts.groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")),
        "terms",
    )
    several = F.col("clean") + F.col("toxic") >= 3
    tried = counts.filter(several).count()
    rate = toxic / (toxic + clean)
    # Logarithm of an upper bound of the binomial tail.
    n, k = F.col("clean") + F.col("toxic"), F.col("toxic")
    share = k / n
    gap = F.when(share >= 1, k * F.lit(-math.log(rate))).otherwise(
        n * (share * F.log(share / rate) + (1 - share) * F.log((1 - share) / (1 - rate)))
    )
    told = (
        counts.filter(several & (share > max(0.5, rate)))
        .withColumn("tail", math.log(max(1, tried)) - gap)
        .filter(F.col("tail") < math.log(loose))
        .orderBy("tail", F.length("term").desc(), "term")
        .limit(8 * max_terms)
        .collect()
    )
    kept, held = [], set()
    for r in told:
        # Of nested beginnings in the same number of texts the longest stands for all.
        marks = {(r["term"][1:][:n], r["toxic"], r["clean"]) for n in range(1, len(r["term"]))}
        if (r["term"][1:], r["toxic"], r["clean"]) not in held:
            kept.append(r)
            held |= marks
    sure = [r["term"] for r in kept if r["tail"] < math.log(chance)][:max_terms]
    rest = [r["term"] for r in kept if r["tail"] >= math.log(chance)][: max_terms - len(sure)]
    sure += [t for t in fixed if t not in sure]
    return sure + [t for t in rest if t not in sure], len(sure)


def voter_names(terms: list[str], sure: int) -> list[str]:
    """The voters: the surest terms, groups of the other sure ones, and patterns."""
    single = min(sure, _SINGLE)
    return [
        *terms[:single],
        *[f"group {g}" for g in range(_SHARED if sure > single else 0)],
        "fixed insult", "two terms", "three terms",
    ]


def votes(hits: list[int], sure: int, insults: frozenset[int]) -> int:
    """Votes on a text as bits, from the numbers of its terms."""
    single = min(sure, _SINGLE)
    groups = _SHARED if sure > single else 0
    out, told = 0, 0
    for h in hits:
        if h < single:
            out |= 1 << h
        elif h < sure:
            out |= 1 << (single + (h - single) % groups)
        told += h < sure
    patterns = single + groups
    if any(h in insults for h in hits):
        out |= 1 << patterns
    if told >= 2:
        out |= 1 << (patterns + 1)
    if told >= 3:
        out |= 1 << (patterns + 2)
    return out


@dataclass
class LabelModel:
    """Share of toxic texts and, for each voter, how often it speaks on either kind."""

    prior: float
    on_toxic: np.ndarray
    on_clean: np.ndarray
    own: np.ndarray = field(default=None)

    def __post_init__(self):
        if self.own is None:
            self.own = np.ones(len(self.on_toxic))

    def posterior(self, spoken: np.ndarray) -> np.ndarray:
        """Probability of toxic for rows of votes (0 or 1)."""
        says = np.log(self.on_toxic / self.on_clean) * self.own
        silent = np.log((1 - self.on_toxic) / (1 - self.on_clean)) * self.own
        odds = math.log(self.prior / (1 - self.prior)) + spoken @ says + (1 - spoken) @ silent
        return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def _spoken(masks: np.ndarray, voters: int) -> np.ndarray:
    return (masks[:, None] >> np.arange(voters)[None, :] & 1).astype(np.float64)


def _moments(model: LabelModel, voters: int):
    """Weighted sums of votes by label over a task's rows; one row a task."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = 2 + 2 * voters + 2 * voters * voters
        total = np.zeros(size)
        for batch in batches:
            x = _spoken(batch.column("votes").to_numpy(zero_copy_only=False), voters)
            n, one, zero = (batch.column(c).to_numpy(zero_copy_only=False).astype(float)
                            for c in ("n", "n_toxic", "n_clean"))
            p = model.posterior(x)
            toxic = one + (n - one - zero) * p
            clean = n - toxic
            pairs = [((x * w[:, None]).T @ x).ravel() for w in (toxic, clean)]
            total += np.concatenate(
                [[toxic.sum(), clean.sum()], toxic @ x, clean @ x, *pairs]
            )
        yield pa.RecordBatch.from_pydict({
            "place": pa.array(np.arange(size), pa.int32()), "value": pa.array(total),
        })

    return add


def _summed(patterns: DataFrame, model: LabelModel, voters: int) -> np.ndarray:
    parts = patterns.mapInArrow(_moments(model, voters), "place int, value double")
    out = np.zeros(2 + 2 * voters + 2 * voters * voters)
    for r in parts.groupBy("place").agg(F.sum("value").alias("value")).collect():
        out[r["place"]] = r["value"]
    return out


def fit_label_model(patterns: DataFrame, voters: int, rounds: int = 8) -> LabelModel:
    """Accuracies and correlations of voters from distinct votes and their counts.

    ``patterns`` has (votes, n, n_toxic, n_clean): rows that voted alike, and how many
    of them have either label. What reaches the driver is a number for each voter and
    pair of voters.
    """
    model = LabelModel(0.1, np.full(voters, 0.3), np.full(voters, 0.003))

    for _ in range(rounds):
        sums = _summed(patterns, model, voters)
        toxic, clean = sums[0], sums[1]
        model = LabelModel(
            min(0.95, max(1e-4, (toxic + 0.5) / (toxic + clean + 1))),
            np.clip((sums[2:2 + voters] + 0.3) / (toxic + 1), 1e-6, 0.999),
            np.clip((sums[2 + voters:2 + 2 * voters] + 0.003) / (clean + 1), 1e-7, 0.999),
            _own_share(sums, voters),
        )
    return model


def _own_share(sums: np.ndarray, voters: int) -> np.ndarray:
    """What each voter adds to the others, from its correlations given the label.

    One for a voter that is independent of all others, a half for each of two that
    always agree.
    """
    overlap = np.zeros((voters, voters))
    for label in (0, 1):
        total = max(sums[label], 1)
        rate = np.clip(sums[2 + label * voters:2 + (label + 1) * voters] / total, 1e-9, 1 - 1e-9)
        first = 2 + 2 * voters + label * voters * voters
        joint = sums[first:first + voters * voters].reshape(voters, voters) / total
        deviation = np.sqrt(rate * (1 - rate))
        overlap = np.maximum(
            overlap, (joint - np.outer(rate, rate)) / np.outer(deviation, deviation)
        )
    np.fill_diagonal(overlap, 0)
    return 1 / (1 + np.square(np.clip(overlap, 0, 1)).sum(axis=1))


@dataclass
class ToxicityModel:
    """A lexicon with a weight for each term."""

    terms: list[str]
    weights: list[float]
    bias: float

    def score(self, hits: list[int]) -> float:
        """Probability that a text with these terms is toxic."""
        odds = self.bias + sum(self.weights[h] for h in hits)
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, odds))))


def _hits(terms: list[str], sure: int):
    insults = frozenset(n for n, t in enumerate(terms) if t[0] == "=" and t[1:] in INSULTS)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(terms)
        for batch in batches:
            hits = [lexicon.hits(t) for t in text_batch(batch.column("text"))]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"),
                "hits": pa.array(hits, pa.list_(pa.int32())),
                "votes": pa.array([votes(h, sure, insults) for h in hits], pa.int64()),
            })

    return find


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, fold: int = 0, sample: int = 20_000, max_terms: int = 1024
) -> ToxicityModel:
    """Lexicon, label model and classifier from the rows outside ``fold``."""
    terms, sure = learn_lexicon(docs, labels, fold, sample, max_terms)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text").filter(~held_out("doc_id", fold))
    found = spread(rows).mapInArrow(
        _hits(terms, sure), f"doc_id {kind}, hits array<int>, votes long"
    )
    seen = materialize(
        found.join(_labels(labels, fold), "doc_id", "left").groupBy("hits", "votes").agg(
            F.count("*").alias("n"), F.count_if(F.col("toxic") == 1).alias("n_toxic"),
            F.count_if(F.col("toxic") == 0).alias("n_clean"),
        ),
        "hits",
    )
    patterns = materialize(
        seen.groupBy("votes").agg(*[F.sum(c).alias(c) for c in ("n", "n_toxic", "n_clean")]),
        "votes",
    )
    voters = len(voter_names(terms, sure))
    if patterns.isEmpty():
        model = LabelModel(0.1, np.full(voters, 0.3), np.full(voters, 0.003))
        says = math.log(100.0)
        return ToxicityModel(terms, [says if n < sure else 0.0 for n in range(len(terms))],
                             math.log(model.prior / (1 - model.prior)))
    model = fit_label_model(patterns, voters)
    return _fit_classifier(seen, model, terms, voters)


def _fit_classifier(seen: DataFrame, model: LabelModel, terms: list[str], voters: int):
    """Logistic regression on posterior labels, a text counting for both by their shares."""
    def target(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _spoken(batch.column("votes").to_numpy(zero_copy_only=False), voters)
            n, one, zero = (batch.column(c).to_numpy(zero_copy_only=False).astype(float)
                            for c in ("n", "n_toxic", "n_clean"))
            toxic = one + (n - one - zero) * model.posterior(x)
            yield pa.RecordBatch.from_pydict({
                "hits": batch.column("hits"), "on": pa.array(toxic), "off": pa.array(n - toxic),
            })

    shares = seen.mapInArrow(target, "hits array<int>, on double, off double")
    vectors = CountVectorizerModel.from_vocabulary(
        [str(i) for i in range(len(terms))], inputCol="names", outputCol="features", binary=True
    )
    rows = vectors.transform(
        shares.withColumn("names", F.transform("hits", lambda i: i.cast("string")))
    ).select(
        "features",
        F.explode(F.array(F.struct(F.lit(1.0).alias("label"), F.col("on").alias("weight")),
                          F.struct(F.lit(0.0).alias("label"), F.col("off").alias("weight"))))
        .alias("s"),
    ).select("features", "s.label", "s.weight").filter("weight > 0")
    fit = LogisticRegression(weightCol="weight", regParam=1e-4, maxIter=60, standardization=False)
    found = fit.fit(materialize(rows, "training"))
    return ToxicityModel(terms, found.coefficients.toArray().tolist(), float(found.intercept))


def score_toxicity(docs: DataFrame, model: ToxicityModel, fold: int = 0) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row for each row of ``docs``; map-only."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(model.terms)
        for batch in batches:
            found = [model.score(lexicon.hits(t)) for t in text_batch(batch.column("text"))]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"),
                "score": pa.array(found, pa.float64()),
                "predicted": pa.array([int(s >= 0.5) for s in found], pa.int32()),
            })

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = spread(docs.select("doc_id", "text", held_out("doc_id", fold).alias("held_out")))
    return rows.mapInArrow(
        score, f"doc_id {kind}, held_out boolean, score double, predicted int"
    )


def without_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = 0.5) -> DataFrame:
    """``docs`` without the texts that score ``threshold`` or more."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(model.terms)
        for batch in sliced(batches):
            good = [model.score(lexicon.hits(t)) < threshold
                    for t in text_batch(batch.column("text"))]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
