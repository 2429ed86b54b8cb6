"""Groups of texts that are near copies of each other."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starsift.functions.text import WORDS, normalized, pieces
from starsift.operators.components import connected_components
from starsift.operators.skew import lookup_join
from starsift.sources.workspace import discard, materialize

# Constants of the hashes of letters, words and shingles, all odd.
_POWER, _STEP, _FIRST, _SECOND = (
    np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
)
_PIECE_BYTES = 1 << 19


def _mixed(x: np.ndarray) -> np.ndarray:
    """64-bit numbers, each bit depending on all bits of those given; no two become one."""
    x = (x ^ (x >> np.uint64(30))) * _FIRST
    x = (x ^ (x >> np.uint64(27))) * _SECOND
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


_LETTER = _mixed(np.arange(1, 257, dtype=np.uint64) * _POWER)
_BACK = np.uint64(pow(int(_POWER), -1, 1 << 64))


def _word_hashes(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of each word of large strings whose words stand between spaces."""
    edges = np.frombuffer(lines.buffers()[1], np.int64)[lines.offset : lines.offset + len(lines) + 1]
    if edges[0] == edges[-1]:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    data = np.frombuffer(lines.buffers()[2], np.uint8)[edges[0] : edges[-1]]
    edges = edges - edges[0]
    inner = data != 32
    # A word begins after a space or where a row does, and ends before either.
    begins, ends = inner.copy(), inner.copy()
    begins[1:] &= ~inner[:-1]
    ends[:-1] &= ~inner[1:]
    cuts = edges[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    begins[cuts] = inner[cuts]
    ends[cuts - 1] = inner[cuts - 1]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LETTER[data] * _powers(_POWER, len(data)), out=total[1:])
    words = _mixed((total[stops] - total[starts]) * _powers(_BACK, len(data))[starts])
    return np.searchsorted(edges, starts, side="right") - 1, words


def shingle_sets(lines: pa.Array, shingle: int) -> pa.Array:
    """Distinct 64-bit hashes of the shingles of large strings, in order.

    Words stand between spaces. A text shorter than one shingle is a single shingle; one
    without words, or null, has none.
    """
    found = [pa.array([], pa.large_list(pa.int64()))]
    for part in pieces(lines, _PIECE_BYTES):
        part = pc.fill_null(part, "")
        row, words = _word_hashes(part)
        counts = np.bincount(row, minlength=len(part))
        first = np.cumsum(counts) - counts
        left = (first + counts)[row] - np.arange(len(words))
        whole = np.flatnonzero((left >= shingle) | (left == counts[row]))
        size = np.minimum(left[whole], shingle)
        hashes = _mixed(words[whole] + size.astype(np.uint64))
        for k in range(1, shingle):
            more = np.flatnonzero(size > k)
            hashes[more] = _mixed(hashes[more] * _STEP + words[whole[more] + k])
        grams, owner = hashes.view(np.int64), row[whole]
        order = np.lexsort((grams, owner))
        grams, owner = grams[order], owner[order]
        new = np.ones(len(grams), bool)
        new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
        ends = np.cumsum(np.bincount(owner[new], minlength=len(part)))
        found.append(
            pa.LargeListArray.from_arrays(pa.array(np.append(0, ends)), pa.array(grams[new]))
        )
    return pa.concat_arrays(found)


def _written(names: Sequence[str]) -> Column:
    """The values of some columns as one text, null told from empty."""
    return F.concat_ws("|", *[F.coalesce(F.concat(F.lit("="), F.col(n).cast("string")), F.lit("-"))
                              for n in names])


def _reachable(n: Column, at: Column, m: Column, met: Column, similarity: float) -> Column:
    """Whether two sets that share a token at these places can be similar enough.

    They have ``n`` and ``m`` tokens and share none before the places ``at`` and ``met``.
    """
    most = F.least(n - at, m - met)
    return (most >= (n + m) * (similarity / (1 + similarity)) - 1e-9) & (
        F.least(n, m) >= F.greatest(n, m) * similarity - 1e-9
    )


def prefixes(sets: DataFrame, similarity: float) -> DataFrame:
    """(token, rep, n, at): the tokens by which similar sets must meet, and their places.

    ``sets`` has (rep, scope, grams); a token is a hash of a scope and a member. Tokens are ordered by how many sets hold them, rarest
    first. Two sets of similarity ``s`` share one of the first ``n - ceil(s * n) + 1``
    tokens of each. Tokens of a single set stand first and meet nothing, so they are
    never ordered: a set that has enough of them is left out at once.
    """
    held = sets.select("rep", "scope", F.size("grams").alias("n"), F.explode("grams").alias("gram")).select(
        "rep", "n", F.xxhash64("scope", "gram").alias("token")
    )
    shared = materialize(
        held.groupBy("token").agg(F.count("*").alias("sets")).filter("sets > 1"), "tokens"
    )
    ordered = lookup_join(held, shared, "token", "sets").groupBy("rep", "n").agg(
        F.array_sort(F.collect_list(F.struct("sets", "token"))).alias("held")
    )
    alone = F.col("n") - F.size("held")
    wide = F.col("n") - F.ceil(F.col("n") * similarity - 1e-9) + 1 - alone
    kept = ordered.select(
        "rep", "n", alone.alias("alone"), "held", wide.cast("int").alias("wide")
    ).filter("wide > 0")
    return kept.select(
        "rep", "n", "alone", F.posexplode(F.slice("held", F.lit(1), F.col("wide"))).alias("i", "t")
    ).select(F.col("t.token").alias("token"), "rep", "n", (F.col("alone") + F.col("i")).alias("at"))


def _with_set(pairs: DataFrame, sets: DataFrame, side: str, name: str) -> DataFrame:
    """Pairs with the set of one side; sides that many pairs have do not gather in one task."""
    uses = pairs.groupBy(side).agg(F.count("*").alias("uses"))
    own = sets.select(F.col("rep").alias(side), F.col("held").alias(name))
    table = materialize(uses.join(own, side), "sides")
    return lookup_join(pairs, table.select(side, name, "uses"), side, "uses").drop("uses")


def _similar(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough, of the same scope."""
    both = _with_set(_with_set(pairs, sets, "a", "one"), sets, "b", "other")
    one, other = F.col("one.grams"), F.col("other.grams")
    common = F.size(F.array_intersect(one, other))
    alike = common >= (F.size(one) + F.size(other) - common) * similarity - 1e-9
    return both.filter((F.col("one.scope") == F.col("other.scope")) & alike).select("a", "b")


def similar_sets(
    sets: DataFrame, similarity: float, max_rounds: int = 60, block: int = 256
) -> DataFrame:
    """(a, b): links that connect all sets of at least this Jaccard similarity.

    ``sets`` is a written table of (rep, scope, grams): distinct tokens, not empty; sets of
    different scopes never link. Sets meet by the tokens of their prefixes. First each set
    is compared with the lowest one of every token it has there; the links connect most
    of what is alike. Of tokens whose sets are still apart, all pairs of two components
    that can be similar by size and by place are compared: the sets are dealt to blocks of
    about ``block``, and pairs of blocks meet in a cell of their own. Links are verified by
    the whole sets. No pair is missed: what is not compared is connected already.
    """
    index = materialize(prefixes(sets, similarity), "prefixes")
    whole = sets.select("rep", F.struct("scope", "grams").alias("held"))
    lists = materialize(
        index.groupBy("token").agg(
            F.min(F.struct("rep", "n", "at")).alias("low"), F.count("*").alias("members")
        ).filter("members > 1"),
        "lists",
    )
    met = lookup_join(index, lists, "token", "members").filter(
        (F.col("rep") != F.col("low.rep"))
        & _reachable(F.col("n"), F.col("at"), F.col("low.n"), F.col("low.at"), similarity)
    )
    stars = materialize(
        met.select(F.col("rep").alias("a"), F.col("low.rep").alias("b")).distinct(), "pairs"
    )
    first = materialize(_similar(stars, whole, similarity), "edges")
    roots = connected_components(first, max_rounds).select(
        F.col("vertex").alias("rep"), "component"
    )
    placed = materialize(
        index.join(roots, "rep", "left").withColumn("root", F.coalesce("component", "rep"))
        .drop("component"),
        "placed",
    )
    apart = materialize(
        placed.groupBy("token").agg(
            F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("members")
        ).filter("low <> high").select("token", "members"),
        "apart",
    )
    if apart.isEmpty():
        return first
    dealt = lookup_join(placed, apart.withColumn("many", F.col("members")), "token", "members")
    cells = (
        dealt.withColumn("blocks", F.ceil(F.col("many") / block).cast("int"))
        .withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
        .withColumn("met", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("token", F.least("own", "met").alias("lo"), F.greatest("own", "met").alias("hi"),
                "own", "rep", "n", "at", "root")
    )
    other = cells.select("token", "lo", "hi", *[
        F.col(c).alias(f"b_{c}") for c in ("own", "rep", "n", "at", "root")
    ])
    pairs = materialize(
        cells.join(other, ["token", "lo", "hi"]).filter(
            (F.col("rep") > F.col("b_rep")) & (F.col("root") != F.col("b_root"))
            & (F.least("own", "b_own") == F.col("lo")) & (F.greatest("own", "b_own") == F.col("hi"))
            & _reachable(F.col("n"), F.col("at"), F.col("b_n"), F.col("b_at"), similarity)
        ).select(F.col("rep").alias("a"), F.col("b_rep").alias("b")).distinct(),
        "pairs",
    )
    rest = materialize(_similar(pairs, whole, similarity), "edges")
    for table in (index, lists, stars, placed, apart, pairs):
        discard(table)
    return first.union(rest)


def near_copies(
    df: DataFrame,
    key: str = "review_id",
    shingle: int = 5,
    similarity: float = 0.8,
    max_rounds: int = 60,
    by: tuple[str, ...] = (),
) -> DataFrame:
    """(by, key, group_id, group_size) for texts that have a copy or near copy.

    Texts equal up to case and spacing are copies, and folded into one. Two texts are near
    copies if their sets of shingles have at least ``similarity``; every such pair counts
    (see :func:`similar_sets`). Groups are what these links connect, within each ``by``,
    and are named by their lowest id. Texts without a word have copies but no near ones.
    ``max_rounds`` bounds the rounds of the components.
    """
    names = [f"_by{i}" for i in range(len(by))]
    marked = df.filter(F.col("text").isNotNull()).select(
        F.col(key).alias("_key"),
        *[F.col(c).alias(n) for c, n in zip(by, names, strict=True)],
        F.sha2(F.concat_ws("|", _written(by), normalized("text")), 256).alias("digest"),
        _written(by).alias("scope"),
        F.regexp_replace(F.lower("text"), WORDS, " ").alias("line"),
    )

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch.column("line").cast(pa.large_string()), shingle)
            columns = [batch.column(c) for c in batch.schema.names if c != "line"]
            yield pa.RecordBatch.from_arrays(
                [*columns, sets.cast(pa.list_(pa.int64()))],
                names=[*(c for c in batch.schema.names if c != "line"), "grams"],
            )

    kind = T.StructType(marked.drop("line").schema.fields).add("grams", T.ArrayType(T.LongType()))
    texts = materialize(
        marked.mapInArrow(shingled, kind).withColumn("_row", F.monotonically_increasing_id()), "texts"
    )
    # Of equal texts the row of the lowest id stands for all; most texts are alone and do not move.
    copied = materialize(
        texts.groupBy("digest").agg(
            F.min(F.struct("_key", "_row")).alias("low"), F.count("*").alias("copies")
        ).filter("copies > 1"),
        "copied",
    )
    folded = materialize(
        lookup_join(texts, copied, "digest", "copies", "left")
        .filter(F.col("low").isNull() | (F.col("low._row") == F.col("_row")))
        .select("digest", F.col("_key").alias("rep"), F.coalesce("copies", F.lit(1)).alias("copies"),
                "scope", "grams"),
        "folded",
    )
    edges = similar_sets(folded.filter(F.size("grams") > 0), similarity, max_rounds)
    linked = connected_components(edges, max_rounds).withColumnRenamed("vertex", "rep")
    grouped = materialize(
        folded.select("digest", "rep", "copies").join(linked, "rep", "left").select(
            "digest", "copies", F.coalesce("component", "rep").alias("group_id")
        ),
        "grouped",
    )
    sizes = grouped.groupBy("group_id").agg(
        F.sum("copies").alias("group_size"), F.count("*").alias("texts")
    )
    wide = materialize(sizes.filter(F.col("group_size") > 1), "wide")
    named = materialize(lookup_join(grouped, wide, "group_id", "texts").drop("texts"), "named")
    out = materialize(
        lookup_join(texts, named, "digest", "copies").select(
            *[F.col(n).alias(c) for c, n in zip(by, names, strict=True)],
            F.col("_key").alias(key), "group_id", "group_size",
        ),
        "near_copies",
    )
    for table in (texts, copied, folded, grouped, wide, named):
        discard(table)
    return out
