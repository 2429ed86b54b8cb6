"""Mixing sources to target weights by exact word budgets.

Every row gets a random key from a hash of its id and text. Within a source, rows in
the order of their keys form one epoch; a source takes as many whole epochs as its
budget holds and then the rows up to the exact word where the budget ends. Keys are
uniform, so equal ranges of them cut a source into buckets of bounded size, and the
prefix sum over a source is one over its buckets plus one within the single bucket
where the budget ends. Texts never move: the plan has one row for each source.

Null sources are a source of their own, last in order. Null texts have no words.
Rows with the same id and the same text cannot be told apart; where the cut falls on
such a group, each of its rows takes an equal whole number of words. Without any word
all targets are 0. Columns other than the named ones are ignored, or kept by
:func:`mixed`, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starsift.llm.common import word_count
from starsift.operators.skew import lookup_join
from starsift.sources.workspace import materialize


def mix_key() -> Column:
    """32 hexadecimal digits, uniform over rows and the same on each run."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.md5(F.concat(key, F.lit(":"), F.coalesce(F.col("text"), F.lit(""))).cast("binary"))


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, group, size, key): a row without its text.

    ``group`` is the source with a mark before it, so that null has a value too.
    """
    return docs.select("doc_id", _group().alias("group"), word_count("text").alias("size"),
                       mix_key().alias("key"))


def _group() -> Column:
    return F.when(F.col("source").isNull(), "1").otherwise(F.concat(F.lit("0"), F.col("source")))


def targets(
    sources: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5,
    epochs: float = 2.0,
) -> DataFrame:
    """(group, rows, source_size, target): words each source is to give.

    ``sources`` has (group, rows, source_size), one row for each source; its windows
    run over those rows only. Weights repeat over the sources in order of their
    names. ``share`` of all words is dealt out by weight, no source above ``epochs``
    times its size; the excess goes to the others by weight. The level that this
    comes to is found at once: sources fill up in order of ``epochs * size / weight``.
    """
    dealt = F.array(*[F.lit(float(w)) for w in weights])
    place = F.row_number().over(Window.orderBy("group")) - 1
    limits = sources.withColumn("_weight", F.get(dealt, place % len(weights))).withColumn(
        "_full", F.col("source_size") * F.lit(float(epochs)) / F.col("_weight")
    )
    order = Window.orderBy("_full", "group")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    budget = F.sum("source_size").over(Window.partitionBy()) * F.lit(float(share))
    taken = F.coalesce(F.sum(F.col("source_size") * F.lit(float(epochs))).over(before), F.lit(0.0))
    levels = limits.withColumn("_level", (budget - taken) / F.sum("_weight").over(after))
    level = F.min_by(
        F.when(F.col("_level") < F.col("_full"), F.col("_level")),
        F.when(F.col("_level") < F.col("_full"), F.col("_full")),
    ).over(Window.partitionBy())
    full = F.col("source_size") * F.lit(float(epochs))
    return levels.select(
        "group", "rows", "source_size",
        F.coalesce(F.least(full, level * F.col("_weight")), full).alias("target"),
    )


def mix_plan(
    rows: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5,
    epochs: float = 2.0, bucket_rows: int = 16384,
) -> DataFrame:
    """One row for each source: its target and where its budget ends.

    ``rows`` is a written :func:`sized` table. ``whole`` epochs are taken in full, then
    rows whose key is below ``cut_key``, and ``cut_words`` words of each row at it.
    """
    sources = rows.groupBy("group").agg(
        F.count("*").alias("rows"), F.sum("size").alias("source_size")
    )
    goal = targets(sources, weights, share, epochs)
    words = F.floor(F.col("target") + 0.5).cast("long")
    size = F.col("source_size")
    goal = materialize(
        goal.withColumn("_buckets", F.ceil(F.col("rows") / bucket_rows).cast("long"))
        .withColumn("whole", F.when(size > 0, F.floor(words / size)).otherwise(0).cast("long"))
        .withColumn("_rest", words - F.col("whole") * size),
        "goals",
    )
    unit = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    placed = lookup_join(rows, goal.select("group", "rows", "_buckets", "_rest"), "group", "rows")
    placed = placed.withColumn("_bucket", F.shiftright(unit * F.col("_buckets"), 32))
    by_bucket = placed.groupBy("group", "_bucket").agg(
        F.sum("size").alias("_words"), F.first("_rest").alias("_rest")
    )
    before = Window.partitionBy("group").orderBy("_bucket")
    starts = by_bucket.withColumn("_start", F.sum("_words").over(before) - F.col("_words"))
    holds = (F.col("_start") <= F.col("_rest")) & (
        F.col("_rest") < F.col("_start") + F.col("_words")
    )
    ends = materialize(
        starts.filter(holds).select("group", F.col("_bucket").alias("_end"), "_start",
                                    F.lit(1).alias("_one")),
        "ends",
    )
    last = lookup_join(placed, ends, "group", "_one").filter("_bucket = _end")
    alike = last.groupBy("group", "key").agg(
        F.count("*").alias("_n"), F.sum("size").alias("_words"),
        F.first("_start").alias("_start"), F.first("_rest").alias("_rest"),
    )
    run = Window.partitionBy("group").orderBy("key")
    first = F.col("_start") + F.sum("_words").over(run) - F.col("_words")
    cut = alike.withColumn("_first", first).filter(
        (F.col("_first") <= F.col("_rest")) & (F.col("_rest") < F.col("_first") + F.col("_words"))
    )
    share_of = F.floor((F.col("_rest") - F.col("_first")) / F.col("_n")).cast("long")
    cuts = cut.select("group", F.col("key").alias("cut_key"), share_of.alias("cut_words"))
    return goal.join(cuts, "group", "left").select(
        "group", "rows", "source_size", "target", "whole",
        F.coalesce("cut_key", F.lit("")).alias("cut_key"),
        F.coalesce("cut_words", F.lit(0).cast("long")).alias("cut_words"),
    )


def taken_words() -> Column:
    """Words a row gives, of a row joined to its source's plan."""
    part = F.when(F.col("key") < F.col("cut_key"), F.col("size")).when(
        F.col("key") == F.col("cut_key"), F.col("cut_words")
    )
    return F.col("whole") * F.col("size") + F.coalesce(part, F.lit(0).cast("long"))


def mix_sources(
    docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5,
    epochs: float = 2.0, bucket_rows: int = 16384,
) -> DataFrame:
    """(doc_id, size, source_size, target, taken): words the mix takes of each row."""
    rows = materialize(sized(docs), "sized")
    plan = materialize(mix_plan(rows, weights, share, epochs, bucket_rows), "mix")
    return lookup_join(rows, plan, "group", "rows").select(
        "doc_id", "size", "source_size", "target", taken_words().alias("taken")
    )


def mixed(
    docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5,
    epochs: float = 2.0, bucket_rows: int = 16384,
) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as the mix takes it.

    A text is never cut: the row where a budget ends is kept once more if at least
    half of its words are within it. A row without words follows its key.
    """
    rows = materialize(sized(docs), "sized")
    plan = materialize(mix_plan(rows, weights, share, epochs, bucket_rows), "mix")
    held = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        _group().alias("group"), word_count("text").alias("size"), mix_key().alias("key"),
    )
    last = (F.col("key") < F.col("cut_key")) | (
        (F.col("key") == F.col("cut_key")) & (2 * F.col("cut_words") >= F.col("size"))
    )
    times = (F.col("whole") + last.cast("long")).cast("int")
    return (
        lookup_join(held, plan, "group", "rows")
        .filter(times > 0)
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), times)))
        .select("_row.*")
    )
