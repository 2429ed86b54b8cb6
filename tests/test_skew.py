import random
import re

import pytest
from pyspark.sql import functions as F

from starsift.operators import components, copies, numbering, skew

HOT = "CASE WHEN id % 3 = 0 THEN 0 WHEN id % 11 = 0 THEN NULL ELSE id % 400 END"


@pytest.fixture(params=[3, 500_000], ids=["split", "broadcast"])
def way(request, monkeypatch):
    """Run with lookups too large to broadcast whole, and with none."""
    monkeypatch.setattr(skew, "BROADCAST_ROWS", request.param)
    monkeypatch.setattr(components, "BROADCAST_ROWS", request.param)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_join_equals_a_plain_join(spark, way, how):
    rows = spark.range(6000).select("id", F.expr(HOT).alias("k"))
    table = (
        rows.filter("k < 350").groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("top"))
    )
    got = skew.lookup_join(rows, table, "k", "n", how)
    plain = rows.join(table, "k", how).select("id", "k", "n", "top")
    assert got.columns == ["id", "k", "n", "top"]
    assert got.exceptAll(plain).count() == plain.exceptAll(got).count() == 0


def test_hot_rows_do_not_move_and_the_rest_spreads(spark, monkeypatch):
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 3)
    settings = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
    }
    kept = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        rows = spark.range(9000).select(
            "id", F.expr("CASE WHEN id % 3 = 0 THEN 0 ELSE id % 5000 END").alias("k")
        )
        table = rows.groupBy("k").agg(F.count("*").alias("n"))
        for copies in (1, 8):
            joined = skew.lookup_join(rows, table, "k", "n", copies=copies)
            sizes = joined.groupBy(F.spark_partition_id()).count().collect()
            assert sum(r["count"] for r in sizes) == 9000
            assert max(r["count"] for r in sizes) < 1500
        # A key in a third of the rows that the table hardly knows spreads over copies.
        rare = table.withColumn("n", F.lit(1))
        joined = skew.lookup_join(rows, rare, "k", "n", "left", copies=64)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in sizes) == 9000
        assert max(r["count"] for r in sizes) < 1500
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value)


@pytest.mark.parametrize("limit", [0, 1, 3, 50, 500_000])
def test_what_is_broadcast_is_bounded(spark, monkeypatch, limit):
    monkeypatch.setattr(skew, "BROADCAST_ROWS", limit)
    table = spark.range(1, 200).select(F.col("id").alias("k"), (F.lit(5000) / F.col("id")).cast("int").alias("n"))
    cut = skew._heavy_from(table, "n")
    if limit >= 199:
        assert cut is None
    else:
        heavy = table.filter(F.col("n") >= cut).count()
        assert heavy <= limit
        total = table.agg(F.sum("n")).first()[0]
        rest = table.filter(F.col("n") < cut).agg(F.max("n")).first()[0]
        assert rest <= 2 * total / max(limit, 1)


def test_long_keys_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(skew, "BROADCAST_BYTES", 20_000)
    rows = spark.range(300).select(
        F.concat(F.repeat(F.lit("k"), 1000), (F.col("id") % 100).cast("string")).alias("k"), "id"
    )
    table = rows.groupBy("k").agg(F.count("*").alias("n"))
    assert skew._heavy_from(table, "n") is not None
    got = skew.lookup_join(rows, table, "k", "n")
    assert got.count() == 300 and got.agg(F.sum("n")).first()[0] == 900
    monkeypatch.setattr(skew, "BROADCAST_BYTES", 1 << 20)
    assert skew._heavy_from(table, "n") is None


def brute_components(edges):
    label = {}

    def find(v):
        label.setdefault(v, v)
        while label[v] != v:
            label[v] = label[label[v]]
            v = label[v]
        return v

    for a, b in edges:
        a, b = find(a), find(b)
        label[max(a, b)] = min(a, b)
    return {v: find(v) for v in label}


@pytest.mark.parametrize(
    ("shape", "limit"),
    [("random", 3), ("random", 500_000), ("path", 500_000), ("star", 500_000), ("none", 500_000)],
)
def test_components(spark, monkeypatch, shape, limit):
    monkeypatch.setattr(skew, "BROADCAST_ROWS", limit)
    monkeypatch.setattr(components, "BROADCAST_ROWS", limit)
    rng = random.Random(5)
    edges = {
        "random": [(rng.randrange(300), rng.randrange(300)) for _ in range(180)],
        "path": [(i, i + 1) for i in rng.sample(range(90), 80)],
        "star": [(7, i) for i in range(8, 60)] + [(59, 100), (3, 100)],
        "none": [(4, 4)],
    }[shape]
    edges = [e for e in edges if e[0] != e[1]] or edges
    df = spark.createDataFrame(edges, "a BIGINT, b BIGINT")
    got = {r["vertex"]: r["component"] for r in components.connected_components(df).collect()}
    want = {} if shape == "none" else brute_components(edges)
    assert got == want


def test_numbering_follows_the_global_order(spark):
    df = spark.range(500).select("id", F.pmod(F.xxhash64("id"), F.lit(40)).alias("v")).repartition(5)
    got = numbering.numbered(df, [F.desc("v"), F.asc("id")], "n").orderBy("n").collect()
    assert [r["n"] for r in got] == list(range(500))
    assert [(r["v"], r["id"]) for r in got] == sorted(
        ((r["v"], r["id"]) for r in got), key=lambda t: (-t[0], t[1])
    )


WORDS = [f"w{i}" for i in range(400)]


def texts():
    rng = random.Random(3)
    base = [" ".join(rng.choices(WORDS, k=60)) for _ in range(20)]
    out = list(base)
    out += [base[0]] * 15  # a group of copies that holds a third of the rows
    out += [base[1].upper() + "  "]  # equal but for case and spacing
    out += [base[2] + " extra words at the end", base[2].replace("w1 ", "w2 ")]
    out += ["short", "short", "!!", ""]
    return out


def shingles(text, shingle=5):
    words = [w for w in re.split(r"\W+", text.lower()) if w]
    n = max(1, len(words) - shingle + 1)
    return {tuple(words[k:k + shingle]) for k in range(n)} if words else set()


def alike(one, other):
    return bool(one and other) and len(one & other) >= 0.8 * len(one | other)


def by_hand(rows):
    """Groups of near copies in plain Python, over all pairs."""
    reps = {}
    for i, t in rows:
        reps.setdefault(re.sub(r"\s+", " ", t.lower()).strip(), i)
    sets = {i: shingles(t) for i, t in rows}
    edges = [(i, i) for i in reps.values()]
    edges += [(a, b) for a in reps.values() for b in reps.values() if a < b and alike(sets[a], sets[b])]
    edges += [(reps[re.sub(r"\s+", " ", t.lower()).strip()], i) for i, t in rows]
    return brute_components(edges)


def test_near_copies_equal_brute_force(spark, way):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(3)
    got = {r["doc_id"]: (r["group_id"], r["group_size"]) for r in copies.near_copies(df, "doc_id").collect()}
    want = by_hand(rows)
    sizes = {}
    for root in want.values():
        sizes[root] = sizes.get(root, 0) + 1
    assert got == {v: (root, sizes[root]) for v, root in want.items() if sizes[root] > 1}
    assert got[0] == (0, 16) and got[1] == (1, 2) and got[2][1] >= 2


def family(pick, size=24, shared=80, own=12):
    """Texts of one template, under 0.8 to each other, and one near copy of the last."""
    word = lambda: f"v{pick.randrange(10**6)}"
    template = [word() for _ in range(shared)]
    texts = [template + [word() for _ in range(own)] for _ in range(size)]
    near = list(texts[-1])
    near[-1] = word()
    return [" ".join(t) for t in [*texts, near]]


@pytest.mark.parametrize("block", [256, 5])
def test_near_copies_within_template_families(spark, block, monkeypatch):
    """One pair of each family is alike, and none to the lowest id of what it shares."""
    pick = random.Random(5)
    rows = list(enumerate([t for _ in range(8) for t in family(pick)]))
    sets = {i: shingles(t) for i, t in rows}
    want = {(a, b) for a, x in sets.items() for b, y in sets.items() if b < a and alike(x, y)}
    assert len(want) == 8
    number = {g: n for n, g in enumerate(sorted({g for s in sets.values() for g in s}))}
    frame = spark.createDataFrame(
        [(i, "", [number[g] for g in s]) for i, s in sets.items()],
        "rep long, scope string, grams array<long>",
    )
    got = copies.similar_sets(copies.materialize(frame, "sets"), 0.8, block=block)
    assert {tuple(r) for r in got.collect()} == want


@pytest.mark.parametrize("similarity", [0.5, 0.8])
def test_similar_sets_miss_no_pair(spark, similarity):
    """Random sets with common tokens: what is linked is what all pairs link."""
    pick = random.Random(int(similarity * 10))
    sets = {}
    for i in range(150):
        if i > 20 and pick.random() < 0.6:
            base = list(sets[pick.randrange(i)])
            kept = pick.sample(base, max(1, int(len(base) * pick.uniform(0.6, 1))))
            sets[i] = set(kept) | {pick.randrange(300) for _ in range(pick.randrange(4))}
        else:
            sets[i] = {pick.randrange(60) for _ in range(pick.randrange(1, 25))}
    frame = spark.createDataFrame(
        [(i, "", list(s)) for i, s in sets.items()], "rep long, scope string, grams array<long>"
    )
    got = [tuple(r) for r in copies.similar_sets(
        copies.materialize(frame, "sets"), similarity, block=20).collect()]
    near = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= similarity
    assert all(near(a, b) for a, b in got)
    every = [(i, i) for i in sets]
    pairs = [(a, b) for a in sets for b in sets if b < a and near(a, b)]
    assert brute_components(every + got) == brute_components(every + pairs) and pairs


def test_texts_without_words_are_only_copies(spark):
    rows = [(0, "!!"), (1, "??"), (2, "!!"), (3, "😀"), (4, ""), (5, None)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    got = [tuple(r) for r in copies.near_copies(df, "doc_id").orderBy("doc_id").collect()]
    assert got == [(0, 0, 2), (2, 0, 2)]


def test_near_copies_of_each_group_apart(spark):
    rows = [(i, "same words in each of these texts", "ab"[i % 2]) for i in range(6)] + [(9, "alone", None)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, kind STRING")
    got = {tuple(r) for r in copies.near_copies(df, "doc_id", by=("kind",)).collect()}
    assert got == {("a", i, 0, 3) for i in (0, 2, 4)} | {("b", i, 1, 3) for i in (1, 3, 5)}
