import math
import random
import string
from datetime import date, datetime
from decimal import Decimal
from itertools import combinations

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starsift.operators import components, skew, topics
from starsift.plans.catalog import QUERIES


def hills_by_hand(points, k, width, min_points, weights=None):
    """Hill climbing over grid cells in plain Python."""
    weights = weights or [1] * len(points)
    size = [
        math.sqrt(
            sum((p[i] - sum(q[i] for q in points) / len(points)) ** 2 for p in points) / len(points)
        )
        for i in range(k)
    ]
    step = [s * width for s in size]
    cell = [tuple(math.floor(p[i] / step[i]) if step[i] else 0 for i in range(k)) for p in points]
    full, first = {}, {}
    for i, c in enumerate(cell):
        full[c] = full.get(c, 0) + weights[i]
        first.setdefault(c, i)

    def up(c):
        near = [c[:i] + (c[i] + d,) + c[i + 1:] for i in range(k) for d in (-1, 1)]
        best = min([(-full[x], first[x], x) for x in near if x in full], default=None)
        return best[2] if best and best[:2] < (-full[c], first[c]) else None

    def top(c):
        while up(c) is not None:
            c = up(c)
        return c

    groups = {}
    for i, c in enumerate(cell):
        groups.setdefault(top(c), []).append(i)
    kept = {t: g for t, g in groups.items() if full[t] >= min_points and sum(weights[i] for i in g) >= 2}
    ordered = sorted(kept.values(), key=lambda g: (-sum(weights[i] for i in g), min(g)))
    found = {i: n for n, g in enumerate(ordered) for i in g}
    return [found.get(i, -1) for i in range(len(points))]


@pytest.mark.parametrize("limit", [3, 500_000], ids=["split", "broadcast"])
@pytest.mark.parametrize("min_points", [2, 4])
def test_assignment_equals_brute_force(spark, monkeypatch, limit, min_points):
    monkeypatch.setattr(skew, "BROADCAST_ROWS", limit)
    monkeypatch.setattr(components, "BROADCAST_ROWS", limit)
    rng = random.Random(11)
    centres = [(0, 0), (6, 1), (2, 7)]
    points = [
        [rng.gauss(c[0], 0.8), rng.gauss(c[1], 0.8)] for c in (centres[i % 3] for i in range(90))
    ]
    points += [[3.0, 3.0]] * 40  # a third of the rows in one cell
    df = spark.createDataFrame(list(enumerate(points)), "review_id BIGINT, coords ARRAY<DOUBLE>")
    got = topics.assign_topics(df.repartition(3), 2, 0.4, min_points)
    found = {r["review_id"]: r["topic"] for r in got.collect()}
    assert [found[i] for i in range(len(points))] == hills_by_hand(points, 2, 0.4, min_points)


def test_points_count_for_all_they_stand_for(spark):
    rng = random.Random(4)
    points = [[rng.gauss(i % 2 * 5, 1.0), rng.gauss(0, 1.0)] for i in range(60)]
    weights = [1 + i % 4 for i in range(60)]
    rows = list(zip(range(60), points, weights, strict=True))
    df = spark.createDataFrame(rows, "review_id BIGINT, coords ARRAY<DOUBLE>, n INT")
    got = {r["review_id"]: r["topic"] for r in topics.assign_topics(df, 2, 0.5).collect()}
    assert [got[i] for i in range(60)] == hills_by_hand(points, 2, 0.5, 2, weights)


def test_more_rows_do_not_melt_topics_together(spark):
    shares = []
    for n in (300, 6000):
        rng = random.Random(n)
        rows = [(i, [rng.gauss(i % 4 * 8, 1.0), rng.gauss(i % 2 * 8, 1.0)]) for i in range(n)]
        df = spark.createDataFrame(rows, "review_id BIGINT, coords ARRAY<DOUBLE>")
        sizes = topics.assign_topics(df, 2).groupBy("topic").count().collect()
        shares.append(max(r["count"] for r in sizes if r["topic"] >= 0) / n)
    assert shares[1] <= max(0.3, shares[0] + 0.05)


def test_repeated_rows_are_counted_once_each(spark, reviews):
    """Rows without an id that repeat share one; their count must not multiply."""
    info = topics.find_topics(reviews.drop("review_id").union(reviews.drop("review_id").limit(7)))
    assert sum(r["Count"] for r in info.collect()) == reviews.count() + 7


def test_small_topics_are_outliers(spark):
    points = [[0.0]] * 5 + [[9.0]] * 2 + [[20.0]]
    df = spark.createDataFrame(list(enumerate(points)), "review_id BIGINT, coords ARRAY<DOUBLE>")
    got = topics.assign_topics(df, 1, 0.5, 2, min_topic_size=3).orderBy("review_id").collect()
    assert [r["topic"] for r in got] == [0] * 5 + [-1] * 3


def test_class_tfidf_formula(spark):
    df = spark.createDataFrame(
        [("x", "aa aa bb c"), ("x", "bb"), ("y", "bb dd"), (None, "dd dd dd")], "k STRING, text STRING"
    )
    got = {(r["k"], r["term"]): r["weight"] for r in topics.class_tfidf(df, "k").collect()}
    mean = 9 / 3  # one-letter words do not count
    assert got["x", "aa"] == pytest.approx(2 * math.log(1 + mean / 2))
    assert got["x", "bb"] == pytest.approx(2 * math.log(1 + mean / 3))
    assert got[None, "dd"] == pytest.approx(3 * math.log(1 + mean / 4))
    assert ("x", "c") not in got
    shuffled = topics.class_tfidf(df.repartition(4), "k")
    assert {(r["k"], r["term"]): pytest.approx(r["weight"]) for r in shuffled.collect()} == got


def test_too_few_documents(spark):
    df = spark.createDataFrame([(i, "t", 5.0, 1) for i in range(4)], "review_id BIGINT, text STRING, rating DOUBLE, sentiment_star INT")
    with pytest.raises(topics.TooFewDocuments, match="found 4"):
        topics.topic_input(df)
    with pytest.raises(topics.TooFewDocuments):
        topics.topic_input(df, min_docs=4, cap=3)


@pytest.fixture(scope="module")
def reviews(spark):
    rng = random.Random(2)
    themes = [
        "shipping box arrived late damaged courier".split(),
        "smell scent perfume strong bottle spray".split(),
        "battery charge power dead cable plug".split(),
    ]
    texts = [" ".join(rng.choices(themes[i % 3], k=14)) for i in range(60)]
    texts += [texts[0]] * 30 + ["zzz qqq xxx"]
    rows = [(i, t, 5.0, 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(
        rows, "review_id BIGINT, text STRING, rating DOUBLE, sentiment_star INT"
    )


def test_topic_table_shape(spark, reviews):
    info = [r.asDict() for r in topics.find_topics(reviews, width=1.0).collect()]
    assert sum(r["Count"] for r in info) == reviews.count()
    known = [r for r in info if r["Topic"] >= 0]
    assert [r["Topic"] for r in known] == list(range(len(known)))
    assert [r["Count"] for r in known] == sorted((r["Count"] for r in known), reverse=True)
    texts = {r["text"] for r in reviews.collect()}
    for r in info:
        assert r["Topic"] >= -1
        assert r["Name"] == "_".join([str(r["Topic"]), *r["Representation"][:4]])
        assert len(r["Representation"]) <= 10
        docs = r["Representative_Docs"]
        assert 1 <= len(docs) <= 3
        assert len(set(docs)) == len(docs)
        assert set(docs) <= texts
    themes = [{"shipping", "courier"}, {"perfume", "scent"}, {"battery", "plug"}]
    for r in known[:3]:
        assert sum(1 for t in themes if t & set(r["Representation"])) == 1


def test_topics_do_not_depend_on_partitioning(spark, reviews):
    one = topics.find_topics(reviews, width=1.0).select("Topic", "Count", "Name").collect()
    two = topics.find_topics(reviews.repartition(7), width=1.0).select("Topic", "Count", "Name").collect()
    assert one == two


def test_relabel_ranks_known_groups(spark):
    df = spark.createDataFrame(
        [(1, "t", "b"), (2, "t", "a"), (3, "t", "b"), (4, "t", None), (5, "t", "c")],
        "review_id BIGINT, text STRING, brand STRING",
    )
    got = topics.relabel(df, "brand").orderBy("review_id").collect()
    assert [r["topic"] for r in got] == [0, 1, 0, -1, 2]


def test_top_topics_and_outliers(spark):
    info = spark.createDataFrame([(i, 9 - i) for i in range(-1, 12)], "Topic INT, Count INT")
    kept = topics.top_topics(topics.drop_outliers(info), 8).collect()
    assert [r["Topic"] for r in kept] == list(range(8))


def test_bars_hold_the_largest_topics(spark):
    df = spark.createDataFrame(
        [(i, f"word{i % 10} common text") for i in range(40)], "review_id BIGINT, text STRING"
    ).withColumn("topic", (F.col("review_id") % 10 - 1).cast("int"))
    bars = topics.topic_bars(df, n=8, terms=1).orderBy("topic").collect()
    assert [(r["topic"], r["place"]) for r in bars] == [(i, 1) for i in range(8)]
    assert [r["term"] for r in bars] == [f"word{i + 1}" for i in range(8)]


def test_embeddings_in_place_of_texts(spark):
    rows = [(i, [float(i % 2), 1.0 - i % 2, 0.01 * (i % 3)]) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<FLOAT>")
    got = {r["review_id"]: r["topic"] for r in topics.embedded_topics(df, "vec_id", "embedding", 2, 1.0).collect()}
    assert len({got[i] for i in range(0, 30, 2)} & {got[i] for i in range(1, 30, 2)} - {-1}) == 0


def test_terms_are_counted_from_each_text_once(spark, monkeypatch):
    """Repeated texts are split once, whatever classes they are in and however batches are cut."""
    monkeypatch.setattr(topics, "_CLASSES", 2)
    split = spark.sparkContext.accumulator(0)

    def words(text="text"):
        @F.udf("array<string>")
        def parts(text):
            split.add(1)
            return [w for w in text.split() if len(w) > 1]

        return parts(F.col(text))

    rows = [("aa bb aa", i % 5 if i % 7 else None) for i in range(60)] + [("bb cc", 1), (None, 2), ("x", 3)]
    df = spark.createDataFrame(rows, "text STRING, k INT").repartition(3)
    want = {}
    for text, k in rows:
        for w in (text or "").split():
            if len(w) > 1:
                want[k, w] = want.get((k, w), 0) + 1
    plain = {(r["k"], r["term"]): r["tf"] for r in topics.class_counts(df, "k").collect()}
    twice = df.withColumn("n", F.lit(2))
    double = {(r["k"], r["term"]): r["tf"] for r in topics.class_counts(twice, "k", copies="n").collect()}
    monkeypatch.setattr(topics, "_CLASSES", 256)
    monkeypatch.setattr(topics, "topic_words", words)
    counted = {(r["k"], r["term"]): r["tf"] for r in topics.class_counts(df, "k").collect()}
    assert plain == want == counted and double == {key: 2 * n for key, n in want.items()}
    assert split.value == 3


@pytest.mark.parametrize("counters, pairs", [(1, 1), (50, 7), (1 << 22, 1 << 20)])
def test_counters_of_a_batch_equal_counting_by_hand(monkeypatch, counters, pairs):
    monkeypatch.setattr(topics, "_COUNTERS", counters)
    monkeypatch.setattr(topics, "_PAIRS", pairs)
    rng = random.Random(5)
    rows, want = [], {}
    for _ in range(40):
        words = [rng.choice("abcdefg") * 2 for _ in range(rng.randrange(12))]
        classes = [{"class": c, "n": rng.randrange(1, 9)} for c in rng.sample([None, *range(8)], rng.randrange(1, 6))]
        rows.append({"words": words, "classes": classes})
        for w in words:
            for c in classes:
                want[c["class"], w] = want.get((c["class"], w), 0) + c["n"]
    kind = pa.schema([("words", pa.list_(pa.string())),
                      ("classes", pa.list_(pa.struct([("class", pa.int32()), ("n", pa.int64())])))])
    got = {}
    for part in topics._counters(pa.RecordBatch.from_pylist(rows, kind)):
        for r in part.to_pylist():
            for c, x in zip(r["classes"], r["n"], strict=True):
                got[c, r["term"]] = got.get((c, r["term"]), 0) + x
    assert got == want


def test_top_terms_equal_a_full_sort(spark):
    rng = random.Random(8)
    rows = [(c, f"t{i}", rng.choice([0.0, 0.3, 1.0, 1.0 + 1e-9, 7.5, rng.random() * 40]))
            for c in (None, 1, 2, 3) for i in range(5 if c == 3 else 200)]
    df = spark.createDataFrame(rows, "topic INT, term STRING, weight DOUBLE")
    got = sorted((repr(r["topic"]), r["place"], r["term"]) for r in topics.top_terms(df, k=30).collect())
    want = []
    for c in (None, 1, 2, 3):
        mine = sorted((r for r in rows if r[0] == c), key=lambda r: (-round(r[2], 6), r[1]))[:30]
        want += [(repr(c), i + 1, r[1]) for i, r in enumerate(mine)]
    assert got == sorted(want)


def test_labelled_info_equals_the_table_of_relabelled_rows(spark):
    rows = [(i % 50 if i % 9 else None, f"{'abcdefghij'[i % 10] * 2} word w{i % 4} w{i % 4}", f"b{i % 6}")
            for i in range(120)]
    rows += [(200, None, "b1"), (201, "aa bb", None), (201, "cc dd", "b0"), (203, "?", "b7")]
    df = spark.createDataFrame(rows, "review_id INT, text STRING, brand STRING").repartition(3)
    want = topics.topic_info(topics.relabel(df, "brand").select("text", "topic"), terms=3).collect()
    assert topics.labelled_info(df, "brand", terms=3).collect() == want
    bars = topics.topic_bars(topics.relabel(df, "brand"), 2, 3)
    got = topics.labelled_bars(df, "brand", 2, 3)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, bars.collect()))


@pytest.fixture(scope="module")
def long_texts(tmp_path_factory, spark):
    """Star-schema tables of 1,500 reviews that share 20 texts of 40,000 random letters."""
    folder = str(tmp_path_factory.mktemp("long"))
    rng = random.Random(6)
    docs = [(i, " ".join("".join(rng.choices(string.ascii_lowercase, k=1999)) for _ in range(20))) for i in range(20)]
    tables = {
        "documents": (docs, "doc_id BIGINT, text STRING"),
        "orders": ([(i, i % 7, "O", datetime(1995, 1, 1), "3-MEDIUM") for i in range(1500)],
                   "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"),
        "lineitem": ([(i, i % 11) for i in range(1500)], "l_orderkey BIGINT, l_partkey BIGINT"),
        "part": ([(i, f"Brand#{i % 4}", "TYPE") for i in range(10)], "p_partkey BIGINT, p_brand STRING, p_type STRING"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("name", ["topic_bars", "topic_info", "top_topics"])
def test_texts_do_not_move_for_each_review(spark, long_texts, name):
    """60 MB of review texts, 0.8 MB of distinct ones, where no table is small enough to broadcast."""
    store = spark.sparkContext._jsc.sc().statusStore()

    def written():
        executors = store.executorList(False)
        return sum(executors.apply(i).totalShuffleWrite() for i in range(executors.size()))

    key = "spark.sql.autoBroadcastJoinThreshold"
    before, least = written(), spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        assert QUERIES[name](spark, long_texts).collect()
    finally:
        spark.conf.set(key, least)
    assert 800_000 < written() - before < 8_000_000


_DAYS = [date(2020, 1, 1 + i) for i in range(5)]


@pytest.mark.parametrize(
    "labels, kind, ids, id_kind",
    [
        (["a", "b", None, "", "é"], "STRING", range(90), "BIGINT"),
        ([1, 2, None, 3, 4], "INT", [f"r{i % 80}" for i in range(90)], "STRING"),
        ([0.0, float("nan"), None, 1.5, 2.0], "DOUBLE", [None if i % 4 else i for i in range(90)], "INT"),
        (_DAYS, "DATE", [Decimal(i) for i in range(90)], "DECIMAL(9,0)"),
        ([True, False, None, True, False], "BOOLEAN", [float(i) for i in range(90)], "DOUBLE"),
        ([("a", 1), ("b", None), None, ("c", 2), ("d", 3)], "STRUCT<x: STRING, y: INT>", range(90), "BIGINT"),
        (["a", "b", None, "c", "d"], "STRING", [datetime(2020, 1, 1, i % 24) for i in range(90)], "TIMESTAMP"),
    ],
)
def test_folded_labels_equal_counting_rows(spark, labels, kind, ids, id_kind):
    texts = ["one two", "three", "", None, "one two", "sech\u00e9", "three"]
    rows = [(texts[i % 7], labels[i % 5 if i % 3 else 1], x) for i, x in enumerate(ids)]
    df = spark.createDataFrame(rows, f"text STRING, label {kind}, review_id {id_kind}").repartition(3)
    folded = topics.fold_rows(df)
    sizes = lambda t, n, first: sorted(
        repr(tuple(r)) for r in t.groupBy("text", "label").agg(F.sum(n), F.min(first)).collect()
    )
    got = folded.select("digest", "text", F.inline("classes"))
    assert sizes(got, "n", "first_id") == sizes(df.withColumn("n", F.lit(1)), "n", "review_id")
    wrong = F.hex("digest").eqNullSafe(F.upper(F.sha2("text", 256)))
    assert folded.filter(~wrong).count() == 0
    _, once, _ = topics.fold_labels(df, "label")
    assert sorted(r["text"] for r in once.collect()) == ["", "one two", "sech\u00e9", "three"]


def test_folding_holds_a_bounded_part(monkeypatch):
    """Parts are passed on when they are large; lists of labels are cut; nothing is lost or doubled."""
    monkeypatch.setattr(topics, "_CLASSES", 2)
    monkeypatch.setattr(topics, "_PIECE", 100)
    rng = random.Random(3)
    rows = [(rng.choice(["a" * 40, "b" * 30, "", None, "c"]), rng.choice([None, 1, 2, 3, 4]), i) for i in range(400)]
    kind = pa.schema([("text", pa.string()), ("label", pa.int32()), ("review_id", pa.int64())])
    names = ["text", "label", "review_id"]
    batches = [pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows[i:i + 50]], kind)
               for i in range(0, 400, 50)]
    want = {}
    for text, label, i in rows:
        n, first = want.get((text, label), (0, i))
        want[text, label] = n + 1, min(first, i)
    for limit in (1, 600, 5000, 1 << 20):
        parts = (topics._folded([topics._unfolded(b)]) for b in batches)
        size = lambda part: part[0].nbytes + part[1].nbytes
        got, passed = {}, 0
        for texts, cells in topics._gathered(parts, size, topics._folded, limit):
            passed += 1
            for out in topics._folded_rows(texts, cells):
                for r in out.to_pylist():
                    assert 1 <= len(r["classes"]) <= 2
                    for c in r["classes"]:
                        n, first = got.get((r["text"], c["label"]), (0, c["first_id"]))
                        got[r["text"], c["label"]] = n + c["n"], min(first, c["first_id"])
        assert got == want
        assert passed == {1: 8, 1 << 20: 1}.get(limit, passed)


@pytest.mark.parametrize("limit", [1, 40, 200, 1 << 20])
def test_counters_of_a_task_are_merged(limit):
    """A term has one row for all batches that fit; frequent terms stay when rarer ones are passed on."""
    rng = random.Random(limit)
    kind = pa.schema([("words", pa.list_(pa.string())),
                      ("classes", pa.list_(pa.struct([("class", pa.int32()), ("n", pa.int64())])))])
    batches, want = [], {}
    for i in range(12):
        rows = []
        for j in range(5):
            words = ["aa", "aa", "bb", f"w{i}", f"w{i}x{j}", rng.choice("cdefgh") * 2]
            classes = [{"class": c, "n": rng.randrange(1, 4)} for c in rng.sample([None, *range(6)], 3)]
            rows.append({"words": words, "classes": classes})
            for w in words:
                for c in classes:
                    want[c["class"], w] = want.get((c["class"], w), 0) + c["n"]
        batches.append(pa.RecordBatch.from_pylist(rows, kind))
    parts = [part for batch in batches for part in topics._counters(batch)]
    got, rows = {}, []
    for out in topics._gathered(iter(parts), topics._width, topics._merged, limit, topics._by_use):
        for r in out.to_pylist():
            rows.append(r["term"])
            for c, n in zip(r["classes"], r["n"], strict=True):
                got[c, r["term"]] = got.get((c, r["term"]), 0) + n
    assert got == want
    if limit == 200:
        assert rows.count("aa") == 1 < rows.count("cc") + rows.count("dd")
    if limit == 1 << 20:
        assert len(rows) == len({w for _, w in want})


def test_heaviest_terms_of_a_batch_keep_all_ties():
    batch = pa.RecordBatch.from_pylist(
        [{"term": t, "classes": [1, None], "n": [n, 1], "f": n + 1} for t, n in zip("abcd", (5, 5, 5, 1), strict=True)],
        pa.schema([("term", pa.string()), ("classes", pa.list_(pa.int32())),
                   ("n", pa.list_(pa.int64())), ("f", pa.int64())]),
    )
    got = topics._heaviest(batch, "k", 8.0, 2).to_pylist()
    assert sorted(r["term"] for r in got if r["k"] == 1) == ["a", "b", "c"]
    assert sorted(r["term"] for r in got if r["k"] is None) == ["a", "b", "c", "d"]


def test_folding_strips_each_distinct_text_once(spark, monkeypatch):
    split = spark.sparkContext.accumulator(0)

    def lowered(text):
        @F.udf("string")
        def once(text):
            split.add(1)
            return " ".join(text.lower().split())

        return once(F.col(text))

    monkeypatch.setattr(topics, "normalized", lowered)
    rows = [(i, "A  b" if i % 2 else "a b") for i in range(3, 43)] + [(None, "c"), (1, "c"), (2, "C")]
    df = spark.createDataFrame(rows, "review_id INT, text STRING").repartition(3)
    got = sorted((r["text"], r["review_id"], r["n"]) for r in topics.fold_texts(df).collect())
    assert got == [("A  b", 3, 40), ("c", None, 3)]
    assert split.value <= 2 * 4
