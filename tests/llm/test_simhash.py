import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from starsift.llm import simhash


def by_hand(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def components(prints, radius=2):
    root = list(range(len(prints)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                root[find(a)] = find(b)
    return [find(a) for a in range(len(prints))]


TEXTS = [
    "", None, "  \t\n", "one", "One", "one two", "ONE two three", "one two three four five six",
    "É one\x0btwo\x1cthree", "a b " * 3000, "no-break space stays", "x" * 70000,
    "Ünï cödé wörds ÀÉ", "one two three four five six seven",
]


@pytest.mark.parametrize("k", [1, 3, 5])
def test_fingerprint(k):
    for t in TEXTS:
        assert simhash.fingerprint(t or "", k) % 2**64 == by_hand(t, k), t


def test_documents_equal_brute_force(docs):
    pick = random.Random(2)
    rows = [(i, " ".join(pick.choice("abcd") for _ in range(pick.randrange(0, 5)))) for i in range(250)]
    rows += [(1000 + i, t) for i, t in enumerate(TEXTS)] + [(None, "one"), (None, "only here"), (3, "q r s t")]
    got = {}
    for r in simhash.near_documents(docs(*rows)).collect():
        got.setdefault((r.doc_id, r.fingerprint), set()).add(r.component_id)
    prints = [by_hand(t, 3) for _, t in rows]
    roots = components(prints)
    low = {}
    for (i, _), r in zip(rows, roots):
        low[r] = i if low.get(r) is None else low[r] if i is None else min(i, low[r])
    want = {}
    for (i, _), p, r in zip(rows, prints, roots):
        want.setdefault((i, f"{p:016x}"), set()).add(low[r])
    assert got == want


@pytest.mark.parametrize("limit,radius", [(512, 2), (3, 2), (1, 1), (2, 0), (512, 1)])
def test_links_connect_what_is_near(spark, limit, radius):
    pick = random.Random(limit)
    centre = [pick.getrandbits(64) for _ in range(8)]
    prints = {0, 2**64 - 1, 2**63, 1}
    for c in centre:
        for _ in range(60):
            p = c
            for _ in range(pick.randrange(4)):
                p ^= 1 << pick.randrange(64)
            prints.add(p)
    prints = sorted(prints)
    frame = spark.createDataFrame([(p - 2**64 if p >= 2**63 else p,) for p in prints], "fp long")
    at = {p: n for n, p in enumerate(prints)}
    root = list(range(len(prints)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in simhash.linked(frame.repartition(3), radius, limit).collect():
        a, b = a % 2**64, b % 2**64
        if limit == 512:
            pass
        root[find(at[a])] = find(at[b])
    got = [find(n) for n in range(len(prints))]
    want = components(prints, radius)
    assert len(set(got)) == len(set(want))
    assert len(set(zip(got, want))) == len(set(want))


def popcounts(plan):
    """How often a plan counts the bits of a half of a fingerprint."""
    return plan.count("& 858993459)")


def test_bits_are_counted_once_for_each_fingerprint(spark, monkeypatch):
    plans = []

    def seen(cells, *rest):
        plans.append(cells._jdf.queryExecution().optimizedPlan().toString())
        return simhash_meet(cells, *rest)

    simhash_meet = simhash._meet
    monkeypatch.setattr(simhash, "_meet", seen)
    frame = spark.createDataFrame([(1,), (None,), (-1,)], "fp long")
    counted = frame.select(simhash.segment_counts(F.col("fp")).alias("point"))
    once = popcounts(counted._jdf.queryExecution().optimizedPlan().toString())
    simhash.linked(frame)
    assert popcounts(plans[0].split("RepartitionByExpression")[-1].partition("\n")[2]) == once
    classes = spark.createDataFrame([(1, [5, -7]), (2, [4, 0]), (3, None), (4, [])], "id long, prints array<long>")
    met = sorted(map(tuple, simhash.half_cells(classes).select("id", "b", "n").distinct().collect()))
    assert (2, 1, 2) in met and {i for i, *_ in met} <= {1, 2}
    assert popcounts(plans[2]) == once


def test_a_fingerprint_and_a_step_cross_the_exchange(spark):
    pick = random.Random(5)
    prints = [0, -1, 1, -(2**63), 2**63 - 1, None, *[pick.getrandbits(64) - 2**63 for _ in range(50)]]
    frame = spark.createDataFrame([(p,) for p in prints], "fp long")
    points = frame.select("fp", simhash.segment_counts(F.col("fp")).alias("point"))
    dealt = simhash._dealt_by_step(points)
    cells = points.select(F.explode(simhash.grid_cells(F.col("point"))).alias("cell"), "fp")
    assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, cells.collect()))
    at = dealt.select("cell", F.spark_partition_id().alias("part")).distinct().groupBy("cell").count()
    assert at.filter("count > 1").count() == 0
    plan = dealt._jdf.queryExecution().optimizedPlan().toString()
    moved = plan[plan.index("RepartitionByExpression"):].split("\n")[1]
    assert re.findall(r"AS (\w+)#", moved) == ["step"] and "point#" not in moved.partition("[")[2].split(",")[0]


def test_one_row_of_each_group_stays(docs):
    same = " ".join(f"w{i}" for i in range(60))
    rows = [(7, same), (4, same), (4, same), (9, same.upper()), (None, same), (1, "other words here"),
            (2, ""), (3, None), (None, "alone without an id at all"), (5, "clean text of its own")]
    frame = docs(*rows)
    out = simhash.without_copies(frame)
    assert out.columns == frame.columns
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)
    assert got == sorted([(4, same), (1, "other words here"), (2, ""), (5, "clean text of its own"),
                          (None, "alone without an id at all")], key=repr)


def jaccard(a, b, k=5):
    def grams(t):
        w = t.split()
        return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))}

    return len(grams(a) & grams(b)) / len(grams(a) | grams(b))


@pytest.mark.parametrize("limit", [512, 4])
def test_near_copies_go_and_the_rest_stays(docs, limit):
    pick = random.Random(8)
    word = lambda: f"w{pick.randrange(4000)}"
    base = [[word() for _ in range(pick.randrange(60, 400))] for _ in range(60)]
    passage = [word() for _ in range(60)]
    rows, near = [], []
    for i, words in enumerate(base):
        rows.append((len(rows), " ".join(words)))
        for changes in (0, 1, 2, 3) if i < 30 else ():
            other = list(words)
            for _ in range(changes):
                other[pick.randrange(len(other))] = word()
            if jaccard(" ".join(words), " ".join(other)) >= 0.85:
                near.append(len(rows))
            rows.append((len(rows), " ".join(other)))
    clean = len(rows)
    rows += [(clean + i, " ".join([word() for _ in range(150)] + passage)) for i in range(20)]
    kept = {r.doc_id for r in simhash.without_copies(docs(*rows), cell_limit=limit).collect()}
    assert len([i for i in near if i not in kept]) >= 0.9 * len(near)
    texts = dict(rows)
    for i in set(texts) - kept:
        assert any(jaccard(texts[i], texts[j]) >= 0.65 for j in texts if j < i), i
    assert set(range(clean, clean + 20)) <= kept


def test_empty(docs):
    none = docs((1, "a")).limit(0)
    assert simhash.near_documents(none).collect() == []
    assert simhash.without_copies(none).collect() == []


@pytest.mark.parametrize("sizes", [(120, 100), (160, 140), (200, 170), (220, 190), (250, 220)])
def test_estimate_is_near_the_similarity_of_unequal_sizes(spark, sizes):
    pick = random.Random(sizes[0])
    pairs = []
    for _ in range(40):
        words = [f"w{pick.randrange(10**6)}" for _ in range(sizes[0] + 4)]
        pairs.append((" ".join(words), " ".join(words[:sizes[1] + 4])))
    rows = [[simhash.signature(t, 5, 3, 128)[1].tolist() for t in p] for p in pairs]
    frame = spark.createDataFrame(rows, "one array<long>, other array<long>")
    found = frame.select("*", simhash.estimated_similarity(frame.one, frame.other, 128).alias("s")).collect()
    want = sizes[1] / sizes[0]
    if sizes[0] < 128:
        assert all(abs(r.s - want) < 1e-9 for r in found)
    assert abs(sum(r.s for r in found) / 40 - want) < 0.02 and all(r.s >= want - 0.13 for r in found)


@pytest.mark.parametrize("limit", [2048, 4])
def test_texts_with_one_dominant_word_stay(docs, limit):
    rows = [(i, " ".join(["0"] * 80 + [f"w{i}x{k}" for k in range(40)])) for i in range(30)]
    assert len({tuple(simhash.signature(t, 5, 3, 128)[0]) for _, t in rows}) == 1
    copies = [(100 + i, t.upper().replace(" ", "\n")) for i, t in rows[:5]]
    kept = simhash.without_copies(docs(*rows, *copies), cell_limit=limit).collect()
    assert sorted(r.doc_id for r in kept) == list(range(30))


def test_near_copies_at_the_threshold_go_and_pairs_under_it_stay(docs):
    pick = random.Random(12)
    rows = []
    for i in range(150):
        words = [f"w{pick.randrange(10**6)}" for _ in range(pick.randrange(80, 400))]
        cut = int((0.82 if i % 2 else 0.78) * len(words))
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words[:cut]))]
    kept = {r.doc_id for r in simhash.without_copies(docs(*rows)).collect()}
    assert set(range(0, 300, 2)) <= kept
    for i in range(150):
        if jaccard(rows[2 * i][1], rows[2 * i + 1][1]) < 0.8:
            assert 2 * i + 1 in kept
    near = [2 * i + 1 for i in range(150) if jaccard(rows[2 * i][1], rows[2 * i + 1][1]) >= 0.8]
    assert len(near) >= 70 and len([i for i in near if i not in kept]) >= 0.97 * len(near)


@pytest.mark.parametrize("limit", [2048, 4])
def test_families_of_one_template(docs, limit):
    """Only the planted pair of each family is near; the lowest of a family is near neither."""
    pick = random.Random(21)
    word = lambda: f"w{pick.randrange(10**6)}"
    rows, planted = [], []
    for _ in range(12):
        template = [word() for _ in range(220)]
        family = []
        for _ in range(12):
            own = list(template)
            for at in pick.sample(range(220), 7):
                own[at] = word()
            family.append(own)
        copy = list(family[-1])
        copy[100] = word()
        planted.append(len(rows) + 12)
        rows += [(len(rows) + k, " ".join(w)) for k, w in enumerate([*family, copy])]
    texts = dict(rows)
    near = {(a, b) for f in range(12) for a in range(13 * f, 13 * f + 13) for b in range(13 * f, a)
            if jaccard(texts[a], texts[b]) >= 0.8}
    assert {a for a, _ in near} == set(planted)
    kept = {r.doc_id for r in simhash.without_copies(docs(*rows), cell_limit=limit).collect()}
    assert set(texts) - kept == set(planted)


@pytest.mark.parametrize("block", [128, 2])
def test_pairs_that_the_lowest_id_does_not_link_are_compared(spark, block):
    """Ten groups in one bucket, whose lowest id is near none of them."""
    pick = random.Random(block)
    rows = [(0, list(range(50)))]
    for group in range(10):
        base = [pick.getrandbits(62) for _ in range(100)]
        rows += [(len(rows) + k, sorted(base[:96] + [pick.getrandbits(62)])) for k in range(3)]
    sets = spark.createDataFrame(rows, "id long, whole array<long>")
    met = spark.createDataFrame([(i, 7, 0, len(rows)) for i, _ in rows], "id long, bucket long, b long, n long")
    judged = spark.createDataFrame([(2, 1)], "a long, b long")
    cells = simhash.open_cells(met, judged, block)
    likely = simhash.likely_cells(cells, sets.withColumnRenamed("whole", "least"), 128, 0.6)
    assert 0 not in {r.id for r in likely.collect()}
    got = {tuple(r) for r in simhash._confirmed(likely, sets, 0.8).collect()}
    root = {i: i for i, _ in rows}
    for a, b in sorted([*got, (2, 1)], key=min):
        old, new = root[a], root[b]
        root = {i: new if r == old else r for i, r in root.items()}
    assert len(set(root.values())) == 11
    assert all(root[1 + 3 * g] == root[2 + 3 * g] == root[3 + 3 * g] for g in range(10))


def test_rows_of_an_open_bucket_of_some_hundred_ids_are_not_multiplied(spark):
    met = spark.createDataFrame([(i, 7, 400) for i in range(400)], "id LONG, bucket LONG, n LONG")
    judged = spark.createDataFrame([(i, 0) for i in range(1, 300)], "a LONG, b LONG")
    assert simhash.open_cells(met, judged).count() == 400
