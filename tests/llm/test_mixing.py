import math
import random
from collections import defaultdict

from starsift.llm import mixing


def water(sizes, weights, share=1.5, epochs=2.0):
    """Targets by resharing until none is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left = {}, set(names)
    budget = share * sum(sizes.values())
    while left:
        level = budget / sum(weight[s] for s in left)
        over = {s for s in left if level * weight[s] >= epochs * sizes[s]}
        if not over:
            target |= {s: level * weight[s] for s in left}
            break
        target |= {s: epochs * sizes[s] for s in over}
        budget -= sum(epochs * sizes[s] for s in over)
        left -= over
    return target


def sample(n, seed=1):
    pick = random.Random(seed)
    rows = [(i, " ".join(["w"] * pick.randrange(0, 40)), pick.choice(["a", "a", "a", "b", None, "é"]))
            for i in range(n)]
    return rows + [(n, None, "b"), (n + 1, "", "a"), (None, "x y", "z"), (9005, "dup dup dup", "a"),
                   (9005, "dup dup dup", "a"), (n + 2, "long " * 5000, "b")]


def test_targets_and_budgets(docs):
    rows = sample(400)
    out = mixing.mix_sources(docs(*rows), bucket_rows=16).collect()
    assert len(out) == len(rows)
    size = defaultdict(int)
    by_id = {}
    for i, t, s in rows:
        size[s] += len((t or "").split())
        by_id[i] = s
    want = water(dict(size), (5, 2, 1))
    taken = defaultdict(int)
    for r in out:
        s = by_id[r.doc_id]
        assert math.isclose(r.target, want[s]) and r.source_size == size[s]
        assert 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    for s, goal in want.items():
        assert abs(taken[s] - goal) <= 2, s


def test_rerun_and_buckets_agree(docs):
    rows = docs(*sample(300))
    runs = [sorted(map(repr, mixing.mix_sources(rows.repartition(p), bucket_rows=b).collect()))
            for p, b in ((1, 16), (7, 16), (3, 100000))]
    assert runs[0] == runs[1] == runs[2]


def test_mixed_repeats_whole_rows(docs):
    rows = sample(400)
    frame = docs(*rows)
    out = mixing.mixed(frame, bucket_rows=16)
    assert out.columns == frame.columns
    size, got = defaultdict(int), defaultdict(int)
    for _, t, s in rows:
        size[s] += len((t or "").split())
    for r in out.collect():
        got[r.source] += len((r.text or "").split())
    want = water(dict(size), (5, 2, 1))
    for s, goal in want.items():
        assert abs(got[s] - goal) <= (2600 if s == "b" else 25)


def test_empty_table_and_no_words(docs):
    assert mixing.mix_sources(docs((1, "a")).limit(0)).collect() == []
    assert mixing.mixed(docs((1, "a")).limit(0)).collect() == []
    out = mixing.mix_sources(docs((1, ""), (2, None, "t"))).collect()
    assert [(r.target, r.taken) for r in out] == [(0.0, 0), (0.0, 0)]
