import numpy as np
import pytest

from starsift.llm import metric_join

KIND = "vec_id long, embedding array<double>, label int, id int, links int, cell int"


def brute(rows, cosine=0.98):
    n = len(rows)
    ok = []
    for _, v, lab in rows:
        good = lab is not None and v is not None and all(
            x is not None and np.isfinite(x) for x in v) and any(v)
        ok.append(np.array(v, float) / np.linalg.norm(np.array(v) / max(map(abs, v))) / max(map(abs, v))
                  if good else None)
    links, root = [0] * n, list(range(n))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(n):
        for b in range(a):
            if ok[a] is None or ok[b] is None or rows[a][2] != rows[b][2] or len(ok[a]) != len(ok[b]):
                continue
            if float(ok[a] @ ok[b]) >= cosine:
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    low = {}
    for a in range(n):
        key = rows[a][0]
        r = find(a)
        low[r] = key if low.get(r) is None else low[r] if key is None else min(low[r], key)
    return sorted(((rows[a][0], links[a], low[find(a)],
                    rows[a][0] is not None and rows[a][0] == low[find(a)]) for a in range(n)), key=repr)


def joined(spark, rows, **how):
    frame = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], KIND)
    return sorted((tuple(r) for r in metric_join.near_vectors(frame, **how).collect()), key=repr)


def clustered(seed, n=260, dim=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    rows = [(i, (centres[i % 12] + rng.normal(size=dim) * 0.09).tolist(), int(i % 3 == 0))
            for i in range(n)]
    rows += [(n + i, rows[7][1], rows[7][2]) for i in range(40)]
    rows += [(n + 50 + i, (np.array(rows[7][1]) * (i + 2)).tolist(), rows[7][2]) for i in range(3)]
    return rows


@pytest.mark.parametrize("cell,block", [(2048, 1024), (20, 8), (7, 1000), (60, 3)])
def test_equals_brute_force(spark, cell, block):
    rows = clustered(1)
    got = joined(spark, rows, cell_rows=cell, block_rows=block)
    assert got == brute(rows)
    assert max(r[1] for r in got) >= 42


def test_rows_that_never_link(spark):
    rows = [(1, None, 0), (2, [0.0, 0.0], 0), (3, [0.0, 0.0], 0), (4, [float("nan"), 1.0], 0),
            (5, [None, 1.0], 0), (6, [1.0, 1.0], None), (7, [1.0, 1.0], None), (8, [], 0),
            (9, [1.0, 1.0], 0), (10, [2.0, 2.0], 0), (None, [3.0, 3.0], 0), (10, [1.0, 1.0], 0),
            (11, [1.0, 1.0, 0.0], 0), (12, [float("inf"), 1.0], 0), (13, [1e300, 1e300], 0),
            (14, [1.0, 1.0], 1), (None, None, None)]
    assert joined(spark, rows) == brute(rows)


def test_empty(spark):
    assert joined(spark, [])== []
