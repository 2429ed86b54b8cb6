import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from starsift.llm import topk_search

KIND = "vec_id long, embedding array<double>, row int, id string"


def brute(rows, k, scale=64):
    sound = [(n, i, [math.floor(scale * x) for x in v]) for n, (i, v) in enumerate(rows)
             if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, i, v in sound:
        if i is None or i % 20:
            continue
        found = sorted((-sum(a * b for a, b in zip(v, w)), j is None, j or 0)
                       for m, j, w in sound if m != n and len(w) == len(v))
        out += [(i, r + 1, None if none else j, -s)
                for r, (s, none, j) in enumerate(found[:k])]
    return sorted(out, key=repr)


def searched(spark, rows, **how):
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], KIND)
    got = topk_search.top_k_search(frame, F.col("id") % 20 == 0, **how)
    return sorted((tuple(r) for r in got.collect()), key=repr)


@pytest.mark.parametrize("block,query,stripe,step", [(4096, 512, 16, 16), (37, 3, 2, 5), (8, 2, 1, 1)])
def test_equals_brute_force(spark, block, query, stripe, step):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=12).round(2).tolist()) for i in range(300)]
    rows += [(300 + i, rows[40][1]) for i in range(50)]
    rows += [(None, rows[3][1]), (20, [1.0] * 12), (20, [1.0] * 12), (401, None), (402, []),
             (440, []), (403, [float("nan")] * 12), (404, [None] + [1.0] * 11), (460, [1e5] * 12),
             (420, [1.0, 2.0]), (405, [3.0, 4.0]), (406, [float("inf")] * 12), (480, [0.0] * 12)]
    got = searched(spark, rows, k=7, block_rows=block, query_rows=query, stripe_blocks=stripe,
                   step=step)
    assert got == brute(rows, 7)


def test_large_components_are_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.integers(-(10**6), 10**6, 6) * 10.0 + 0.5).tolist()) for i in range(60)]
    assert searched(spark, rows, k=5, block_rows=16) == brute(rows, 5)


def test_fewer_rows_than_k_and_none(spark):
    rows = [(20, [1.0]), (21, [2.0])]
    assert searched(spark, rows) == [(20, 1, 21, 8192)]
    assert searched(spark, [(20, None)]) == []
    assert searched(spark, rows[1:]) == []


def test_ties_at_large_negative_scores(spark):
    """The k-th score is held by id 5; one that equals it in a later block has id 3."""
    rows = [(20, [-1000.0, 1.0]), (5, [1000.0, 0.0]), (7, [2000.0, 0.0]), (8, [2000.5, 0.0]),
            (3, [1000.0, 0.0]), (9, [3000.0, 0.0])]
    got = searched(spark, rows, k=1, scale=1, block_rows=2, step=1)
    assert got == brute(rows, 1, 1) == [(20, 1, 3, -1_000_000)]
