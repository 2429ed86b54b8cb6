import random

import pytest
from pyspark.sql import functions as F

from starsift.operators import bursts

SCHEMA = "user_id STRING, s BIGINT"


def frame(spark, pairs):
    return spark.createDataFrame(pairs, SCHEMA).withColumn("review_time", F.timestamp_seconds("s"))


def windows_by_hand(pairs, seconds, least):
    out = {}
    for user in {u for u, _ in pairs}:
        times = sorted(t for u, t in pairs if u == user and t is not None)
        held = [(sum(t - seconds <= x <= t for x in times), t) for t in times]
        full = [(c, t) for c, t in held if c >= least]
        if full:
            top = max(c for c, _ in full)
            out[user] = (top, min(t for c, t in full if c == top), len(full))
    return out


def sessions_by_hand(pairs, gap, least):
    out = set()
    for user in {u for u, _ in pairs}:
        runs, last = [], None
        for t in sorted(t for u, t in pairs if u == user and t is not None):
            if last is None or t - last > gap:
                runs.append([])
            runs[-1].append(t)
            last = t
        out |= {(user, r[0], r[-1], len(r)) for r in runs if len(r) >= least}
    return out


@pytest.mark.parametrize("seed", range(4))
def test_windows_and_sessions_equal_brute_force_at_any_period(spark, seed):
    draw = random.Random(seed)
    pairs = [(draw.choice(["a", "a", "b", "c", None]), draw.randrange(-500, 2000)) for _ in range(150)]
    pairs += [("a", 100)] * 3 + [("b", None), ("d", None)]
    df = frame(spark, pairs)
    period = [20, 35, 100, 5000][seed]
    got = bursts.burst_windows(df, 20, 3, period=period)
    found = {r[0]: tuple(r)[1:] for r in got.select(
        "user_id", "peak_count", F.unix_seconds("peak_end"), "burst_ends").collect()}
    assert found == windows_by_hand(pairs, 20, 3)
    runs = bursts.burst_sessions(df, 12, 2, period=period).select(
        "user_id", F.unix_seconds("session_start"), F.unix_seconds("session_end"), "review_count")
    assert sorted(map(repr, (tuple(r) for r in runs.collect()))) == sorted(
        map(repr, sessions_by_hand(pairs, 12, 2)))


def test_a_burst_over_midnight_is_one(spark):
    day = 86_400
    pairs = [("a", day - 60), ("a", day - 30), ("a", day + 30), ("b", 0), ("b", day // 2), ("b", day + 1)]
    df = frame(spark, pairs)
    got = bursts.burst_windows(df, 3600, 3, period=day).collect()
    assert [(r["user_id"], r["peak_count"], r["burst_ends"]) for r in got] == [("a", 3, 1)]
    session = bursts.burst_sessions(df, 3600, 3, period=day).collect()
    assert [(r["user_id"], r["review_count"]) for r in session] == [("a", 3)]


def test_a_period_shorter_than_the_window_is_refused(spark):
    with pytest.raises(ValueError):
        bursts.burst_windows(frame(spark, [("a", 1)]), 100, 3, period=99)


def test_no_rows(spark):
    df = frame(spark, [])
    assert bursts.burst_windows(df).count() == 0
    assert bursts.burst_sessions(df).count() == 0
