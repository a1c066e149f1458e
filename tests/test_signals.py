from __future__ import annotations

import random
import statistics
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventflow.operators import signals
from eventflow.operators.joins import lookup
from eventflow.operators import greedy as greedy_pass
from eventflow.operators.rate_limit import rate_limit, rate_limit_tumbling

T0 = datetime(2024, 1, 1)


def prices(rows, n=300, seed=1):
    """One symbol with two thirds of the quotes, bursts, gaps, equal times and copies."""
    rng = random.Random(seed)
    data, at = [], T0
    for _ in range(n):
        at += timedelta(seconds=rng.choice([0, 0, 1, 60, 400, 4000]))
        quote = (rng.choice(["a", "a", "b"]), at, rng.choice([0.0, 100.0, 1e5 + rng.random()]))
        data += [quote] * rng.choice([1, 1, 3])
    return data, rows(data, "symbol STRING, ts TIMESTAMP, price DOUBLE")


def frame(data, symbol, ts, hour=3600):
    return [(t, p) for s, t, p in data if s == symbol and ts - timedelta(seconds=hour) <= t <= ts]


def test_price_change(rows):
    data, df = prices(rows)
    out = signals.price_change(df).collect()
    assert len(out) == len(set(data)) and sum(r.copies for r in out) == len(data)
    for r in out:
        base = min(frame(data, r.symbol, r.ts))[1]
        assert r.base_price == base
        assert r.change_percent == (pytest.approx((r.price - base) / base * 100) if base else None)


def test_volatility(rows):
    data, df = prices(rows, 400, 2)
    out = signals.volatility(df).collect()
    assert {(r.symbol, r.ts) for r in out} == {(s, t) for s, t, _ in data}
    for r in out:
        sample = [p for _, p in frame(data, r.symbol, r.ts)]
        assert r.prices == len(sample)
        if len(sample) == 1:
            assert r.volatility is None
        else:
            assert r.volatility == pytest.approx(statistics.stdev(sample), rel=1e-9, abs=1e-6)


def test_thresholds_are_strict(rows):
    df = rows([("a", -3.0), ("b", -3.1), ("c", 5.0), ("d", 5.1), ("e", None)], "symbol STRING, change_percent DOUBLE")
    assert {r.symbol: r.alert_type for r in signals.price_alerts(df).collect()} == {"b": "PRICE_DROP", "d": "PRICE_SPIKE"}


def greedy(times, width):
    out = []
    for t in sorted(set(times)):
        if not out or t - out[-1] >= width:
            out.append(t)
    return out


def test_rate_limit_example(rows):
    df = rows([("x", T0 + timedelta(minutes=m)) for m in (1, 5, 16, 20, 31, 33)], "topic STRING, ts TIMESTAMP")
    out = rate_limit(df, "topic", "ts", 900).orderBy("ts").collect()
    assert [(r.ts - T0).seconds // 60 for r in out] == [1, 16, 31]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rate_limit_over_slots(rows, seed):
    """Dense, sparse and regular alerts; slots of few and many intervals, summed up in small and large parts."""
    rng = random.Random(seed)
    series = {
        "dense": [rng.uniform(0, 40) for _ in range(300)],
        "sparse": [rng.uniform(0, 4000) for _ in range(60)],
        "regular": [i * 0.9 for i in range(200)],
        "exact": [float(i) for i in range(100)],
        "single": [5.0],
        None: [rng.uniform(0, 100) for _ in range(50)],
    }
    stamp = lambda m: T0 + timedelta(microseconds=round(m * 60_000_000))
    data = [(k, stamp(m)) for k, ms in series.items() for m in ms for _ in range(2)]
    df = rows(data, "topic STRING, ts TIMESTAMP")
    expected = {(k, t) for k, ms in series.items() for t in greedy([stamp(m) for m in ms], timedelta(minutes=15))}
    df = df.unionByName(rows([("untimed", None), ("dense", None)], "topic STRING, ts TIMESTAMP"))
    for widths, chunk in ((64, 1 << 20), (1, 1 << 20), (2, 7), (3, 1)):
        out = rate_limit(df, "topic", "ts", 900, widths, chunk).collect()
        assert {(r.topic, r.ts) for r in out} == expected and len(out) == len(expected)


@pytest.mark.parametrize("seed", range(5))
def test_steps_say_where_a_chain_ends(seed):
    rng = random.Random(seed)
    times = np.array(sorted({rng.randrange(60 if seed else 8) for _ in range(25)}))
    for width in (1, 3, 10, 100):
        tops, exits = greedy_pass.steps(times, width)
        for last in [None, *range(int(times[0]) - 2 * width - 1, int(times[0]))]:
            passed, end = greedy_pass.chain(times, last, width)
            assert greedy_pass.entered(last, tops, exits, width) == end
            assert passed == greedy([t for t in times.tolist() if last is None or t >= last + width], width)
    assert len(greedy_pass.steps(np.arange(0, 10**6, 7), 10**5)[0]) <= 10**5 // 7 + 2


def test_rate_limit_of_one_key_with_a_million_alerts(spark):
    alerts = spark.range(1_000_000).select(F.lit("x").alias("topic"), F.timestamp_micros(F.col("id") * 997_001).alias("ts"))
    got = sorted(int(r.t) for r in rate_limit(alerts, "topic", "ts", 900).select(F.unix_micros("ts").alias("t")).collect())
    wanted, _ = greedy_pass.chain(np.arange(1_000_000) * 997_001, None, 900_000_000)
    assert got == wanted


def test_rate_limit_runs_nothing_while_it_is_built(spark, rows):
    broken = rows([("x", T0)], "topic STRING, ts TIMESTAMP").withColumn("topic", F.raise_error(F.lit("ran")).cast("string"))
    assert rate_limit(broken, "topic", "ts", 900).columns == ["topic", "ts"]


def test_keywords_and_sentiment(rows):
    df = rows([(1, "Crypto CRASH now"), (2, "calm"), (3, "good good bad"), (4, None)], "id INT, text STRING")
    hits = {(r.id, r.keyword) for r in signals.keyword_match(df, ("crash", "crypto", "a")).collect()}
    assert hits == {(1, "crash"), (1, "crypto"), (1, "a"), (2, "a"), (3, "a")} - {(3, "a")} | {(3, "a")}
    scored = {r.id: (r.score, r.sentiment) for r in signals.sentiment(df, {"good": 1, "bad": -1, "crash": -2}).collect()}
    assert scored[1] == (-2, "NEGATIVE") and scored[2] == (0, "NEUTRAL") and scored[3] == (1, "POSITIVE")


def test_windows_and_spikes(rows):
    posts = [("x", T0 + timedelta(minutes=m), s) for m, s in ((0, 1), (1, 1), (6, 0), (7, -1), (12, -1))]
    df = rows(posts, "topic STRING, ts TIMESTAMP, score INT")
    counts = signals.topic_counts(df)
    assert counts.agg(F.sum("posts")).first()[0] == 5 * 5
    assert signals.trending(counts, 1).filter("posts <= 1").isEmpty()
    uneven = {(r.window_start.minute, r.posts) for r in signals.topic_counts(df, "5 minutes", "2 minutes").collect()
              if r.window_start >= T0}
    assert uneven == {(0, 2), (2, 1), (4, 2), (6, 2), (8, 1), (10, 1), (12, 1)} - {(2, 1)} | {(2, 1)}
    spikes = signals.sentiment_spike(df).orderBy("window_start").collect()
    assert [(r.previous_mean, r.mean_score) for r in spikes] == [(1.0, -0.5), (-0.5, -1.0)]


def test_tumbling_rate_limit(rows):
    df = rows([("x", T0 + timedelta(minutes=m)) for m in (1, 5, 16, 20, 31, 33)], "topic STRING, ts TIMESTAMP")
    out = rate_limit_tumbling(df, "topic", "ts", "15 minutes").orderBy("ts").collect()
    assert [(r.ts - T0).seconds // 60 for r in out] == [1, 16, 31]


def test_salted_lookup(spark, rows):
    many = spark.range(5000).select(F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 2 == 0, "cold").alias("k"), "id")
    facts = rows([("hot", 1), (None, 2), ("unused", 3)], "k STRING, v INT")
    out = lookup(many, facts, ["k"], F.col("id"))
    assert {(r.k, r.v): r["count"] for r in out.groupBy("k", "v").count().collect()} == {("hot", 1): 3333, (None, 2): 833}
    assert out.columns == ["k", "id", "v"]
    spread = lookup(many, facts, ["k"], F.col("id"), "left")
    assert spread.count() == 5000
