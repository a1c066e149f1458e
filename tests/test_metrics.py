from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from eventflow.operators import cluster, delivery, metrics

T0 = datetime(2024, 1, 1)
PROBES = "label STRING, latency_ms BIGINT, ok BOOLEAN, cb_ts TIMESTAMP"


def probes(rows, latencies, ok=True):
    return rows([("a", x, ok, T0 + timedelta(seconds=i)) for i, x in enumerate(latencies)], PROBES)


@pytest.mark.parametrize(("n", "nearest", "floor"), [
    (1, (1, 1, 1), (1, 1, 1)), (2, (1, 2, 2), (2, 2, 2)), (10, (5, 10, 10), (6, 10, 10)),
    (20, (10, 19, 20), (11, 20, 20)), (100, (50, 95, 99), (51, 96, 100)),
])
def test_percentiles(rows, n, nearest, floor):
    df = probes(rows, reversed(range(1, n + 1)))
    for kind, expected in (("nearest", nearest), ("floor", floor)):
        row = metrics.run_summary(df, ["label"], kind).first()
        assert (row.p50, row.p95, row.p99) == expected


def test_summary_without_success(rows):
    row = metrics.run_summary(probes(rows, [5, 7], ok=False), ["label"]).first()
    assert (row.sent, row.failed, row.avg_ms, row.p50, row.min_ms, row.throughput) == (0, 2, 0, 0, None, 0.0)
    assert metrics.floor_percentiles(probes(rows, [5], ok=False), ["label"]).isEmpty()
    failed_too = metrics.run_summary(probes(rows, [5, 7], ok=False), ["label"], include_failed=True).first()
    assert (failed_too.p50, failed_too.avg_ms) == (5, 6)
    assert metrics.run_summary(rows([], PROBES), ["label"]).isEmpty()


def test_truncated_mean_and_throughput(rows):
    row = metrics.run_summary(probes(rows, [1, 2, None]), ["label"]).first()
    assert (row.avg_ms, row.sent, row.elapsed_s, row.throughput) == (1, 3, 2.0, 1.5)
    assert metrics.run_summary(probes(rows, [1]), ["label"]).first().throughput == 0.0


def test_success_rate(rows):
    df = rows([("a", True), ("a", False), ("a", None), ("b", None)], "label STRING, ok BOOLEAN")
    out = {r.label: r.success_rate for r in metrics.success_rate(df, ["label"]).collect()}
    assert out == {"a": 50.0, "b": None}


def test_buckets(rows):
    df = rows([("a", 1, True, T0 + timedelta(milliseconds=m)) for m in (0, 999, 1000, 3500)]
              + [("a", 1, False, T0 + timedelta(milliseconds=2500))], PROBES)
    buckets = metrics.per_second_counts(df, ["label"])
    assert {(r.bucket, r.acks) for r in buckets.collect()} == {(0, 2), (1, 1), (3, 1)}
    sparse = metrics.throughput_stats(buckets, ["label"]).first()
    dense = metrics.throughput_stats(buckets, ["label"], dense=True).first()
    assert (sparse.buckets, sparse.min_acks, sparse.max_acks) == (3, 1, 2)
    assert (dense.buckets, dense.min_acks, dense.avg_acks) == (4, 0, 1.0)


def test_latency_since_start_in_blocks(rows):
    df = rows([(label, 0, i % 3 > 0, T0 + timedelta(milliseconds=i * i)) for label in "ab" for i in range(200)], PROBES)
    plain = metrics.latency_since_start(df, ["label"])
    cut = metrics.latency_since_start(df, ["label"], slot_ms=20)
    assert plain.exceptAll(cut).isEmpty() and plain.count() == cut.count() == 2


def test_progress(rows):
    df = rows([("a", T0 + timedelta(seconds=i // 7)) for i in range(50)] + [("b", T0)], "label STRING, at_ts TIMESTAMP")
    samples = metrics.progress_samples(df, ["label"], "at_ts").filter("label = 'a'").orderBy("sampled_at").collect()
    assert [(r.processed, r.total) for r in samples] == [(35, 35), (15, 50)]
    for slot in (3600, 2):
        marks = metrics.progress_marks(df, ["label"], "at_ts", 10, slot=slot).collect()
        expected = {("a", n, T0 + timedelta(seconds=(n - 1) // 7)) for n in (1, 10, 20, 30, 40, 50)} | {("b", 1, T0)}
        assert {(r.label, r.record, r["at"]) for r in marks} == expected


def test_consumer_lag(rows):
    made = rows([("a", T0 + timedelta(seconds=s)) for s in (0, 1, 2, 11)], "label STRING, t TIMESTAMP")
    used = rows([("a", T0 + timedelta(seconds=s)) for s in (6, 7, 12)], "label STRING, t TIMESTAMP")
    out = metrics.consumer_lag(made, used, ["label"], "t").orderBy("at").collect()
    assert [r.lag for r in out] == [3, 1, 1]


def test_resources(rows):
    df = rows([("r", T0, -1.0, 3 * 2**20, 2**29), ("r", T0 + timedelta(seconds=1), 0.5, 2**20, 2**20),
               ("r", T0 + timedelta(seconds=2), 0.7, 2**20 + 5, 0), ("idle", T0, -1.0, 0, 0)],
              "run STRING, ts TIMESTAMP, cpu_load DOUBLE, heap_used BIGINT, heap_max BIGINT")
    out = {r.run: r for r in metrics.resource_summary(df, ["run"]).collect()}
    row = out["r"]
    assert row.avg_cpu == pytest.approx(0.6) and row.peak_cpu == 0.7
    assert (row.avg_heap_mb, row.peak_heap_mb, row.max_heap_mb) == (1, 3, 512)
    assert (out["idle"].avg_cpu, out["idle"].peak_cpu) == (0.0, 0.0)


def test_delivery(rows):
    schema = "phase STRING, attempted BIGINT, sent BIGINT, failed BIGINT, consumed BIGINT"
    df = rows([("FAULT", 10, 8, 2, 10), ("BASELINE", 10, 10, 0, 12), ("FAULT", 9, 9, 0, 6), ("FAULT", 0, 0, 0, 0)], schema)
    out = [(r.lost, r.verdict, r.delivery_rate) for r in delivery.add_loss(df).collect()]
    assert out == [(0, "SURVIVED", 100.0), (0, "PERFECT", 120.0), (3, "DATA LOSS", pytest.approx(66.6667, abs=1e-3)),
                   (0, "PERFECT", 100.0)]


def test_conservation_and_phases(rows):
    df = rows([(rf, acks, phase, i % 3 > 0, i % 4 > 0) for rf in (1, 3) for acks in ("0", "all")
               for phase in ("BASELINE", "FAULT") for i in range(rf * 7)],
              "rf INT, acks STRING, phase STRING, acked BOOLEAN, consumed BOOLEAN")
    results = delivery.delivery_result(df)
    for r in results.collect():
        assert r.attempted == r.sent + r.failed
        if r.phase == "FAULT":
            assert r.attempted == r.consumed + r.lost
    assert delivery.compare_phases(results.filter("NOT (rf = 1 AND phase = 'BASELINE')")).count() == 2
    matrix = rows([(rf, a, "FAULT") for rf, a in delivery.FAULT_CONFIGS], "rf INT, acks STRING, phase STRING")
    report = {(r.rf, r.acks): r for r in delivery.config_matrix(results, matrix).collect()}
    assert set(delivery.report_rows(results).columns) >= {"rf", "acks", "sendFailed", "dropped", "dropRate", "verdict"}
    assert len(report) == 4 and not report[(1, "1")].tested and report[(1, "1")].attempted == 0


def test_offset_reset(rows):
    df = rows([(T0 + timedelta(seconds=i),) for i in range(10)], "time TIMESTAMP")
    out = {r.policy: (r.sent_while_down, r.received, r.lost)
           for r in delivery.offset_reset_report(df, F.lit(T0 + timedelta(seconds=5))).collect()}
    assert out == {"earliest": (6, 10, 0), "latest": (6, 4, 6)}


OBS = "topic STRING, partition INT, obs_id INT, observed_at TIMESTAMP, leader INT, isr ARRAY<INT>, replicas ARRAY<INT>"


@pytest.mark.parametrize("slot", [86_400, 1])
def test_cluster(rows, slot):
    leaders = [1, 1, 2, None, 2]
    isrs = [[1, 2], [1, 2], [2, 1], [], [1]]
    df = rows([("t", 0, i, T0 + timedelta(seconds=i), leader, isr, [1, 2, 3]) for i, (leader, isr) in enumerate(zip(leaders, isrs))], OBS)
    changes = cluster.leader_changes(df, slot=slot)
    assert [(r.old_leader, r.new_leader) for r in changes.orderBy("observed_at").collect()] == [(1, 2), (2, -1), (-1, 2)]
    gaps = cluster.failover_time(changes, slot=slot).orderBy("observed_at").collect()
    assert [r.gap_ms for r in gaps] == [None, 1000, 1000]
    ordered = cluster.isr_changes(df, slot=slot).orderBy("observed_at").collect()
    assert [(r.old_isr, r.new_isr) for r in ordered] == [("1,2", "2,1"), ("2,1", ""), ("", "1")]
    assert cluster.isr_changes(df, as_set=True, slot=slot).count() == 2
    state = cluster.cluster_state(df.filter("obs_id < 4")).first()
    assert (state.leader, state.isr, state.replicas) == ("NONE", "", "1,2,3")
