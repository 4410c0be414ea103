"""Closed forms against plain-Python event machines on random keyed events.

The machines follow the reference's keyed functions step by step under an
ideal watermark (before an event at ``t`` the timers ``< t`` fire; at the
end every timer fires). Times are drawn on a coarse grid so that ties and
gaps of exactly ``d``, ``d - 1`` and ``d + 1`` occur; small chunk widths
force the halo paths.
"""

import random

import pytest
from pyspark.sql import functions as F

from eventlytics import operators as ops
from eventlytics.sources.memory import rows_to_frame

D = 10_000_000  # 10 s in µs
SCHEMA = "k BIGINT, typ STRING, t BIGINT"


def _events(seed, n=160, keys=4, types=("a", "b", "c")):
    rnd = random.Random(seed)
    grid = [0, D - 1, D, D + 1, 1, D // 2]
    out, t = [], 0
    for _ in range(n):
        t += rnd.choice(grid + [0, 0, 3 * D])
        out.append((rnd.randrange(keys), rnd.choice(types), t))
    return out


def _per_key(evs):
    by = {}
    for seq, (k, typ, t) in enumerate(evs):
        by.setdefault(k, []).append((t, seq, typ))
    return {k: sorted(v) for k, v in by.items()}


def _timer_machine(evs, on_event, on_fire):
    out = []
    for k, seq_rows in _per_key(evs).items():
        state, timers = {"v": None}, set()
        for t, seq, typ in seq_rows:
            for tm in sorted(x for x in timers if x < t):
                timers.discard(tm)
                out.extend((k,) + r for r in on_fire(state))
            on_event(state, (t, seq, typ))
            timers.add(t + D)
        for tm in sorted(timers):
            out.extend((k,) + r for r in on_fire(state))
    return sorted(out)


def burst_machine(evs):
    def on_event(st, ev):
        if ev[2] == "a":
            st["v"] = (st["v"] or []) + [ev]

    def on_fire(st):
        stored, st["v"] = st["v"] or [], None
        return [(stored[0][1],)] if len(stored) > 1 else []

    return _timer_machine(evs, on_event, on_fire)


def slot_machine(evs):
    def on_event(st, ev):
        if ev[2] == "a":
            if st["v"] is None:
                st["v"] = ev
        else:
            st["v"] = ev

    def on_fire(st):
        v, st["v"] = st["v"], None
        return [(v[1],)] if v is not None and v[2] == "a" else []

    return _timer_machine(evs, on_event, on_fire)


def adjacent_machine(evs):
    out = []
    for k, r in _per_key(evs).items():
        for (t0, s0, y0), (t1, s1, y1) in zip(r, r[1:]):
            if y0 == "a" and y1 == "a" and t1 - t0 < D:
                out.append((k, s1))
    return sorted(out)


def timeout_machine(evs):
    out = []
    for k, r in _per_key(evs).items():
        for i, (t, s, y) in enumerate(r):
            if y == "a" and (i + 1 == len(r) or r[i + 1][0] - t >= D):
                out.append((k, s))
    return sorted(out)


def matches_machine(evs):
    out = []
    for k, r in _per_key(evs).items():
        for (t0, s0, y0), (t1, s1, y1) in zip(r, r[1:]):
            if y0 == "a" and y1 == "b" and t1 - t0 < D:
                out.append((k, s0))
    return sorted(out)


def _frame(spark, evs):
    df = rows_to_frame(spark, evs, SCHEMA)
    return df.withColumn("et", F.timestamp_micros("t"))


def _got(df):
    return sorted((r["k"], r["seq"]) for r in df.select("k", "seq").collect())


CHUNKS = [None, D, 3 * D + 7]


@pytest.mark.parametrize("seed", range(6))
def test_timer_closed_forms(spark, seed):
    evs = _events(seed)
    df = _frame(spark, evs).cache()
    a = F.col("typ") == "a"
    for chunk in CHUNKS:
        assert _got(ops.failure_burst(df, ["k"], a, D // 1000, chunk_us=chunk)) == burst_machine(evs)
        assert _got(ops.single_slot_timeout(df, ["k"], a, D // 1000, chunk_us=chunk)) == slot_machine(evs)


@pytest.mark.parametrize("seed", range(6))
def test_pattern_forms(spark, seed):
    evs = _events(seed + 100)
    df = _frame(spark, evs).cache()
    a, b = F.col("typ") == "a", F.col("typ") == "b"
    for chunk in CHUNKS:
        assert _got(ops.adjacent_pair_within(df, ["k"], a, a, D // 1000, chunk_us=chunk)) == \
            adjacent_machine(evs)
        assert _got(ops.pattern_timeout(df, ["k"], a, b, D // 1000, chunk_us=chunk)) == \
            timeout_machine(evs)
        assert _got(ops.pattern_matches(df, ["k"], a, b, D // 1000, chunk_us=chunk)) == \
            matches_machine(evs)


def test_chunk_narrower_than_gap_gives_the_same(spark):
    evs = _events(1, n=150)
    df = _frame(spark, evs)
    a = F.col("typ") == "a"
    got = ops.failure_burst(df, ["k"], a, D // 1000, chunk_us=D // 5)
    assert sorted((r.k, r.seq) for r in got.collect()) == burst_machine(evs)
