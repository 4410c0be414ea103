"""Consuming reconciliation against the two-slot machine."""

import random

import pytest
from pyspark.sql import functions as F

from eventlytics import operators as ops
from eventlytics import streaming as S
from eventlytics.session import scratch_path

SCHEMA = "k STRING, seq BIGINT, t BIGINT, name STRING"


def events(seed, n=300, keys=4):
    """(is_order, k, seq, t, name) with ties in time and in seq."""
    rnd, out, t = random.Random(seed), [], -5_000_000
    for i in range(n):
        t += rnd.choice([0, 0, 1, 500_000, 1_000_000, 1_000_001, 40_000_000])
        out.append((rnd.random() < 0.5, rnd.choice([None, "hot", "hot", "hot", *map(str, range(keys))]), i // 2, t, f"e{i}"))
    return out


def machine(evs, wait):
    held, out = {}, []
    alone = {True: "unmatched_order", False: "unmatched_payment"}
    for e in sorted(evs, key=lambda e: (e[3], e[2], not e[0])):
        o, k, _, t, name = e
        b = held.pop(k, None)
        if b and wait is not None and t - b[3] > wait:
            out.append((k, alone[b[0]], b[4] if b[0] else None, None if b[0] else b[4]))
            b = None
        if b and b[0] != o:
            out.append((k, "matched", *((b[4], name) if b[0] else (name, b[4]))))
            continue
        if b:
            out.append((k, alone[o].replace("unmatched", "replaced"), b[4] if o else None, None if o else b[4]))
        held[k] = e
    out += [(k, alone[b[0]], b[4] if b[0] else None, None if b[0] else b[4]) for k, b in held.items()]
    return sorted(out, key=str)


def sides(spark, evs):
    def side(is_order):
        return spark.createDataFrame([e[1:] for e in evs if e[0] == is_order], SCHEMA).withColumn(
            "et", F.timestamp_micros("t"))
    return side(True), side(False)


@pytest.mark.parametrize("wait_ms,chunk_ms", [(None, 1000), (None, 86_400_000), (1000, 1000), (1000, 700), (0, 5000)])
def test_consuming_equals_the_machine(spark, wait_ms, chunk_ms):
    evs = events(wait_ms or 1)
    got = ops.reconcile_consuming(*sides(spark, evs), ["k"], ["name"], ["name"], wait_ms, chunk=chunk_ms)
    assert got.columns == ["k", "status", "o_name", "o_et", "p_name", "p_et"]
    have = sorted(((r["k"], r["status"], r["o_name"], r["p_name"]) for r in got.collect()), key=str)
    assert have == machine(evs, None if wait_ms is None else wait_ms * 1000)
    assert {s for _, s, *_ in have} >= {"matched", "replaced_order", "replaced_payment"}


def test_long_run_of_links_crosses_chunks(spark):
    """One key, sides alternating, hundreds of chunks: every other link pairs."""
    evs = [(i % 2 == 0, "hot", i, i * 1_000_000, f"e{i}") for i in range(501)]
    got = ops.reconcile_consuming(*sides(spark, evs), ["k"], ["name"], ["name"], chunk=3000)
    assert {(r["status"], r["o_name"], r["p_name"]) for r in got.collect()} == {
        *(("matched", f"e{i}", f"e{i + 1}") for i in range(0, 500, 2)), ("unmatched_order", "e500", None)}


def test_hot_key_is_spread_over_chunks(spark):
    evs = events(3)
    plan = ops.reconcile_consuming(*sides(spark, evs), ["k"], ["name"], ["name"], chunk=1000)._jdf.queryExecution(
        ).executedPlan().toString()
    assert "Join" not in plan and "Python" not in plan
    # only the chunks' summaries are windowed by the key alone
    assert "Window [" in plan and "_chunk" in plan
    o, p = sides(spark, evs)
    chunks = o.unionByName(p).where("k = 'hot'").select(F.floor(F.col("t") / 1_000_000)).distinct().count()
    assert chunks > 20


def test_consuming_leaves_out_rows_without_time(spark):
    evs = [(True, "a", 1, None, "x"), (False, "a", 2, 5, "y"), (False, "b", 3, None, "z")]
    got = ops.reconcile_consuming(*sides(spark, evs), ["k"], ["name"], ["name"])
    assert [(r["status"], r["p_name"]) for r in got.collect()] == [("unmatched_payment", "y")]
    none = [x.where("false") for x in sides(spark, evs)]
    assert ops.reconcile_consuming(*none, ["k"], ["name"], ["name"]).count() == 0


def unique_sides():
    rnd = random.Random(4)
    o = [(i, i, i * 1_000_000, f"o{i}") for i in range(60) if i % 4]
    p = [(i, i, i * 1_000_000 + rnd.choice([-1, 0, 5_000_000, 10_000_000, 10_000_001]), f"p{i}") for i in range(60) if i % 5]
    return o, sorted(p, key=lambda r: r[2])


def unique_truth(o, p, wait):
    po, pp = {r[0]: r for r in o}, {r[0]: r for r in p}
    out = []
    for k in po.keys() | pp.keys():
        a, b = po.get(k), pp.get(k)
        if a and b and a[2] <= b[2] <= a[2] + wait:
            out.append((k, "matched", a[3], b[3]))
        else:
            out += [(k, "unmatched_order", a[3], None)] if a else []
            out += [(k, "unmatched_payment", None, b[3])] if b else []
    return sorted(out, key=str)


def test_unique_keys_by_a_stream_stream_join(spark):
    o, p = unique_sides()
    schema = "id BIGINT, seq BIGINT, t BIGINT, name STRING"
    folders = []
    for side in (o, p):
        folder = scratch_path(spark, "unique-in")
        spark.createDataFrame(side, schema).coalesce(1).write.parquet(folder)
        folders.append(folder)
    with_time = lambda df: df.withColumn("et", F.timestamp_micros("t"))
    batch = S.reconcile_unique(*(with_time(spark.read.parquet(f)) for f in folders), "id", ["name"], ["name"], "10 seconds")
    flat = lambda df: sorted(((r["id"], r["status"], r["o_name"], r["p_name"]) for r in df.collect()), key=str)
    assert flat(batch) == unique_truth(o, p, 10_000_000)
    end = S.End(spark)
    st = S.reconcile_unique(*(end.ending(with_time(spark.readStream.schema(schema).parquet(f))) for f in folders),
                            "id", ["name"], ["name"], "10 seconds", delay="20 seconds")
    assert flat(S.stream_result(st, "unique", end).where("id is not null")) == unique_truth(o, p, 10_000_000)


def test_the_join_drops_what_cannot_pair_any_more(spark):
    """Once both watermarks have passed, the state holds no earlier row."""
    schema = "id BIGINT, seq BIGINT, t BIGINT, name STRING"
    folders, checkpoint, out = [scratch_path(spark, "bounded-in") for _ in "op"], *(
        scratch_path(spark, f"bounded-{x}") for x in "cr")

    def run(side_rows):
        for f, part in zip(folders, side_rows):
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f)
        o, p = (spark.readStream.schema(schema).parquet(f).withColumn("et", F.timestamp_micros("t")) for f in folders)
        q = (S.reconcile_unique(o, p, "id", ["name"], ["name"], "10 seconds").writeStream.format("parquet")
             .option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        q.awaitTermination()
        return [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]][-1]

    many = [[(i, i, i * 1000, f"{side}{i}") for i in range(300)] for side in "op"]
    assert run(many) >= 300
    far = [[(10_000 + n, 0, 10**12, "x")] for n in range(2)]
    run(far)
    assert run([[(20_000 + n, 0, 10**12 + 1, "y")] for n in range(2)]) <= 4
