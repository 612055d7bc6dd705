"""Sessions, cubes, rankings, multisets and as-of joins against plain Python."""

import json
import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lakelayers.operators import cubes
from lakelayers.operators.asof import asof_join
from lakelayers.operators.multisets import multiset_difference, multiset_intersection
from lakelayers.operators.ranking import top_k
from lakelayers.operators.sessions import sessions
from lakelayers.sinks.tables import create_managed_table
from lakelayers.sources.tables import scan_table
from lakelayers.streaming.silver import run_silver_incremental

START = datetime(2024, 1, 1)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- sessions


def plain_sessions(rows, gap):
    out, open_session = [], {}
    for key, time in sorted((r for r in rows if r[1] is not None), key=lambda r: (repr(r[0]), r[1])):
        last = open_session.get(key)
        if last and time - last[1] <= gap:
            last[1:] = [time, last[2] + 1]
        else:
            open_session[key] = last = [time, time, 1]
            out.append((key, last))
    return sorted(((k, *v) for k, v in out), key=repr)


@pytest.mark.parametrize("span", [timedelta(seconds=40), timedelta(minutes=3), timedelta(days=2)])
def test_sessions_go_on_over_spans(spark, span):
    rng, gap = random.Random(1), timedelta(seconds=30)
    rows = [(rng.choice(["hot"] * 6 + ["a", None]), START + timedelta(seconds=rng.randint(0, 4000))) for _ in range(500)]
    rows += [("edge", START), ("edge", START + gap), ("edge", START + 2 * gap + timedelta(microseconds=1)), ("a", None)]
    rows += [("long", START + timedelta(seconds=29 * i)) for i in range(200)]
    frame = spark.createDataFrame(rows, "key string, time timestamp")
    found = [tuple(r) for r in sessions(frame, ["key"], "time", gap, span).collect()]
    assert sorted(found, key=repr) == plain_sessions(rows, gap)
    assert sessions(frame.limit(0), ["key"], "time", gap).count() == 0


def test_only_sessions_at_borders_are_merged(spark):
    """A hot key of one event a minute in its own sessions: a span hands on two at most."""
    frame = spark.range(5000).select(F.lit("hot").alias("key"), F.timestamp_seconds(F.col("id") * 60).alias("time"))
    found = sessions(frame, ["key"], "time", timedelta(seconds=30))
    assert found.count() == 5000
    from lakelayers.operators import sessions as module

    seen = {}
    stitched = module._stitched
    module._stitched = lambda parts, *rest: stitched(seen.setdefault("parts", parts), *rest)
    try:
        assert sessions(frame, ["key"], "time", timedelta(seconds=30)).count() == 5000
    finally:
        module._stitched = stitched
    assert seen["parts"].count() <= 2 * (5000 // 1440 + 1)


# --- cubes


def measures():
    return [cubes.rows(), cubes.total("total", "v", "DECIMAL(38,2)"), cubes.least("low", "v", "DOUBLE"), cubes.greatest("high", "v", "DOUBLE")]


def test_cube_of_repeated_loads(spark, table):
    rng = random.Random(2)
    rows = [(rng.choice(["x", "y", None]), rng.choice([1, 2, None]), rng.choice([None, 0.1, 2.5, -3.25])) for _ in range(300)]
    frame = spark.createDataFrame(rows, "a string, b int, v double")
    ref, kinds = table("cube"), {"a": "STRING", "b": "INT"}
    halves = frame.filter("a = 'x'"), frame.filter("a is null or a <> 'x'")
    for load, part in (("1", halves[0]), ("2", halves[0]), ("2", halves[1]), ("1", halves[0])):
        cubes.write_cube(part, ref, load, kinds, measures())
    found = {(r.grouping, r.a, r.b): (r.rows, None if r.total is None else float(r.total), r.low, r.high) for r in cubes.read_cube(spark, ref, list(kinds), measures()).collect()}
    expected = {}
    for grouping in range(4):
        for a, b, v in rows:
            expected.setdefault((grouping, None if grouping & 2 else a, None if grouping & 1 else b), []).append(v)
    def of(values):
        some = [v for v in values if v is not None]
        return len(values), round(sum(some), 2) if some else None, min(some, default=None), max(some, default=None)
    assert found == {key: of(values) for key, values in expected.items()}
    one = cubes.read_cube(spark, ref, list(kinds), measures(), ["1"]).filter("grouping = 3").first()
    assert one.rows == sum(a == "x" for a, _, _ in rows)


def test_a_load_without_rows(spark, table):
    ref = table("cube")
    cubes.write_cube(spark.createDataFrame([], "a string, v double"), ref, "1", {"a": "STRING"}, measures())
    assert cubes.read_cube(spark, ref, ["a"], measures()).count() == 0


def test_rows_are_aggregated_before_they_are_copied(spark):
    frame = spark.createDataFrame([("x", 1, 1.0)], "a string, b int, v double")
    plan = plan_of(cubes.partial_cube(frame, ["a", "b"], measures()))
    assert plan.index("Generate explode") < plan.rindex("partial_count")
    assert plan.count("Exchange hashpartitioning") == 2


def test_sketches_merge_within_their_bounds(spark, table):
    frame = spark.range(60_000).selectExpr("id % 20000 as k", "cast((id * 7919) % 60000 as double) as v", "'s' as a")
    some = [cubes.distinct("k", "k"), cubes.quantile("q", "v", 0.25)]
    ref = table("sketches")
    for load in range(4):
        cubes.write_cube(frame.filter(F.col("v") % 4 == load), ref, str(load), {"a": "STRING"}, some)
    row = cubes.read_cube(spark, ref, ["a"], some).filter("grouping = 0").first()
    assert abs(row.k - 20_000) <= 0.03 * 20_000 and abs(row.q / 60_000 - 0.25) <= 0.01


# --- rankings


def test_top_k_keeps_k_rows_a_task(spark):
    frame = spark.range(1000).repartition(4).selectExpr("id % 3 as g", "id % 10 as v", "id")
    order = [F.col("v").desc_nulls_last(), F.col("id").asc()]
    found = top_k(frame, 2, order, ["g"])
    assert sorted((r.g, r.rank, r.v) for r in found.collect()) == [(g, k, 9) for g in range(3) for k in (1, 2)]
    plan = plan_of(top_k(frame, 2, order, ["g"]))
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")
    first = top_k(frame, 3, order)
    assert [(r.id, r.rank) for r in first.orderBy("rank").collect()] == [(9, 1), (19, 2), (29, 3)]
    assert "TakeOrderedAndProject" in plan_of(first)
    assert top_k(frame.limit(0), 3, order).count() == 0
    with pytest.raises(ValueError):
        top_k(frame, 0, order)


# --- multisets


def test_multisets(spark, monkeypatch):
    import lakelayers.operators.multisets as module

    monkeypatch.setattr(module, "COPIES", 3)
    rng = random.Random(3)
    left = [(rng.choice([1, 2, None]), rng.choice(["a", None])) for _ in range(60)] + [(9, "hot")] * 20
    right = [(rng.choice([1, 2, None]), rng.choice(["a", None])) for _ in range(30)] + [(9, "hot")] * 7
    a = spark.createDataFrame(left, "n int, s string")
    b = spark.createDataFrame(right, "n int, s string").select("s", "n")
    for result, expected in ((multiset_difference(a, b), Counter(left) - Counter(right)), (multiset_intersection(a, b), Counter(left) & Counter(right))):
        assert Counter(tuple(r) for r in result.collect()) == expected
    assert multiset_difference(a.limit(0), b).count() == 0
    with pytest.raises(ValueError):
        multiset_difference(a, b.drop("n"))


# --- as-of joins


def plain_asof(left, right):
    out = []
    for key, time, name in left:
        met = [(t, (v is not None, v or 0), v) for k, t, v in right if None not in (key, time, k, t) and k == key and t <= time]
        out.append((key, time, name, max(met)[2] if met else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("partitions", [1, 7])
def test_asof_join(spark, partitions):
    rng = random.Random(5)

    def row(i):
        return rng.choice([1] * 5 + [2, 3, None]), rng.choice([None] + [rng.randint(0, 60)] * 9), i

    left = [row(i) for i in range(250)] + [(8, 1, 1), (1, 61, 9)] * 2
    right = [(*row(i)[:2], rng.choice([None, i])) for i in range(150)] + [(7, 3, 5)]
    frames = spark.createDataFrame(left, "k int, t int, name int").repartition(3), spark.createDataFrame(right, "k int, t int, v int")
    found = asof_join(*frames, ["k"], "t", ["v"], partitions=partitions)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain_asof(left, right)
    inner = asof_join(*frames, ["k"], "t", ["v"], "inner", partitions)
    hit = sum(any(None not in (k, t, a, b) and a == k and b <= t for a, b, _ in right) for k, t, _ in left)
    assert inner.count() == hit
    with pytest.raises(ValueError):
        asof_join(*frames, ["k"], "t", ["t"])


def test_a_hot_key_is_spread(spark, monkeypatch):
    import lakelayers.operators.asof as module

    staged = {}
    stage = module.stage
    monkeypatch.setattr(module, "stage", lambda df, name: staged.setdefault(name, stage(df, name)))
    left = spark.range(4000).selectExpr("if(id % 2 = 0, 0, id) k", "if(id % 4 = 0, 5, id) t", "id name")
    right = spark.range(4000).selectExpr("if(id % 2 = 0, 0, id) k", "id t", "id v")
    assert asof_join(left, right, ["k"], "t", ["v"], partitions=8).count() == 4000
    parts = [r["count"] for r in staged["asof-ranges"].filter("k = 0").groupBy("_part").count().collect()]
    assert len(parts) >= 3 and max(parts) < 0.3 * 8000


# --- streams


def test_late_and_repeated_rows(spark, table, tmp_path):
    silver, late, folder = table("silver"), table("late"), tmp_path / "raw"
    folder.mkdir()
    batches = [
        [("a", 0), ("b", 100), ("b", 100), (None, 100)],
        [("a", 0), ("b", 100), ("c", 40), ("d", 39), ("e", 41), ("f", None)],
        [("g", 10_000)],
        [("c", 40), ("h", 9939), ("h", 9941), ("g", 10_000)],
    ]
    for number, batch in enumerate(batches):
        lines = [json.dumps({"payload": {"id": i, "at": None if s is None else (START + timedelta(seconds=s)).isoformat()}}) for i, s in batch]
        (folder / f"{number}.json").write_text("\n".join(lines))
        for _ in range(2):  # a run without new files changes nothing
            run_silver_incremental(
                spark, str(folder), "payload struct<id: string, at: string>", silver, late, str(tmp_path / "state"), "at", timedelta(seconds=60)
            )
    assert sorted(r.record_id for r in scan_table(spark, silver).collect()) == ["a", "b", "e", "g", "h"]
    assert sorted(r.record_id for r in scan_table(spark, late).collect()) == ["a", "c", "c", "d", "f", "h"]


def test_streamed_tables_have_the_silver_columns(spark, table, tmp_path):
    silver = table("silver")
    create_managed_table(spark, silver, "record_id STRING, payload_json STRING, payload_size INT, payload_hash STRING, processed_at TIMESTAMP, standardized_at TIMESTAMP, event_time TIMESTAMP, load_id STRING", ["load_id"])
    (tmp_path / "raw").mkdir()
    run_silver_incremental(spark, str(tmp_path / "raw"), "payload struct<id: string, at: string>", silver, table("late"), str(tmp_path / "s"), "at", timedelta(0))
    assert scan_table(spark, silver).count() == 0


def test_the_exact_figures_beside_sketches_are_not_dealt_by_status(spark, tmp_path):
    """A status or the total would be one task's rows; nulls and repeats count as in SQL."""
    from lakelayers.plans.queries import gold_sketches

    rows = [(i // 4, "FO"[i % 2], float(i)) for i in range(4000)]
    rows += rows[:50] + [(None, "F", 7.0), (None, None, 8.0), (3, None, None), (None, "N", 9.0)]
    spark.createDataFrame(rows, "l_orderkey long, l_linestatus string, l_extendedprice double").write.parquet(f"{tmp_path}/lineitem.parquet")
    found = gold_sketches(spark, str(tmp_path))
    plan = found._jdf.queryExecution().optimizedPlan().toString(), found._jdf.queryExecution().sparkPlan().toString()
    assert "RepartitionByExpression [l_orderkey" in plan[0] and "BroadcastHashJoin [status" in plan[1]
    # Lines without an order are in no load.
    shown = {r.status: (r.lines, r.distinct_kept, r.median_kept, r.high_kept) for r in found.collect()}
    assert shown == {"F": (2025, True, True, True), "O": (2025, True, True, True), "all": (4051, True, True, True)}
