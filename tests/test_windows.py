"""Window operators against plain Python, and on the edges."""

import math
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tests import weather
from tidemill.functions import COUNT, EXACT_MEAN, MEAN
from tidemill.operators import (
    keep_above,
    keep_at_least,
    pane_mean,
    session_combine,
    sliding_combine,
    tumbling_combine,
    windows,
)

UTC = timezone.utc
HOUR = timedelta(hours=1)
MS = timedelta(milliseconds=1)


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, t timestamp, v double").repartition(4)


def utc(value: datetime) -> datetime:
    """Collected timestamps are naive, in the zone of this machine."""
    return value.astimezone(UTC)


def random_rows(seed, n=400, span=40 * 3600, start=datetime(1969, 12, 31, tzinfo=UTC)):
    """Around 1970, half of them for one key, with repeated times."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        key = "hot" if rng.random() < 0.5 else f"k{rng.randrange(6)}"
        step = timedelta(microseconds=rng.randrange(span * 4) * 250_000)
        rows.append((key, start + step, float(rng.randrange(1000)) / 8))
    return rows


def found_sessions(df):
    return sorted((r[0], utc(r[1]), utc(r[2]), r[3]) for r in df.collect())


def expected_sessions(rows, gap):
    keys = {k for k, _, _ in rows}
    return sorted(
        (k, *s) for k in keys for s in weather.sessions([t for key, t, _ in rows if key == k], gap)
    )


@pytest.mark.parametrize("gap", [timedelta(seconds=20), timedelta(minutes=7), HOUR, 30 * HOUR])
@pytest.mark.parametrize("how", ["chunked", "one chunk", "built in"])
def test_sessions(spark, monkeypatch, gap, how):
    # Chunks of three cells, so that sessions cross many chunk edges; or of all cells.
    monkeypatch.setattr(windows, "_LONG_SPAN", (9 if how == "chunked" else 10**8) * gap)
    options = {"prefold": False} if how == "built in" else {}
    rows = random_rows(seed=7)
    out = session_combine(frame(spark, rows), "t", "v", keys=["k"], gap=gap, **options)
    assert found_sessions(out) == expected_sessions(rows, gap)


def test_only_edge_sessions_meet_again(spark, tmp_path):
    rows = [(f"k{i % 3}", datetime(2022, 1, 1, tzinfo=UTC) + 3 * i * HOUR, 1.0) for i in range(6000)]
    frame(spark, rows).write.parquet(f"{tmp_path}/rows")
    out = session_combine(spark.read.parquet(f"{tmp_path}/rows"), "t", "v", keys=["k"])
    plan = out._jdf.queryExecution().executedPlan()
    out.collect()
    text = plan.toString()
    # One scan and one fold into cells serve both branches, and the last exchange is
    # above the filter that leaves the edges.
    final = text[: text.index("== Initial Plan")]
    assert "ReusedExchange" in final
    assert "Filter _edge" in final or "Filter (isnotnull(_edge" in final


def test_session_tasks_grow_with_the_rows(spark, monkeypatch):
    """However few shuffle partitions a session has: both chainings have a task for each share."""
    monkeypatch.setattr(windows, "_TASK_ROWS", 200, raising=False)
    monkeypatch.setattr(windows, "_LONG_SPAN", 9 * HOUR)  # chunks of three cells
    rows = random_rows(seed=11, n=4000, span=4000 * 3600)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 1)
    try:
        out = session_combine(frame(spark, rows), "t", "v", keys=["k"])
        assert found_sessions(out) == expected_sessions(rows, HOUR)
        assert out.rdd.getNumPartitions() >= 2 * 20
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_reserved_keys_are_refused(spark):
    rows = frame(spark, random_rows(seed=1)).withColumnRenamed("k", "_n")
    for combine in (tumbling_combine, sliding_combine, session_combine):
        with pytest.raises(ValueError, match="_n"):
            combine(rows, "t", "v", keys=["_n"])


@pytest.mark.parametrize("hours", [1, 2, 15, 24, 72])
def test_every_width_has_windows(spark, hours):
    rows = random_rows(seed=2)
    out = tumbling_combine(frame(spark, rows), "t", "v", width=hours * HOUR, combine=COUNT, name="n").collect()
    assert sum(r["n"] for r in out) == len(rows)
    assert all(r["window_end"] - r["window_start"] == hours * HOUR for r in out)


def test_session_gap_is_closed(spark):
    start = datetime(2022, 1, 1, 0, 30, tzinfo=UTC)
    rows = [("a", start, 1.0), ("a", start + HOUR, 1.0), ("a", start + 2 * HOUR + MS, 1.0)]
    out = session_combine(frame(spark, rows), "t", "v", keys=["k"])
    assert found_sessions(out) == [
        ("a", start, start + 2 * HOUR, 2),
        ("a", start + 2 * HOUR + MS, start + 3 * HOUR + MS, 1),
    ]


def test_session_mean_is_mergeable(spark):
    start = datetime(2022, 1, 1, tzinfo=UTC)
    rows = [("a", start + i * HOUR, float(i)) for i in range(5)]
    out = session_combine(frame(spark, rows), "t", "v", keys=["k"], combine=MEAN, name="mean")
    assert [r["mean"] for r in out.collect()] == [2.0]


def test_sessions_need_a_key(spark):
    with pytest.raises(ValueError, match="key"):
        session_combine(frame(spark, []), "t", "v", keys=[])


def test_tumbling_edge_belongs_to_the_new_day(spark):
    midnight = datetime(2022, 1, 1, 15, tzinfo=UTC)  # 2022-01-02T00:00+09:00
    rows = [("a", midnight - MS, 1.0), ("a", midnight, 3.0)]
    out = tumbling_combine(frame(spark, rows), "t", "v", keys=["k"]).collect()
    assert sorted((utc(r["window_start"]), r["mean"]) for r in out) == [
        (midnight - timedelta(days=1), 1.0),
        (midnight, 3.0),
    ]


@pytest.mark.parametrize("prefold", [False, True])
@pytest.mark.parametrize(
    "width,slide",
    [(3 * HOUR, HOUR), (3 * HOUR, 2 * HOUR), (timedelta(minutes=90), HOUR), (HOUR, HOUR)],
)
def test_sliding(spark, prefold, width, slide):
    rows = random_rows(seed=3)
    out = sliding_combine(
        frame(spark, rows), "t", "v", keys=["k"], combine=COUNT, name="n",
        width=width, slide=slide, prefold=prefold,
    )
    epoch = datetime(1970, 1, 1, tzinfo=UTC)
    expected: dict = {}
    for key, time, _ in rows:
        start = epoch + (time - epoch) // slide * slide
        while start + width > time:
            expected[key, start] = expected.get((key, start), 0) + 1
            start -= slide
    found = {(r["k"], utc(r["window_start"])): r["n"] for r in out.collect()}
    assert found == expected
    ends = out.select((F.col("window_end") - F.col("window_start")).alias("d")).distinct().collect()
    assert [r["d"] for r in ends] == [width]


def test_mean_ignores_nulls(spark):
    time = datetime(2022, 1, 1, tzinfo=UTC)
    rows = [("a", time, 1.0), ("a", time, None), ("b", time, None)]
    out = tumbling_combine(frame(spark, rows), "t", "v", keys=["k"])
    assert {r["k"]: r["mean"] for r in out.collect()} == {"a": 1.0, "b": None}


def test_rows_without_time_are_in_no_window(spark):
    rows = [("a", None, 1.0)]
    assert tumbling_combine(frame(spark, rows), "t", "v").count() == 0
    assert sliding_combine(frame(spark, rows), "t", "v").count() == 0
    assert session_combine(frame(spark, rows), "t", "v", keys=["k"]).count() == 0


def test_filter_bounds(spark):
    rows = [(float(v),) for v in (-0.1, 0.0, -0.0, 0.1, "nan", "inf")] + [(None,)]
    df = spark.createDataFrame(rows, "v float")
    assert [r["v"] for r in keep_at_least(df, "v").collect()] == pytest.approx(
        [0.0, 0.0, 0.1, float("inf")]
    )
    assert [r["v"] for r in keep_above(df, "v").collect()] == pytest.approx([0.1, float("inf")])
    ints = spark.createDataFrame([(0,), (1,)], "v int")
    assert keep_above(ints, "v").count() == 1


def test_filter_reaches_the_scan(spark, small_sf):
    items = spark.read.parquet(f"{small_sf}/lineitem.parquet").select("l_orderkey", "l_discount")
    plan = keep_above(items, "l_discount", 0.05)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_discount,0.05)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_discount:double>" in plan


def test_empty_pane_gives_no_row(spark):
    empty = spark.createDataFrame([], "v double")
    assert pane_mean(empty, "v").count() == 0
    one = spark.createDataFrame([(2.0,), (4.0,)], "v double")
    assert [tuple(r) for r in pane_mean(one, "v").collect()] == [(3.0, 2)]


def test_hot_key_is_folded_before_the_shuffle(spark, small_sf):
    """Rows are combined into cells in the map tasks, then cells are exchanged."""
    events = spark.read.parquet(f"{small_sf}/events.parquet")
    out = session_combine(events, "ts", "value", keys=["event_type"])
    query = out._jdf.queryExecution()
    query.executedPlan().executeCollect()
    plan = query.executedPlan().toString()
    final = plan[: plan.index("== Initial Plan")]
    lowest_exchange = final.rindex("Exchange hashpartitioning", 0, final.index("FileScan"))
    assert "partial_count" in final[lowest_exchange:]
    # Cells, chunks, edges: rows are read once.
    assert final.count("FileScan") == 1


def test_exact_means_do_not_depend_on_partitions(spark):
    draw = random.Random(9)
    values = [draw.uniform(-1, 1) * 10.0 ** draw.randint(-9, 12) for _ in range(4000)]
    values += [0.1, -0.0, 0.0, 1e-300, 2.0**119, -(2.0**119), 2.0**-67, 1e18 + 1, None]
    start = datetime(2022, 1, 1)
    rows = spark.createDataFrame([(start + timedelta(minutes=i), v, i % 3) for i, v in enumerate(values)], "t timestamp_ntz, v double, k int")
    found = set()
    for n in (1, 8, 200):
        dealt = rows.repartition(n, F.rand(n))
        days = tumbling_combine(dealt, "t", "v", combine=EXACT_MEAN, keys=["k"]).collect()
        hours = sliding_combine(dealt, "t", "v", combine=EXACT_MEAN, keys=["k"]).collect()
        found.add(tuple(sorted((r["k"], r["window_start"], r["mean"].hex()) for r in days + hours)))
    assert len(found) == 1
    by = {}
    for r, v in zip(rows.collect(), values):
        day = (r["t"] - timedelta(hours=15)).date()
        by.setdefault((r["k"], day), []).append(v)
    for r in tumbling_combine(rows, "t", "v", combine=EXACT_MEAN, keys=["k"]).collect():
        own = [v for v in by[r["k"], r["window_start"].date()] if v is not None]
        assert r["mean"] == pytest.approx(math.fsum(own) / len(own), rel=1e-14, abs=1e-300)
