"""Stretches of time that every partition has passed."""

import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemill.operators.windows import session_runs
from tidemill.streaming import late_rows, start_complete_stretches, write_numbered

HOUR = timedelta(hours=1)
START = datetime(2024, 1, 1)
SCHEMA = "topic string, partition int, event_time timestamp, v int"


class Arrivals:
    """Rows (partition, hour, value) arrive in turns; each turn is one run of the stream."""

    def __init__(self, spark, base, **how):
        self.spark, self.base, self.how, self.turn = spark, base, how, 0
        self.stretches = []

    def take(self, *rows):
        data = [("t", p, None if h is None else START + h * HOUR, v) for p, h, v in rows]
        self.spark.createDataFrame(data, SCHEMA).coalesce(1).write.parquet(f"{self.base}/in/{self.turn}")
        self.turn += 1
        stream = self.spark.readStream.schema(SCHEMA).parquet(f"{self.base}/in/*")
        start_complete_stretches(stream, self.write, f"{self.base}/state", available_now=True, **self.how).awaitTermination()

    def write(self, rows, stretch):
        self.stretches.append(stretch)
        write_numbered(rows.select("v"), f"{self.base}/out", stretch.number)

    def released(self):
        try:
            return sorted(r.v for r in self.spark.read.parquet(f"{self.base}/out").collect())
        except Exception as error:
            assert "PATH_NOT_FOUND" in str(error)
            return []

    def late(self):
        stream = self.spark.readStream.schema(SCHEMA).parquet(f"{self.base}/in/*")
        return {(r.v, r.missed) for r in late_rows(self.spark, f"{self.base}/state", stream.schema).collect()}


def test_the_slowest_partition_holds_all_back(spark, tmp_path):
    arrivals = Arrivals(spark, tmp_path, expected=[("t", 0), ("t", 1)])
    arrivals.take((0, 0.5, 1), (0, 9.5, 2))
    assert arrivals.released() == []  # partition 1 has not come yet
    arrivals.take((1, 0.2, 3), (1, 2.1, 4))
    assert arrivals.released() == [1, 3]
    arrivals.take((1, 0.9, 5), (1, 9.9, 6), (1, None, 7))
    assert arrivals.released() == [1, 3, 4]
    assert arrivals.late() == {(5, START + 2 * HOUR), (7, None)}
    assert [(s.before is None, s.low is None) for s in arrivals.stretches] == [(True, True), (False, False)]


def test_an_idle_partition_holds_back_no_longer(spark, tmp_path):
    arrivals = Arrivals(spark, tmp_path, expected=[("t", 1)], idle=timedelta(seconds=2))
    arrivals.take((0, 0.5, 1))
    time.sleep(2)
    arrivals.take((0, 5.5, 2))
    assert arrivals.released() == [1]
    arrivals.take((1, 0.6, 3), (1, 8.0, 4), (0, 8.0, 5))
    assert arrivals.released() == [1, 2]
    assert {v for v, _ in arrivals.late()} == {3}


def test_lookback_and_reserved_names(spark, tmp_path):
    arrivals = Arrivals(spark, tmp_path, lookback=2 * HOUR)
    arrivals.take((0, 0.5, 1), (0, 1.5, 2), (0, 2.0, 3))
    arrivals.take((0, 4.0, 4))
    rows = spark.read.parquet(f"{tmp_path}/out/batch=1")
    assert sorted(r.v for r in rows.collect()) == [1, 2, 3]
    with pytest.raises(ValueError, match="reserved"):
        stream = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in/*").withColumn("_late", F.lit(1))
        start_complete_stretches(stream, arrivals.write, f"{tmp_path}/other")


def test_rows_of_a_hot_key_are_folded_before_they_meet(spark, capsys):
    """What is dealt out by key are cells, in a stretch as in a batch."""
    rows = spark.range(1000).select(F.lit("hot").alias("k"), F.timestamp_seconds("id").alias("t"), F.col("id").alias("v"))
    open_ = session_runs(rows, "t", "v", keys=["k"], gap=HOUR)
    session_runs(rows, "t", "v", keys=["k"], gap=HOUR, earlier=open_).explain("formatted")
    plan = capsys.readouterr().out
    parts = [p for p in plan.split("\n\n") if p.lstrip().startswith("(")]
    exchanges = [p for p in parts if "Exchange" in p.split("\n")[0] and "Reused" not in p.split("\n")[0]]
    assert exchanges
    for part in exchanges:
        given = part.split("Input")[1].split("\n")[0]
        assert "_first" in given or "min#" in given
    assert "session_window" not in plan and "MergingSessions" not in plan
