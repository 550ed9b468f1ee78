"""Every registered query gives what its SQL gives."""

import time

import pytest
from pyspark.sql.streaming import StreamingQueryListener

import __spark_entry__ as contract
from tests.compare import connect, difference
from tidemill.plans.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def tables(small_sf):
    return connect(small_sf)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.items() <= contract.queries().items()


class DataBatches(StreamingQueryListener):
    """Counts the micro-batches that had rows."""

    def __init__(self):
        self.n = 0

    def onQueryProgress(self, event):
        self.n += event.progress.numInputRows > 0

    def onQueryStarted(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, small_sf, tables):
    spark.streams.addListener(batches := DataBatches())
    try:
        result = contract.queries()[name](spark, small_sf)
        assert difference(result, tables, contract.oracle_sql()[name]) == ""
        if name.startswith("stream_"):
            give_up = time.monotonic() + 20
            while batches.n < 5 and time.monotonic() < give_up:  # events come a little later
                time.sleep(0.2)
            assert batches.n >= 5
    finally:
        spark.streams.removeListener(batches)


def test_entry(spark, small_sf):
    result = contract.entry(spark)
    assert result.columns == ["s", "m", "n"]
    assert result.count() > 0
