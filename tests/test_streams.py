import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from greenlake.streaming import weather

SCHEMA = "station_code string, observed_at timestamp, air_temperature_c double"


class Feed:
    """A folder of one file for each batch, read in the order they were put there."""

    def __init__(self, spark, path):
        self.spark, self.path, self.n = spark, path, 0

    def put(self, *rows):
        rows = [(s, dt.datetime.fromisoformat(t), v) for s, t, v in rows]
        out = self.path / f"w{self.n}"
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(out))
        (self.path / "in").mkdir(exist_ok=True)
        target = self.path / "in" / f"{self.n}.parquet"
        os.rename(next(out.glob("part-*")), target)
        os.utime(target, (1_700_000_000 + self.n * 60,) * 2)
        self.n += 1

    def stream(self):
        return weather.observations(self.spark, str(self.path / "in"), SCHEMA, 1)

    def run(self, frame, mode, write=None, sink=None):
        q = frame.writeStream.outputMode(mode).option("checkpointLocation", str(self.path / "checkpoint")).trigger(availableNow=True)
        q = q.foreachBatch(write) if write else q.format("parquet").option("path", str(sink))
        q = q.start()
        q.awaitTermination()
        return q


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def test_newest_survives_restarts_late_and_repeated_rows(spark, feed, tmp_path):
    state = str(tmp_path / "state")
    everything = []

    def put(*rows):
        everything.extend(rows)
        feed.put(*rows)

    def run():
        with weather.rocksdb_state(spark):
            feed.run(weather.newest(feed.stream()), "update", weather.changes(state))
        return {r["station_code"]: (str(r["observed_at"]), r["air_temperature_c"]) for r in weather.newest_state(spark, state).collect()}

    def expected():
        df = spark.createDataFrame([(s, dt.datetime.fromisoformat(t), v) for s, t, v in everything], SCHEMA)
        df.createOrReplaceTempView("all_observations")
        rows = spark.sql("SELECT station_code, max(struct(observed_at, air_temperature_c)) AS o FROM all_observations GROUP BY station_code").collect()
        return {r["station_code"]: (str(r["o"]["observed_at"]), r["o"]["air_temperature_c"]) for r in rows}

    put(("a", "2024-01-01 10:00", 20.0), ("b", "2024-01-01 09:00", 18.0))
    put(("a", "2024-01-01 09:30", 99.0), ("a", "2024-01-01 10:00", 20.0))  # older and repeated
    assert run() == expected()
    put(("a", "2024-01-01 10:00", 21.0), ("c", "2024-01-01 01:00", None))  # the same instant again, with a greater value
    put(("b", "2023-12-01 00:00", 1.0), ("c", "2024-01-01 01:00", 3.0))
    assert run() == expected()  # a new query from the checkpoint
    batches = {p.name for p in (tmp_path / "state").glob("batch=*")}
    assert len(batches) == 3  # the second batch changed nothing


def test_days_are_closed_by_the_watermark_and_late_rows_counted(spark, feed, tmp_path):
    days = tmp_path / "days"

    def run():
        q = feed.run(weather.daily(weather.without_repeats(weather.timely(feed.stream()))), "append", sink=days)
        rows = spark.read.parquet(str(days)).collect()
        return sorted((r["station_code"], str(r["observed_on"]), r["mean_c"], r["n"]) for r in rows), weather.dropped_late(q)

    feed.put(("a", "2024-01-01 10:00", 10.0), ("a", "2024-01-01 23:00", 20.0), ("b", "2024-01-01 12:00", 5.0))
    feed.put(("a", "2024-01-02 01:00", 30.0), ("a", "2024-01-01 22:30", 30.0), ("a", "2024-01-01 23:00", 20.0))  # the watermark is 22:00 of the first day
    rows, late = run()
    assert rows == [] and late == 0
    feed.put(("a", "2024-01-02 06:00", 1.0))  # the watermark passes the first day's end
    rows, late = run()
    assert rows == [("a", "2024-01-01", 20.0, 3), ("b", "2024-01-01", 5.0, 1)] and late == 0
    feed.put(("a", "2024-01-01 21:00", 99.0), ("b", "2024-01-02 02:59", 99.0), ("b", "2024-01-02 03:01", 7.0))  # two of three come too late
    feed.put(("b", "2024-01-03 04:00", 7.0))
    rows, late = run()
    assert rows == [("a", "2024-01-01", 20.0, 3), ("a", "2024-01-02", 15.5, 2), ("b", "2024-01-01", 5.0, 1), ("b", "2024-01-02", 7.0, 1)]
    assert late == 2


def test_a_silent_station_is_forgotten(spark, feed, tmp_path):
    feed.put(("a", "2024-01-01 10:00", 20.0))
    state = str(tmp_path / "state")
    with weather.rocksdb_state(spark):
        q = weather.newest(feed.stream(), ttl_ms=1).writeStream.outputMode("update").foreachBatch(weather.changes(state))
        q = q.option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(processingTime="1 second").start()
        try:
            wait(lambda: list((tmp_path / "state").glob("batch=*/_SUCCESS")))
            feed.put(("a", "2024-01-01 08:00", 5.0))  # older, but nothing is known any more
            wait(lambda: len(list((tmp_path / "state").glob("batch=*/_SUCCESS"))) > 1)
        finally:
            q.stop()
    assert weather.newest_state(spark, state).first()["air_temperature_c"] == 5.0


def wait(done, seconds=60):
    until = time.time() + seconds
    while not done():
        assert time.time() < until
        time.sleep(0.5)
