"""Weather feeds as streams: late data, duplicates, daily aggregates, gated batches, latest state.

Every stream takes and gives a streaming DataFrame, so any source and sink fit; state is bounded by the
watermark of three hours, and that of the newest observations by the number of stations and a time to live.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from greenlake.operators.quality import judge

LATE, AHEAD = "3 hours", "5 minutes"


def observations(spark: SparkSession, path: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    return (r if files_per_trigger is None else r.option("maxFilesPerTrigger", files_per_trigger)).parquet(path)


def timely(stream: DataFrame) -> DataFrame:
    """Drop observations from more than five minutes ahead, and watermark the rest."""
    return stream.where(F.col("observed_at") <= F.current_timestamp() + F.expr(f"interval {AHEAD}")).withWatermark("observed_at", LATE)


def without_repeats(stream: DataFrame) -> DataFrame:
    """One observation for each station and instant; keys leave the state with the watermark."""
    return stream.dropDuplicatesWithinWatermark(["station_code", "observed_at"])


def daily(stream: DataFrame) -> DataFrame:
    """Daily temperatures of each station: in append mode once a day is past the watermark, in update mode as they change."""
    return stream.groupBy("station_code", F.window("observed_at", "1 day").alias("day")).agg(
        F.avg("air_temperature_c").alias("mean_c"), F.min("air_temperature_c").alias("min_c"), F.max("air_temperature_c").alias("max_c"), F.count("*").alias("n"),
    ).select("station_code", F.to_date("day.start").alias("observed_on"), "mean_c", "min_c", "max_c", "n")


def dropped_late(query: StreamingQuery) -> int:
    """Rows that a query's stateful operators have dropped as later than the watermark, over its recent progress."""
    return sum(int(s["numRowsDroppedByWatermark"]) for p in query.recentProgress for s in p["stateOperators"])


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Queries that start within keep their state in RocksDB; others keep the session's setting."""
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(STATE_STORE, before)


class NewestObservation(StatefulProcessor):
    """Keeps each key's newest row, by the order columns, and hands it on when it changes."""

    def __init__(self, key: str, fields: list[T.StructField], order: list[str], ttl_ms: int | None):
        self.key, self.fields, self.order, self.ttl_ms = key, fields, order, ttl_ms

    def init(self, handle) -> None:
        self.state = handle.getValueState("newest", T.StructType(self.fields), self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        names = [f.name for f in self.fields]
        # Nulls come before all values, as in the engine's own order.
        place = lambda values: [(v is not None, v) if v is not None else (False, 0) for v in values]
        at = [names.index(c) for c in self.order]
        known = tuple(self.state.get()) if self.state.exists() else None
        best = known
        for r in rows:
            values = tuple(r[n] for n in names)
            if best is None or place(values[i] for i in at) > place(best[i] for i in at):
                best = values
        if best != known:
            self.state.update(best)
            yield Row(**{self.key: key[0], **dict(zip(names, best))})

    def close(self) -> None:
        pass


def newest(stream: DataFrame, key: str = "station_code", order: str = "observed_at", ttl_ms: int | None = None) -> DataFrame:
    """Each station's newest observation, handed on when a batch brings a newer one; start it within :func:`rocksdb_state`, in update mode.

    A batch reads and writes the state of its own stations only. Repeated and older rows change nothing; of two at one instant the
    greater in the other columns stays. With ``ttl_ms`` a station that is silent for so long is forgotten; such a query checks for that
    in batches without data too, so run it without ``availableNow``.
    """
    # Instants are kept as microseconds, which no time zone of a Python worker can shift.
    instants = [f.name for f in stream.schema.fields if f.name != key and isinstance(f.dataType, T.TimestampType)]
    plain = stream.withColumns({c: F.unix_micros(c) for c in instants})
    rest = [f for f in plain.schema.fields if f.name != key]
    out = T.StructType([plain.schema[key], *rest])
    processor = NewestObservation(key, rest, [order, *(f.name for f in rest if f.name != order)], ttl_ms)
    kept = plain.groupBy(key).transformWithState(processor, out, "Update", "None" if ttl_ms is None else "ProcessingTime")
    return kept.withColumns({c: F.timestamp_micros(c) for c in instants}).select(*stream.columns)


def changes(path: str) -> Callable[[DataFrame, int], None]:
    """A batch writer that keeps what each batch of :func:`newest` hands on; a batch that is run again writes the same place."""

    def write(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write


def newest_state(spark: SparkSession, path: str, key: str = "station_code") -> DataFrame:
    """Each station's row of the last batch that wrote one."""
    x = spark.read.parquet(path)
    rest = [c for c in x.columns if c not in (key, "batch")]
    return x.groupBy(key).agg(F.max_by(F.struct(*rest), "batch").alias("o")).select(key, "o.*")


def gated(rules: Sequence[dict], facts: str, evidence: str, dataset: str, threshold: float = 95.0) -> Callable[[DataFrame, int], None]:
    """A batch writer that keeps a batch's passing rows when it passes its gate, and its evidence always."""

    def write(batch: DataFrame, number: int) -> None:
        judged = judge(batch, rules, dataset, threshold)
        judged.report.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{evidence}/batch={number}")
        if judged.passed:
            judged.kept().write.mode("overwrite").parquet(f"{facts}/batch={number}")

    return write
