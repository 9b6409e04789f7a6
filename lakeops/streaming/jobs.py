"""Streaming twins of the batch operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from lakeops.functions.exprs import epoch_seconds, haversine, time_partition
from lakeops.operators import business, fraud, spatial
from lakeops.streaming import run, state


def latest_positions(stream: DataFrame) -> DataFrame:
    """Newest fix per truck (update mode); partial results are merged before the state."""
    row = F.struct(*[F.col(k) for k in stream.columns if k != "truck_id"])
    return stream.groupBy("truck_id").agg(F.max_by(row, F.struct("ts", "seq")).alias("r")).select("truck_id", "r.*")


def geofence_transitions(stream: DataFrame, fences: DataFrame, keep_days: float = 30) -> DataFrame:
    """Enter and exit alerts; the last fix and its fences are kept per truck, until it is silent for ``keep_days``."""
    placed = spatial.with_fences(stream, fences).withColumn("inside", F.col("inside").cast("array<bigint>")).select("truck_id", "seq", "ts", "latitude", "longitude", "inside")
    paired = state.previous_in_stream(placed, "truck_id", "ts", "seq", {"inside": "_was"}, keep_days)
    return spatial.transitions(paired.filter(~F.col("late") & F.col("_was").isNotNull()), fences)


def trip_windows(stream: DataFrame, window_seconds: int = 86_400, delay: str = "1 hour") -> DataFrame:
    """Trip statistics per truck and time window (``kind`` trip), given out when the clock has passed the window's end, and
    the fixes that came too late to be counted (``kind`` late). Nothing else happens to a row: it is in one of the two."""
    marked = stream.withColumn("at_micros", F.unix_micros(F.col("ts").cast("timestamp")))
    carry = {"latitude": "_lat", "longitude": "_lon", "at_micros": "before_micros"}
    paired = state.previous_in_stream(marked, "truck_id", "ts", "seq", carry, delay=delay)
    segments = spatial.segments_of(paired.withColumn("_ts", F.timestamp_micros("before_micros")))
    return state.trips_in_stream(segments, dict(stream.dtypes)["truck_id"], window_seconds)


def trips_of(out: DataFrame) -> DataFrame:
    """Finished windows of ``trip_windows``."""
    at = {"window_start": "start_us", "period_start": "first_us", "period_end": "last_us"}
    return out.filter("kind = 'trip'").withColumns({n: F.timestamp_micros(c).cast("timestamp_ntz") for n, c in at.items()}).select(
        "truck_id", *at, "total_distance_km", "average_speed_kmh", "max_speed_kmh", "idle_time_minutes", "coordinates_count"
    )


def late_fixes_of(out: DataFrame) -> DataFrame:
    """Fixes that ``trip_windows`` handed on because they came too late."""
    return out.filter("kind = 'late'").select("truck_id", "seq", F.timestamp_micros("at_us").cast("timestamp_ntz").alias("ts"))


def fraud_vectors(stream: DataFrame, keep_days: float = 400) -> DataFrame:
    """The batch operator's fraud vector for each transaction as it arrives; ``late`` marks those without history."""
    x = state.velocity_in_stream(stream, keep_days)
    whole = {n: F.col(n).cast("bigint") for n in ("tx_count_1h", "tx_count_24h")} | {n: F.col(n).cast("int") for n in ("is_new_merchant", "is_new_device")}
    gap = epoch_seconds("ts") - F.floor(F.col("prev_us") / 1_000_000)
    moved = {
        "distance_from_last": haversine(_given("prev_lat"), _given("prev_lon"), F.col("location_lat"), F.col("location_lon")),
        "time_since_last": F.when(~F.isnan("prev_us"), gap / F.lit(3600.0)),
        "amount_zscore": _given("amount_zscore"),
        "is_high_risk_country": fraud.high_risk_country("location_country"),
    }
    x = fraud.categorical_encoding(fraud.temporal_features(x)).withColumns(whole | moved)
    return x.select("transaction_id", "account_id", *fraud.FEATURES, "ts", "date", "late")


def _given(name: str) -> Column:
    """A number from pandas, where a missing one may stand as not-a-number."""
    return F.when(~F.isnan(name), F.col(name))


def sms_periods(stream: DataFrame, by: str | None = None, period: str = "5 minutes", delay: str = "10 minutes") -> DataFrame:
    """Message metrics per period (update mode), overall or by a column."""
    timed = stream.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp")).withWatermark("event_timestamp", delay)
    w = F.window("event_timestamp", period).alias("w")
    return business.sms_metrics(timed, [w] if by is None else [w, F.col(by)])


def dedup_cheap(stream: DataFrame, key: str, ts: str, delay: str = "24 hours") -> DataFrame:
    """Drop repeats seen within the watermark: holds each key at least ``delay``, maybe longer."""
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    return timed.dropDuplicatesWithinWatermark([key])


def score_batches(stream: DataFrame, score: Callable[[DataFrame], DataFrame], folder: str) -> DataStreamWriter:
    """Score each micro-batch once; write predictions and alerts under its batch id."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        predictions = fraud.score_status(score(batch)).persist()
        try:
            run.write_batch_once(predictions, batch_id, f"{folder}/predictions")
            alerts = predictions.filter("fraud_status <> 'LEGITIMATE'")
            run.write_batch_once(alerts, batch_id, f"{folder}/alerts")
        finally:
            predictions.unpersist()

    return stream.writeStream.foreachBatch(handle)


def archive(stream: DataFrame, folder: str, ts: str = "ts") -> DataStreamWriter:
    """File sink with date folders of each row's own time."""
    parts = time_partition(ts, hour=False)
    return stream.withColumns(parts).writeStream.format("json").option("path", f"{folder}/archive").partitionBy(*parts)


def route_batches(stream: DataFrame, folder: str) -> DataStreamWriter:
    """One pass per micro-batch: each route's rows go to the route's own folder."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        routed = business.route_events(batch)
        routed.write.mode("overwrite").partitionBy("handler").parquet(f"{folder}/routes/batch_id={batch_id}")

    return stream.writeStream.foreachBatch(handle)
