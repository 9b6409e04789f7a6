"""Transaction features, weak labels, scoring rules and alerts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.functions import fixed
from lakeops.functions.exprs import c, epoch_seconds, hash_fraction, haversine, non_null_items, ratio
from lakeops.operators import timeline as tl

KEY = ["account_id"]
ORDER = ["ts", "transaction_id"]
HOUR, DAY = 3600, 86400
WINDOWS = {"w1h": (HOUR, 0), "w24h": (DAY, 0), "w30d": (30 * DAY, 1)}
PREVIOUS = {"location_lat": "_prev_lat", "location_lon": "_prev_lon", "ts": "_prev_ts"}
FIRSTS = {"merchant_id": "is_new_merchant", "device_id": "is_new_device"}

FEATURES = [
    "amount", "hour_of_day", "day_of_week", "is_weekend", "tx_count_1h", "tx_count_24h", "tx_amount_1h",
    "tx_amount_24h", "avg_amount_30d", "std_amount_30d", "amount_zscore", "distance_from_last", "time_since_last",
    "is_new_merchant", "is_new_device", "is_high_risk_country", "channel_encoded", "tx_type_encoded",
]


def temporal_features(df: DataFrame, ts: str = "ts") -> DataFrame:
    weekday = F.dayofweek(ts)
    hour = F.hour(ts)
    return df.withColumns(
        {
            "hour_of_day": hour,
            "day_of_week": weekday,
            "is_weekend": F.when(weekday.isin(1, 7), 1).otherwise(0),
            "is_night": F.when((hour >= 22) | (hour <= 5), 1).otherwise(0),
            "date": F.to_date(ts),
        }
    )


def code_of(value: Column | str, codes: dict[str, int], unknown: int = fixed.UNKNOWN_CODE) -> Column:
    table = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])
    return F.coalesce(F.try_element_at(table, c(value)), F.lit(unknown))


def categorical_encoding(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "channel_encoded": code_of("channel", fixed.CHANNEL_CODES),
            "tx_type_encoded": code_of("transaction_type", fixed.TXN_TYPE_CODES),
        }
    )


def _window_columns(prefix: str, label: str) -> dict[str, Column]:
    return {
        f"tx_count_{label}": F.col(f"{prefix}_n").cast("bigint"),
        f"tx_amount_{label}": F.col(f"{prefix}_sum"),
    }


def _thirty_day_columns() -> dict[str, Column]:
    mean = ratio(F.col("w30d_sum"), F.col("w30d_k"))
    std = F.coalesce("w30d_std", F.lit(1.0))
    return {
        "avg_amount_30d": mean,
        "std_amount_30d": std,
        "amount_zscore": F.when(std > 0, (F.col("amount") - mean) / std).otherwise(F.lit(0.0)),
    }


def _movement_columns() -> dict[str, Column]:
    gap = epoch_seconds("ts") - epoch_seconds("_prev_ts")
    return {
        "distance_from_last": haversine(F.col("_prev_lat"), F.col("_prev_lon"), F.col("location_lat"), F.col("location_lon")),
        "time_since_last": gap / F.lit(3600.0),
    }


def high_risk_country(country: Column | str) -> Column:
    return F.when(c(country).isin(*fixed.HIGH_RISK_COUNTRIES), 1).otherwise(0)


def _trailing(windows: dict[str, tuple[int, int]]) -> tl.Trailing:
    return tl.Trailing(KEY, "ts", "amount", windows, spread=[w for w in windows if w == "w30d"])


def velocity_features(df: DataFrame, floor: int = tl.HOT_ROWS) -> DataFrame:
    """Count and amount of the last hour and day, current second included."""
    t = _trailing({w: WINDOWS[w] for w in ("w1h", "w24h")})
    out = tl.by_heat(df, KEY, t.plain, t.sliced, floor)
    return out.withColumns(_window_columns("w1h", "1h") | _window_columns("w24h", "24h")).drop(*t.columns())


def statistical_features(df: DataFrame, floor: int = tl.HOT_ROWS) -> DataFrame:
    """Mean, deviation and z-score against the last 30 days, current second excluded."""
    t = _trailing({"w30d": WINDOWS["w30d"]})
    out = tl.by_heat(df, KEY, t.plain, t.sliced, floor)
    return out.withColumns(_thirty_day_columns()).drop(*t.columns())


def distance_features(df: DataFrame, floor: int = tl.HOT_ROWS) -> DataFrame:
    out = tl.previous_row(df, KEY, ORDER, PREVIOUS, floor)
    return out.withColumns(_movement_columns()).drop(*PREVIOUS.values())


def behavioral_features(df: DataFrame, floor: int = tl.HOT_ROWS) -> DataFrame:
    out = tl.by_heat(
        df, KEY,
        lambda d: tl.first_seen_plain(d, KEY, ORDER, FIRSTS),
        lambda d: tl.first_seen_sliced(d, KEY, ORDER, FIRSTS),
        floor,
    )
    return out.withColumn("is_high_risk_country", high_risk_country("location_country"))


def fraud_features(df: DataFrame, floor: int = tl.HOT_ROWS) -> DataFrame:
    """Full feature vector; ordinary accounts cost one exchange."""
    t = _trailing(WINDOWS)

    def plain(d: DataFrame) -> DataFrame:
        return tl.first_seen_plain(tl.previous_plain(t.plain(d), KEY, ORDER, PREVIOUS), KEY, ORDER, FIRSTS)

    def sliced(d: DataFrame) -> DataFrame:
        return tl.first_seen_sliced(tl.previous_sliced(t.sliced(d), KEY, ORDER, PREVIOUS), KEY, ORDER, FIRSTS)

    out = tl.by_heat(df, KEY, plain, sliced, floor)
    out = categorical_encoding(temporal_features(out)).withColumns(
        _window_columns("w1h", "1h") | _window_columns("w24h", "24h") | _thirty_day_columns() | _movement_columns()
        | {"is_high_risk_country": high_risk_country("location_country")}
    )
    return out.select("transaction_id", "account_id", *FEATURES, "ts", "date")


def features_for_date(df: DataFrame, date: str, floor: int = tl.HOT_ROWS) -> DataFrame:
    """Feature vectors of one day, computed with the history before it; gaps become 0."""
    # first-seen flags and the previous row need the whole history, not just 30 days
    history = df.filter(F.col("ts") < F.to_timestamp_ntz(F.lit(date)) + F.expr("INTERVAL 1 DAY"))
    out = fraud_features(history, floor).filter(F.col("date") == F.lit(date).cast("date"))
    return out.fillna(0.0, FEATURES)


# --- extended vector --------------------------------------------------------------


def distinct_in_window(df: DataFrame, key: Sequence[str], ts: str, value: str, windows: dict[str, int], floor: int = tl.HOT_ROWS) -> DataFrame:
    """Distinct ``value`` in [t - back, t] per key and second: (key, second, one column per window).

    A value counts from its occurrence until ``back`` seconds after the last one, so
    each stay adds one entry and one exit to a running sum.
    """
    seen = df.select(*key, F.col(value).alias("_val"), epoch_seconds(ts).alias("_s")).distinct()
    w = Window.partitionBy(*key, "_val").orderBy("_s")
    seen = seen.withColumns({"_before": F.lag("_s").over(w), "_after": F.lead("_s").over(w)})
    names = list(windows)

    def event(at: Column, name: str | None, delta: int) -> Column:
        return F.struct(at.alias("at"), *[F.lit(delta if n == name else 0).alias(n) for n in names])

    real = F.col("_val").isNotNull()
    items = [event(F.col("_s"), None, 0)]
    for name, back in windows.items():
        fresh = real & (F.col("_before").isNull() | (F.col("_before") + back < F.col("_s")))
        gone = real & (F.col("_after").isNull() | (F.col("_after") > F.col("_s") + back))
        items.append(F.when(fresh, event(F.col("_s"), name, 1)))
        items.append(F.when(gone, event(F.col("_s") + back + 1, name, -1)))
    events = seen.select(*key, F.explode(non_null_items(items)).alias("_e"))
    changes = events.groupBy(*key, F.col("_e.at").alias("_s")).agg(*[F.sum(f"_e.{n}").alias(n) for n in names])
    totals = tl.running_totals(changes.select(*key, "_s", *[F.col(n).alias(f"_{n}") for n in names]), key, ["_s"], {n: F.col(f"_{n}") for n in names}, floor)
    return totals.select(*key, "_s", *names)


def extremes_of_days(df: DataFrame, key: Sequence[str], ts: str, value: str, days: int) -> DataFrame:
    """Minimum and maximum over the ``days`` days before each second, current second excluded.

    The window is the start of the current day, the end of the day ``days`` ago and the
    full days between; each part is found within (key, day), never over a whole key.
    """
    back = days * DAY
    seconds = df.groupBy(*key, epoch_seconds(ts).alias("_s")).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    shifts = F.explode(F.array(F.lit(0), F.lit(back))).alias("_shift")
    both = seconds.select("*", shifts).withColumn("_at", F.col("_s") + F.col("_shift"))
    both = both.withColumn("_day", F.floor(F.col("_at") / DAY))
    own, old = F.col("_shift") == 0, F.col("_shift") > 0
    so_far = Window.partitionBy(*key, "_day").orderBy("_at").rangeBetween(Window.unboundedPreceding, -1)
    still = Window.partitionBy(*key, "_day").orderBy(F.desc("_at")).rangeBetween(Window.unboundedPreceding, 0)
    parts = both.withColumns(
        {
            "_lo1": F.min(F.when(own, F.col("_lo"))).over(so_far), "_hi1": F.max(F.when(own, F.col("_hi"))).over(so_far),
            "_lo2": F.min(F.when(old, F.col("_lo"))).over(still), "_hi2": F.max(F.when(old, F.col("_hi"))).over(still),
        }
    ).filter(own)
    full = Window.partitionBy(*key).orderBy("_day").rangeBetween(-(days - 1), -1)
    daily = (
        seconds.groupBy(*key, F.floor(F.col("_s") / DAY).alias("_day"))
        .agg(F.min("_lo").alias("_dlo"), F.max("_hi").alias("_dhi"))
        .select(*key, "_day", F.min("_dlo").over(full).alias("_lo3"), F.max("_dhi").over(full).alias("_hi3"))
    )
    joined = tl.join_null_safe(parts, daily, [*key, "_day"])
    return joined.select(
        *key, "_s",
        F.least("_lo1", "_lo2", "_lo3").alias("min_value"),
        F.greatest("_hi1", "_hi2", "_hi3").alias("max_value"),
    )


def home_locations(df: DataFrame) -> DataFrame:
    """Most frequent location per account; ties go to the smallest coordinates."""
    places = df.filter(F.col("location_lat").isNotNull() & F.col("location_lon").isNotNull())
    visits = places.groupBy("account_id", "location_lat", "location_lon").agg(F.count(F.lit(1)).alias("n"))
    best = F.max_by(F.struct("location_lat", "location_lon"), F.struct("n", -F.col("location_lat"), -F.col("location_lon")))
    return visits.groupBy("account_id").agg(best.alias("home")).select("account_id", "home.*").toDF("account_id", "home_lat", "home_lon")


def fraud_features_ext(df: DataFrame, floor: int = tl.HOT_ROWS) -> DataFrame:
    """Wider vector: 6-hour and 7-day windows, distinct merchants and places, extremes, home distance, speed."""
    t = _trailing({"w6h": (6 * HOUR, 0), "w7d": (7 * DAY, 0)})

    def plain(d: DataFrame) -> DataFrame:
        return tl.previous_plain(t.plain(d), KEY, ORDER, PREVIOUS)

    def sliced(d: DataFrame) -> DataFrame:
        return tl.previous_sliced(t.sliced(d), KEY, ORDER, PREVIOUS)

    placed = df.withColumn("_place", F.struct("location_lat", "location_lon"))
    per_second = [
        distinct_in_window(df, KEY, "ts", "merchant_id", {"unique_merchants_7d": 7 * DAY, "unique_merchants_30d": 30 * DAY}, floor),
        distinct_in_window(placed, KEY, "ts", "_place", {"unique_locations_7d": 7 * DAY}, floor),
        extremes_of_days(df, KEY, "ts", "amount", 30),
    ]
    rows = tl.by_heat(df, KEY, plain, sliced, floor).withColumn("_s", epoch_seconds("ts"))
    rows = reduce(lambda a, b: tl.join_null_safe(a, b, [*KEY, "_s"]), per_second, rows)
    rows = tl.join_null_safe(rows, home_locations(df), KEY)
    moved = rows.withColumns(_movement_columns())
    return moved.withColumns(
        _window_columns("w6h", "6h") | _window_columns("w7d", "7d")
    ).select(
        "transaction_id", "account_id", "tx_count_6h", "tx_count_7d", "tx_amount_6h", "tx_amount_7d",
        F.coalesce("unique_merchants_7d", F.lit(0)).alias("unique_merchants_7d"),
        F.coalesce("unique_merchants_30d", F.lit(0)).alias("unique_merchants_30d"),
        F.coalesce("unique_locations_7d", F.lit(0)).alias("unique_locations_7d"),
        F.coalesce("min_value", F.lit(0.0)).alias("min_amount_30d"),
        F.coalesce("max_value", F.lit(0.0)).alias("max_amount_30d"),
        haversine(F.col("home_lat"), F.col("home_lon"), F.col("location_lat"), F.col("location_lon")).alias("distance_from_home"),
        ratio(F.col("distance_from_last"), F.col("time_since_last")).alias("velocity_km_per_hour"),
    )


# --- labels, scores, alerts -------------------------------------------------------


def weak_labels(features: DataFrame, flip: float = 0.0, seed: str = "labels") -> DataFrame:
    """Rule labels; a repeatable share ``flip`` of them is inverted."""
    top = fixed.WEAK_LABEL_LIMITS
    risky = (
        (F.col("amount_zscore") > top["amount_zscore"])
        | ((F.col("is_new_merchant") == 1) & (F.col("amount") > top["new_merchant_amount"]))
        | ((F.col("distance_from_last") > top["distance_from_last"]) & (F.col("time_since_last") < top["time_since_last"]))
        | (F.col("tx_count_1h") > top["tx_count_1h"])
    )
    label = F.when(risky, 1).otherwise(0)
    if flip > 0:
        label = F.when(hash_fraction("transaction_id", seed) < flip, 1 - label).otherwise(label)
    return features.withColumn("is_fraud", label)


def score_status(df: DataFrame, score: str = "fraud_score", fraud: float = 0.7, suspicious: float = 0.4, confidence: str = "piecewise") -> DataFrame:
    """Status from two thresholds; confidence is ``piecewise`` or the ``centre`` distance 2*|score-0.5|."""
    s = F.col(score)
    status = F.when(s >= fraud, "FRAUDULENT").when(s >= suspicious, "SUSPICIOUS").otherwise("LEGITIMATE")
    if confidence == "centre":
        sure = F.abs(s - 0.5) * 2
    else:
        sure = F.when(s >= fraud, s).when(s >= suspicious, F.abs(s - suspicious) / (fraud - suspicious)).otherwise(1.0 - s)
    return df.withColumns({"fraud_status": status, "confidence": sure})


def risk_factors(df: DataFrame) -> DataFrame:
    return df.withColumn("risk_factors", non_null_items(F.when(F.expr(condition), F.lit(name)) for name, condition in fixed.RISK_FACTORS.items()))


def _by_severity(score: Column, position: int) -> Column:
    out = None
    for step in fixed.SEVERITY_STEPS:
        out = (F if out is None else out).when(score >= step[0], F.lit(step[position]))
    return out.otherwise(F.lit(fixed.LOWEST_SEVERITY[position - 1]))


def alert_type(factors: Column | str) -> Column:
    """Type of the first factor that names one, in factor order."""

    def lookup(factor: Column) -> Column:
        hits = [F.when(F.contains(F.lower(factor), F.lit(k)), F.lit(v)) for k, v in fixed.ALERT_TYPES.items()]
        return F.coalesce(*hits)

    found = F.filter(F.transform(c(factors), lookup), lambda x: x.isNotNull())
    return F.coalesce(F.get(found, F.lit(0)), F.lit(fixed.DEFAULT_ALERT_TYPE))


def fraud_alerts(predictions: DataFrame) -> DataFrame:
    """Alerts for fraudulent and suspicious rows, with severity, action and message."""
    top = F.array_join(F.slice("risk_factors", 1, 3), ", ")
    summary = F.when(F.size("risk_factors") > 0, top).otherwise(F.lit("Pattern anomaly"))
    flagged = predictions.filter(F.col("fraud_status").isin("FRAUDULENT", "SUSPICIOUS"))
    return flagged.select(
        F.concat(F.lit("alert-"), F.col("transaction_id").cast("string")).alias("alert_id"),
        "transaction_id", "account_id", "fraud_score", "fraud_status",
        alert_type("risk_factors").alias("alert_type"),
        _by_severity(F.col("fraud_score"), 1).alias("severity"),
        _by_severity(F.col("fraud_score"), 2).alias("recommended_action"),
        F.concat(
            F.lit("Potential fraud detected: "), summary, F.lit(". Score: "),
            F.format_string("%.2f", "fraud_score"),
        ).alias("message"),
        "amount",
        F.lit(False).alias("acknowledged"),
    )


def fraud_stats(predictions: DataFrame) -> DataFrame:
    """Dashboard counts of a prediction table in one pass."""
    status = F.col("fraud_status")
    alerted = status.isin("FRAUDULENT", "SUSPICIOUS")
    return predictions.agg(
        F.count(F.lit(1)).alias("total_predictions"),
        F.count_if(status == "FRAUDULENT").alias("fraud_detected"),
        F.count_if(status == "SUSPICIOUS").alias("suspicious_detected"),
        F.count_if(alerted).alias("total_alerts"),
        F.count_if(alerted & ~F.col("acknowledged")).alias("unacknowledged_alerts"),
    ).withColumn("fraud_rate", ratio(F.col("fraud_detected"), F.col("total_predictions")))
