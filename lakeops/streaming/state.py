"""Keyed operators whose state outlives a micro-batch and ends when its key falls silent.

Rows of a key are put in order within a micro-batch. A row that is older than what its
key has already seen is passed on marked ``late`` and does not touch the state. No row is
dropped for its age: the event-time clock (``with_clock``) only drives timers, which remove
the state of keys that have been silent for long. A micro-batch is bounded by the rate
limit that ``run.open_folder`` sets on every source, and with it the rows of one key.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.ipc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lakeops.functions.exprs import epoch_seconds

DAY = 86400

# a stateful operator is also unpickled by a driver-side process that does not see shipped
# files, so the processors travel by value
cloudpickle.register_pickle_by_value(sys.modules[__name__])


# column names here have no leading underscore: the pandas bridge renames such columns


def _ordered(rows: Iterator[pd.DataFrame], *by: str) -> pd.DataFrame:
    return pd.concat(list(rows), ignore_index=True).sort_values(list(by), kind="stable", ignore_index=True)


def _fields(df: DataFrame) -> str:
    return ", ".join(f"`{n}` {t}" for n, t in df.dtypes)


def with_clock(stream: DataFrame, ts: str, delay: str, key: str) -> DataFrame:
    """``stream`` with an event-time clock that moves timers but drops no late row.

    The watermark sits on a copy of ``ts`` that is not handed on, so no operator can compare rows with it. Rows without a
    key and with a time only move the clock (see ``run.closing_row``); they end here.
    """
    timed = stream.withColumn("clock", F.col(ts).cast("timestamp")).withWatermark("clock", delay)
    return timed.filter(F.col("clock").isNull() | F.col(key).isNotNull()).drop("clock")


class _Silence:
    """One event-time timer per key: due when nothing has come for ``keep_us``."""

    def __init__(self, handle: StatefulProcessorHandle, keep_us: int):
        self.handle, self.keep_us = handle, keep_us
        self.due = handle.getValueState("due", "ms bigint")

    def seen(self, last_us: int) -> None:
        at = (last_us + self.keep_us) // 1000 + 1
        if self.due.exists():
            before = self.due.get()[0]
            if before >= at:
                return
            self.handle.deleteTimer(before)
        self.due.update((at,))
        self.handle.registerTimer(at)

    def over(self) -> None:
        self.due.clear()


class _Previous(StatefulProcessor):
    """Hands every row the carried columns of the row before it."""

    def __init__(self, carry: dict[str, str], types: str, keep_us: int):
        self.carry, self.types, self.keep_us = carry, types, keep_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", f"us bigint, tie bigint, {self.types}")
        self.silence = _Silence(handle, self.keep_us)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        df = _ordered(rows, "at_us", "tie_id")
        held = self.last.get() if self.last.exists() else None
        late = np.zeros(len(df), dtype=bool)
        if held is not None:
            late = ((df["at_us"] < held[0]) | ((df["at_us"] == held[0]) & (df["tie_id"] <= held[1]))).to_numpy()
        fresh = df[~late]
        out = df.assign(late=late)
        for i, (old, new) in enumerate(self.carry.items()):
            before = fresh[old].shift(1).astype(object)
            if len(fresh) and held is not None:
                before.iloc[0] = held[2 + i]
            out[new] = before.reindex(df.index)
            out[new] = out[new].where(out[new].notna(), None)
        if len(fresh):
            end = fresh.iloc[-1]
            self.last.update((int(end["at_us"]), int(end["tie_id"]), *[_plain(end[c]) for c in self.carry]))
            self.silence.seen(int(end["at_us"]))
        yield out.drop(columns=["at_us", "tie_id"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.last.clear()
        self.silence.over()
        return iter([])

    def close(self) -> None:
        pass


def _plain(value):
    if isinstance(value, np.ndarray):
        return [int(v) for v in value]
    if isinstance(value, np.generic):
        return value.item()
    return value


def previous_in_stream(stream: DataFrame, key: str, ts: str, tie: str, carry: dict[str, str], keep_days: float = 30, delay: str = "1 hour") -> DataFrame:
    """Stream form of the previous-row operator; ``carry`` maps bigint, double or array<bigint> columns.

    A key that is silent for ``keep_days`` is forgotten; its next row has no row before it.
    """
    types = dict(stream.dtypes)
    held = ", ".join(f"{new} {types[old]}" for old, new in carry.items())
    rows = with_clock(stream, ts, delay, key).withColumns({"at_us": F.unix_micros(F.col(ts).cast("timestamp")), "tie_id": F.col(tie).cast("bigint")})
    schema = f"{_fields(stream)}, late boolean, {held}"
    return rows.groupBy(key).transformWithStateInPandas(_Previous(carry, held, int(keep_days * DAY * 1_000_000)), schema, "append", "eventTime")


# --- windows that close -----------------------------------------------------------


class _Trips(StatefulProcessor):
    """Sums per key and time window. A window is given out once the clock has passed its end; a row that comes after that,
    or after younger rows of its key, is handed on as it is, marked ``late``."""

    SUMS = ("first_us bigint, last_us bigint, metres double, speed double, speeds bigint, top double, idle bigint, fixes bigint")

    def __init__(self, width_us: int):
        self.width_us = width_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "start_us bigint", self.SUMS)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        df = pd.concat(list(rows), ignore_index=True)
        df["start_us"] = df["at_us"] // self.width_us * self.width_us
        past = (df["start_us"] + self.width_us) // 1000 <= timerValues.getCurrentWatermarkInMs()
        late = df[df["late"] | past]
        if len(late):
            yield self._rows(key, "late", late["start_us"], seq=late["tie_id"], at_us=late["at_us"])
        fresh = df.drop(late.index).groupby("start_us")
        speed = fresh["speed_kmh"]
        sums = pd.DataFrame({
            "first": fresh["at_us"].min(), "last": fresh["at_us"].max(), "metres": fresh["segment_m"].sum(), "speed": speed.sum(),
            "speeds": speed.count(), "top": speed.max(), "idle": fresh["idle_us"].sum(), "fixes": fresh.size(),
        })
        for start, new in zip(sums.index, sums.itertuples(index=False), strict=True):
            held = self.open.getValue((int(start),)) if self.open.containsKey((int(start),)) else None
            top = None if new.top != new.top else float(new.top)
            now = (int(new.first), int(new.last), float(new.metres), float(new.speed), int(new.speeds), top, int(new.idle), int(new.fixes))
            if held is not None:
                tops = [x for x in (held[5], top) if x is not None]
                now = (min(held[0], now[0]), max(held[1], now[1]), *(a + b for a, b in zip(held[2:5], now[2:5], strict=True)), max(tops, default=None), held[6] + now[6], held[7] + now[7])
            else:
                self.handle.registerTimer((int(start) + self.width_us) // 1000)
            self.open.updateValue((int(start),), now)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        start = expiredTimerInfo.getExpiryTimeInMs() * 1000 - self.width_us
        if self.open.containsKey((start,)):
            first, last, metres, speed, speeds, top, idle, fixes = self.open.getValue((start,))
            self.open.removeKey((start,))
            yield self._rows(
                key, "trip", pd.Series([start]), first_us=[first], last_us=[last], total_distance_km=[metres / 1000], average_speed_kmh=[speed / speeds if speeds else 0.0],
                max_speed_kmh=[np.nan if top is None else top], idle_time_minutes=[idle / 60_000_000], coordinates_count=[fixes],
            )

    @staticmethod
    def _rows(key, kind: str, start_us: pd.Series, **given) -> pd.DataFrame:
        out = pd.DataFrame({"kind": kind, "start_us": start_us.to_numpy()})
        out.insert(0, "truck_id", key[0])
        for name in TRIP_FIELDS:
            values = given.get(name)
            out[name] = pd.array([None] * len(out) if values is None else list(values), dtype="Float64" if TRIP_FIELDS[name] == "double" else "Int64")
        return out

    def close(self) -> None:
        pass


TRIP_FIELDS = {
    "first_us": "bigint", "last_us": "bigint", "total_distance_km": "double", "average_speed_kmh": "double", "max_speed_kmh": "double",
    "idle_time_minutes": "double", "coordinates_count": "bigint", "seq": "bigint", "at_us": "bigint",
}


def trips_in_stream(segments: DataFrame, key_type: str, width_seconds: int) -> DataFrame:
    """(truck_id, kind, start_us, ...): finished windows (``trip``) and rows that came too late for theirs (``late``).

    ``segments``: truck_id, ts, seq, late, segment_m, idle_us, speed_kmh, from ``previous_in_stream``, whose clock goes on.
    """
    rows = segments.select(
        "truck_id", "late", "segment_m", "idle_us", F.col("speed_kmh").cast("double").alias("speed_kmh"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("at_us"), F.col("seq").cast("bigint").alias("tie_id"),
    )
    schema = f"truck_id {key_type}, kind string, start_us bigint, " + ", ".join(f"{n} {t}" for n, t in TRIP_FIELDS.items())
    return rows.groupBy("truck_id").transformWithStateInPandas(_Trips(width_seconds * 1_000_000), schema, "append", "eventTime")


# --- idempotency ------------------------------------------------------------------


class _AcceptOnce(StatefulProcessor):
    """First request per key and day. A group holds many keys, and its state the last accepted request of each of them, so
    a micro-batch reads and writes a group once, however many keys it has. A timer at the earliest end of a quiet key removes it."""

    def __init__(self, key: str, ttl_us: int):
        self.key, self.ttl_us = key, ttl_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "keys binary, due_ms bigint")

    def _load(self) -> tuple[dict, int | None]:
        if not self.held.exists():
            return {}, None
        data, due = self.held.get()
        table = pa.ipc.open_stream(data).read_all()
        return dict(zip(table["key"].to_pylist(), zip(table["us"].to_pylist(), table["free"].to_pylist(), strict=True), strict=True)), due

    def _store(self, held: dict, before: int | None) -> None:
        due = min(self._due(us) for us, _ in held.values()) if held else None
        if before is not None and before != due:
            self.handle.deleteTimer(before)
        if due is None:
            self.held.clear()
            return
        if before != due:
            self.handle.registerTimer(due)
        table = pa.table({"key": list(held), "us": pa.array([us for us, _ in held.values()], pa.int64()), "free": [free for _, free in held.values()]})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table)
        self.held.update((sink.getvalue().to_pybytes(), due))

    def _due(self, us: int) -> int:
        return (us + self.ttl_us) // 1000 + 1

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        df = _ordered(rows, "at_us", "tie_id")
        held, due = self._load()
        taken = []
        for name, us, failed in zip(df[self.key].tolist(), df["at_us"].tolist(), df["is_failed"].tolist(), strict=True):
            last, free = held.get(name, (None, True))
            take = free or us - last > self.ttl_us
            if take:
                held[name] = us, failed
            taken.append(take)
        self._store(held, due)
        yield df.assign(accepted=taken).drop(columns=["at_us", "tie_id", "is_failed", "group_no"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held, _ = self._load()
        at = expiredTimerInfo.getExpiryTimeInMs()
        now = max(at, timerValues.getCurrentWatermarkInMs())
        self._store({name: kept for name, kept in held.items() if self._due(kept[0]) > now}, at)
        return iter([])

    def close(self) -> None:
        pass


def accept_once_in_stream(stream: DataFrame, key: str, ts: str, row_id: str, failed, ttl_seconds: int = DAY, delay: str = "1 hour", groups: int = 4096) -> DataFrame:
    """Stream form of the idempotency rule, exact also across restarts; every row comes out, however late it is.

    Keys share ``groups`` groups of state; like the number of state partitions, it stays as it was at the first start.
    """
    schema = f"{_fields(stream)}, accepted boolean"
    rows = with_clock(stream, ts, delay, key).withColumns({
        "at_us": F.unix_micros(F.col(ts).cast("timestamp")), "tie_id": F.col(row_id).cast("bigint"), "is_failed": F.coalesce(failed, F.lit(False)),
        "group_no": F.pmod(F.xxhash64(key), F.lit(groups)),
    })
    return rows.groupBy("group_no").transformWithStateInPandas(_AcceptOnce(key, ttl_seconds * 1_000_000), schema, "append", "eventTime")


#: Amounts are added up as whole numbers of 1e-8, so taking one out leaves nothing behind; amounts of a million and more are
#: kept to 1e-4, and those of 1e15 and more give no deviation, as in the batch operator.
UNIT, COARSE, LARGE, HUGE = 100_000_000, 10_000, 1e6, 1e15


def _units(amount: float) -> int:
    return round(amount * UNIT) if abs(amount) < LARGE else round(amount * COARSE) * (UNIT // COARSE)


class _Velocity(StatefulProcessor):
    """Account history of 30 days, one entry per second, the last fix, and the merchants and devices seen with the time of
    their last use. A group holds many accounts, and its state all that is known of them, so a micro-batch reads and writes a
    group once and its rows are measured together. A silent account is forgotten after ``keep_us``, by a timer at the earliest
    end of one in the group, and so is a merchant or device that was not used for it."""

    SHIFT = 40  # a place is the number of an account in the batch, then 40 bits of seconds

    def __init__(self, keep_us: int):
        self.keep_us = keep_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "accounts binary, due_ms bigint")

    def _load(self) -> tuple[dict, int | None]:
        """(last row's time, latitude and longitude; seconds of the history and their five sums; merchants, devices, last sweep) by account."""
        if not self.held.exists():
            return {}, None
        data, due = self.held.get()
        return pickle.loads(data), due

    def _store(self, held: dict, before: int | None) -> None:
        due = min(self._due(known[0]) for known in held.values()) if held else None
        if before is not None and before != due:
            self.handle.deleteTimer(before)
        if due is None:
            self.held.clear()
            return
        if before != due:
            self.handle.registerTimer(due)
        self.held.update((pickle.dumps(held, protocol=5), due))

    def _due(self, us: int) -> int:
        return (us + self.keep_us) // 1000 + 1

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held, due = self._load()
        df = pd.concat(list(rows), ignore_index=True)
        df["account_no"], names = pd.factorize(df["account_id"])
        df = df.sort_values(["account_no", "at_us", "transaction_id"], kind="stable", ignore_index=True)
        names = names.tolist()
        known = [held.get(name) for name in names]
        before = np.array([x[0] if x else np.iinfo("int64").min for x in known])
        late = df["at_us"].to_numpy() < before[df["account_no"].to_numpy()]
        ok = df[~late]
        no = ok["account_no"].to_numpy(dtype="int64")

        amount = ok["amount"].to_numpy(dtype="float64")
        given = np.isfinite(amount)
        units = np.array([_units(x) if k else 0 for x, k in zip(amount, given, strict=True)], dtype=object)
        huge = given & (np.abs(amount) >= HUGE)
        own = {"n": np.ones(len(ok), dtype=object), "k": given.astype(int).astype(object), "t": units, "q": np.where(huge, 0, units * units) if len(ok) else units, "h": huge.astype(int).astype(object)}
        now = ok["at_second"].to_numpy(dtype="int64")
        old_no = np.repeat(np.arange(len(names)), [len(x[3]) if x else 0 for x in known])
        old_sec = np.array([s for x in known if x for s in x[3]], dtype="int64")
        first = min(now.min(initial=np.iinfo("int64").max), old_sec.min(initial=np.iinfo("int64").max))

        def place(account: np.ndarray, sec: np.ndarray) -> np.ndarray:
            return (account << self.SHIFT) + np.maximum(sec - first, -1)

        here, there = place(no, now), place(old_no, old_sec)
        at = np.unique(np.concatenate([there, here]))
        sums, totals = {}, {}
        for i, name in enumerate("nktqh"):
            total = np.zeros(len(at), dtype=object)
            total[np.searchsorted(at, there)] += np.array([v for x in known if x for v in x[4 + i]], dtype=object)
            np.add.at(total, np.searchsorted(at, here), own[name])
            totals[name], sums[name] = total, np.concatenate([np.zeros(1, dtype=object), np.cumsum(total)])

        def window(column: str, back: int, skip: int) -> np.ndarray:
            return sums[column][np.searchsorted(at, place(no, now - skip), "right")] - sums[column][np.searchsorted(at, place(no, now - back), "left")]

        def money(numbers) -> np.ndarray:
            return np.array([x / UNIT for x in numbers], dtype="float64")

        k30, t30, q30, h30 = (window(c, 30 * DAY, 1) for c in "ktqh")
        mean = np.array([t / (k * UNIT) if k else 0.0 for k, t in zip(k30, t30, strict=True)], dtype="float64")
        std = np.array([(max(k * q - t * t, 0) / (k * (k - 1))) ** 0.5 / UNIT if k > 1 and not h else 1.0 for k, t, q, h in zip(k30, t30, q30, h30, strict=True)], dtype="float64")
        score = np.where(std > 0, np.divide(amount - mean, std, out=np.zeros(len(ok)), where=std > 0), 0.0)

        starts = np.flatnonzero(np.diff(no, prepend=-1))
        ends = np.append(starts[1:], len(no)) - 1 if len(no) else starts

        def previous(column: str, field: int) -> np.ndarray:
            values = ok[column].to_numpy(dtype="float64")
            out = np.concatenate([[np.nan], values])[:-1]
            out[starts] = [known[i][field] if known[i] and known[i][field] is not None else np.nan for i in no[starts]]
            return out

        seen = [({**x[9]}, {**x[10]}) if x else ({}, {}) for x in known]
        out = df.drop(columns=["at_us", "at_second", "account_no", "group_no"]).assign(late=late)
        new = {
            "tx_count_1h": window("n", 3600, 0).astype("float64"), "tx_count_24h": window("n", DAY, 0).astype("float64"),
            "tx_amount_1h": money(window("t", 3600, 0)), "tx_amount_24h": money(window("t", DAY, 0)),
            "avg_amount_30d": mean, "std_amount_30d": std, "amount_zscore": score,
            "prev_lat": previous("location_lat", 1), "prev_lon": previous("location_lon", 2), "prev_us": previous("at_us", 0),
            "is_new_merchant": self._first_time(ok, "merchant_id", no, [m for m, _ in seen]),
            "is_new_device": self._first_time(ok, "device_id", no, [d for _, d in seen]),
        }
        for name, values in new.items():
            out[name] = pd.Series(values, index=ok.index, dtype="float64").reindex(df.index)
        if len(ok):
            last = ok.iloc[ends]
            kept_from = np.searchsorted(at, place(no[ends], now[ends] - 30 * DAY), "left")
            kept_to = np.searchsorted(at, no[ends] + 1 << self.SHIFT, "left")
            secs = (at & ((1 << self.SHIFT) - 1)) + first
            lat, lon = (last[c].astype("object").where(last[c].notna(), None).tolist() for c in ("location_lat", "location_lon"))
            for j, (i, us, a, b) in enumerate(zip(no[ends].tolist(), last["at_us"].tolist(), kept_from.tolist(), kept_to.tolist(), strict=True)):
                swept = self._sweep(us, known[i][11] if known[i] else None, seen[i])
                held[names[i]] = (us, lat[j], lon[j], secs[a:b].tolist(), *(totals[c][a:b].tolist() for c in "nktqh"), *seen[i], swept)
            self._store(held, due)
        yield out

    def _sweep(self, now_us: int, swept: int | None, seen: tuple[dict, dict]) -> int:
        """Once per ``keep_us``, drop the merchants and devices that were not used for that long."""
        if swept is not None and now_us - swept < self.keep_us:
            return swept
        if swept is not None:
            for values in seen:
                for value in [v for v, us in values.items() if us < now_us - self.keep_us]:
                    del values[value]
        return now_us

    @staticmethod
    def _first_time(rows: pd.DataFrame, column: str, account: np.ndarray, seen: list[dict]) -> np.ndarray:
        """1 where a value stands for the first time with its account; ``seen`` gets its time."""
        flags = np.zeros(len(rows))
        for i, (no, value, known, us) in enumerate(zip(account.tolist(), rows[column].tolist(), rows[column].notna().tolist(), rows["at_us"].tolist(), strict=True)):
            if known:
                flags[i] = value not in seen[no]
                seen[no][value] = us
        return flags

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held, _ = self._load()
        at = expiredTimerInfo.getExpiryTimeInMs()
        now = max(at, timerValues.getCurrentWatermarkInMs())
        self._store({name: known for name, known in held.items() if self._due(known[0]) > now}, at)
        return iter([])

    def close(self) -> None:
        pass


VELOCITY_FIELDS = [
    "tx_count_1h", "tx_count_24h", "tx_amount_1h", "tx_amount_24h", "avg_amount_30d", "std_amount_30d", "amount_zscore",
    "prev_lat", "prev_lon", "prev_us", "is_new_merchant", "is_new_device",
]


def velocity_in_stream(stream: DataFrame, keep_days: float = 400, delay: str = "1 hour", groups: int = 4096) -> DataFrame:
    """Transactions with the history of their account as they arrive; an account silent for ``keep_days`` starts anew.

    A late transaction comes out marked, without history. Missing amounts count as transactions and as nothing else.
    Accounts share ``groups`` groups of state; like the number of state partitions, it stays as it was at the first start.
    """
    rows = with_clock(stream, "ts", delay, "account_id").withColumns(
        {"at_second": epoch_seconds("ts"), "at_us": F.unix_micros(F.col("ts").cast("timestamp")), "group_no": F.pmod(F.xxhash64("account_id"), F.lit(groups))}
    )
    schema = f"{_fields(stream)}, late boolean, " + ", ".join(f"{n} double" for n in VELOCITY_FIELDS)
    return rows.groupBy("group_no").transformWithStateInPandas(_Velocity(int(keep_days * DAY * 1_000_000)), schema, "append", "eventTime")
