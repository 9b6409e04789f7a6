"""Ordered per-key operators that survive a key holding a large share of the rows.

A window over one key runs in one task. Keys with a fair share of the rows take that
plan. The few larger ones ("hot") are cut along their time axis: each slice is its own
group, and a per-slice summary, built with map-side combine, carries what a slice needs
from the slices before it. Both plans return the same rows, nulls included.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions.exprs import epoch_seconds
from lakeops.session import materialize

#: Rows of a key that one task may hold; a key with more is hot, whatever its share of the table.
HOT_ROWS = 250_000
#: Rows of a slice of a hot key.
SLICE_ROWS = 250_000
#: Rows of ordinary keys that one task shall get.
TASK_ROWS = 100_000
#: Hot keys up to which the list is sent to every executor; a longer one is joined by shuffle.
BROADCAST_KEYS = 10_000


def hot_keys(df: DataFrame, key: Sequence[str], floor: int = HOT_ROWS) -> DataFrame:
    """Keys with more than ``floor`` rows, as columns ``_hot_<key>``."""
    return _hot(_key_counts(df, key), key, floor)


def _key_counts(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))


def _hot(counts: DataFrame, key: Sequence[str], floor: int) -> DataFrame:
    return counts.filter(F.col("_n") > floor).select(*[F.col(k).alias(f"_hot_{k}") for k in key])


def by_heat(
    df: DataFrame,
    key: Sequence[str],
    plain: Callable[[DataFrame], DataFrame],
    sliced: Callable[[DataFrame], DataFrame],
    floor: int = HOT_ROWS,
) -> DataFrame:
    """``plain`` on ordinary keys, ``sliced`` on hot ones.

    One count per key, written as a table, decides when the plan is made: a table without
    hot keys gets the plain plan and nothing else. Ordinary keys are dealt to as many tasks as
    their rows need, so the memory of a task does not grow with the table.
    """
    counts = materialize(_key_counts(df, key), "key-counts")
    found = _hot(counts, key, floor)
    count, rows = counts.agg(F.count_if(F.col("_n") > floor), F.sum(F.when(F.col("_n") <= floor, F.col("_n")))).first()
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-(rows or 0) // TASK_ROWS))
    if not count:
        return plain(df.repartition(tasks, *key))
    hot = F.broadcast(found) if count <= BROADCAST_KEYS else found
    same = F.lit(True)
    for k in key:
        same = same & df[k].eqNullSafe(hot[f"_hot_{k}"])
    return plain(df.join(hot, same, "left_anti").repartition(tasks, *key)).unionByName(sliced(df.join(hot, same, "left_semi")))


def join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join in which a null key meets a null key; keeps the left key columns."""
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") if k in on else F.col(k) for k in right.columns])
    cond = F.lit(True)
    for k in on:
        cond = cond & left[k].eqNullSafe(renamed[f"_r_{k}"])
    return left.join(renamed, cond, how).drop(*[f"_r_{k}" for k in on])


def with_slice(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Add ``_slice``: the rows in the order of (key, order), cut into ranges of about ``SLICE_ROWS`` rows.

    ``order`` ends with a unique column, so rows of one moment are divided as well. The
    number of ranges follows the rows. The table is written once, so every reader sees the
    same cuts.
    """
    ranges = max(1, -(-df.count() // SLICE_ROWS))
    return materialize(df.repartitionByRange(ranges, *key, *order).withColumn("_slice", F.spark_partition_id()), "slices")


# --- previous row -----------------------------------------------------------------


def previous_plain(df: DataFrame, key: Sequence[str], order: Sequence[str], carry: dict[str, str]) -> DataFrame:
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumns({new: F.lag(old).over(w) for old, new in carry.items()})


def previous_sliced(df: DataFrame, key: Sequence[str], order: Sequence[str], carry: dict[str, str]) -> DataFrame:
    base = with_slice(df, key, order)
    row = F.struct(*[F.col(o).alias(n) for o, n in carry.items()])
    last = base.groupBy(*key, "_slice").agg(F.max_by(row, F.struct(*order)).alias("_last"))
    handed_on = last.select(
        *key, F.lead("_slice").over(Window.partitionBy(*key).orderBy("_slice")).alias("_slice"), F.col("_last").alias("_from_before")
    ).filter(F.col("_slice").isNotNull())
    w = Window.partitionBy(*key, "_slice").orderBy(*order)
    joined = join_null_safe(base, handed_on, [*key, "_slice"])
    prev = joined.withColumn("_prev", F.coalesce(F.lag(row).over(w), F.col("_from_before")))
    return prev.withColumns({n: F.col("_prev")[n] for n in carry.values()}).drop("_slice", "_prev", "_from_before")


def previous_row(df: DataFrame, key: Sequence[str], order: Sequence[str], carry: dict[str, str], floor: int = HOT_ROWS) -> DataFrame:
    """Columns of the row before this one in its key; ``carry`` maps column -> new name.

    ``order`` starts with a timestamp and ends with a unique column.
    """
    return by_heat(
        df, key,
        lambda d: previous_plain(d, key, order, carry),
        lambda d: previous_sliced(d, key, order, carry),
        floor,
    )


# --- running totals ---------------------------------------------------------------


def running_plain(df: DataFrame, key: Sequence[str], order: Sequence[str], sums: dict[str, Column]) -> DataFrame:
    w = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({name: F.sum(expr).over(w) for name, expr in sums.items()})


def running_sliced(df: DataFrame, key: Sequence[str], order: Sequence[str], sums: dict[str, Column]) -> DataFrame:
    base = with_slice(df.withColumns({f"_in_{n}": e for n, e in sums.items()}), key, order)
    totals = base.groupBy(*key, "_slice").agg(*[F.sum(f"_in_{n}").alias(f"_sum_{n}") for n in sums])
    before = Window.partitionBy(*key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*key, "_slice", *[F.sum(f"_sum_{n}").over(before).alias(f"_before_{n}") for n in sums])
    inside = Window.partitionBy(*key, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    joined = join_null_safe(base, offsets, [*key, "_slice"])
    # null only where neither this slice so far nor an earlier one has a value
    out = {}
    for n in sums:
        kind = totals.schema[f"_sum_{n}"].dataType
        # one digit is left for the addition, so a decimal keeps all of its places
        wide = T.DecimalType(37, kind.scale) if isinstance(kind, T.DecimalType) and kind.precision == 38 else kind
        within, before = F.sum(f"_in_{n}").over(inside).cast(wide), F.col(f"_before_{n}").cast(wide)
        out[n] = F.coalesce(within + before, within, before).cast(kind)
    return joined.withColumns(out).select(*df.columns, *sums)


def running_totals(df: DataFrame, key: Sequence[str], order: Sequence[str], sums: dict[str, Column], floor: int = HOT_ROWS) -> DataFrame:
    """Inclusive running sums per key in a total order."""
    return by_heat(
        df, key,
        lambda d: running_plain(d, key, order, sums),
        lambda d: running_sliced(d, key, order, sums),
        floor,
    )


# --- trailing time windows --------------------------------------------------------


class Trailing:
    """Row count, count and sum of a value over [t - back, t - skip] seconds, per key; its deviation where asked.

    A row enters each window once and leaves it once, so the frame is a running sum over
    entries and exits: linear in the rows however wide the window. Sums are kept in whole
    units, so taking a value out leaves nothing behind: values below a million in units of
    1e-8, larger ones in units of 1e-4. Values of 1e15 and more (beyond the exact whole
    numbers of a double in these units) count and add up, but give no deviation.
    """

    FINE, COARSE, LARGE, HUGE = 100_000_000, 10_000, 1_000_000, 1e15

    def __init__(self, key: Sequence[str], ts: str, value: str, windows: dict[str, tuple[int, int]], spread: Sequence[str] = ()):
        self.key, self.ts, self.value, self.windows, self.spread = list(key), ts, value, windows, set(spread)
        # event codes: 0 is the row itself, then one entry and one exit code per window;
        # a window that includes the current second is entered by the row itself
        self.codes = {w: (0 if skip == 0 else 2 * i + 1, 2 * i + 2) for i, (w, (_, skip)) in enumerate(windows.items())}

    def _parts(self, window: str) -> dict[str, str]:
        """Running sum of a window -> column of the events that it adds up."""
        more = {"kl": "_kl", "qf": "_qf", "qc": "_qc", "kh": "_kh"} if window in self.spread else {}
        return {"n": "_n", "k": "_k", "vf": "_vf", "vc": "_vc"} | more

    def _inputs(self) -> list[str]:
        x = f"CAST(`{self.value}` AS DOUBLE)"
        fine, coarse, huge = f"abs({x}) < {self.LARGE}", f"abs({x}) >= {self.LARGE}", f"abs({x}) >= {self.HUGE}"
        vf = f"CASE WHEN {fine} THEN CAST(round({x} * {self.FINE}, 0) AS DECIMAL(15,0)) ELSE 0 END"
        vc = f"CASE WHEN {coarse} THEN CAST(round(CAST({x} AS DECIMAL(38,4)) * {self.COARSE}, 0) AS DECIMAL(28,0)) ELSE 0 END"
        small = f"CASE WHEN {coarse} AND NOT {huge} THEN CAST(round({x} * {self.COARSE}, 0) AS DECIMAL(19,0)) ELSE 0 END"
        squares = [
            f"CAST(({vf}) AS DECIMAL(15,0)) * CAST(({vf}) AS DECIMAL(15,0)) AS _qf", f"CAST(({small}) AS DECIMAL(19,0)) * CAST(({small}) AS DECIMAL(19,0)) AS _qc",
            f"CASE WHEN {coarse} THEN 1 ELSE 0 END AS _kl", f"CASE WHEN {huge} THEN 1 ELSE 0 END AS _kh",
        ]
        return [f"CASE WHEN `{self.value}` IS NULL THEN 0 ELSE 1 END AS _k", f"CAST({vf} AS DECIMAL(15,0)) AS _vf", f"CAST({vc} AS DECIMAL(28,0)) AS _vc", *(squares if self.spread else [])]

    def _events(self, rows: DataFrame, payload: Sequence[str]) -> DataFrame:
        items = ["struct(_s AS at, 0 AS code)"]
        for w, (back, skip) in self.windows.items():
            enter, leave = self.codes[w]
            if skip:
                items.append(f"struct(_s + {skip} AS at, {enter} AS code)")
            items.append(f"struct(_s + {back + 1} AS at, {leave} AS code)")
        carried = [f"CASE WHEN _e.code = 0 THEN `{k}` END AS `{k}`" for k in payload if k not in self.key]
        spread = rows.selectExpr("*", f"explode(array({', '.join(items)})) AS _e")
        return spread.selectExpr(*[f"`{k}`" for k in self.key], *self._names(), "_e.at AS _at", "_e.code AS _code", *carried)

    def _names(self) -> list[str]:
        return ["_n", "_k", "_vf", "_vc", *(["_qf", "_qc", "_kl", "_kh"] if self.spread else [])]

    def _steps(self) -> dict[str, str]:
        """What an event adds to each running sum."""
        return {f"{w}_{m}": f"CASE _code WHEN {self.codes[w][0]} THEN {x} WHEN {self.codes[w][1]} THEN -{x} END" for w in self.windows for m, x in self._parts(w).items()}

    def _finish(self, df: DataFrame, kept: Sequence[str]) -> DataFrame:
        """Sums and deviations from whole units; a spread of zero is found exactly."""
        out = [f"`{c}`" for c in kept]
        for w in self.windows:
            out += [f"{w}_n", f"{w}_k", f"CAST({w}_vf AS DOUBLE) / {self.FINE}D + CAST({w}_vc AS DOUBLE) / {self.COARSE}D AS {w}_sum"]
            if w in self.spread:
                exact = "greatest(coalesce(CAST(try_subtract(try_multiply(CAST({w}_k AS DECIMAL(10,0)), {q}), try_multiply(CAST({v} AS DECIMAL(19,0)), CAST({v} AS DECIMAL(19,0)))) AS DOUBLE), CAST({w}_k AS DOUBLE) * CAST({q} AS DOUBLE) - CAST({v} AS DOUBLE) * CAST({v} AS DOUBLE)), 0D)"
                fine = exact.format(w=w, q=f"CAST({w}_qf AS DECIMAL(28,0))", v=f"{w}_vf") + f" / {float(self.FINE) ** 2}D"
                coarse = exact.format(w=w, q=f"CAST({w}_qc AS DECIMAL(38,0))", v=f"{w}_vc") + f" / {float(self.COARSE) ** 2}D"
                mean_of = f"(CAST({w}_vf AS DOUBLE) / {self.FINE}D + CAST({w}_vc AS DOUBLE) / {self.COARSE}D)"
                mixed = f"greatest(CAST({w}_k AS DOUBLE) * (CAST({w}_qf AS DOUBLE) / {float(self.FINE) ** 2}D + CAST({w}_qc AS DOUBLE) / {float(self.COARSE) ** 2}D) - {mean_of} * {mean_of}, 0D)"
                spread = f"CASE WHEN {w}_kl = 0 THEN {fine} WHEN {w}_kl = {w}_k THEN {coarse} ELSE {mixed} END"
                out.append(f"CASE WHEN {w}_k > 1 AND {w}_kh = 0 THEN sqrt(({spread}) / (CAST({w}_k AS DOUBLE) * ({w}_k - 1))) END AS {w}_std")
        return df.selectExpr(*out)

    def plain(self, df: DataFrame) -> DataFrame:
        rows = df.withColumn("_s", epoch_seconds(self.ts)).selectExpr("*", "1 AS _n", *self._inputs())
        keys = ", ".join(f"`{k}`" for k in self.key)
        frame = f"OVER (PARTITION BY {keys} ORDER BY _at RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        measured = self._events(rows, df.columns).selectExpr(*[f"`{c}`" for c in df.columns], "_code", *[f"sum({step}) {frame} AS {name}" for name, step in self._steps().items()])
        return self._finish(measured.filter("_code = 0"), df.columns)

    def sliced(self, df: DataFrame) -> DataFrame:
        """One row per second stands for all its peers; what enters and leaves at a second is added up, and the running
        sums over seconds are cut into slices. Results go back by (key, second)."""
        base = df.withColumn("_s", epoch_seconds(self.ts))
        keys = [f"`{k}`" for k in self.key]
        seconds = base.selectExpr(*keys, "_s", "1 AS _n", *self._inputs()).groupBy(*self.key, "_s").agg(*[F.sum(n).alias(n) for n in self._names()])
        steps = self._steps()
        changes = self._events(seconds, self.key).groupBy(*self.key, "_at").agg(
            F.max(F.expr("CASE WHEN _code = 0 THEN 1 ELSE 0 END")).alias("_own"), *[F.sum(F.expr(step)).alias(f"_add_{name}") for name, step in steps.items()]
        )
        run = running_sliced(changes, self.key, ["_at"], {name: F.col(f"_add_{name}") for name in steps})
        measured = self._finish(run.filter("_own = 1").withColumnRenamed("_at", "_s"), [*self.key, "_s"])
        return join_null_safe(base, measured, [*self.key, "_s"]).drop("_s")

    def columns(self) -> list[str]:
        return [f"{w}_{m}" for w in self.windows for m in ("n", "k", "sum", *(["std"] if w in self.spread else []))]


# --- first occurrence -------------------------------------------------------------


def first_seen_plain(df: DataFrame, key: Sequence[str], order: Sequence[str], values: dict[str, str]) -> DataFrame:
    cols = {}
    for value, flag in values.items():
        w = Window.partitionBy(*key, value).orderBy(*order)
        cols[flag] = F.when(F.col(value).isNotNull() & (F.row_number().over(w) == 1), 1).otherwise(0)
    return df.withColumns(cols)


def first_seen_sliced(df: DataFrame, key: Sequence[str], order: Sequence[str], values: dict[str, str]) -> DataFrame:
    """Find the first row per value by aggregation, then mark it through its unique id."""
    row_id = order[-1]
    out = df
    for value, flag in values.items():
        firsts = (
            df.filter(F.col(value).isNotNull())
            .groupBy(*key, value)
            .agg(F.min(F.struct(*order)).alias("_first"))
            .select(F.col("_first")[row_id].alias(row_id), F.lit(1).alias(flag))
        )
        out = out.join(firsts, row_id, "left").withColumn(flag, F.coalesce(flag, F.lit(0)))
    return out.select(*df.columns, *values.values())


# --- trailing row counts ----------------------------------------------------------
# 1-based sequence ``number`` per key, and mean of the ``rows`` rows before this one in ``out``


def numbered_mean_plain(df: DataFrame, key: Sequence[str], order: Sequence[str], value: str, rows: int, out: str, number: str) -> DataFrame:
    w = Window.partitionBy(*key).orderBy(*order)
    frame = w.rowsBetween(-rows, -1)
    return df.withColumns(
        {
            number: F.row_number().over(w).cast("bigint"),
            out: F.sum(value).over(frame).cast("double") / F.count(value).over(frame),
        }
    )


def numbered_mean_sliced(df: DataFrame, key: Sequence[str], order: Sequence[str], value: str, rows: int, out: str, number: str) -> DataFrame:
    """Blocks of equal row counts; the tail of a block is repeated as context of the next."""
    block = rows * 100
    numbered = running_sliced(df, key, order, {number: F.lit(1).cast("bigint")})
    own = F.floor(F.col(number) / block)
    spread = numbered.withColumns(
        {
            "_own": own,
            "_block": F.explode(F.when(F.pmod(F.col(number), F.lit(block)) >= block - rows, F.array(own, own + 1)).otherwise(F.array(own))),
        }
    )
    frame = Window.partitionBy(*key, "_block").orderBy(number).rowsBetween(-rows, -1)
    mean = F.sum(value).over(frame).cast("double") / F.count(value).over(frame)
    return spread.withColumn(out, mean).filter(F.col("_block") == F.col("_own")).drop("_block", "_own")
