"""Column expressions shared by the operators; all of them stay inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0


def c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def epoch_seconds(ts: Column | str) -> Column:
    """Whole seconds since 1970 of a zoned or zone-less timestamp (session zone UTC)."""
    return F.unix_seconds(c(ts).cast("timestamp"))


def ntz(x: Column | str) -> Column:
    return c(x).cast("timestamp_ntz")


def number_or_null(text: Column | str) -> Column:
    """A finite number read from text; anything else is null."""
    x = c(text).try_cast("double")
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), None).otherwise(x)


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = EARTH_KM) -> Column:
    """Great-circle distance in the unit of ``radius``; null when any input is null."""
    half_lat = F.radians(lat2 - lat1) / 2
    half_lon = F.radians(lon2 - lon1) / 2
    chord = F.pow(F.sin(half_lat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(half_lon), 2)
    # not least(): that would turn a missing position into the far side of the globe
    return F.lit(2 * radius) * F.asin(F.sqrt(F.when(chord > 1.0, F.lit(1.0)).otherwise(chord)))


def ratio(num: Column, den: Column, when_zero: float | None = 0.0) -> Column:
    """``num / den`` as double, ``when_zero`` for a zero or missing denominator."""
    return F.when(den != 0, num.cast("double") / den.cast("double")).otherwise(F.lit(when_zero).cast("double"))


def exact_sum(x: Column | str) -> Column:
    """Sum of doubles as double, the same in whatever order the rows come.

    Values are added up as decimals with 16 places. Where one reaches 1e14, is infinite or not a number, or the decimals run
    out, it is the plain sum.
    """
    x = c(x).cast("double")
    return F.when(F.max(F.abs(x)) < 1e14, F.coalesce(F.try_sum(x.try_cast("decimal(30,16)")).cast("double"), F.sum(x))).otherwise(F.sum(x))


def non_null_items(items: Iterable[Column]) -> Column:
    return F.filter(F.array(*items), lambda x: x.isNotNull())


def rule_messages(rules: Sequence[tuple[Column, str]]) -> Column:
    """Array with the message of every rule whose condition holds."""
    return non_null_items(F.when(cond, F.lit(msg)) for cond, msg in rules)


def words_of(text: Column | str) -> Column:
    """Lower-case words, punctuation dropped."""
    return F.array_remove(F.split(F.lower(c(text)), r"[^\p{L}\p{N}]+"), "")


def clean_text(text: Column | str) -> Column:
    return F.trim(F.regexp_replace(c(text), r"\s+", " "))


def truncate_words(text: Column | str, max_length: int) -> Column:
    """Cut after the last full word that fits, with an ellipsis; short text is unchanged."""
    head = F.substring(c(text), 1, max_length)
    cut = F.when(F.instr(head, " ") > 0, F.regexp_replace(head, r"(?s) [^ ]*$", "")).otherwise(head)
    return F.when(F.length(c(text)) <= max_length, c(text)).otherwise(F.concat(cut, F.lit("...")))


def truncate_chars(text: Column | str, max_length: int, suffix: str = "...") -> Column:
    return F.when(F.length(c(text)) <= max_length, c(text)).otherwise(
        F.concat(F.substring(c(text), 1, max_length - len(suffix)), F.lit(suffix))
    )


def mask_all_but(text: Column | str, visible: int = 4) -> Column:
    n = F.length(c(text))
    return F.when(n <= visible, F.repeat(F.lit("*"), n)).otherwise(
        F.concat(F.repeat(F.lit("*"), n - visible), F.right(c(text), F.lit(visible)))
    )


def hash_key(*parts: Column | str) -> Column:
    """URL-safe base64 of the SHA-256 of the parts joined by ``|``, without padding."""
    raw = F.base64(F.unhex(F.sha2(F.concat_ws("|", *[c(p).cast("string") for p in parts]), 256)))
    return F.rtrim(F.translate(raw, "+/", "-_"), F.lit("="))


def short_id(text: Column | str) -> Column:
    return F.left(F.sha2(c(text), 256), F.lit(16))


def hash_fraction(key: Column | str, salt: str = "") -> Column:
    """Repeatable pseudo-random number in [0, 1) that depends only on ``key``."""
    digest = F.sha2(F.concat(F.lit(salt), c(key).cast("string")), 256)
    return F.conv(F.left(digest, F.lit(8)), 16, 10).cast("bigint") / F.lit(4294967296.0)


def percent_change(current: Column, previous: Column) -> Column:
    return F.when(previous != 0, (current - previous) / previous * 100).otherwise(F.lit(0.0))


def time_partition(ts: Column | str, hour: bool = True) -> dict[str, Column]:
    """Zero-padded partition columns of an event time."""
    parts = {"year": "yyyy", "month": "MM", "day": "dd"} | ({"hour": "HH"} if hour else {})
    return {name: F.date_format(c(ts), pattern) for name, pattern in parts.items()}


def all_of(*conditions: Column | None) -> Column:
    """Conjunction of the filters that are set; true when none is."""
    out = F.lit(True)
    for cond in conditions:
        if cond is not None:
            out = out & cond
    return out
