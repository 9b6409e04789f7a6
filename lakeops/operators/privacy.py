"""Tokens, masks, views and detection of personal data, all as column expressions."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.exprs import c, mask_all_but

REDACTED = "***REDACTED***"


def hmac_sha256(text: Column | str, secret: str) -> Column:
    """Hex HMAC-SHA256; the two key pads are computed once, the hashing runs in the JVM."""
    key = secret.encode()
    if len(key) > 64:
        raise ValueError("secret longer than one hash block (64 bytes)")
    key = key.ljust(64, b"\0")
    inner = F.lit(bytearray(b ^ 0x36 for b in key))
    outer = F.lit(bytearray(b ^ 0x5C for b in key))
    first = F.unhex(F.sha2(F.concat(inner, F.encode(c(text), "UTF-8")), 256))
    return F.sha2(F.concat(outer, first), 256)


def deterministic_token(text: Column | str, secret: str, length: int = 16) -> Column:
    return F.left(hmac_sha256(c(text).cast("string"), secret), F.lit(length))


def format_preserving_token(text: Column | str, secret: str, prefix: int = 0, suffix: int = 0) -> Column:
    """Keep both ends and all separators; letters and digits between become hash characters."""
    x = c(text)
    alnum = r"[^\p{L}\p{N}]"
    digest = F.upper(hmac_sha256(F.regexp_replace(x, alnum, ""), secret))
    middle = F.substring(x, F.lit(prefix + 1), F.length(x) - prefix - suffix)
    chars = F.split(middle, "")

    def replace(ch: Column, i: Column) -> Column:
        earlier = F.length(F.regexp_replace(F.substring(middle, F.lit(1), i), alnum, ""))
        return F.when(ch.rlike(r"[\p{L}\p{N}]"), F.substring(digest, F.pmod(earlier, F.lit(64)) + 1, F.lit(1))).otherwise(ch)

    body = F.array_join(F.transform(chars, replace), "")
    token = F.concat(F.left(x, F.lit(prefix)), body, F.right(x, F.lit(suffix)))
    return F.when(F.length(x) <= prefix + suffix, x).otherwise(token)


def hash_token(text: Column | str) -> Column:
    return F.sha2(c(text).cast("string"), 256)


def redact(text: Column | str) -> Column:
    """Constant in place of every value, missing ones included."""
    return F.lit(REDACTED)


def tokenize_table(df: DataFrame, secret: str, config: Mapping[str, Mapping]) -> DataFrame:
    """Apply one method per column: deterministic, format_preserving, hash, redact or mask."""

    def one(name: str, how: Mapping) -> Column:
        match how.get("method", "deterministic"):
            case "deterministic":
                return deterministic_token(name, secret, how.get("length", 16))
            case "format_preserving":
                return format_preserving_token(name, secret, how.get("prefix", 0), how.get("suffix", 0))
            case "hash":
                return hash_token(name)
            case "redact":
                return redact(name)
            case "mask":
                return mask_all_but(name, how.get("visible", 4))
            case other:
                raise ValueError(f"unknown tokenisation method: {other}")

    return df.withColumns({name: one(name, how) for name, how in config.items() if name in df.columns})


# fixed values: one pattern per kind of personal data, tried in this order
PII_PATTERNS = {
    "EMAIL": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "SSN": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
    "CREDIT_CARD": r"\b[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}\b",
    "IP_ADDRESS": r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b",
    "PHONE": r"\+[0-9]{1,3}[ -]?[0-9]{2,4}[ -]?[0-9]{3,4}[ -]?[0-9]{2,4}",
}


#: What every match of a kind holds: a cheap test that spares most texts the pattern.
PII_HINTS: dict[str, Callable[[Column], Column]] = {
    "EMAIL": lambda t: F.contains(t, F.lit("@")),
    "SSN": lambda t: t.rlike("[0-9]-[0-9]"),
    "CREDIT_CARD": lambda t: t.rlike("[0-9]{4}"),
    "IP_ADDRESS": lambda t: t.rlike("[0-9][.][0-9]"),
    "PHONE": lambda t: F.contains(t, F.lit("+")),
}


def detect_pii(df: DataFrame, key: str, text: str, patterns: Mapping[str, str] = PII_PATTERNS) -> DataFrame:
    """One row per hit over the whole text: key, entity type, matched string.

    A text meets a pattern only if it holds what every match of it holds.
    """
    digits = F.col(text).rlike("[0-9]")

    def of_kind(kind: str, pattern: str) -> Column:
        found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        if pattern == PII_PATTERNS.get(kind):
            hint = PII_HINTS[kind](F.col(text))
            found = F.when(hint if kind == "EMAIL" else digits & hint, found).otherwise(F.array().cast("array<string>"))
        return F.transform(found, lambda m: F.struct(F.lit(kind).alias("entity_type"), m.alias("matched")))

    hits = [of_kind(kind, pattern) for kind, pattern in patterns.items()]
    return df.select(key, F.explode(F.concat(*hits)).alias("hit")).select(key, "hit.entity_type", "hit.matched")


def mask_pii(text: Column | str, patterns: Mapping[str, str] = PII_PATTERNS) -> Column:
    """Replace every hit by its type in brackets, one type after the other."""
    out = c(text)
    for kind, p in patterns.items():
        out = F.regexp_replace(out, p, f"[{kind}]")
    return out


def mask_spans(text: Column | str, spans: Column | str) -> Column:
    """Replace given ``{begin, end, entity_type}`` spans (0-based, end exclusive), last span first."""

    def swap(acc: Column, s: Column) -> Column:
        masked = F.concat(
            F.left(acc, s["begin"]), F.lit("["), s["entity_type"], F.lit("]"),
            F.substring(acc, s["end"] + 1, F.length(acc)),
        )
        return F.when((s["begin"] < s["end"]) & (s["end"] <= F.length(acc)), masked).otherwise(acc)

    from_end = F.reverse(F.array_sort(F.transform(spans, lambda s: F.struct(s["begin"].alias("begin"), s["end"].alias("end"), s["entity_type"].alias("entity_type")))))
    return F.aggregate(from_end, c(text), swap)


def encrypt_id(value: Column | str, key: Column, context: Column | str, iv: Column | None = None) -> Column:
    """AES-GCM with ``context`` as authenticated data: decrypting under another context fails."""
    return F.base64(F.aes_encrypt(c(value).cast("string"), key, F.lit("GCM"), F.lit("DEFAULT"), iv, c(context).cast("string")))


def decrypt_id(token: Column | str, key: Column, context: Column | str) -> Column:
    return F.aes_decrypt(F.unbase64(c(token)), key, F.lit("GCM"), F.lit("DEFAULT"), c(context).cast("string")).cast("string")


def shift_date(date: Column | str, owner: Column | str, span: int = 365) -> Column:
    """Move a date by the same number of days (within +-span) for every row of an owner."""
    digest = F.conv(F.left(F.sha2(c(owner).cast("string"), 256), F.lit(8)), 16, 10).cast("bigint")
    return F.date_add(c(date), (F.pmod(digest, F.lit(2 * span + 1)) - span).cast("int"))


def secure_view(df: DataFrame, row_filter: Column | None = None, exclude: Sequence[str] = (), name: str | None = None) -> DataFrame:
    """Rows that pass the filter without the excluded columns; optionally a temp view.

    Narrows what a query sees; it does not stop code that can read the files.
    """
    out = (df if row_filter is None else df.filter(row_filter)).drop(*exclude)
    if name:
        out.createOrReplaceTempView(name)
    return out


def tenant_scope(df: DataFrame, tenant: int | str, roles: Sequence[str] = (), column: str = "tenant_id") -> DataFrame:
    """Rows of one tenant; everything for a super admin."""
    return df if "super_admin" in roles else df.filter(F.col(column) == F.lit(tenant))


def permissions_of(users: DataFrame, user: str, roles: str, grants: DataFrame) -> DataFrame:
    """Distinct permissions per user from an array of roles and a (role, permission) table."""
    return (
        users.select(user, F.explode(roles).alias("role")).distinct()
        .join(grants, "role").select(user, "permission").distinct()
    )
