"""Scalar expressions. All are Column to Column, safe under ANSI mode, and give NULL where a value cannot be read."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.functions import rules

WHITE = " \t\n\r\f\x0b"


def truncated(x: Column) -> Column:
    """A number that may carry a fraction, toward zero as an int; NaN and overflow are NULL."""
    return x.try_cast("double").try_cast("int")


def clamped(x: Column, low: int = 0, high: int = 255) -> Column:
    """Within bounds; NULL stays NULL."""
    return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(low)), F.lit(high)))


def clamped_or_zero(x: Column, low: int = 0, high: int = 255) -> Column:
    """Within bounds; NULL counts as 0."""
    return F.least(F.greatest(F.coalesce(x, F.lit(0)), F.lit(low)), F.lit(high))


def stripped(x: Column) -> Column:
    return F.btrim(x, F.lit(WHITE))


def lower_or_null(x: Column) -> Column:
    """Lower case; an empty string is NULL."""
    return F.nullif(F.lower(x), F.lit(""))


def normalized(x: Column) -> Column:
    """Trimmed and lower case; an empty string is NULL."""
    return F.nullif(F.lower(stripped(x)), F.lit(""))


def truthy(x: Column) -> Column:
    """Whether a JSON value read as a string counts as true: neither null, empty, false, zero nor an empty container."""
    return x.isNotNull() & ~x.isin("", "false", "False", "null", "0", "0.0", "[]", "{}")


def detections_of(entries: Column) -> Column:
    """`engine:result;...` in order over an array of struct(key, value: struct(detected, result)), both read as strings,
    for engines that detected something with a result; NULL if none."""
    hits = F.filter(entries, lambda e: truthy(e["value"]["detected"]) & truthy(e["value"]["result"]))
    joined = F.array_join(F.transform(hits, lambda e: F.concat(e["key"], F.lit(":"), e["value"]["result"])), ";")
    return F.nullif(joined, F.lit(""))


def detection_string(scans: Column) -> Column:
    """The same of a map, in document order; of a key that repeats the last value counts, at its first place."""
    entries = F.map_entries(scans)
    keys = F.array_distinct(F.map_keys(scans))
    last = lambda k: F.element_at(F.filter(entries, lambda e: e["key"] == k), -1)
    return detections_of(F.when(F.size(keys) == F.size(entries), entries).otherwise(F.transform(keys, last)))


def prefer_verbatim(given: Column, built: Column) -> Column:
    """A non-empty given string as it is, else the built one."""
    return F.coalesce(F.nullif(given, F.lit("")), built)


def tsv_text(x: Column) -> Column:
    """For the TSV sink only: backslashes doubled, tab and line ends to blanks, empty to NULL."""
    return F.nullif(F.translate(F.replace(x, F.lit("\\"), F.lit("\\\\")), "\t\n\r", "   "), F.lit(""))


def enum_or(x: Column, values: tuple[str, ...], default: str, aliases: dict[str, str] | None = None) -> Column:
    """Upper-case value if it is one of `values` or has an alias, else the default; NULL and empty get the default."""
    up = F.upper(x)
    out = F.when(up.isin(*[v.upper() for v in values]), up)
    for name, to in (aliases or {}).items():
        out = out.when(up == name, F.lit(to))
    return out.otherwise(F.lit(default))


def target_class(x: Column) -> Column:
    return enum_or(x, rules.TARGET_ENUM, rules.TARGET_DEFAULT, rules.TARGET_ALIASES)


def domain_class(x: Column, default: str = rules.DOMAIN_DEFAULT) -> Column:
    return enum_or(x, rules.DOMAIN_ENUM, default)


def value_of(text: Column, key: str = "maliciousClassification", split: str = ";") -> Column:
    """From `k=v;k=v` text: of the first part that contains `key=`, what follows its first `=`; trimmed, lower case."""
    part = F.get(F.filter(F.split(text, split), lambda p: p.contains(f"{key}=")), F.lit(0))
    return F.lower(stripped(F.substr(part, F.instr(part, "=") + 1)))


def resolved_class(own: Column, looked_up: Column) -> Column:
    """Own class if valid; rejected (NULL) if it is one to skip; else a valid looked-up class; else NULL."""
    mine, other = normalized(own), normalized(looked_up)
    valid = rules.CONVERT_VALID
    return F.when(mine.isin(*rules.CONVERT_SKIP), F.lit(None)).when(mine.isin(*valid), mine).when(other.isin(*valid), other)


def to_date(x: Column) -> Column:
    return x.try_cast("date")


def partition_date(scan_date: Column) -> Column:
    """YYYYMMDD of a date written with dashes; NULL for other shapes."""
    dashed = (F.length(scan_date) >= 10) & (F.substring(scan_date, 5, 1) == "-")
    return F.when(dashed, F.replace(F.substring(scan_date, 1, 10), F.lit("-"), F.lit("")))


def number_of(plain: Column, wrapped: Column) -> Column:
    """An int that may be wrapped as an extended-JSON struct field."""
    return F.coalesce(wrapped, plain)


def domain_name(x: Column) -> Column:
    """Trimmed and lower case; NULL where empty or too long."""
    d = normalized(x)
    return F.when(F.length(d) <= rules.MOST_DOMAIN_CHARS, d)


def hash_key(sha1: Column, md5: Column, sha256: Column) -> Column:
    """The hash that names a file: sha1, else md5, else sha256."""
    empty = F.lit("")
    return F.coalesce(F.nullif(sha1, empty), F.nullif(md5, empty), F.nullif(sha256, empty))


def key_bytes(hexadecimal: Column, chars: int = 40) -> Column:
    """Binary key of a hex digest; NULL where it is not one."""
    return F.when(F.length(hexadecimal) == chars, F.unhex(hexadecimal))


def is_digest(hexadecimal: Column, chars: int = 64) -> Column:
    """Length alone decides; the characters are not looked at."""
    return F.coalesce(F.length(hexadecimal) == chars, F.lit(False))


SUMMARY = r"^([^.(]+)((?:\.[^(]+)?)\(([-0-9.]+),([-0-9.]+)\);([^.]*)\.(.*)$"


def summary_parts(text: Column) -> Column:
    """struct(type, subtypes, score1, score2, product_type, product) of `type[.sub...](s1,s2);productType.product`."""
    part = lambda i: F.nullif(F.regexp_extract(text, SUMMARY, i), F.lit(""))
    subs = F.filter(F.split(F.regexp_extract(text, SUMMARY, 2), r"\."), lambda s: s != "")
    return F.struct(part(1).alias("type"), subs.alias("subtypes"), part(3).try_cast("double").alias("score1"), part(4).try_cast("double").alias("score2"), part(5).alias("product_type"), part(6).alias("product"))


def extensions(name: Column) -> Column:
    """struct(second, last): the last two extensions of a file name; NULL where either is shorter than two characters
    or a number."""
    parts = F.split(F.lower(name), r"\.")
    last, second = F.element_at(parts, -1), F.get(parts, F.size(parts) - 2)
    fits = lambda e: (F.length(e) >= 2) & ~e.rlike(r"^\d+$")
    return F.when((F.size(parts) >= 3) & fits(last) & fits(second), F.struct(second.alias("second"), last.alias("last")))


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def text_value(key: str, json: Column, default: str) -> Column:
    """A field of a JSON object; the default only where the field is absent, while an explicit null stays NULL."""
    keys = F.coalesce(F.json_object_keys(json), F.array().cast("array<string>"))
    return F.when(F.array_contains(keys, key), F.get_json_object(json, f"$.{key}")).otherwise(F.lit(default))
