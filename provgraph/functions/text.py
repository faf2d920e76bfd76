"""Scalar text functions as Column expressions; none leaves the JVM."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ZERO_TIME = "0001-01-01T00:00:00Z"


def text(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))


def _escaped(value: Column, chars: str) -> Column:
    """Percent-encode single characters; `%` first, so that what later steps write stays as it is."""
    return reduce(lambda v, c: F.replace(v, F.lit(c), F.lit(f"%{ord(c):02X}")), chars, value)


def escape_identity(value: Column) -> Column:
    """A component of an id: its delimiters and line ends are percent-encoded."""
    return _escaped(text(value), "%/+|\n\r")


def escape_edge(value: Column) -> Column:
    return _escaped(text(value), "%|")


def query_escape(value: Column) -> Column:
    """Form encoding that keeps `~` and encodes `*`."""
    return F.replace(F.replace(F.url_encode(text(value)), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def sorted_pairs(pairs: Column) -> Column:
    """array<struct<key, value>> by key, then value; null is empty."""
    plain = F.transform(F.coalesce(pairs, F.array().cast("array<struct<key:string,value:string>>")), lambda p: F.struct(text(p["key"]).alias("key"), text(p["value"]).alias("value")))
    return F.array_sort(plain)


def canon_qualifiers(pairs: Column) -> Column:
    return F.array_join(F.transform(sorted_pairs(pairs), lambda p: F.concat(query_escape(p["key"]), F.lit("="), query_escape(p["value"]))), "&")


def framed(value: Column) -> Column:
    """One field with its length in bytes before it, so that no two lists of fields read alike."""
    v = text(value)
    return F.concat(F.octet_length(v).cast("string"), F.lit(":"), v)


def frame(*values: Column) -> Column:
    return F.concat(*[framed(v) for v in values]) if values else F.lit("")


def hash_parts(*values: Column) -> Column:
    return F.sha2(frame(*values), 256)


def join_ids(ids: Column) -> Column:
    """Framed ids in the order given."""
    return F.array_join(F.transform(F.coalesce(ids, F.array().cast("array<string>")), framed), "")


def sorted_ids(ids: Column) -> Column:
    return F.array_sort(ids)


def encode_pairs(pairs: Column) -> Column:
    """Sorted pairs, key and value framed in turn."""
    return F.array_join(F.transform(sorted_pairs(pairs), lambda p: frame(p["key"], p["value"])), "")


def time_text(value: Column) -> Column:
    """UTC time to the second, with a fraction only where there is one; null stays null."""
    return F.regexp_replace(F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"), r"\.?0+Z$", "Z")


def required_time(value: Column) -> Column:
    return F.coalesce(time_text(value), F.lit(ZERO_TIME))


def optional_time(value: Column) -> Column:
    return F.coalesce(time_text(value), F.lit(""))


def canonical_time(raw: Column) -> Column:
    """Offset times as text, in UTC, with up to nine digits of fraction kept; null where it can't be read."""
    parts = r"^(\d{4}-\d\d-\d\d[Tt]\d\d:\d\d:\d\d)(?:\.(\d+))?([Zz]|[+-]\d\d:\d\d)$"
    seconds = F.try_to_timestamp(F.concat(F.regexp_extract(raw, parts, 1), F.regexp_extract(raw, parts, 3)))
    fraction = F.regexp_replace(F.substring(F.regexp_extract(raw, parts, 2), 1, 9), "0+$", "")
    return F.concat(F.date_format(seconds, "yyyy-MM-dd'T'HH:mm:ss"), F.when(fraction == "", "").otherwise(F.concat(F.lit("."), fraction)), F.lit("Z"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often it is named."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _digits(value: Column) -> tuple[Column, Column, Column]:
    """(sign, significant digits, decimal exponent) of the shortest text of a double."""
    raw = F.abs(value).cast("string")
    whole, fraction = F.regexp_extract(raw, r"^(\d+)", 1), F.regexp_extract(raw, r"\.(\d+)", 1)
    power = F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(raw, r"E-?(\d+)", 1), F.lit("")), F.lit("999")).cast("int"), F.lit(0)) * F.when(raw.contains("E-"), -1).otherwise(1)
    every = F.concat(whole, fraction)
    bare = F.regexp_replace(every, "^0+", "")
    digits = F.regexp_replace(bare, "0+$", "")
    exponent = F.length(whole) - 1 - (F.length(every) - F.length(bare)) + power
    zero = value == 0
    return F.when(value < 0, "-").otherwise(""), F.when(zero, "0").otherwise(digits), F.when(zero, 0).otherwise(exponent)


def _plain(digits: Column, exponent: Column) -> Column:
    n = F.length(digits)
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -exponent - 1), digits)
    padded = F.rpad(digits, F.greatest(exponent + 1, F.lit(1)), F.lit("0"))
    pointed = F.concat(F.substring(digits, F.lit(1), exponent + 1), F.lit("."), F.substring(digits, exponent + 2, n))
    return F.when(exponent < 0, small).when(n <= exponent + 1, padded).otherwise(pointed)


def _scientific(digits: Column, exponent: Column, least: int) -> Column:
    mantissa = F.when(F.length(digits) == 1, digits).otherwise(F.concat(F.substring(digits, 1, 1), F.lit("."), F.substring(digits, 2, 400)))
    size = F.abs(exponent).cast("string")
    return F.concat(mantissa, F.when(exponent < 0, "e-").otherwise("e+"), F.when(F.length(size) < least, F.lpad(size, least, "0")).otherwise(size))


def float_text(value: Column, style: str = "g") -> Column:
    """Shortest text of a double: `g` turns to exponents below 1e-4 and from 1e6 on, `f` never, `json` below 1e-6 and from 1e21 on."""
    low, high, least = {"g": (-4, 6, 2), "f": (-400, 400, 2), "json": (-6, 21, 1)}[style]

    def shown(x: Column) -> Column:
        far = (x["e"] < low) | (x["e"] >= high)
        return F.concat(x["s"], F.when(far, _scientific(x["d"], x["e"], least)).otherwise(_plain(x["d"], x["e"])))

    def split(x: Column) -> Column:
        sign, digits, exponent = _digits(x)
        return F.struct(sign.alias("s"), digits.alias("d"), exponent.alias("e"))

    return let(let(value, split), shown)


def json_text(value: Column) -> Column:
    """A JSON string; markup and line separators are escaped too."""
    quoted = F.to_json(F.struct(value.alias("v")))
    bare = F.substring(quoted, F.lit(6), F.length(quoted) - 6)
    for c in "<>&\u2028\u2029":
        bare = F.replace(bare, F.lit(c), F.lit(f"\\u{ord(c):04x}"))
    return bare
