"""Row filters. All of them are plain column expressions, so Catalyst can push them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from storelens.functions.scalars import let


def instant(value) -> Column:
    """A time literal that takes the type of the column it is compared with.

    Text literals are cast by the analyser to the column's type; a Python datetime
    would turn the *column* into a zoned timestamp and lose the pushed filter.
    """
    if isinstance(value, Column):
        return value
    return F.lit(str(value))


def time_range(ts: Column, lo, hi) -> Column:
    """``lo <= ts < hi``."""
    return (ts >= instant(lo)) & (ts < instant(hi))


def day_range(ts: Column, day: str) -> Column:
    """One calendar day as a half-open range, which reaches the Parquet reader."""
    first = dt.date.fromisoformat(day)
    return time_range(ts, first, first + dt.timedelta(days=1))


def month_range(ts: Column, month: str) -> Column:
    """One month, given as ``yyyy-MM``, as a half-open range."""
    first = dt.date.fromisoformat(f"{month}-01")
    return time_range(ts, first, (first + dt.timedelta(days=31)).replace(day=1))


def truncated_day_is(ts: Column, day: str) -> Column:
    """The function-on-column form. Same rows as ``day_range``, but nothing is pushed."""
    return F.date_trunc("day", ts) == F.lit(day).cast("timestamp")


def is_late(delivered: Column, estimated: Column) -> Column:
    return delivered > estimated


def has_text(value: Column) -> Column:
    """Present and not null; the empty text counts as present."""
    return value.isNotNull()


def array_has_all(value: Column, wanted: list[str]) -> Column:
    return F.size(F.array_except(F.array(*[F.lit(w) for w in wanted]), value)) == 0


def active_at(lo: Column, hi: Column, as_of) -> Column:
    """Half-open period holds the instant; a null bound is open."""
    at = instant(as_of)
    return (lo.isNull() | (lo <= at)) & (hi.isNull() | (hi > at))


def after_cursor(key: Column, cursor) -> Column:
    return key > F.lit(cursor)


def has_separator(text: Column) -> Column:
    return text.rlike(r"[,;|]")


def outside(value: Column, lo, hi) -> Column:
    return ~value.between(lo, hi)


# Base letter and the accented letters that fold to it.
ACCENTED = {
    "a": "àáâãäåāăą",
    "c": "çćĉċč",
    "d": "ďđ",
    "e": "èéêëēĕėęě",
    "g": "ĝğġģ",
    "h": "ĥħ",
    "i": "ìíîïĩīĭįı",
    "j": "ĵ",
    "k": "ķ",
    "l": "ĺļľŀł",
    "n": "ñńņňŉ",
    "o": "òóôõöøōŏő",
    "r": "ŕŗř",
    "s": "śŝşš",
    "t": "ţťŧ",
    "u": "ùúûüũūŭůűų",
    "w": "ŵ",
    "y": "ýÿŷ",
    "z": "źżž",
}


def folded_contains(text: Column, needle: str) -> Column:
    """Accent- and case-insensitive substring test, by Spark's own collation."""
    return F.contains(F.collate(text, "UNICODE_CI_AI"), F.lit(needle))


def folded_like(text: Column, pattern: str) -> Column:
    """The same for LIKE patterns, which the collation does not take: letters are folded."""
    accents = "".join(ACCENTED.values())
    bases = "".join(base * len(letters) for base, letters in ACCENTED.items())
    plain = pattern.lower().translate(str.maketrans(accents, bases))
    return F.translate(F.lower(text), accents, bases).like(plain)


def json_contains(value: Column, wanted: dict) -> Column:
    """The JSON text holds everything in ``wanted``; other keys are ignored.

    Objects match key by key, arrays when each wanted element is present in any place,
    scalars on type and value (1 equals 1.0, but "1" does not equal 1).
    """
    return let(
        F.try_parse_json(value),
        lambda doc: F.coalesce(_contains(doc, wanted), F.lit(False)),
    )


def _contains(doc: Column, wanted) -> Column:
    kind = F.schema_of_variant(doc)
    if isinstance(wanted, dict):
        result = kind.startswith("OBJECT")
        for key, inner in wanted.items():
            path = "$['" + key.replace("'", "\\'") + "']"
            result = result & let(
                F.try_variant_get(doc, path, "variant"), _holding(inner)
            )
        return F.coalesce(result, F.lit(False))
    if isinstance(wanted, (list, tuple)):
        elements = F.try_variant_get(doc, "$", "array<variant>")
        result = kind.startswith("ARRAY")
        for inner in wanted:
            result = result & _any_contains(elements, inner)
        return F.coalesce(result, F.lit(False))
    if wanted is None:
        return F.coalesce(kind == "VOID", F.lit(False))
    if isinstance(wanted, bool):
        same = (kind == "BOOLEAN") & (F.try_variant_get(doc, "$", "boolean") == F.lit(wanted))
    elif isinstance(wanted, int) and abs(wanted) >= 1 << 53:
        # beyond what a double tells apart: whole numbers as decimals
        exact = F.try_variant_get(doc, "$", "decimal(38,0)")
        same = kind.rlike("^(BIGINT|DECIMAL)") & (exact == F.lit(str(wanted)).cast("decimal(38,0)"))
    elif isinstance(wanted, (int, float)):
        numeric = kind.rlike("^(BIGINT|DOUBLE|DECIMAL)")
        same = numeric & (F.try_variant_get(doc, "$", "double") == F.lit(float(wanted)))
    else:
        same = (kind == "STRING") & (F.try_variant_get(doc, "$", "string") == F.lit(str(wanted)))
    return F.coalesce(same, F.lit(False))


def _holding(wanted):
    return lambda doc: _contains(doc, wanted)


def _any_contains(elements: Column, wanted) -> Column:
    return F.exists(elements, lambda e: _contains(e, wanted))
