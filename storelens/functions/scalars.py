"""Scalar column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``.

    An expression repeated inside array functions is worked out at each place it stands.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def month_start(df: DataFrame, name: str) -> Column:
    """First instant of the month, in the column's own timestamp type.

    Goes through ``date``, so a zone-less column never passes the session zone.
    """
    kind = df.select(name).schema[0].dataType.simpleString()
    return F.trunc(F.col(name).cast("date"), "month").cast(kind)


def day_start(df: DataFrame, name: str) -> Column:
    kind = df.select(name).schema[0].dataType.simpleString()
    return F.col(name).cast("date").cast(kind)


def year_month(ts: Column, missing: str = "unknown") -> Column:
    return F.coalesce(F.date_format(ts, "yyyy-MM"), F.lit(missing))


def lenient_timestamp(text: Column) -> Column:
    """Timestamp from text, null where it does not parse."""
    return F.try_to_timestamp(text)


def months_after(ts: Column, months: int) -> Column:
    return ts + F.expr(f"INTERVAL {int(months)} MONTH")


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def half_even(value: Column, places: int) -> Column:
    return F.bround(value, places)


def volume_or_zero(length: Column, height: Column, width: Column) -> Column:
    """Volume where a missing side counts as 0 (relational tables)."""
    return or_zero(length) * or_zero(height) * or_zero(width)


def volume_or_null(length: Column, height: Column, width: Column) -> Column:
    """Volume where any missing side gives null (documents)."""
    return length * height * width


def revenue(price: Column, units: Column) -> Column:
    return or_zero(price) * or_zero(units)


def kilometres(metres: Column) -> Column:
    return metres / 1000


def trimmed_length(text: Column) -> Column:
    return F.char_length(F.trim(text))


def title_case(text: Column) -> Column:
    """Upper-case each letter that follows a non-letter, lower-case the others.

    Differs from ``initcap``, which starts a word only after white space.
    """
    letters = F.split(text, "")
    return F.concat_ws(
        "",
        F.transform(
            letters,
            lambda ch, i: F.when(
                (i == 0) | ~F.coalesce(F.get(letters, i - 1), F.lit("")).rlike(r"\p{L}"), F.upper(ch)
            ).otherwise(F.lower(ch)),
        ),
    )


def product_name(category: Column, product_id: Column) -> Column:
    return F.concat(
        F.lit("Producto "),
        title_case(F.replace(category, F.lit("_"), F.lit(" "))),
        F.lit(" - "),
        F.substring(product_id.cast("string"), 1, 5),
    )


def photo_urls(product_id: Column, host: str = "https://images.example") -> Column:
    return F.array(F.concat(F.lit(f"{host}/"), product_id.cast("string"), F.lit("_1.jpg")))


def narrow(value: Column) -> Column:
    """Whole numbers as integers, others as doubles, in one VARIANT column."""
    return F.when(value == F.floor(value), value.cast("bigint").cast("variant")).otherwise(
        value.cast("variant")
    )


def whole_or_null(value: Column) -> Column:
    """A float-typed integer column read back as ``bigint``; null if it has a fraction."""
    return F.when(value == F.floor(value), value.cast("bigint"))


def dimensions_json(
    weight: Column, length: Column, height: Column, width: Column
) -> Column:
    return F.to_json(
        F.struct(
            weight.alias("weight_g"),
            length.alias("length_cm"),
            height.alias("height_cm"),
            width.alias("width_cm"),
            volume_or_zero(length, height, width).alias("volume_cm3"),
        ),
        {"ignoreNullFields": "false"},
    )


def weight_class(weight_g: Column) -> Column:
    grams = or_zero(weight_g)
    return F.when(grams > 1000, "heavy").when(grams > 300, "medium").otherwise("light")


def hash_bucket(key: Column, buckets: int) -> Column:
    """SHA-256 of the key's text, read as one big integer, modulo ``buckets``.

    The digest is folded in eight 32-bit pieces, so every step fits in a ``bigint``
    and the whole expression stays in generated code.
    """
    if not 0 < buckets <= 2**31:
        raise ValueError("buckets must be between 1 and 2^31")
    digest = F.sha2(key.cast("string"), 256)
    shift = 2**32 % buckets
    folded = F.lit(0).cast("bigint")
    for piece in range(8):
        part = F.conv(F.substring(digest, 8 * piece + 1, 8), 16, 10).cast("bigint")
        folded = (folded * shift + part) % buckets
    return folded


def exact_mean(total: Column, count: Column, places: int) -> Column:
    """Mean of exact numbers, rounded half-even once, from a sum and a count.

    The result stays a decimal; null if the count is 0.
    """
    return F.bround(F.try_divide(total.cast("decimal(38,16)"), count), places)


def improvement_percent(before: Column, after: Column) -> Column:
    """Percent saved against ``before``; null if a side is missing or ``before`` is 0.

    Worked out in decimals, so a tie at the third place is a real tie.
    """
    b, a = before.cast("decimal(20,6)"), after.cast("decimal(20,6)")
    return F.bround(F.try_divide((b - a) * 100, b), 2).cast("double")


def read_efficiency(examined: Column, returned: Column) -> Column:
    return examined / F.greatest(returned, F.lit(1))


def grouped_digits(value: Column, places: int = 0) -> Column:
    return F.format_number(value, places)


def money_text(value: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(value, 2))


def event_key(*parts: Column) -> Column:
    """A repeatable id from business columns, so a retried load makes no second row.

    Lengths go into the digest as well, so ('ab','c') and ('a','bc') stay apart.
    """
    texts = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    marks = [F.coalesce(F.char_length(p.cast("string")), F.lit(-1)).cast("string") for p in parts]
    return F.sha2(F.concat_ws("|", *marks, *texts), 256)
