"""CSV and document readers, column defaults and text-form parsers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.functions.scalars import let


CORRUPT = "_corrupt_record"


def _csv(spark: SparkSession, schema: T.StructType, multiline: bool):
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("timestampFormat", "yyyy-MM-dd HH:mm:ss")
    )


def _struct(schema: str | T.StructType) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _sorted_out(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    # a row counts as read only if every column was parsed, so the test uses them all
    plain = [f.name for f in rows.schema if f.name != CORRUPT and not isinstance(f.dataType, (T.MapType, T.VariantType))]
    parsed = F.xxhash64(*(F.col(f"`{n}`") for n in plain)) >= F.lit(-(1 << 63))
    told = rows.withColumn(CORRUPT, F.when(parsed, F.col(CORRUPT)))
    return (
        told.filter(F.col(CORRUPT).isNull()).drop(CORRUPT),
        told.filter(F.col(CORRUPT).isNotNull()),
    )


def read_csv(
    spark: SparkSession, path: str, schema: str | T.StructType, multiline: bool = False
) -> DataFrame:
    """CSV with a header, typed by a declared schema; a row that does not fit it fails the read.

    ``multiline`` is for tables with line breaks inside quotes (reviews). It makes a
    file one task, so such tables should come as many files; all others stay splittable.
    """
    return _csv(spark, _struct(schema), multiline).option("mode", "FAILFAST").csv(path)


def read_csv_with_rejects(
    spark: SparkSession, path: str, schema: str | T.StructType, multiline: bool = False
) -> tuple[DataFrame, DataFrame]:
    """The rows that fit the schema, and the others with their text in ``_corrupt_record``."""
    wide = T.StructType([*_struct(schema).fields, T.StructField(CORRUPT, T.StringType())])
    return _sorted_out(_csv(spark, wide, multiline).option("columnNameOfCorruptRecord", CORRUPT).csv(path))


def read_docs(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Newline-delimited JSON documents of a declared nested schema; a line that does not fit fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_docs_with_rejects(
    spark: SparkSession, path: str, schema: str | T.StructType
) -> tuple[DataFrame, DataFrame]:
    """The documents that fit the schema, and the other lines in ``_corrupt_record``."""
    wide = T.StructType([*_struct(schema).fields, T.StructField(CORRUPT, T.StringType())])
    return _sorted_out(spark.read.schema(wide).option("columnNameOfCorruptRecord", CORRUPT).json(path))


def read_open_docs(spark: SparkSession, path: str) -> DataFrame:
    """Documents of open shape: one VARIANT column, null where the line is no JSON."""
    return spark.read.text(path).select(F.try_parse_json("value").alias("doc"))


def rename_product_lengths(products: DataFrame) -> DataFrame:
    return products.withColumnsRenamed(
        {
            "product_name_lenght": "product_name_length",
            "product_description_lenght": "product_description_length",
        }
    )


def with_defaults(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Fill the named columns where null, and add those the input does not have."""
    return df.withColumns(
        {
            name: F.coalesce(F.col(name), value) if name in df.columns else value
            for name, value in defaults.items()
        }
    )


def parse_array_text(text: Column) -> Column:
    """``{a,"b,c"}`` to an array; ``{}`` to an empty one. Unquoted NULL becomes null.

    A backslash keeps the character after it, in quotes and outside.
    """
    inner = F.regexp_replace(F.trim(text), r"^\{|\}$", "")
    parts = F.regexp_extract_all(
        F.concat(inner, F.lit(",")), F.lit(r'("(?:[^"\\]|\\.)*"|(?:[^,\\]|\\.)*),'), F.lit(1)
    )
    plain = lambda p: F.regexp_replace(F.regexp_replace(p, r'(?s)^"(.*)"$', "$1"), r"(?s)\\(.)", "$1")
    element = lambda p: F.when(F.upper(p) == "NULL", F.lit(None).cast("string")).otherwise(plain(p))
    return F.when(text.isNull(), F.lit(None).cast("array<string>")).when(
        inner == "", F.array().cast("array<string>")
    ).otherwise(F.transform(parts, element))


def parse_json_text(text: Column) -> Column:
    return F.try_parse_json(text)


def parse_range_text(text: Column) -> Column:
    """``["lo","hi")`` to ``struct<lo, hi, valid>``, a half-open period.

    A side left out is null, meaning open. ``(`` and ``]`` move their bound by a microsecond, the
    step of a timestamp. ``empty`` is a period from one instant to the same, so it holds
    none; so is, with ``valid`` false, a text that is no range or has a side that is no time, and
    with ``valid`` null a null text.
    """
    shape = r'^\s*([\[(])\s*"?([^",]*)"?\s*,\s*"?([^",]*)"?\s*([\])])\s*$'
    part = lambda i: F.regexp_extract(text, shape, i)
    no_time = F.lit("1970-01-01").cast("timestamp")
    nothing = lambda valid: F.struct(no_time.alias("lo"), no_time.alias("hi"), valid.alias("valid"))
    step = F.expr("INTERVAL '0.000001' SECOND")
    sides = F.struct(
        part(1).alias("open"),
        F.trim(part(2)).alias("from"),
        F.trim(part(3)).alias("to"),
        part(4).alias("close"),
        F.trim(part(2)).try_cast("timestamp").alias("lo"),
        F.trim(part(3)).try_cast("timestamp").alias("hi"),
    )

    def period(s: Column) -> Column:
        broken = (s["open"] == "") | ((s["from"] != "") & s["lo"].isNull()) | ((s["to"] != "") & s["hi"].isNull())
        return F.when(broken, nothing(F.lit(False))).otherwise(
            F.struct(
                F.when(s["open"] == "(", s["lo"] + step).otherwise(s["lo"]).alias("lo"),
                F.when(s["close"] == "]", s["hi"] + step).otherwise(s["hi"]).alias("hi"),
                F.lit(True).alias("valid"),
            )
        )

    return (
        F.when(text.isNull(), nothing(F.lit(None).cast("boolean")))
        .when(F.lower(F.trim(text)) == "empty", nothing(F.lit(True)))
        .otherwise(let(sides, period))
    )
