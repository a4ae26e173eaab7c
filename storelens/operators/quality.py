"""Data-quality reports: declared constraints become lists of violations.

Every check returns ``check, tbl, key, detail, rows``. Row rules of one table are tested
in a single pass without a shuffle. Key checks count rows per key first, so a key that
fills a third of a table reaches the shuffle as one row per task.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storelens.functions.scalars import hash_bucket
from storelens.operators.aggregates import share_of_total
from storelens.operators.runs import RUN, sorted_runs


@dataclass(frozen=True)
class Rule:
    """A named row condition; as in SQL, a condition that comes out null passes."""

    name: str
    holds: Column
    detail: Column


def _shown(*names: str) -> Column:
    return F.concat_ws(
        ", ",
        *[
            F.concat(F.lit(f"{n}="), F.coalesce(F.col(n).cast("string"), F.lit("null")))
            for n in names
        ],
    )


def not_null(*columns: str) -> list[Rule]:
    return [Rule(f"not_null:{c}", F.col(c).isNotNull(), F.lit(f"{c} is null")) for c in columns]


def in_range(column: str, lo=None, hi=None, lo_open: bool = False) -> Rule:
    value = F.col(column)
    holds = F.lit(True)
    if lo is not None:
        holds = holds & ((value > lo) if lo_open else (value >= lo))
    if hi is not None:
        holds = holds & (value <= hi)
    return Rule(f"range:{column}", holds, _shown(column))


def in_domain(column: str, values: list) -> Rule:
    return Rule(f"domain:{column}", F.col(column).isin(values), _shown(column))


def matches(column: str, pattern: str) -> Rule:
    return Rule(f"pattern:{column}", F.col(column).rlike(pattern), _shown(column))


def not_before(later: str, earlier: str) -> Rule:
    return Rule(f"order:{later}>={earlier}", F.col(later) >= F.col(earlier), _shown(later, earlier))


def not_blank(column: str) -> Rule:
    return Rule(
        f"not_blank:{column}",
        F.char_length(F.trim(F.col(column))) > 0,
        F.lit(f"{column} is blank"),
    )


def row_violations(df: DataFrame, table: str, key: list[str], rules: list[Rule]) -> DataFrame:
    """All row rules of a table in one scan."""
    broken = F.array_compact(
        F.array(
            *[
                F.when(~r.holds, F.struct(F.lit(r.name).alias("check"), r.detail.alias("detail")))
                for r in rules
            ]
        )
    )
    # The outer form plus a null test: the plain generator would make Spark test every
    # rule once more in a filter of its own.
    found = df.select(_key_text(key).alias("key"), F.inline_outer(broken))
    return found.filter(F.col("check").isNotNull()).select(
        "check", F.lit(table).alias("tbl"), "key", "detail", F.lit(1).cast("bigint").alias("rows")
    )


def _key_text(key: list[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in key])


def _report(df: DataFrame, check: str, table: str, key: list[str], detail: Column) -> DataFrame:
    return df.select(
        F.lit(check).alias("check"),
        F.lit(table).alias("tbl"),
        _key_text(key).alias("key"),
        detail.alias("detail"),
        F.col("rows"),
    )


def unique_key(df: DataFrame, table: str, key: list[str]) -> DataFrame:
    """Keys held by more than one row."""
    repeated = df.groupBy(*key).agg(F.count("*").alias("rows")).filter(F.col("rows") > 1)
    return _report(repeated, "unique:" + ",".join(key), table, key, F.lit("repeated key"))


def foreign_key(
    child: DataFrame, table: str, key: list[str], parent: DataFrame, parent_key: list[str]
) -> DataFrame:
    """Child keys without a parent; a key with a null part passes."""
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])
    used = child.filter(known).groupBy(*key).agg(F.count("*").alias("rows"))
    parents = parent.select(*[F.col(p).alias(f"_p{i}") for i, p in enumerate(parent_key)])
    on = [F.col(k) == F.col(f"_p{i}") for i, k in enumerate(key)]
    orphans = used.join(parents, on, "left_anti")
    return _report(orphans, "foreign:" + ",".join(key), table, key, F.lit("no such parent"))


def overlapping_periods(df: DataFrame, key: str, lo: str, hi: str) -> DataFrame:
    """Periods of one key that overlap, one row per (key, start).

    A start is listed if an earlier period of the key is still open there, or if several
    periods begin on it. Periods are half-open: touching is allowed, empty ones never
    overlap, a null bound is unbounded.

    The running maximum of the ends is a prefix scan: starts are made distinct and dealt to
    ranges by key and start, so that the periods of one busy key or day lie in as many ranges as their
    number asks for; each range has its own maxima, and per key and range one row carries the maximum over the
    range's edge.
    """
    kind = df.schema[lo].dataType
    low = F.lit("0001-01-01").cast(kind)
    high = F.lit("9999-12-31 23:59:59").cast(kind)
    starts = (
        df.select(
            F.col(key).alias("key"),
            F.coalesce(F.col(lo), low).alias("lo"),
            F.coalesce(F.col(hi), high).alias("hi"),
        )
        .filter(F.col("key").isNotNull() & (F.col("lo") < F.col("hi")))
        .groupBy("key", "lo")
        .agg(F.max("hi").alias("hi"), F.count("*").alias("periods"))
    )
    runs = sorted_runs(starts, ["key", "lo"], "periods")
    earlier = (Window.unboundedPreceding, -1)
    edges = runs.groupBy("key", RUN).agg(F.max("hi").alias("run_hi"))
    carried = edges.select(
        F.col("key").alias("edge_key"),
        F.col(RUN).alias("edge_run"),
        F.max("run_hi").over(Window.partitionBy("key").orderBy(RUN).rowsBetween(*earlier)).alias("carried"),
    ).filter(F.col("carried").isNotNull())
    within = F.max("hi").over(Window.partitionBy("key", RUN).orderBy("lo").rowsBetween(*earlier))
    return (
        runs.withColumn("within", within)
        .join(carried, (F.col("key") == F.col("edge_key")) & (F.col(RUN) == F.col("edge_run")), "left")
        .withColumn("open_until", F.greatest("within", "carried"))
        .filter((F.col("open_until") > F.col("lo")) | (F.col("periods") > 1))
        .select(F.col("key").alias(key), F.col("lo").alias(lo), "periods", "open_until")
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    """How many rows are exact copies of an earlier one."""
    counted = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    return counted.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"))


def atomicity(df: DataFrame) -> DataFrame:
    """Per column: does any text cell hold a list separator. One pass."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    cells = [
        F.struct(
            F.lit(name).alias("column"),
            F.lit(kind).alias("type"),
            (
                F.coalesce(F.max(F.col(name).rlike(r"[,;|]")), F.lit(False))
                if kind == "string"
                else F.lit(False)
            ).alias("has_separator"),
        )
        for name, kind in kinds.items()
    ]
    return df.agg(F.array(*cells).alias("c")).select(F.inline("c"))


def granularity(df: DataFrame, key: str) -> DataFrame:
    """Rows against distinct keys, and how many keys are repeated."""
    per_key = df.groupBy(key).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count(key).alias("distinct_keys"),
        F.count_if(F.col(key).isNotNull() & (F.col("n") > 1)).alias("repeated_keys"),
    )


def repeated_keys(df: DataFrame, key: str, n: int | None = None) -> DataFrame:
    """Keys on several rows with their frequency, most frequent first; ``n`` for a top list."""
    counted = (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias("rows"))
        .filter(F.col("rows") > 1)
        .orderBy(F.col("rows").desc(), key)
    )
    return counted if n is None else counted.limit(n)


def rows_of(df: DataFrame, key: str, value) -> DataFrame:
    return df.filter(F.col(key) == F.lit(value))


def determines(df: DataFrame, left: list[str], right: list[str]) -> DataFrame:
    """Breaks of the dependency ``left -> right``: keys with more than one right side.

    An empty result says that ``right`` depends on ``left`` alone, so keeping it in a
    table with a wider key repeats it (second and third normal form).
    """
    versions = df.groupBy(*left, *right).agg(F.count("*").alias("n"))
    return (
        versions.groupBy(*left)
        .agg(F.count("*").alias("versions"), F.sum("n").alias("rows"))
        .filter(F.col("versions") > 1)
    )


def redundancy(df: DataFrame, left: list[str]) -> DataFrame:
    """How often facts that depend on ``left`` alone are repeated: keys and spare rows."""
    return (
        df.groupBy(*left)
        .agg(F.count("*").alias("n"))
        .agg(
            F.count_if(F.col("n") > 1).alias("keys_repeated"),
            F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("rows_spare"),
        )
    )


def cardinality(a: DataFrame, b: DataFrame, key: str, key_b: str | None = None) -> DataFrame:
    """``1`` or ``N`` for each side of a relation; null keys are left out."""

    def busiest(df: DataFrame, column: str) -> DataFrame:
        counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
        return counts.agg(
            F.when(F.max("n") == 1, "1").otherwise("N").alias("side"),
        )

    left = busiest(a, key).withColumnRenamed("side", "left_side")
    return left.withColumn("right_side", busiest(b, key_b or key).scalar())


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    frames = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("tbl"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, frames)


def rows_per_partition(df: DataFrame, part: str = "part") -> DataFrame:
    return df.groupBy(part).agg(F.count("*").alias("rows"))


def bytes_per_partition(df: DataFrame, part: str = "part") -> DataFrame:
    """Rows, files and bytes per bucket of a file-backed table."""
    files = df.groupBy(
        part, F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size")
    ).agg(F.count("*").alias("n"))
    return files.groupBy(part).agg(
        F.sum("n").alias("rows"), F.count("*").alias("files"), F.sum("size").alias("bytes")
    )


def default_rows(df: DataFrame, part: str = "part") -> DataFrame:
    return df.filter(F.col(part) == "default").agg(F.count("*").alias("rows_in_default"))


def bucket_balance(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """Rows and percent per hash bucket of a key: a trial of a distribution key."""
    return share_of_total(
        df.select(hash_bucket(F.col(key), buckets).alias("shard")), ["shard"], count="orders"
    ).orderBy("shard")


def integrity_error_rate(
    child: DataFrame, key: str, parent: DataFrame, parent_key: str
) -> DataFrame:
    """Share of child rows whose key has no parent."""
    used = child.groupBy(key).agg(F.count("*").alias("n"))
    known = parent.select(F.col(parent_key).alias("_p"), F.lit(True).alias("_known")).distinct()
    orphan = F.col(key).isNotNull() & F.col("_known").isNull()
    return used.join(known, F.col(key) == F.col("_p"), "left").agg(
        F.sum("n").alias("rows"),
        F.sum(F.when(orphan, F.col("n")).otherwise(0)).alias("orphan_rows"),
        F.try_divide(
            F.sum(F.when(orphan, F.col("n")).otherwise(0)), F.sum("n")
        ).alias("error_rate"),
    )


def run_checks(reports: list[DataFrame]) -> DataFrame:
    """All violation lists as one."""
    return reduce(DataFrame.unionByName, reports)


# -- documents of open shape ------------------------------------------------------------

# Document type names and the VARIANT types they accept.
_TYPE_PATTERNS = {
    "string": "^STRING",
    "int": "^BIGINT",
    "long": "^BIGINT",
    "double": "^(DOUBLE|FLOAT|DECIMAL)",
    "decimal": "^DECIMAL",
    "object": "^OBJECT",
    "array": "^ARRAY",
    "null": "^VOID",
}


def dealt(rows: DataFrame) -> DataFrame:
    """Rows dealt over the tasks by their hash: a file of few bytes is few tasks, but many documents to make, parse and test.

    Use it before texts or columns become a VARIANT, which has no hash.
    """
    return rows.repartition(F.xxhash64(*rows.columns))


def validate_docs(docs: DataFrame, doc: str, key: str, shape: dict, collection: str) -> DataFrame:
    """Violations of a document shape, from a VARIANT column, in one pass.

    A null document (text that is no JSON) is a violation of its own.
    Fields the shape does not name pass. ``date`` accepts text that parses as a time, as
    JSON has no date type.
    """
    is_object = F.coalesce(_is_object(F.col(doc)), F.lit(False))
    whole = Rule("type:document", is_object, F.lit("the document is no object"))
    rules = [whole, *_shape_rules(F.col(doc), shape, "")]
    return row_violations(docs, collection, [key], rules)


def _shape_rules(doc: Column, shape: dict, at: str) -> list[Rule]:
    rules = []
    for name in shape.get("required", []):
        present = _field(doc, name).isNotNull()
        rules.append(
            Rule(
                f"required:{at}{name}",
                F.when(_is_object(doc), present).otherwise(F.lit(True)),
                F.lit(f"{at}{name} is missing"),
            )
        )
    for name, rule in shape.get("fields", {}).items():
        value = _field(doc, name)
        where = f"{at}{name}"
        if "types" in rule:
            kind = F.schema_of_variant(value)
            rules.append(
                Rule(
                    f"type:{where}",
                    _only_if(value, _has_type(value, rule["types"])),
                    F.concat(F.lit(f"{where} is "), kind),
                )
            )
        rules += _value_rules(value, rule, where)
        if "fields" in rule or "required" in rule:
            rules += _shape_rules(value, rule, f"{where}.")
        if "items" in rule:
            elements = F.try_variant_get(value, "$", "array<variant>")
            for inner in _item_rules(rule["items"], where):
                rules.append(
                    Rule(
                        inner[0],
                        _only_if(elements, F.forall(elements, inner[1])),
                        F.lit(f"{where}[] breaks {inner[0]}"),
                    )
                )
    return rules


def _item_rules(item: dict, where: str) -> list[tuple[str, Callable[[Column], Column]]]:
    def has(name: str):
        return lambda e: _field(e, name).isNotNull()

    def typed(name: str, types: list[str]):
        return lambda e: _field(e, name).isNull() | _has_type(_field(e, name), types)

    required = [(f"required:{where}[].{name}", has(name)) for name in item.get("required", [])]
    kinds = [
        (f"type:{where}[].{name}", typed(name, rule["types"]))
        for name, rule in item.get("fields", {}).items()
        if "types" in rule
    ]
    return required + kinds


def _value_rules(value: Column, rule: dict, where: str) -> list[Rule]:
    rules = []
    shown = F.concat(F.lit(f"{where}="), F.to_json(value))
    number = F.try_variant_get(value, "$", "double")
    if "min" in rule:
        rules.append(Rule(f"min:{where}", number >= rule["min"], shown))
    if "max" in rule:
        rules.append(Rule(f"max:{where}", number <= rule["max"], shown))
    if "enum" in rule:
        rules.append(
            Rule(f"enum:{where}", F.try_variant_get(value, "$", "string").isin(rule["enum"]), shown)
        )
    length = F.size(F.try_variant_get(value, "$", "array<variant>"))
    if "min_items" in rule:
        rules.append(Rule(f"min_items:{where}", length >= rule["min_items"], shown))
    if "max_items" in rule:
        rules.append(Rule(f"max_items:{where}", length <= rule["max_items"], shown))
    return rules


def _is_object(doc: Column) -> Column:
    return F.schema_of_variant(doc).startswith("OBJECT")


def _field(doc: Column, name: str) -> Column:
    return F.try_variant_get(doc, f"$.{name}", "variant")


def _only_if(present: Column, holds: Column) -> Column:
    return F.when(present.isNotNull(), holds).otherwise(F.lit(True))


def _has_type(value: Column, names: list[str]) -> Column:
    kind = F.schema_of_variant(value)
    accepted = F.lit(False)
    for name in names:
        if name == "date":
            text = F.try_variant_get(value, "$", "string")
            accepted = accepted | (
                kind.rlike("^STRING") & F.try_to_timestamp(text).isNotNull()
            )
        else:
            accepted = accepted | kind.rlike(_TYPE_PATTERNS[name])
    return accepted
