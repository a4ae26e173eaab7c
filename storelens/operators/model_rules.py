"""The commerce model's own constraints as rule sets, one per table, and their check over whatever tables are at hand."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens import schemas
from storelens.operators import quality
from storelens.operators.quality import Rule


@dataclass(frozen=True)
class TableSpec:
    """Constraints of a table: its key, columns that must be there, parents of foreign keys, row rules, and spans that must not overlap."""

    key: tuple[str, ...]
    required: tuple[str, ...] = ()
    parents: tuple[tuple[tuple[str, ...], str, tuple[str, ...]], ...] = ()
    rules: tuple[Rule, ...] = ()
    apart: tuple[str, str, str] | None = None


def _at_least_zero(*columns: str) -> tuple[Rule, ...]:
    return tuple(quality.in_range(c, 0) for c in columns)


def model() -> dict[str, TableSpec]:
    """The rule sets by table name. A null passes every rule but ``required``, and every foreign key, as in SQL."""
    order = (("order_id",), "orders", ("order_id",))
    place = lambda c: ((c,), "geo_locations", ("zip_code_prefix",))
    return {
        "customers": TableSpec(
            ("customer_id",),
            ("customer_id", "customer_unique_id", "customer_city", "customer_state"),
            (place("customer_zip_code_prefix"),),
            (quality.matches("customer_state", schemas.STATE_PATTERN),),
        ),
        "sellers": TableSpec(
            ("seller_id",),
            ("seller_id", "seller_city", "seller_state"),
            (place("seller_zip_code_prefix"),),
            (quality.matches("seller_state", schemas.STATE_PATTERN),),
        ),
        "geo_locations": TableSpec(
            ("zip_code_prefix",),
            ("zip_code_prefix", "city", "state"),
            (),
            (quality.matches("state", schemas.STATE_PATTERN), quality.in_range("latitude", -90, 90), quality.in_range("longitude", -180, 180)),
        ),
        "products": TableSpec(
            ("product_id",), ("product_id",), (), _at_least_zero("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")
        ),
        "orders": TableSpec(
            ("order_id",),
            ("order_id", "customer_id", "order_status", "order_purchase_timestamp"),
            ((("customer_id",), "customers", ("customer_id",)),),
            (quality.in_domain("order_status", schemas.ORDER_STATUSES), quality.not_before("order_approved_at", "order_purchase_timestamp")),
        ),
        "order_items": TableSpec(
            ("order_id", "order_item_id"),
            ("order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value"),
            (order, (("product_id",), "products", ("product_id",)), (("seller_id",), "sellers", ("seller_id",))),
            _at_least_zero("price", "freight_value"),
        ),
        "order_payments": TableSpec(
            ("order_id", "payment_sequential"),
            ("order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"),
            (order,),
            (quality.in_domain("payment_type", schemas.PAYMENT_TYPES), *_at_least_zero("payment_installments", "payment_value")),
        ),
        "order_reviews": TableSpec(("review_id",), ("review_id", "order_id", "review_score"), (order,), (quality.in_range("review_score", 1, 5),)),
        "product_promotions": TableSpec(
            ("promotion_id",),
            ("promotion_id", "product_id", "discount_percentage"),
            ((("product_id",), "products", ("product_id",)), (("seller_id",), "sellers", ("seller_id",))),
            (quality.in_range("discount_percentage", 0, 100, lo_open=True),),
            ("product_id", "period_lo", "period_hi"),
        ),
        "outbox_events": TableSpec(
            ("event_id",), ("event_id", "aggregate_type", "aggregate_id", "event_type", "payload"), (), _at_least_zero("retries")
        ),
    }


def check_tables(tables: dict[str, DataFrame], specs: dict[str, TableSpec] | None = None) -> DataFrame:
    """Every violation in the tables at hand: ``check, tbl, key, detail, rows``.

    All row rules of a table are one pass; keys and foreign keys count per key before they are shuffled. A foreign
    key is checked if its parent table is there as well; rules on columns that a table lacks are passed over.
    """
    specs = specs if specs is not None else model()
    reports = []
    for name, spec in specs.items():
        if name not in tables:
            continue
        df, key = tables[name], list(spec.key)
        rules = [*quality.not_null(*(c for c in spec.required if c in df.columns)), *(r for r in spec.rules if _has(df, r))]
        reports.append(quality.row_violations(df, name, key, rules))
        if all(k in df.columns for k in key):
            reports.append(quality.unique_key(df, name, key))
        for columns, parent, parent_key in spec.parents:
            if parent in tables and all(c in df.columns for c in columns):
                reports.append(quality.foreign_key(df, name, list(columns), tables[parent], list(parent_key)))
        if spec.apart and all(c in df.columns for c in spec.apart):
            reports.append(_overlaps(df, name, *spec.apart))
    return quality.run_checks(reports)


def _has(df: DataFrame, rule: Rule) -> bool:
    """Whether the table has the columns that the rule's name says it looks at."""
    return all(c in df.columns for c in rule.name.split(":", 1)[1].split(">="))


def _overlaps(df: DataFrame, table: str, key: str, lo: str, hi: str) -> DataFrame:
    found = quality.overlapping_periods(df, key, lo, hi)
    return found.select(
        F.lit(f"apart:{key},{lo},{hi}").alias("check"),
        F.lit(table).alias("tbl"),
        F.concat_ws("|", F.coalesce(F.col(key).cast("string"), F.lit("null")), F.col(lo).cast("string")).alias("key"),
        F.lit("overlaps another").alias("detail"),
        F.col("periods").alias("rows"),
    )


def summary(violations: DataFrame) -> DataFrame:
    """How many keys and rows break each rule."""
    return violations.groupBy("check", "tbl").agg(F.count("*").alias("keys"), F.sum("rows").alias("rows"))


def typed(tables: dict[str, DataFrame], declared: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """The tables with the columns and types that the model declares; values that do not fit fail the read.

    Columns a table lacks are null; those the model does not know are kept, after the declared ones.
    """
    declared = declared if declared is not None else schemas.TABLES
    out = {}
    for name, df in tables.items():
        if name not in declared:
            out[name] = df
            continue
        fields = df.sparkSession.createDataFrame([], declared[name]).schema.fields
        known = [(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields]
        names = {f.name for f in fields}
        out[name] = df.select(*known, *(c for c in df.columns if c not in names))
    return out
