"""JSON columns whose often-asked paths are kept as typed columns of their own, so that filters reach the scan."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.functions.predicates import json_contains
from storelens.functions.scalars import let

_KINDS = {"string": "^STRING$", "boolean": "^BOOLEAN$", "double": "^(BIGINT|DOUBLE|DECIMAL)"}


@dataclass(frozen=True)
class JsonPaths:
    """``column`` holds JSON text; ``paths`` names scalars in it, as ``a.b``, with type string, boolean or double."""

    column: str
    paths: dict[str, str] = field(hash=False)

    def name(self, path: str) -> str:
        return f"{self.column}__{path.replace('.', '__')}"


def with_paths(df: DataFrame, spec: JsonPaths) -> DataFrame:
    """``df`` with a column per path, parsed once; null where the path is missing or of another type (a number is no string)."""

    def value(doc: Column, path: str, kind: str) -> Column:
        steps = "$" + "".join("['" + p.replace("'", "\\'") + "']" for p in path.split("."))
        return let(
            F.try_variant_get(doc, steps, "variant"),
            lambda v: F.when(F.schema_of_variant(v).rlike(_KINDS[kind]), F.try_variant_get(v, "$", kind)),
        )

    taken = let(F.try_parse_json(F.col(spec.column)), lambda doc: F.struct(*(value(doc, p, k).alias(spec.name(p)) for p, k in spec.paths.items())))
    return df.withColumn("_paths", taken).select(*df.columns, *(F.col(f"_paths.{spec.name(p)}").alias(spec.name(p)) for p in spec.paths))


def holds(spec: JsonPaths, wanted: dict) -> Column:
    """The JSON holds everything in ``wanted``: as ``json_contains``, over a table written with the spec's columns.

    Declared scalars are compared in their columns, which the scan can use to leave row groups out; the text is
    parsed only for what is not declared, and not even read if everything is.
    """
    checks, rest = _split(spec, wanted, "")
    if rest or not checks:
        checks.append(json_contains(F.col(spec.column), rest or wanted))
    out = checks[0]
    for c in checks[1:]:
        out = out & c
    return out


def _split(spec: JsonPaths, wanted: dict, above: str) -> tuple[list[Column], dict]:
    """Column tests for the declared leaves, and the part of ``wanted`` that is left."""
    checks, rest = [], {}
    for key, inner in wanted.items():
        path, kind = f"{above}{key}", spec.paths.get(f"{above}{key}")
        if isinstance(inner, dict) and inner:
            more, left = _split(spec, inner, f"{path}.")
            checks += more
            if left:
                rest[key] = left
        elif "." not in key and _fits(inner, kind):
            checks.append(F.col(spec.name(path)) == F.lit(float(inner) if kind == "double" else inner))
        else:
            rest[key] = inner
    return checks, rest


def _fits(value, kind: str | None) -> bool:
    if isinstance(value, bool):
        return kind == "boolean"
    if isinstance(value, (int, float)):
        return kind == "double" and abs(value) < 1 << 53
    return isinstance(value, str) and kind == "string"
