"""Secret scans: a trigram inverted index finds the texts to verify for each rule.

Everything on the path from documents to spans is DataFrame functions. Only the rules, a fixed
list, are analysed on the driver: their parse trees give the trigrams that any match must contain.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product
from re import _constants as op
from re import _parser

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storelens.llm.common import id_or_last, text_key, text_or_empty


@dataclass(frozen=True)
class Rule:
    """``group`` of a match must have ``least`` characters; base rules come first in their order."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    base: bool = False


# The kinds and patterns to be found.
RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16, True),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32, True),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abeoprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("webtoken", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
)
_MOST = 32


def trigram_query(pattern: str) -> tuple[frozenset[str], ...]:
    """The pattern's Boolean query: alternatives, each a set of lower-case trigrams that must all occur.

    Empty if the pattern has no mandatory trigram: every text must then be scanned. The strings
    that a part of the pattern can match are followed as long as they are few; where they are not,
    what has been gathered is cut into trigrams.
    """

    def strings(part) -> set[str] | None:
        kind, value = part
        if kind is op.LITERAL:
            return {chr(value).lower()}
        if kind is op.IN:
            out: set[str] = set()
            for item, of in value:
                if item is op.LITERAL:
                    out.add(chr(of).lower())
                elif item is op.RANGE and of[1] - of[0] < _MOST:
                    out |= {chr(c).lower() for c in range(of[0], of[1] + 1)}
                else:
                    return None
            return out if len(out) <= 8 else None
        if kind is op.SUBPATTERN:
            return sequence(value[3])
        if kind is op.BRANCH:
            each = [sequence(b) for b in value[1]]
            return None if None in each else set().union(*each)
        if kind in (op.MAX_REPEAT, op.MIN_REPEAT):
            low, high, inner = value
            one = sequence(inner)
            if one is None or high is op.MAXREPEAT or int(high) > 2:
                return None
            return {"".join(x) for n in range(low, int(high) + 1) for x in product(one, repeat=n)}
        return None

    def sequence(parts) -> set[str] | None:
        out = {""}
        for part in parts:
            if (more := strings(part)) is None:
                return None
            out = {a + b for a in out for b in more}
            if len(out) > _MOST:
                return None
        return out

    def cut(found: set[str]) -> tuple[frozenset[str], ...]:
        if any(len(x) < 3 for x in found):
            return ()
        sets = {frozenset(x[i : i + 3] for i in range(len(x) - 2)) for x in found}
        # an alternative that demands all of another one adds nothing
        return tuple(s for s in sets if not any(other < s for other in sets))

    best: tuple[frozenset[str], ...] = ()
    have = {""}
    for part in [*_parser.parse(pattern), None]:
        more = strings(part) if part is not None else None
        grown = {a + b for a in have for b in more} if more is not None else None
        if grown is not None and len(grown) <= _MOST:
            have = grown
            continue
        query = cut(have)
        # of the runs of the pattern keep the one whose least demanding alternative demands most
        if query and (not best or min(map(len, query)) > min(map(len, best))):
            best = query
        have = more if more is not None and grown is not None and len(more) <= _MOST else {""}
    return best


def _any_of(words: list[str]) -> str:
    """A regex of alternatives that share their first letters."""
    heads: dict[str, list[str]] = {}
    for w in words:
        heads.setdefault(w[:1], []).append(w[1:])
    parts = [re.escape(h) + ("" if rest == [""] else f"(?:{_any_of(rest)})") for h, rest in sorted(heads.items())]
    return "|".join(parts)


def postings(named: DataFrame, trigrams: list[str]) -> DataFrame:
    """The inverted index over the trigrams that queries use: one row per trigram and text that has it."""
    lower = F.lower("text")
    found = F.regexp_extract_all(lower, F.lit(f"(?=({_any_of(trigrams)}))"), F.lit(1))
    return named.select("id", "key", F.explode(F.array_distinct(found)).alias("trigram"))


def candidates(named: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Texts and the kinds of which they have all trigrams of some alternative: ``id, key, kinds``."""
    queries = [(r.kind, i, sorted(q)) for r in rules for i, q in enumerate(trigram_query(r.pattern))]
    terms = [(kind, i, len(q), t) for kind, i, q in queries for t in q]
    # as many rows as the rules have trigrams
    names = ("kind", "alternative", "needed", "trigram")
    listed = F.array(*(F.struct(*(F.lit(v).alias(n) for n, v in zip(names, t, strict=True))) for t in terms))
    wanted = named.sparkSession.range(1).select(F.inline(listed))
    hits = postings(named, sorted({t[3] for t in terms})).join(F.broadcast(wanted), "trigram")
    met = hits.groupBy("id", "key", "kind", "alternative", "needed").agg(F.count_distinct("trigram").alias("n"))
    return met.where("n = needed").groupBy("id", "key").agg(F.collect_set("kind").alias("kinds"))


def _matches(rule: Rule) -> Column:
    """All matches of a rule in ``text``: lengths of the gap before each, of the match, and whether it counts."""
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all("text", pattern, F.lit(0))
    gaps = F.split("text", rule.pattern, -1)
    tested = F.regexp_extract_all("text", pattern, F.lit(rule.group))
    return F.transform(
        F.arrays_zip(F.slice(gaps, 1, F.size(found)).alias("gap"), found.alias("found"), tested.alias("tested")),
        lambda x: F.struct(
            F.length(x["gap"]).alias("gap"),
            F.length(x["found"]).alias("size"),
            (F.length(x["tested"]) >= rule.least).alias("counts"),
        ),
    )


def find(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per distinct (id, text): ``id``, ``key`` (of the text), ``times`` and ``found``.

    ``found`` is the list of spans by start and then by the order of the rules: ``start``, ``place``
    of the rule, ``kind``, ``end`` (code points, end exclusive). Matches of a rule are leftmost and do
    not overlap; those of different rules may. Null texts count as empty and have none.
    """
    named = docs.select(id_or_last().alias("id"), text_key().alias("key"), text_or_empty().alias("text"))
    indexed = tuple(r for r in rules if trigram_query(r.pattern))
    chosen = candidates(named, indexed)
    marked = named.join(chosen, ["id", "key"], "left")
    none = F.lit(None).cast("array<struct<gap:int,size:int,counts:boolean>>")
    every = [
        F.when(
            F.array_contains("kinds", r.kind) if r in indexed else F.col("text").rlike(r.pattern),
            _matches(r),
        ).otherwise(none).alias(r.kind)
        for r in rules
    ]
    # equal rows give equal lists, so one of each is worked on
    verified = marked.select("id", "key", *every)
    once = verified.groupBy("id", "key").agg(F.count("*").alias("times"), *(F.any_value(r.kind).alias(r.kind) for r in rules))
    by_rule = F.array(*(F.struct(F.lit(i).alias("place"), F.lit(r.kind).alias("kind"), F.col(r.kind).alias("list")) for i, r in enumerate(rules)))
    lists = once.where(F.greatest(*(F.coalesce(F.size(r.kind), F.lit(-1)) for r in rules)) > 0).select("id", "key", F.explode(by_rule).alias("of"))
    each = lists.select("id", "key", "of.place", "of.kind", F.posexplode("of.list").alias("i", "m"))
    so_far = Window.partitionBy("id", "key", "place").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = F.sum(F.col("m.gap") + F.col("m.size")).over(so_far)
    spans = each.withColumn("end", ends).where("m.counts").select(
        "id", "key", F.struct((F.col("end") - F.col("m.size")).alias("start"), "place", "kind", "end").alias("span")
    )
    listed = spans.groupBy("id", "key").agg(F.sort_array(F.collect_list("span")).alias("found"))
    empty = F.array().cast("array<struct<start:bigint,place:int,kind:string,end:bigint>>")
    return once.select("id", "key", "times").join(listed, ["id", "key"], "left").withColumn("found", F.coalesce("found", empty))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ","
    )


def of_kind(spans: str, kind: str) -> Column:
    """How many spans are of a kind."""
    return F.size(F.filter(spans, lambda x: x["kind"] == kind))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: ``doc_id``, ``found`` (see ``find``) and ``base`` (spans of base rules).

    Equal rows each get their row; null ids stay null (an id of 2^63 - 1 is read as null); an empty
    table gives no rows. Other columns are not read.
    """
    base = F.array(*(F.lit(r.kind) for r in rules if r.base))
    once = find(docs, rules)
    block = 10_000
    again = once.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("times") - 1) / block))))
    rows = F.explode(F.sequence(F.lit(1).cast("bigint"), F.least(F.lit(block), F.col("times") - F.col("block") * block)))
    return again.withColumn("row", rows).select(
        F.nullif("id", F.lit((1 << 63) - 1)).alias("doc_id"),
        "found",
        F.filter("found", lambda x: F.array_contains(base, x["kind"])).alias("base"),
    )


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``mark``; overlapping spans become one mark.

    Texts without a secret, null ones included, stay as they are, and so do all other columns.
    """
    names = [F.col(f"d.`{c}`") for c in docs.columns]
    spans = find(docs, rules).where(F.size("found") > 0).select("id", "key", "found")
    named = docs.alias("d").select(F.struct(*names).alias("row"), id_or_last().alias("id"), text_key().alias("key"))
    hit = named.join(spans, ["id", "key"], "left")
    text = F.col("row.text")
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("upto"))

    def one(done: Column, span: Column) -> Column:
        gap = F.substring(text, (done["upto"] + 1).cast("int"), F.greatest(span["start"] - done["upto"], F.lit(0)).cast("int"))
        more = F.when(span["start"] >= done["upto"], F.concat(done["out"], gap, F.lit(mark))).otherwise(done["out"])
        return F.struct(more.alias("out"), F.greatest(done["upto"], span["end"]).alias("upto"))

    masked = F.aggregate(
        "found", start, one, lambda d: F.concat(d["out"], F.substring(text, (d["upto"] + 1).cast("int"), F.length(text)))
    )
    shown = F.when(F.col("found").isNull(), text).otherwise(masked)
    return hit.select(*(shown.alias("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns))
