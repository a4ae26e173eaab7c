"""Mixing sources to target weights by pivotal dependent rounding."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storelens.llm import kernels
from storelens.llm.common import stored

_UNITS = "source string, leaf bigint, doc_id bigint, a bigint, b bigint, size double, times bigint, share double, whole bigint, open boolean"
_ARROW = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), ("a", pa.int64()), ("b", pa.int64()), ("size", pa.int64())])


def sizes(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``source``, ``size`` in words and 128 bits that name the row's content."""
    named = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"), "text", *row_name(docs)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in kernels.slices(batch):
                kept = [kernels.column(part, n) for n in ("doc_id", "source", "a", "b")]
                yield kernels.rows(_ARROW, *kept, kernels.Words(texts).count)

    return named.mapInArrow(run, "doc_id bigint, source string, a bigint, b bigint, size bigint")


def row_name(docs: DataFrame) -> list:
    """Two 64-bit hashes of all columns of a row; equal rows have equal names."""
    content = F.to_json(F.struct(*(F.col(f"`{c}`") for c in sorted(docs.columns) if c != "text")), {"ignoreNullFields": "false"})
    parts = [content, F.col("text").isNull(), F.coalesce("text", F.lit(""))]
    return [F.xxhash64(*parts).alias("a"), F.xxhash64(F.lit(1), *parts).alias("b")]


def targets(per_source: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """``per_source`` (source, source_size) with ``target``: ``share`` of all words dealt by weight.

    Sources in code-point order, null last, take the weights in turn. A target stops at ``most``
    times its source's size; the excess goes to the others by weight until none is above. With
    sources ordered by size over weight, those before some place are full and the rest share what
    is left; the place is found from running sums, so one row per source is ordered, not the documents.
    """
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), (F.col("place") % len(weights) + 1).cast("int"))
    numbered = per_source.withColumn("place", F.row_number().over(in_order) - 1).withColumn("weight", weight)
    everywhere = Window.partitionBy()
    full = F.col("source_size") * F.lit(float(most))
    before = Window.orderBy(full / F.col("weight"), "place").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy(full / F.col("weight"), "place").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    all_words = F.sum("source_size").over(everywhere).cast("double")
    level = (all_words * share - F.coalesce(F.sum(full).over(before), F.lit(0.0))) / F.sum("weight").over(after)
    leveled = numbered.withColumn("level", level).withColumn("room", full / F.col("weight"))
    settled = F.min(F.when(F.col("level") <= F.col("room"), F.struct("room", "place", "level"))).over(everywhere)
    return leveled.withColumn("at", settled).select(
        "source",
        "source_size",
        # with no such place every source is full
        F.coalesce(F.least(full, F.col("weight") * F.col("at.level")), full).alias("target"),
    )


def _uniform(pair: np.ndarray, seed: int) -> np.ndarray:
    return (kernels.mix(pair + np.uint64(seed)) >> np.uint64(11)).astype(np.float64) / (1 << 53)


def _against_pool(size: np.ndarray, share: float, draw: np.ndarray) -> tuple[np.ndarray, int]:
    """Shares after rounding units that begin with one share; sizes descend. Also the unit left open, or -1.

    Each unit is paired with the pool of all smaller ones, whose members keep one common share.
    Words move between the two until the unit is in or out, or the pool is.
    """
    out = np.zeros(len(size))
    rest = float(size.sum())
    for i, s in enumerate(size.tolist()):
        rest -= s
        if share <= 0 or share >= 1:
            out[i:] = min(max(share, 0.0), 1.0)
            return out, -1
        if rest <= 0:
            out[i] = share
            return out, i
        up, down = min((1 - share) * s, share * rest), min(share * s, (1 - share) * rest)
        if draw[i] * (up + down) < down:
            out[i], share = (1.0, share - up / rest) if up == (1 - share) * s else (share + up / s, 0.0)
        else:
            out[i], share = (0.0, share + down / rest) if down == share * s else (share - down / s, 1.0)
        if 0 < out[i] < 1:
            out[i + 1 :] = share
            return out, i
    return out, -1


def _pivot(units: pd.DataFrame, seed: int) -> pd.DataFrame:
    """Pivotal rounding of one leaf: at most one unit stays fractional.

    What two sides of a pair exchange is words, not probability, so the sum of share times size
    is kept; the direction is drawn so that each share keeps its mean. Units of one share, as
    all of a source have at first, are paired with the pool of the smaller ones, which leaves a small
    unit open; then the open unit is paired with each other one. Draws depend on the
    units' names alone.
    """
    units = units.sort_values(["size", "a", "b", "doc_id"], ascending=[False, True, True, True], kind="stable").reset_index(drop=True)
    name = kernels.mix(units["a"].to_numpy().view(np.uint64)) + units["b"].to_numpy().view(np.uint64)
    draw = _uniform(name, seed)
    share, size = units["share"].to_numpy().copy(), units["size"].to_numpy()
    todo = np.flatnonzero((share > 0) & (share < 1) & (size > 0))
    open_ = -1
    if len(todo):
        values, times = np.unique(share[todo], return_counts=True)
        common = values[np.argmax(times)]
        alike = todo[share[todo] == common]
        share[alike], at = _against_pool(size[alike], float(common), draw[alike])
        open_ = int(alike[at]) if at >= 0 else -1
        todo = todo[~np.isin(todo, alike)]
    for i in todo.tolist():
        if open_ < 0:
            open_ = i
            continue
        s, t, p, q = size[open_], size[i], share[open_], share[i]
        up, down = min((1 - p) * s, q * t), min(p * s, (1 - q) * t)
        if draw[i] * (up + down) < down:
            # words go to the open unit
            p, q = (1.0, q - up / t) if up == (1 - p) * s else (p + up / s, 0.0)
        else:
            p, q = (0.0, q + down / t) if down == p * s else (p - down / s, 1.0)
        share[open_], share[i] = p, q
        left = [k for k in (open_, i) if 0 < share[k] < 1]
        open_ = left[0] if left else -1
    units["whole"] += (share == 1).astype(np.int64)
    units["open"] = np.arange(len(units)) == open_
    units["share"] = np.where(units["open"], share, 0.0)
    return units


def _pivot_with(seed: int):
    return lambda units: _pivot(units, seed)


def copies(docs: DataFrame, weights: tuple[float, ...], share: float = 1.5, most: float = 2.0, seed: int = 7, leaf_rows: int = 20_000, fan_in: int = 64) -> DataFrame:
    """One row per distinct row of ``docs``: ``times`` it occurs and the ``copies`` taken of all of them.

    ``doc_id, source, a, b, size, source_size, target, times, copies``. A source's rows are dealt to
    leaves by the hash of their content, as many as keep a leaf near ``leaf_rows`` rows, so a large
    source is many tasks and the draw does not depend on the layout of the input. Each leaf leaves one fractional unit at
    most; these meet ``fan_in`` leaves at a time, level by level, until a source has one, which is drawn.
    The number of levels grows with the logarithm of the largest source.
    """
    each = sizes(docs).groupBy("doc_id", "source", "a", "b", "size").agg(F.count("*").alias("times"))
    each = stored(each, "mixing-sizes")
    per_source = each.groupBy("source").agg(F.sum(F.col("size") * F.col("times")).alias("source_size"), F.count("*").alias("n"))
    aimed = stored(targets(per_source.select("source", "source_size"), weights, share, most), "mixing-targets")
    leaves = per_source.select("source", F.ceil(F.col("n") / leaf_rows).cast("bigint").alias("leaves"))
    aimed = aimed.join(leaves, aimed["source"].eqNullSafe(leaves["source"])).drop(leaves["source"])
    widest = aimed.agg(F.max("leaves")).first()[0] or 1
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rated = each.join(aimed, each["source"].eqNullSafe(aimed["source"])).drop(aimed["source"]).withColumn("rate", rate)
    # of equal rows all together: the whole part for each, and what is left over as one unit
    wanted = F.col("rate") * F.col("times")
    units = rated.select(
        "source",
        F.pmod(F.xxhash64("a", "b"), F.col("leaves")).alias("leaf"),
        "doc_id", "a", "b", F.col("size").cast("double").alias("size"), "times",
        (wanted - F.floor(wanted)).alias("share"), F.floor(wanted).cast("bigint").alias("whole"), F.lit(False).alias("open"),
    )
    level, done = 0, None
    while True:
        made = stored(units.groupBy("source", "leaf").applyInPandas(_pivot_with(seed + level), _UNITS), f"mixing-level{level}")
        settled = made.where(~F.col("open"))
        done = settled if done is None else done.unionByName(settled)
        rest = made.where("open")
        if widest <= 1:
            break
        widest = -(-widest // fan_in)
        units = rest.withColumn("leaf", F.floor(F.col("leaf") / fan_in).cast("bigint")).withColumn("open", F.lit(False))
        level += 1
    chance = F.pmod(F.xxhash64("a", "b", F.lit(seed)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    drawn = rest.withColumn("whole", F.col("whole") + (chance < F.col("share")).cast("bigint"))
    all_ = done.unionByName(drawn)
    source = aimed.select(F.col("source").alias("of"), "source_size", "target")
    return all_.join(source, all_["source"].eqNullSafe(source["of"])).select(
        "doc_id", "source", "a", "b", F.col("size").cast("bigint").alias("size"), "source_size", "target", "times", F.col("whole").alias("copies")
    )


def plan(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 7) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, taken``.

    ``taken`` is the words that the mix takes, repeats counted: 0, 1 or up to ``most`` copies of the
    whole document. Null and empty texts have size 0 and give nothing; null sources are one source,
    the last; equal rows are dealt as many copies as they get together, as evenly as can be; an
    empty table gives no rows. Reruns agree, also on another layout of the files.
    """
    chosen = copies(docs, weights, share, most, seed)
    # rows of a repeated row: numbered in two steps, so that no task makes more than a block of them
    block = 10_000
    blocks = chosen.withColumn("block", F.explode(F.sequence(F.lit(0), F.floor((F.col("times") - 1) / block))))
    number = F.explode(F.sequence(F.col("block") * block, F.least(F.col("times"), (F.col("block") + 1) * block) - 1))
    each = blocks.withColumn("number", number)
    taken = F.floor(F.col("copies") / F.col("times")) + (F.col("number") < F.col("copies") % F.col("times")).cast("bigint")
    return each.select("doc_id", "source", "size", "source_size", "target", (taken * F.col("size")).cast("bigint").alias("taken"))


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 7) -> DataFrame:
    """The rows of the mix: each document as often as it is taken, with the columns of ``docs``.

    Edge cases as in ``plan``. A repeated row is read once and written as often as all its repeats
    are taken together.
    """
    chosen = copies(docs, weights, share, most, seed).where("copies > 0").select("a", "b", "times", "copies")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    named = docs.select(F.struct(*columns).alias("row"), *row_name(docs))
    joined = named.join(chosen, ["a", "b"])
    once = joined.where("times = 1").select("row", "copies")
    # equal rows meet in one, pre-aggregated, and are dealt out again in blocks
    repeated = joined.where("times > 1").groupBy("a", "b").agg(F.any_value("row").alias("row"), F.max("copies").alias("copies"))
    block = 1_000
    dealt = repeated.select(
        "row", F.col("copies").alias("all"), F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / block))).alias("block")
    ).select("row", F.least(F.lit(block), F.col("all") - F.col("block") * block).alias("copies"))
    many = once.unionByName(dealt).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    return many.select("row.*")
