"""Near duplicates by consistent weighted sampling of weighted word shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.llm import kernels
from storelens.llm.cells import frequent_cells
from storelens.llm.common import LAST_ID, id_or_last, stored, text_key, text_or_empty
from storelens.llm.components import components
from storelens.operators.runs import spread_join

WIDTH = 5
#: bands of samples; texts of similarity 0.8 share one with probability 1 - (1 - 0.8 ** 3) ** 16 = 0.99999
BANDS, ROWS = 16, 3
#: shingles in at least one of so many documents weigh less; there are at most that many times a mean text's shingles
COMMON = 200
#: 2 ** CELL_BITS cells tell which shingles can be common: a mean cell holds a quarter of the bound even at 1,300 shingles a text
CELL_BITS = 20
#: how much more a rare shingle weighs than one that every document has
RARE = 0.25
#: cells of a text's outline
CELLS = 64
_U = np.uint64
_LOW = _U((1 << 48) - 1)


def shingles(texts: kernels.Texts, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct shingles of every text: owner, 48-bit hash (ascending within a text) and times.

    A shingle is ``width`` consecutive words; a shorter text with a word is one shingle.
    """
    words = kernels.Words(texts)
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, _U), np.zeros(0, np.int64)
    runs = kernels.Sequences(words.hashes())
    n = np.where(words.count >= width, words.count - width + 1, (words.count > 0).astype(np.int64))
    at = kernels.ragged(words.first[:-1], n)
    owner = np.repeat(np.arange(len(texts)), n)
    value = runs.of(at, np.minimum(at + width, words.first[1:][owner])) & _LOW
    keys, times = np.unique(owner.astype(_U) << _U(48) | value, return_counts=True)
    return (keys >> _U(48)).astype(np.int64), keys & _LOW, times


def weights(hashes: np.ndarray, times: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Times each shingle's damped inverse document frequency; shingles outside the table are rare: 1 + RARE."""
    common, idf = table
    out = np.full(len(hashes), 1 + RARE)
    if len(common) and len(hashes):
        at = np.minimum(np.searchsorted(common, hashes), len(common) - 1)
        out = np.where(common[at] == hashes, idf[at], out)
    return times * out


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gamma(2, 1) by 16-bit rank: the values, their inverses, and their logarithms."""
    p = (np.arange(1 << 16) + 0.5) / (1 << 16)
    low, high = np.zeros(len(p)), np.full(len(p), 40.0)
    for _ in range(60):
        mid = (low + high) / 2
        below = 1 - (1 + mid) * np.exp(-mid) < p
        low, high = np.where(below, mid, low), np.where(below, high, mid)
    return low.astype(np.float32), (1 / low).astype(np.float32), np.log(low).astype(np.float32)


_gamma: tuple | None = None


def samples(owner: np.ndarray, hashes: np.ndarray, weight: np.ndarray, texts: int, count: int) -> np.ndarray:
    """``count`` consistent samples of each text's weighted set, 0 for texts without a shingle.

    For each sample a shingle draws r, c from Gamma(2, 1) and b from [0, 1) by its hash; with t = floor(ln w / r + b)
    the sample is the (shingle, t) with the least ln c - r (t - b) - r. Two sets have the
    same sample with the probability of their weighted Jaccard similarity.
    """
    global _gamma
    _gamma = _gamma or _tables()
    r_of, inverse_of, log_of = _gamma
    out = np.zeros((texts, count), np.uint64)
    if not len(owner):
        return out
    starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    have = owner[starts]
    group = np.cumsum(np.append(0, owner[1:] != owner[:-1]))
    log_w = np.log(weight).astype(np.float32)
    multipliers = kernels.mix(np.arange(1, count + 1, dtype=np.uint64)) | _U(1)
    for k in range(count):
        x = hashes * multipliers[k]
        x ^= x >> _U(29)
        x *= _U(0xBF58476D1CE4E5B9)
        first, second = x >> _U(48), (x >> _U(32)) & _U(0xFFFF)
        b = ((x >> _U(16)) & _U(0xFFFF)).astype(np.float32) / np.float32(1 << 16)
        r = r_of[first]
        t = np.floor(log_w * inverse_of[first] + b)
        a = log_of[second] - r * (t - b + 1)
        hit = np.flatnonzero(a == np.minimum.reduceat(a, starts)[group])
        hit = hit[np.searchsorted(group[hit], np.arange(len(starts)))]
        out[have, k] = kernels.mix(hashes[hit] ^ t[hit].astype(np.int64).view(_U) * _U(0x9E3779B97F4A7C15))
    return out


def common_shingles(named: DataFrame, common: int = COMMON) -> tuple[np.ndarray, np.ndarray]:
    """Shingles in at least one of ``common`` documents (two at least), with their weights, by hash.

    Two passes over all texts. The first counts in cells, whose number does not depend on the corpus: a shingle that is frequent
    is in a cell that is, so none is lost. The second counts the shingles of frequent cells; those by chance in such a cell fall away by their own count.
    """
    spark = named.sparkSession
    n = named.count()
    least = max(2, -(-n // common))
    marks = spark.sparkContext.broadcast(np.packbits(frequent_cells(named.select("text"), lambda part, texts: shingles(texts)[1] << _U(16), CELL_BITS, least)))
    schema = pa.schema([("h", pa.int64()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value, times = np.zeros(0, _U), np.zeros(0, np.int64)
        for batch in batches:
            for _, texts in kernels.slices(batch):
                h = shingles(texts)[1]
                cell = (h >> _U(48 - CELL_BITS)).astype(np.int64)
                h = h[marks.value[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8) & 1 == 1]
                value, back = np.unique(np.concatenate([value, h]), return_inverse=True)
                times = np.bincount(back, np.concatenate([times, np.ones(len(h), np.int64)]), len(value)).astype(np.int64)
                if len(value) > 1 << 20:
                    yield kernels.rows(schema, value.view(np.int64), times)
                    value, times = np.zeros(0, _U), np.zeros(0, np.int64)
        yield kernels.rows(schema, value.view(np.int64), times)

    found = named.select("text").mapInArrow(count, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= least).toArrow()
    value = found.column("h").to_numpy().view(_U)
    rarity = np.log(n / np.maximum(found.column("n").to_numpy(), 1)) / np.log(common)
    order = np.argsort(value)
    return value[order], (1 + RARE * np.clip(rarity, 0, 1))[order]


def signatures(named: DataFrame, table) -> DataFrame:
    """``id, node`` and the ``bands`` of every text; a text without a word has none."""
    schema = pa.schema([("id", pa.int64()), ("node", pa.int64()), ("bands", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in kernels.slices(batch):
                owner, hashes, times = shingles(texts)
                drawn = samples(owner, hashes, weights(hashes, times, table.value), len(texts), BANDS * ROWS)
                band = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(texts), BANDS))
                for r in range(ROWS):
                    band = kernels.mix(band * _U(31) + drawn[:, r::ROWS])
                has = np.zeros(len(texts), bool)
                has[owner] = True
                ends = np.concatenate([[0], np.cumsum(has * BANDS)])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(band[has].view(np.int64).ravel()))
                yield kernels.rows(schema, kernels.column(part, "id"), kernels.column(part, "node"), lists)

    return named.select("id", "node", "text").mapInArrow(run, "id bigint, node bigint, bands array<bigint>")


def verified(pairs: DataFrame, texts: DataFrame, table, threshold: float, block: int = 512) -> DataFrame:
    """The pairs (``a``, ``b``) whose weighted Jaccard similarity reaches the threshold, with ``likeness``.

    Partners of one text are cut into blocks, each of which gets that text once, and are read as a stream.
    """
    sizes = pairs.groupBy("a").agg(F.ceil(F.count("*") / block).alias("blocks"))
    dealt = pairs.join(sizes, "a").withColumn("block", F.pmod(F.xxhash64("b"), "blocks"))
    partners = dealt.join(texts.withColumnRenamed("node", "b"), "b").select("a", "block", F.lit(1).alias("role"), "b", "text")
    leads = dealt.select("a", "block").distinct().join(texts.withColumnRenamed("node", "a"), "a")
    stream = partners.unionByName(leads.select("a", "block", F.lit(0).alias("role"), F.col("a").alias("b"), "text"))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("likeness", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead_hash, lead_weight, total = np.zeros(0, _U), np.zeros(0), 0.0
        for batch in batches:
            for part, texts_ in kernels.slices(batch):
                owner, hashes, times = shingles(texts_)
                weight = weights(hashes, times, table.value)
                cuts = np.searchsorted(owner, np.arange(len(texts_) + 1))
                a, role, b = (kernels.column(part, c).to_pylist() for c in ("a", "role", "b"))
                out = []
                for i in range(len(texts_)):
                    h, w = hashes[cuts[i] : cuts[i + 1]], weight[cuts[i] : cuts[i + 1]]
                    if role[i] == 0:
                        lead_hash, lead_weight, total = h, w, w.sum()
                        continue
                    at = np.minimum(np.searchsorted(lead_hash, h), max(len(lead_hash) - 1, 0))
                    same = np.flatnonzero(lead_hash[at] == h) if len(lead_hash) else np.zeros(0, int)
                    shared = np.minimum(lead_weight[at[same]], w[same]).sum()
                    likeness = shared / (total + w.sum() - shared) if total + w.sum() > 0 else 0.0
                    if likeness >= threshold:
                        out.append((a[i], b[i], likeness))
                if out:
                    yield kernels.rows(schema, *map(list, zip(*out, strict=True)))

    return stream.repartition("a", "block").sortWithinPartitions("a", "block", "role", "b").mapInArrow(run, "a bigint, b bigint, likeness double")


def outlines(texts: DataFrame, table) -> DataFrame:
    """``node``, its ``total`` weight, and the weights of its shingles that other given texts have too, summed in CELLS cells by hash.

    Two texts share at most the sum of the smaller weights cell by cell.
    """
    schema = pa.schema(
        [("node", pa.int64()), ("total", pa.float64()), ("cells", pa.list_(pa.float64())), ("hashes", pa.list_(pa.int64())), ("each", pa.list_(pa.float64()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts_ in kernels.slices(batch):
                owner, hashes, times = shingles(texts_)
                weight = weights(hashes, times, table.value)
                n = len(texts_)
                cell = owner * CELLS + (hashes % _U(CELLS)).astype(np.int64)
                cells = np.bincount(cell, weight, n * CELLS)
                cuts = pa.array(np.searchsorted(owner, np.arange(n + 1)), pa.int32())
                yield kernels.rows(
                    schema,
                    kernels.column(part, "node"),
                    np.bincount(owner, weight, n),
                    pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * CELLS, pa.int32()), pa.array(cells)),
                    pa.ListArray.from_arrays(cuts, pa.array(hashes.view(np.int64))),
                    pa.ListArray.from_arrays(cuts, pa.array(weight)),
                )

    made = stored(texts.select("node", "text").mapInArrow(run, "node bigint, total double, cells array<double>, hashes array<bigint>, each array<double>"), "near-outlines")
    single = made.select("node", F.explode(F.arrays_zip("hashes", "each")).alias("s")).groupBy("s.hashes").agg(
        F.count("*").alias("n"), F.min("node").alias("node"), F.min("s.each").alias("each")
    )
    own = single.where("n = 1").groupBy("node", (F.col("hashes") % CELLS).alias("cell")).agg(F.sum("each").alias("w"))
    by_cell = own.groupBy("node").agg(F.map_from_entries(F.collect_list(F.struct("cell", "w"))).alias("own"))
    less = F.transform("cells", lambda w, i: w - F.coalesce(F.col("own")[i.cast("bigint")], F.lit(0.0)))
    return made.join(by_cell, "node", "left").select("node", "total", F.when(F.col("own").isNull(), F.col("cells")).otherwise(less).alias("cells"))


def classes(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """One row per row of ``docs``: ``id`` (null last), ``node`` (names the text), ``root`` (names the class) and ``class_id``, its smallest id.

    Classes are the connected parts of the graph of texts whose weighted Jaccard similarity is at least ``threshold``. Equal
    texts are one node, named by 64 bits. In every bucket of a band all texts are first compared with its hub, the text that shares
    buckets with most others, so a group of like texts costs one comparison a member. Where a bucket's texts are then
    still in different classes, each two of different classes are compared unless a bound says that they cannot be alike: a
    text too much of whose weight no other such text has is like none, and two texts share no more than their outlines do. So
    no pair that shares a bucket is lost. What remains quadratic is the test of outlines within a bucket, among texts that have near misses.
    """
    spark = docs.sparkSession
    named = docs.select(id_or_last().alias("id"), text_key().alias("node"), text_or_empty().alias("text"))
    table = spark.sparkContext.broadcast(common_shingles(named))
    drawn = stored(signatures(named, table), "near-signatures")
    once = drawn.groupBy("node").agg(F.any_value("bands").alias("bands"))
    rows = once.select("node", F.explode("bands").alias("bucket"))
    sized = rows.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = stored(rows.join(sized, "bucket"), "near-buckets")
    mass = members.groupBy("node").agg(F.sum("size").alias("mass"))
    texts = stored(
        named.select("node", "text").join(mass.select("node"), "node", "left_semi").groupBy("node").agg(F.any_value("text").alias("text")), "near-texts"
    )
    hubs = members.join(mass, "node").groupBy("bucket").agg(F.max(F.struct("mass", "node"))["node"].alias("a"))
    pairs = members.select("bucket", F.col("node").alias("b")).join(hubs, "bucket").where("a != b").select("a", "b").distinct()
    links = stored(verified(pairs, texts, table, threshold), "near-links")
    placed = members.join(components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))
    apart = placed.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("bucket")
    left = stored(placed.join(apart, "bucket").select("bucket", "node", "root"), "near-apart")
    some = texts.join(left.select("node").distinct(), "node", "left_semi")
    outlined = outlines(some, table).withColumn("common", F.aggregate("cells", F.lit(0.0), lambda x, y: x + y))
    able = stored(left.join(outlined.where(F.col("common") >= threshold * F.col("total") - 1e-9), "node"), "near-able")
    one = able.select("bucket", *(F.col(c).alias(f"{c}_a") for c in ("node", "root", "total", "cells", "common")))
    two = able.select("bucket", *(F.col(c).alias(f"{c}_b") for c in ("node", "root", "total", "cells", "common")))
    # shared weight s is enough if s / (total_a + total_b - s) >= threshold
    enough = (F.col("total_a") + F.col("total_b")) * F.lit(threshold / (1 + threshold)) - 1e-9
    outline = F.aggregate(F.zip_with("cells_a", "cells_b", lambda x, y: F.least(x, y)), F.lit(0.0), lambda x, y: x + y)
    may = (F.col("node_a") < F.col("node_b")) & (F.col("root_a") != F.col("root_b")) & (F.least("common_a", "common_b") >= enough) & (outline >= enough)
    todo = one.join(two, (one["bucket"] == two["bucket"]) & may).select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()
    links = links.unionByName(stored(verified(stored(todo, "near-pairs"), texts, table, threshold), "near-links"))
    roots = components(links)
    placed = drawn.select("id", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = placed.groupBy("root").agg(F.min("id").alias("class_id"))
    # a class with a third of all rows meets its smallest id in 64 parts
    dealt = placed.withColumn("part", F.pmod(F.xxhash64("id", "node"), F.lit(64)))
    return spread_join(dealt, least, ["root"], "part", "inner").select("id", "node", "root", "class_id")


def near_duplicates(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """``doc_id`` and ``class_id`` of every row: near copies share the smallest id among them.

    Null texts count as empty and all texts without a word that are equal are copies; a text shorter than a shingle
    is like a text with the same words only. A null id counts as larger than all others; the class of null ids only is
    null. Repeated rows each get their row; an empty table gives no rows.
    """
    found = classes(docs, threshold)
    return found.select(F.nullif("id", F.lit(LAST_ID)).alias("doc_id"), F.nullif("class_id", F.lit(LAST_ID)).alias("class_id"))


def keep_one(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """``docs`` with one row of each class: the row with the smallest id (null last), of equal ids any one."""
    best = classes(docs, threshold).groupBy("root").agg(F.min(F.struct("id", "node")).alias("best"))
    kept = best.select("best.id", "best.node")
    names = [F.col(f"`{c}`") for c in docs.columns]
    named = docs.select(F.struct(*names).alias("row"), id_or_last().alias("id"), text_key().alias("node"))
    return named.join(kept, ["id", "node"], "left_semi").groupBy("id", "node").agg(F.any_value("row").alias("row")).select("row.*")
