"""Toxicity scores by a factorization machine over hashed terms."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.llm import kernels
from storelens.llm.common import text_or_empty
from storelens.llm.spotsigs import _APART

_U = np.uint64


@dataclass(frozen=True)
class Model:
    """log-odds = bias + sum of weight * scale over terms + products of factors * share of every two terms.

    The scale tells how much a term says alone; it counts in the sum only, so that two terms which say nothing alone can say
    something together. ``paired`` marks terms that have factors; the share is the same for all of a text's and falls
    with their number. A constant term, with share 1, takes part in the products.
    """

    bias: float
    weight: np.ndarray
    scale: np.ndarray
    factors: np.ndarray
    paired: np.ndarray
    constant: np.ndarray

    def log_odds(self, owner: np.ndarray, terms: np.ndarray, texts: int) -> np.ndarray:
        """``owner`` (ascending) and ``terms``: the distinct terms of each text."""
        out = self.bias + np.bincount(owner, self.weight[terms] * self.scale[terms], texts)
        some = self.paired[terms]
        return out + products(owner[some], self.factors[terms[some]], self.constant, texts)[0]


def products(owner: np.ndarray, factors: np.ndarray, constant: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sum over every two terms of each text, the constant included; the sums of factors * share; and each term's share."""
    share = np.maximum(np.bincount(owner, minlength=texts), 1)[owner] ** -0.25
    v = factors * share[:, None]
    sums = np.stack([np.bincount(owner, v[:, f], texts) for f in range(v.shape[1])], 1) + constant
    squares = np.bincount(owner, (v * v).sum(1), texts) + (constant**2).sum()
    return ((sums**2).sum(1) - squares) / 2, sums, share


def terms_of(texts: kernels.Texts, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashed terms of every text: lower-cased words, and the first five bytes of longer ones."""
    words = kernels.Words(texts.lowered(), _APART)
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    owner = words.owner()
    long = np.flatnonzero(words.ends - words.starts > 5)
    heads = kernels.hash_spans(words.texts.data, words.starts[long], words.starts[long] + 5)
    hashes = np.concatenate([words.hashes(), kernels.mix(heads)])
    who = np.concatenate([owner, owner[long]]).astype(_U)
    keys = np.unique(who << _U(32) | hashes >> _U(64 - bits))
    return (keys >> _U(32)).astype(np.int64), (keys & _U(0xFFFFFFFF)).astype(np.int64)


def fit(
    owner: np.ndarray, terms: np.ndarray, labels: np.ndarray, bits: int, rank: int, steps: int, pair_steps: int = 1200,
    support: int = 30, prior: float = 10.0, step: float = 0.2, decay: float = 4e-3, seed: int = 7,
) -> Model:
    """Stochastic gradient descent on the logistic loss in batches of 32 texts: ``steps`` for the sum, then ``pair_steps`` for the products.

    A term's scale is its log-odds over the base rate, shrunk by ``prior`` texts of that rate, so that terms that say
    little alone add little and rare ones are not learnt by heart. Then the products learn what the sum leaves. Factors know no scale: they
    start at random, move by ``step`` over the root of their summed squared gradients, and fade by ``decay``; terms of
    fewer than ``support`` texts have none.
    """
    rng = np.random.default_rng(seed)
    n, size = len(labels), 1 << bits
    rate = (labels.sum() + 0.1) / (n + 1)
    bias = float(np.log(rate / (1 - rate)))
    all_ = np.bincount(terms, minlength=size)
    toxic = np.bincount(terms, labels[owner], size)
    scale = np.where(all_ >= 2, np.log((toxic + prior * rate) / (all_ - toxic + prior * (1 - rate))) - bias, 0.0)
    learns, paired = 0 < labels.sum() < n, all_ >= support
    weight, factors, constant = np.zeros(size), np.zeros((size, rank)), np.zeros(rank)
    cuts = np.searchsorted(owner, np.arange(n + 1))

    def batches(count: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for _ in range(min(40, -(-count * 32 // n)) if learns else 0):
            for rows in np.array_split(rng.permutation(n), max(1, n // 32)):
                k = cuts[rows + 1] - cuts[rows]
                yield rows, np.repeat(np.arange(len(rows)), k), terms[kernels.ragged(cuts[rows], k)]

    def missed(z: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[rows]) / len(rows)

    for rows, who, t in batches(steps):
        x = scale[t]
        miss = missed(bias + np.bincount(who, weight[t] * x, len(rows)), rows)
        some, back = np.unique(t, return_inverse=True)
        weight[some] -= 0.1 * (np.bincount(back, miss[who] * x, len(some)) + 1e-3 * weight[some])
        bias -= 0.1 * miss.sum()
    if learns:
        factors[paired] = rng.normal(0, 0.1 / np.sqrt(rank), (int(paired.sum()), rank))
        constant = rng.normal(0, 0.1 / np.sqrt(rank), rank)
    moved, moved_constant = np.full(size, 1e-8), np.full(rank, 1e-8)
    for rows, who, t in batches(pair_steps):
        alone = bias + np.bincount(who, weight[t] * scale[t], len(rows))
        who, t = who[paired[t]], t[paired[t]]
        both, sums, share = products(who, factors[t], constant, len(rows))
        miss = missed(alone + both, rows)
        slope, slope_constant, some = pair_slopes(who, t, factors, constant, sums, share, miss)
        slope, slope_constant = slope + decay * factors[some], slope_constant + decay * constant
        moved[some] += (slope**2).mean(1)
        factors[some] -= step * slope / np.sqrt(moved[some])[:, None]
        moved_constant += slope_constant**2
        constant = constant - step * slope_constant / np.sqrt(moved_constant)
    return Model(bias, *(x.astype(np.float32) for x in (weight, scale, factors)), paired, constant)


def pair_slopes(
    who: np.ndarray, terms: np.ndarray, factors: np.ndarray, constant: np.ndarray, sums: np.ndarray, share: np.ndarray, miss: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gradients of the loss by the factors of the distinct terms and of the constant, and those terms; ``miss`` is that by the log-odds."""
    some, back = np.unique(terms, return_inverse=True)
    pull = miss[who] * share
    own = factors[terms] * share[:, None]
    slope = np.stack([np.bincount(back, pull * (sums[who, f] - own[:, f]), len(some)) for f in range(factors.shape[1])], 1)
    return slope, (miss[:, None] * (sums - constant)).sum(0), some


def learn(
    docs: DataFrame, labels: DataFrame, learnable: Column, max_rows: int = 12_000, bits: int = 18, rank: int = 4, steps: int = 2500
) -> Model:
    """A model of ``labels.toxic`` from labelled rows for which ``learnable`` (over ``doc_id``) holds.

    At most ``max_rows`` labelled ids, those with the smallest hashes, are learnt from: that bounds what reaches
    the driver, and the join that picks their texts is with that many ids. Rows without an id or label
    are left out, an id with several labels counts as toxic if one says so, one with several texts gives the
    smallest. Without both labels in the sample the model is the smoothed rate.
    """
    marked = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).where(learnable)
    order = F.shiftrightunsigned(F.xxhash64("doc_id"), 11)
    # hashes far too large for the sample are left out before any are ordered
    least = int(min(1.0, 2 * (max_rows + 100) / max(marked.count(), 1)) * (1 << 53))
    few = marked.where(order <= F.lit(least)).groupBy("doc_id").agg(F.max("toxic").cast("double").alias("label"))
    chosen = few.orderBy(order, "doc_id").limit(max_rows)
    rows = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(chosen), "doc_id")
    single = rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("label", pa.float64()), ("terms", pa.list_(pa.int32()))])
        for batch in batches:
            for part, texts in kernels.slices(batch):
                owner, terms = terms_of(texts, bits)
                ends = np.searchsorted(owner, np.arange(len(texts) + 1))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(terms, pa.int32()))
                yield kernels.rows(schema, kernels.column(part, "doc_id").cast(pa.int64()), kernels.column(part, "label"), lists)

    got = single.mapInArrow(run, "doc_id bigint, label double, terms array<int>").toArrow().combine_chunks().sort_by("doc_id")
    lists = got.column("terms").combine_chunks()
    n = lists.value_lengths().to_numpy(zero_copy_only=False) if len(lists) else np.zeros(0, np.int64)
    terms = lists.flatten().to_numpy().astype(np.int64) if len(lists) else np.zeros(0, np.int64)
    return fit(np.repeat(np.arange(len(n)), n), terms, got.column("label").to_numpy(), bits, rank, steps)


def score(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """``doc_id``, ``score`` (0 to 1) and ``predicted`` (1 from ``threshold``) of every text.

    Only the text counts. Null and empty texts get the model's bias; repeated rows stay; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = len(shared.value.weight).bit_length() - 1
        for batch in batches:
            for part, texts in kernels.slices(batch):
                z = shared.value.log_odds(*terms_of(texts, bits), len(texts))
                p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
                yield kernels.rows(schema, kernels.column(part, "doc_id"), p, (p >= threshold).astype(np.int32))

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, score double, predicted int")


def id_fold(parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.crc32(F.col("doc_id").cast("bigint").cast("string")) % parts
