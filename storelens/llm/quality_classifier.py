"""Quality of texts by supervised subword embeddings."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.llm import kernels
from storelens.llm.common import text_or_empty

_U = np.uint64
#: bytes of a character n-gram; words are taken with a blank on either side
GRAM = 4
_AGAIN = _U(0x51ED270B7A3F2C19)


@dataclass(frozen=True)
class Model:
    """``vectors``: one per bucket of terms; ``output``: class x width, ``bias``: class."""

    vectors: np.ndarray
    output: np.ndarray
    bias: np.ndarray

    def probabilities(self, owner: np.ndarray, terms: np.ndarray, times: np.ndarray, texts: int) -> np.ndarray:
        """Softmax over the classes of each text, from the mean of its terms' vectors; a text without a term has the mean 0."""
        logits = means(self.vectors, owner, terms, times, texts) @ self.output.T + self.bias
        grown = np.exp(logits - logits.max(1, keepdims=True))
        return grown / grown.sum(1, keepdims=True)


def means(vectors: np.ndarray, owner: np.ndarray, terms: np.ndarray, times: np.ndarray, texts: int) -> np.ndarray:
    out = np.zeros((texts, vectors.shape[1]))
    if len(owner):
        starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        out[owner[starts]] = np.add.reduceat(vectors[terms] * times[:, None], starts) / np.add.reduceat(times, starts)[:, None]
    return out


def terms_of(texts: kernels.Texts, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct hashed terms of every text and how often each occurs: owner (ascending), term, times.

    Terms are words as they are, pairs of neighbours, and character n-grams of words with a blank around them; the n-grams of one
    word together count as one. A word that follows itself makes the same pair whatever the word, so that repetition is a term of its own.
    """
    words = kernels.Words(texts)
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    owner, hashes = words.owner(), words.hashes()
    pair = np.flatnonzero(owner[1:] == owner[:-1])
    pairs = np.where(hashes[pair] == hashes[pair + 1], _AGAIN, kernels.mix(hashes[pair] * _U(31) + hashes[pair + 1]))
    # the words once more, each between blanks, in one buffer
    sizes = words.ends - words.starts
    ends = np.cumsum(sizes + 2)
    buffer = np.full(int(ends[-1]) + 8, 0x20, np.uint8)
    buffer[kernels.ragged(ends - sizes - 1, sizes)] = texts.data[kernels.ragged(words.starts, sizes)]
    n = np.maximum(sizes + 3 - GRAM, 1)
    at = kernels.ragged(ends - sizes - 2, n)
    four = np.ndarray((len(buffer) - 4,), "<u4", buffer, strides=(1,))
    grams = kernels.mix(four[at].astype(_U) + _U(1 << 40))
    every = np.concatenate([kernels.mix(hashes), kernels.mix(pairs + _U(1)), grams]) >> _U(64 - bits)
    who = np.concatenate([owner, owner[pair], np.repeat(owner, n)]).astype(_U)
    keys, back = np.unique(who << _U(32) | every, return_inverse=True)
    times = np.bincount(back, np.concatenate([np.ones(len(words) + len(pair)), np.repeat(1 / n, n)]), len(keys))
    return (keys >> _U(32)).astype(np.int64), (keys & _U(0xFFFFFFFF)).astype(np.int64), times


def fit(
    owner: np.ndarray, terms: np.ndarray, times: np.ndarray, labels: np.ndarray, bits: int, width: int = 8, rounds: int = 8, step: float = 0.2, batch: int = 32, seed: int = 11
) -> Model:
    """Stochastic gradient descent on the cross-entropy of the softmax over two classes.

    Steps are divided by the root of a row's summed squared gradients; only the vectors of a batch's terms move.
    Terms of a single text stay where they began, at zero, so that rare words are not learnt by heart.
    """
    rng = np.random.default_rng(seed)
    n, size = len(labels), 1 << bits
    rate = np.array([np.sum(labels == 0), np.sum(labels == 1)], float)
    bias = np.log((rate + 0.1) / (n + 0.2))
    vectors, output = np.zeros((size, width)), rng.normal(0, 0.5, (2, width))
    if not rate.all():
        return Model(vectors.astype(np.float32), output, bias)
    shared = np.bincount(terms, minlength=size) > 1
    total = np.maximum(np.bincount(owner, times, n), 1e-9).astype(np.float32)
    vectors[shared] = rng.uniform(-1 / width, 1 / width, (int(shared.sum()), width))
    some = shared[terms]
    owner, terms, weight = owner[some], terms[some], times[some]
    weight = weight / total[owner]
    cuts = np.searchsorted(owner, np.arange(n + 1))
    seen, seen_out, seen_bias = np.full(size, 1e-8), np.full((2, width), 1e-8), np.full(2, 1e-8)
    truth = np.stack([labels == 0, labels == 1], 1).astype(float)
    for _ in range(rounds):
        for rows in np.array_split(rng.permutation(n), max(1, n // batch)):
            k = cuts[rows + 1] - cuts[rows]
            place = kernels.ragged(cuts[rows], k)
            t, who, w = terms[place], np.repeat(np.arange(len(rows)), k), weight[place]
            mean = np.stack([np.bincount(who, w * vectors[t, f], len(rows)) for f in range(width)], 1)
            logits = mean @ output.T + bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            miss = (p / p.sum(1, keepdims=True) - truth[rows]) / len(rows)
            down = miss @ output
            ids, back = np.unique(t, return_inverse=True)
            slope = np.stack([np.bincount(back, w * down[who, f], len(ids)) for f in range(width)], 1)
            seen[ids] += (slope**2).sum(1)
            vectors[ids] -= step * slope / np.sqrt(seen[ids])[:, None]
            pull = miss.T @ mean + 1e-3 * output
            seen_out += pull**2
            output -= step * pull / np.sqrt(seen_out)
            seen_bias += miss.sum(0) ** 2
            bias -= step * miss.sum(0) / np.sqrt(seen_bias)
    return Model(vectors.astype(np.float32), output, bias)


def labelled(docs: DataFrame, labels: DataFrame, column: str, learnable: Column, max_rows: int) -> DataFrame:
    """``doc_id``, ``text``, ``label`` of at most ``max_rows`` labelled ids, those with the smallest hashes.

    Rows without an id or a label are left out; an id with several labels has the largest, one with several texts the smallest.
    """
    marked = labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull()).where(learnable).select(F.col("doc_id").cast("bigint").alias("doc_id"), column)
    order = F.shiftrightunsigned(F.xxhash64("doc_id"), 11)
    # hashes far too large for the sample are left out before any are ordered
    least = int(min(1.0, 2 * (max_rows + 100) / max(marked.count(), 1)) * (1 << 53))
    chosen = marked.where(order <= F.lit(least)).groupBy("doc_id").agg(F.max(column).cast("double").alias("label")).orderBy(order, "doc_id").limit(max_rows)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text")).join(F.broadcast(chosen), "doc_id")
    return rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label"))


def learn(docs: DataFrame, labels: DataFrame, learnable: Column, max_rows: int = 5_000, bits: int = 17, **settings) -> Model:
    """A model of ``labels.quality`` from at most ``max_rows`` labelled rows for which ``learnable`` (over ``doc_id``) holds.

    Their texts are turned into counted buckets by the executors, so what reaches the driver is bounded by ``max_rows`` and
    ``2 ** bits``. Without both labels in the sample the model is the smoothed rate.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("label", pa.float64()), ("terms", pa.list_(pa.int32())), ("times", pa.list_(pa.float32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in kernels.slices(batch):
                owner, terms, times = terms_of(texts, bits)
                ends = pa.array(np.searchsorted(owner, np.arange(len(texts) + 1)), pa.int32())
                lists = [pa.ListArray.from_arrays(ends, pa.array(x, kind)) for x, kind in ((terms, pa.int32()), (times, pa.float32()))]
                yield kernels.rows(schema, kernels.column(part, "doc_id"), kernels.column(part, "label"), *lists)

    single = labelled(docs, labels, "quality", learnable, max_rows)
    got = single.mapInArrow(run, "doc_id bigint, label double, terms array<int>, times array<float>").toArrow().combine_chunks().sort_by("doc_id")
    flat = []
    # four bytes each: this is the most that the driver holds
    for name, kind in (("terms", np.int32), ("times", np.float32)):
        lists = got.column(name).combine_chunks()
        flat.append(lists.flatten().to_numpy() if len(lists) else np.zeros(0, kind))
    n = lists.value_lengths().to_numpy(zero_copy_only=False) if len(lists) else np.zeros(0, np.int64)
    return fit(np.repeat(np.arange(len(n), dtype=np.int32), n), *flat, got.column("label").to_numpy(), bits, **settings)


def score(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """``doc_id``, ``score`` (0 to 1, the probability of label 1) and ``predicted`` (1 from ``threshold``) of every whole text.

    Only the text counts. Null and empty texts, and those without a word, get the softmax of the bias; repeated rows stay; other columns are
    not read; an empty table gives no rows.
    """
    # the mean goes through the output layer term by term: one number a term
    shared = docs.sparkSession.sparkContext.broadcast((model.vectors @ (model.output[1] - model.output[0]), float(model.bias[1] - model.bias[0])))
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odds, bias = shared.value
        bits = len(odds).bit_length() - 1
        for batch in batches:
            for part, texts in kernels.slices(batch):
                owner, terms, times = terms_of(texts, bits)
                total = np.maximum(np.bincount(owner, times, len(texts)), 1e-9)
                z = np.bincount(owner, odds[terms] * times, len(texts)) / total + bias
                p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
                yield kernels.rows(schema, kernels.column(part, "doc_id"), p, (p >= threshold).astype(np.int32))

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, score double, predicted int")
