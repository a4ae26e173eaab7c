"""Token counts of a BPE model whose pieces hold word starts only at their front.

Such a model never merges across the beginning of a run of spaces, nor around a line break that
no piece contains, so a text's count is the sum over its pre-tokens. Counts come from two tiers
in each map task and no pre-token is shuffled: a compact sorted table of hashes with the lengths
of frequent pre-tokens, which every task gets, and for the rest a cache in each worker.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from storelens.llm import kernels

MARK = "▁"
#: what may follow a vocabulary word in the table of frequent pre-tokens
ENDINGS = ("", ".", ",")
_models: dict[int, object] = {}


def _model(raw: bytes):
    if (key := hash(raw)) not in _models:
        import sentencepiece

        _models[key] = sentencepiece.SentencePieceProcessor(model_proto=raw)
    return _models[key]


def separable(model) -> bool:
    """Whether the model's pieces allow counting by pre-token."""
    pieces = [model.id_to_piece(i) for i in range(len(model))]
    inner = any(MARK in p.lstrip(MARK) or "\n" in p for p in pieces)
    kept = model.encode(" a  b ", out_type=str)
    return not inner and "".join(kept) == f"{MARK}{MARK}a{MARK}{MARK}b{MARK}"


def frequent_table(model) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, ascending, and lengths of the vocabulary's whole words, bare and before common marks.

    The vocabulary bounds the table: ``len(ENDINGS)`` entries of 10 bytes for each of its words.
    """
    words = {model.id_to_piece(i)[1:] for i in range(len(model)) if model.id_to_piece(i).startswith(MARK)}
    keys = sorted({w + e for w in words if w and MARK not in w for e in ENDINGS})
    raw = [k.encode() for k in keys]
    ends = np.cumsum([len(r) for r in raw])
    hashes = kernels.hash_spans(np.frombuffer(b"".join(raw), np.uint8), ends - [len(r) for r in raw], ends)
    sizes = np.array([len(x) for x in model.encode(keys, num_threads=1)], np.uint16)
    order = np.argsort(hashes)
    return hashes[order], sizes[order]


class Counter:
    """Counts for texts of one worker; ``max_cached`` bounds its cache."""

    def __init__(self, raw: bytes, table: tuple[np.ndarray, np.ndarray], max_cached: int):
        self.model, (self.hashes, self.sizes), self.max_cached = _model(raw), table, max_cached
        self.cache: dict[bytes, int] = {}

    def missing(self, keys: list[bytes]) -> list[int]:
        """The lengths of pre-tokens that the table lacks, from the cache or the model."""
        new = [k for k in keys if k not in self.cache]
        if len(self.cache) + len(new) > self.max_cached:
            self.cache.clear()
            new = keys
        # after a line break the model's own word start is one token too many
        for k, ids in zip(new, self.model.encode([k.decode() for k in new], num_threads=1), strict=True):
            self.cache[k] = len(ids) - (k[:1] == b"\n")
        return [self.cache[k] for k in keys]

    def counts(self, texts: kernels.Texts) -> np.ndarray:
        data, bounds = texts.data, texts.bounds
        total = np.zeros(len(texts), np.int64)
        if not len(data):
            return total
        space = data == 0x20
        begins = space.copy()
        begins[1:] &= ~space[:-1]
        begins |= data == 0x0A
        begins[1:] |= data[:-1] == 0x0A
        first = bounds[:-1][np.diff(bounds) > 0]
        begins[first] = True
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(data))
        opening = np.zeros(len(data), bool)
        opening[first] = True
        opening = opening[starts]
        skip = space[starts] & ~opening
        owner = np.searchsorted(bounds, starts, "right") - 1
        # a line break at the front of a text keeps the model's word start
        lead_break = opening & (data[starts] == 0x0A)
        # after a line break there is no word start, so the break goes with what follows
        after = ~opening & ~space[starts] & (data[starts] != 0x0A)
        body = starts + skip
        hashes = kernels.hash_spans(data, body, ends)
        hashes = np.where(after, kernels.mix(hashes), hashes)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        known = (self.hashes[at] == hashes) & ~after
        size = np.where(known, self.sizes[at], 0).astype(np.int64)
        lone = body == ends
        size[lone] = 1
        rest = np.flatnonzero(~known & ~lone)
        if len(rest):
            _, where, back = np.unique(hashes[rest], return_index=True, return_inverse=True)
            pick = rest[where]
            glue = after[pick]
            keys = [
                (b"\n" if g else b"") + data[b:e].tobytes()
                for g, b, e in zip(glue.tolist(), body[pick].tolist(), ends[pick].tolist(), strict=True)
            ]
            got = np.array(self.missing(keys), np.int64) - glue
            size[rest] = got[back]
        size[lead_break] += 1
        np.add.at(total, owner, size)
        return total


def count_tokens(docs: DataFrame, model_file: str, limit: int = 4096, max_cached: int = 200_000) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every text.

    Counts are those of the model without begin, end or added special tokens. A null text counts as
    empty: 0 tokens. A null id stays null, repeated rows stay, other columns are not read. The
    model file is read on the driver. Raises ValueError for a model that cannot be counted by
    pre-token; a text that holds the word-start mark itself is encoded whole.
    """
    with open(model_file, "rb") as f:
        raw = f.read()
    model = _model(raw)
    if not separable(model):
        raise ValueError("the model's pieces cross pre-tokens")
    shared = docs.sparkSession.sparkContext.broadcast((raw, frequent_table(model)))
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])
    mark = MARK.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(*shared.value, max_cached)
        for batch in batches:
            for part, texts in kernels.slices(batch):
                n = counter.counts(texts)
                if mark in texts.data.tobytes():
                    for i in range(len(texts)):
                        if mark in (text := texts.raw(i)):
                            n[i] = len(counter.model.encode(text.decode(), num_threads=1))
                yield kernels.rows(schema, kernels.column(part, "doc_id"), np.diff(texts.bounds), n, n > limit)

    ids = docs.selectExpr("cast(doc_id as bigint) as doc_id", "text")
    return ids.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")
