"""Phrases whose words keep company: counts of longest windows, rolled up to all shorter ones."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storelens.llm import kernels
from storelens.llm.cells import frequent_cells
from storelens.llm.common import stored, text_or_empty
from storelens.operators.runs import spread_join

#: words of the longest window
LONGEST = 5
#: cells that tell rare windows: 2 MB at the executors for each of two passes, 16 MB in each counting task
CELL_BITS = 24
_U = np.uint64
_BREAK = np.zeros(256, bool)
_BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
_APART = _BREAK.copy()
_APART[[0x20, 0x09]] = True
_W = [f"w{k}" for k in range(1, LONGEST + 1)]


class _Pieces:
    """The words of some texts, hashed with their text's language, and whether the next word is in the same piece."""

    def __init__(self, part: pa.RecordBatch, texts: kernels.Texts):
        self.words = kernels.Words(texts.lowered(), _APART)
        langs = kernels.column(part, "lang").dictionary_encode()
        self.names = langs.dictionary.to_pylist()
        # a language's name as a word must not cancel its salt
        self.salt = kernels.mix(np.array([_name_hash(x) for x in self.names], _U) + _U(0x9E3779B97F4A7C15))
        owner = self.words.owner()
        self.lang = langs.indices.to_numpy(zero_copy_only=False)[owner]
        self.hashes = kernels.mix(self.words.hashes() ^ self.salt[self.lang]) if len(owner) else np.zeros(0, _U)
        breaks = np.cumsum(_BREAK[texts.data])
        w = self.words
        self.joined = np.zeros(len(w), bool)
        if len(w) > 1:
            self.joined[:-1] = (breaks[w.ends[:-1] - 1] == breaks[w.starts[1:]]) & (owner[:-1] == owner[1:])

    def pairs(self) -> np.ndarray:
        """The hash of each word and the next; that of the last word is of no use."""
        return kernels.mix(self.hashes * _U(0x9E3779B97F4A7C15) + np.roll(self.hashes, -1)) if len(self.hashes) else self.hashes


def _name_hash(name: str) -> int:
    raw = np.frombuffer(name.encode(), np.uint8)
    return int(kernels.hash_spans(raw, np.array([0]), np.array([len(raw)]))[0])


def _often(packed: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    cell = (hashes >> _U(64 - bits)).astype(np.int64)
    return packed[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8) & 1 == 1


def _windows(p: _Pieces, marks: list[np.ndarray], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of each window's words, -1 from its end on, and the hashes of its beginnings, by length.

    A window ends with its piece, and where the first ``marks`` say that a word or pair, the second that a longer beginning, is rare.
    """
    n = len(p.words)
    at, begun = np.full((LONGEST, n), -1, np.int64), np.zeros((LONGEST, n), _U)
    if not n:
        return at, begun
    fine, on = _often(marks[0], p.hashes, bits), p.joined & _often(marks[0], p.pairs(), bits)
    at[0], begun[0] = np.where(fine, np.arange(n), -1), p.hashes
    for k in range(1, LONGEST):
        goes = np.flatnonzero(at[k - 1] >= 0)
        goes = goes[on[at[k - 1, goes]]]
        goes = goes[fine[at[k - 1, goes] + 1]]
        hashes = kernels.mix(begun[k - 1, goes] * _U(0x9E3779B97F4A7C15) + p.hashes[at[k - 1, goes] + 1])
        if k >= 2 and len(marks) > 1:
            stays = _often(marks[1], hashes, bits)
            goes, hashes = goes[stays], hashes[stays]
        at[k, goes], begun[k, goes] = at[k - 1, goes] + 1, hashes
    return at, begun


#: distinct windows that a task holds before it gives them out
_HELD = 1 << 20


class _Tally:
    """Windows of the slices of a task: their words' hashes, language, count, and how the words are spelled."""

    def __init__(self):
        self.key, self.n, self.lang = np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.words, self.known, self.spelled = np.zeros((LONGEST, 0), _U), np.zeros(0, _U), np.zeros(0, object)
        self.names: dict[str, int] = {}

    def add(self, p: _Pieces, at: np.ndarray, begun: np.ndarray) -> None:
        size = (at >= 0).sum(0)
        whole = np.where(size > 0, begun[size - 1, np.arange(len(size))], p.salt[p.lang])
        key, one, n = np.unique(kernels.mix(whole + size.astype(_U)), return_index=True, return_counts=True)
        at, place = at[:, one], [self.names.setdefault(x, len(self.names)) for x in p.names]
        words = np.where(at >= 0, p.hashes[at], _U(0))
        key = np.concatenate([self.key, key])
        self.key, first, back = np.unique(key, return_index=True, return_inverse=True)
        self.n = np.bincount(back, np.concatenate([self.n, n]), len(self.key)).astype(np.int64)
        self.lang = np.concatenate([self.lang, np.array(place, np.int64)[p.lang[one]]])[first]
        self.words = np.concatenate([self.words, words], 1)[:, first]
        used = np.unique(at[at >= 0])
        ids, where = np.unique(p.hashes[used], return_index=True)
        new = ~np.isin(ids, self.known, assume_unique=True)
        w = p.words
        spelled = np.array([w.texts.data[w.starts[i] : w.ends[i]].tobytes().decode("utf-8", "replace") for i in used[where[new]]], object)
        known = np.concatenate([self.known, ids[new]])
        order = np.argsort(known)
        self.known, self.spelled = known[order], np.concatenate([self.spelled, spelled])[order]

    def blocks(self) -> Iterator[pa.RecordBatch]:
        """A row for each block of keys: its windows' keys and counts, and their words as places in a list of the block's words."""
        edges = np.searchsorted(self.key >> _U(64 - _BLOCK_BITS), np.arange((1 << _BLOCK_BITS) + 1, dtype=_U))
        for b in np.flatnonzero(np.diff(edges)).tolist():
            part = slice(edges[b], edges[b + 1])
            used, at = np.unique(self.words[:, part], return_inverse=True)
            none = int(used[0] == 0)
            words = self.spelled[np.searchsorted(self.known, used[none:])].tolist()
            yield kernels.rows(_BLOCKS, [b], [self.key[part].view(np.int64)], [self.n[part]], [list(self.names)], [self.lang[part]], [words], [at.ravel() - none])


#: blocks of keys that windows are merged by
_BLOCK_BITS = 8
_BLOCKS = pa.schema(
    [
        ("block", pa.int32()), ("key", pa.list_(pa.int64())), ("n", pa.list_(pa.int64())), ("langs", pa.list_(pa.string())), ("lang", pa.list_(pa.int32())),
        ("words", pa.list_(pa.string())), ("at", pa.list_(pa.int32())),
    ]
)
_BLOCKS_DDL = "block int, key array<bigint>, n array<bigint>, langs array<string>, lang array<int>, words array<string>, at array<int>"
_WINDOWS = pa.schema([("lang", pa.string()), *((w, pa.string()) for w in _W), ("n", pa.int64())])


def _summed(held: list[tuple[np.ndarray, pa.Table]]) -> tuple[np.ndarray, pa.Table]:
    """Each key once, with the sum of its counts."""
    key, first, back = np.unique(np.concatenate([k for k, _ in held]), return_index=True, return_inverse=True)
    every = pa.concat_tables([t for _, t in held])
    n = np.bincount(back, every.column("n").to_numpy(), len(key)).astype(np.int64)
    return key, every.take(pa.array(first)).drop_columns("n").append_column("n", pa.array(n)).combine_chunks()


def _merge_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each window of a block once, with its count in all tasks; rows of a block come together."""
    held, block, summed = [], None, 0
    for batch in batches:
        b, key, n, langs, lang, words, places = (kernels.column(batch, f.name) for f in _BLOCKS)
        for i in range(len(batch)):
            if block not in (None, b[i].as_py()):
                yield from _summed(held)[1].to_batches(1 << 16)
                held, summed = [], 0
            block = b[i].as_py()
            at = places[i].values.to_numpy().reshape(LONGEST, -1)
            spelled = [words[i].values.take(pa.array(x, mask=x < 0)) for x in at]
            columns = [langs[i].values.take(lang[i].values), *spelled, n[i].values]
            held.append((key[i].values.to_numpy(), pa.Table.from_arrays(columns, schema=_WINDOWS)))
            if sum(len(k) for k, _ in held) > max(1 << 17, 2 * summed):
                held = [_summed(held)]
                summed = len(held[0][0])
    if held:
        yield from _summed(held)[1].to_batches(1 << 16)


def longest_windows(docs: DataFrame, least: int, bits: int = CELL_BITS) -> DataFrame:
    """``lang``, ``w1`` to ``w5`` and ``n``: how often each window of words in a row within a piece occurs.

    A window begins at every word and leads to the four after it; it is padded with nulls where the piece ends, and from where
    it surely occurs fewer than ``least`` times in the language, as no phrase that counts goes on there. Two passes find out where: one counts words
    and pairs of neighbours in cells, the next the longer beginnings of windows that those leave. A word that
    is itself so rare gives a window of nulls, so the windows of a language are as many as its words. A task counts its windows and
    gives them out in blocks of keys; blocks of all tasks are merged, so each window is one row.
    """
    frame = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), text_or_empty().alias("text"))
    share = lambda marks: docs.sparkSession.sparkContext.broadcast(np.packbits(marks))

    def short(part: pa.RecordBatch, texts: kernels.Texts) -> np.ndarray:
        p = _Pieces(part, texts)
        return np.concatenate([p.hashes, p.pairs()[p.joined]])

    first = share(frequent_cells(frame, short, bits, least))

    def long(part: pa.RecordBatch, texts: kernels.Texts) -> np.ndarray:
        at, begun = _windows(_Pieces(part, texts), [first.value], bits)
        return begun[2:][at[2:] >= 0]

    second = share(frequent_cells(frame, long, bits, least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = _Tally()
        for batch in batches:
            for part, texts in kernels.slices(batch):
                p = _Pieces(part, texts)
                if len(p.words):
                    tally.add(p, *_windows(p, [first.value, second.value], bits))
                if len(tally.n) > _HELD:
                    yield from tally.blocks()
                    tally = _Tally()
        yield from tally.blocks()

    blocks = frame.mapInArrow(run, _BLOCKS_DDL).repartition("block").sortWithinPartitions("block")
    return blocks.mapInArrow(_merge_blocks, "lang string, " + ", ".join(f"{w} string" for w in _W) + ", n bigint")


def phrase_counts(windows: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """``lang``, ``n`` of all words; and ``lang``, ``p`` (its words), ``k``, ``f`` of every phrase of up to five words that occurs ``least`` times.

    A phrase begins wherever it occurs, so it is the beginning of as many windows: ROLLUP over the window's columns sums
    every length from the counts of the longest.
    """
    rolled = windows.rollup("lang", *_W).agg(F.sum("n").alias("f"), F.grouping_id().alias("left_out"))
    level = LONGEST - F.length(F.regexp_replace(F.bin("left_out"), "0", ""))
    kept = stored(
        rolled.withColumn("k", level)
        .where((F.col("k") == 0) | (F.col("f") >= least))
        # the beginning of a padded window was already counted by its own length
        .where((F.col("k") == 0) | F.get(F.array(*_W), F.col("k") - 1).isNotNull())
        .where(F.col("lang").isNotNull())
        .select("lang", F.slice(F.array(*_W), F.lit(1), F.greatest("k", F.lit(1))).alias("p"), "k", "f"),
        "phrase-counts",
    )
    return kept.where("k = 0").select("lang", F.col("f").alias("n")), kept.where("k > 0")


def collocations(docs: DataFrame, least: int = 100, top: int = 2000, bits: int = CELL_BITS) -> DataFrame:
    """The ``top`` phrases of each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    Words are lower-cased (A-Z) runs without blanks, tabs, line breaks or ``.,;:!?``; phrases never go over line breaks or those marks. A
    phrase of two to five words that occurs ``least`` times is cut where ``floor(1000 * a * n / (l * r))`` is lowest, of equal
    ones at the first place. It is left out if a longer phrase that holds it occurs as often.

    Null texts are empty, a null language is ``und``, repeated rows count again, other columns are not read, an empty table gives no
    rows; ties go by score, count and the phrase's bytes. Counts are exact but for words and windows that share a 64-bit hash.
    """
    totals, counts = phrase_counts(longest_windows(docs, least, bits), least)
    wanted = counts.where("k >= 2").withColumn("part", F.pmod(F.xxhash64("p"), F.lit(64)))
    cut = wanted.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1))).select(
        "lang", "p", "k", "f", "part", "cut", F.slice("p", F.lit(1), F.col("cut")).alias("first"), F.slice("p", F.col("cut") + 1, F.col("k") - F.col("cut")).alias("rest")
    )
    # "the" begins or ends a large share of all phrases
    cut = spread_join(cut, counts.select("lang", F.col("p").alias("first"), F.col("f").alias("l")), ["lang", "first"], "part")
    cut = spread_join(cut, counts.select("lang", F.col("p").alias("rest"), F.col("f").alias("r")), ["lang", "rest"], "part")
    wide = lambda c: F.col(c).cast("decimal(17,0)")
    valued = cut.join(totals, "lang").withColumns({"x": F.lit(1000).cast("decimal(4,0)") * (wide("f") * wide("n")), "y": wide("l") * wide("r")})
    lowest = valued.groupBy("lang", "p").agg(
        F.min("f").alias("a"), F.min("n").alias("n"), F.min(F.struct(F.expr("x div y").alias("score"), "cut", "l", "r")).alias("best")
    )
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("k") - 1),
            lambda size: F.transform(F.sequence(F.lit(1), F.col("k") - size + 1), lambda start: F.slice("p", start, size)),
        )
    )
    held = counts.where("k >= 3").select("lang", "f", F.explode(inner).alias("p")).groupBy("lang", "p").agg(F.max("f").alias("longer"))
    free = lowest.join(held, ["lang", "p"], "left").where(F.col("longer").isNull() | (F.col("longer") < F.col("a")))
    named = free.select("lang", F.array_join("p", " ").alias("phrase"), "a", "best.l", "best.r", "n", "best.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
