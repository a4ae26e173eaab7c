"""Quality rules on words, lines and repeated passages inside a document."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from storelens.llm import kernels

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
COLUMNS = (
    ("n_words", "bigint"),
    ("word_chars", "bigint"),
    ("n_symbols", "bigint"),
    ("n_dup_lines", "bigint"),
    ("n_repeat_words", "bigint"),
    ("n_covered", "bigint"),
    ("longest_repeat", "bigint"),
    ("base_failed", "boolean"),
    ("kept", "boolean"),
)


def suffix_order(words: kernels.Words, hashes: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array of every text at once, by prefix doubling.

    Places are ranked by text and first word, then by twice as many words a round until all ranks
    differ. Returns the places in order and, by round, the class of each place among prefixes of
    1, 2, 4, ... words; places whose text ends before that are classes of their own.
    """
    n, left = len(words), words.left()
    owner = words.owner().astype(np.uint64)
    # equal classes must be in the same text, so the text goes into the first key
    _, rank = np.unique(kernels.mix(hashes ^ kernels.mix(owner + np.uint64(1))), return_inverse=True)
    rank = rank.astype(np.int64)
    levels, width = [rank], 1
    while n:
        # a prefix of 2 * width words needs all of them; shorter rests sort before and differ from all
        after = np.full(n, -1, np.int64)
        full = np.flatnonzero(left > width)
        after[full] = rank[full + width]
        key = rank * (n + 1) + after + 1
        order = np.argsort(key, kind="stable")
        new = np.empty(n, bool)
        new[0] = True
        sorted_key = key[order]
        short = left[order] < 2 * width
        new[1:] = (sorted_key[1:] != sorted_key[:-1]) | short[1:] | short[:-1]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new) - 1
        if new.all():
            return order, levels
        levels.append(rank)
        width *= 2
    return np.zeros(0, np.int64), levels


def common_prefixes(order: np.ndarray, levels: list[np.ndarray], left: np.ndarray) -> np.ndarray:
    """Longest common prefix, in words, of each suffix and the one before it (0 for the first).

    Two prefixes of a round's width are equal if their classes are, so the length is read off the
    classes from the widest round down.
    """
    n = len(order)
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    a, b = order[:-1].copy(), order[1:].copy()
    length = np.zeros(n - 1, np.int64)
    room = np.minimum(left[a], left[b])
    for k in range(len(levels) - 1, -1, -1):
        width = 1 << k
        fits = np.flatnonzero(length + width <= room)
        same = fits[levels[k][a[fits]] == levels[k][b[fits]]]
        length[same] += width
        a[same] = np.minimum(a[same] + width, n - 1)
        b[same] = np.minimum(b[same] + width, n - 1)
    out[1:] = length
    return out


def repeats(words: kernels.Words, hashes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """By text: words covered by substrings of ``least`` words or more that occur twice, and the longest.

    The suffixes of an interval of common prefixes begin the occurrences of one maximal repeat;
    at a place the longest of them is the larger of the prefixes shared with its two neighbours.
    """
    n = len(words)
    covered = np.zeros(len(words.count), np.int64)
    longest = np.zeros(len(words.count), np.int64)
    if not n:
        return covered, longest
    order, levels = suffix_order(words, hashes)
    shared = common_prefixes(order, levels, words.left())
    both = np.maximum(shared, np.append(shared[1:], 0))
    reach = np.empty(n, np.int64)
    reach[order] = both
    owner = words.owner()
    np.maximum.at(longest, owner, reach)
    np.add.at(covered, owner, _union(reach, least))
    return covered, longest


def _union(reach: np.ndarray, least: int) -> np.ndarray:
    """1 for each place inside a span of at least ``least`` places that begins there or before."""
    ends = np.where(reach >= least, np.arange(len(reach)) + reach, 0)
    return (np.maximum.accumulate(ends) > np.arange(len(reach))).astype(np.int64)


def _repeat_words(words: kernels.Words, hashes: np.ndarray, width: int = 3) -> np.ndarray:
    """Words in windows of ``width`` words that the text holds twice or more."""
    out = np.zeros(len(words.count), np.int64)
    if len(words) < width:
        return out
    grams = kernels.Sequences(hashes).grams(width)
    owner = words.owner()
    starts = np.flatnonzero(words.left() >= width)
    if not len(starts):
        return out
    key = kernels.mix(grams[starts] ^ kernels.mix(owner[starts].astype(np.uint64) + np.uint64(1)))
    _, back, times = np.unique(key, return_inverse=True, return_counts=True)
    reach = np.zeros(len(words), np.int64)
    reach[starts[times[back] > 1]] = width
    np.add.at(out, owner, _union(reach, width))
    return out


def _dup_lines(words: kernels.Words) -> np.ndarray:
    """Lines with a word that equal an earlier line of the text."""
    texts = words.texts
    starts, ends = kernels.spans(texts.data != 0x0A, texts.bounds)
    out = np.zeros(len(texts), np.int64)
    with_word = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    starts, ends = starts[with_word], ends[with_word]
    if not len(starts):
        return out
    owner = np.searchsorted(texts.bounds, starts, "right") - 1
    lines = kernels.hash_spans(texts.data, starts, ends)
    _, first = np.unique(kernels.mix(lines ^ kernels.mix(owner.astype(np.uint64) + np.uint64(1))), return_index=True)
    again = np.ones(len(starts), bool)
    again[first] = False
    np.add.at(out, owner[again], 1)
    return out


def measure(texts: kernels.Texts, least: int) -> dict[str, np.ndarray]:
    words = kernels.Words(texts)
    hashes = words.hashes()
    points = np.concatenate([[0], np.cumsum((texts.data & 0xC0) != 0x80)])
    per_word = points[words.ends] - points[words.starts]
    chars = np.zeros(len(texts), np.int64)
    np.add.at(chars, words.owner(), per_word)
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[texts.data])])
    covered, longest = repeats(words, hashes, least)
    return {
        "n_words": words.count.astype(np.int64),
        "word_chars": chars,
        "n_symbols": symbols[texts.bounds[1:]] - symbols[texts.bounds[:-1]],
        "n_dup_lines": _dup_lines(words),
        "n_repeat_words": _repeat_words(words, hashes),
        "n_covered": covered,
        "longest_repeat": longest,
    }


def quality(
    docs: DataFrame,
    min_words: int = 50,
    max_repeat_percent: int = 50,
    least: int = 8,
    max_covered_percent: int = 40,
    max_longest_percent: int = 25,
    longest_floor: int = 30,
) -> DataFrame:
    """``docs`` with the counts of its text's words, lines and repeats, and the verdict ``kept``.

    The base rule fails texts of fewer than ``min_words`` words, and those with more than
    ``max_repeat_percent`` of their words in repeated three-word windows. The repetition rule,
    over the suffix array of the words, fails texts with more than ``max_covered_percent`` of
    their words in repeats of ``least`` words or more, or with a repeat of more than both
    ``longest_floor`` words and ``max_longest_percent`` of the text; overlapping occurrences count.
    A null or empty text has no words, so it fails; repeated rows each get their verdict; columns
    of ``docs`` with the names of the new ones are replaced, the others pass through.
    """
    from storelens.llm.byte_bpe import _arrow, _ddl

    docs = docs.drop(*(n for n, _ in COLUMNS))
    schema = _arrow(docs, *((n, pa.bool_() if t == "boolean" else pa.int64()) for n, t in COLUMNS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in kernels.slices(batch):
                m = measure(texts, least)
                n = m["n_words"]
                failed = (n < min_words) | (100 * m["n_repeat_words"] > max_repeat_percent * n)
                covered = 100 * m["n_covered"] > max_covered_percent * n
                long = (m["longest_repeat"] > longest_floor) & (100 * m["longest_repeat"] > max_longest_percent * n)
                yield kernels.rows(schema, *part.columns, *m.values(), failed, ~(failed | covered | long))

    return docs.mapInArrow(run, _ddl(docs, *(f"{n} {t}" for n, t in COLUMNS)))
