"""Removal of long passages that an earlier document holds, by a compacted de Bruijn graph of words.

Nodes are word sequences of ``window - 1`` words and each window of ``window`` words is an edge. An edge is
named by its minimizer, the least hash among the sequences of ``anchor`` words in it, which depends on the
window alone. Consecutive edges with one minimizer form a path. A path that is the only one with
its minimizer does not branch: it travels as one row with a hash of all its words, however many
edges it has, and occurrences are matched by joins on (minimizer, path). Only where several
different paths share a minimizer, the graph branches, and one occurrence of each is opened into
its edges; what is found there holds for the path's other occurrences under that id, too.
Matching paths and edges are traced to the smallest document that holds them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.llm import kernels
from storelens.llm.common import LAST_ID, id_or_last, stored, text_key, text_or_empty

_PATHS = "m bigint, path bigint, id bigint, key bigint, at int, n int"
_PATHS_ARROW = pa.schema([("m", pa.int64()), ("path", pa.int64()), ("id", pa.int64()), ("key", pa.int64()), ("at", pa.int32()), ("n", pa.int32())])
_EDGES = "edge bigint, check bigint, id bigint, key bigint, begin int, at int"
_EDGES_ARROW = pa.schema([("edge", pa.int64()), ("check", pa.int64()), ("id", pa.int64()), ("key", pa.int64()), ("begin", pa.int32()), ("at", pa.int32())])
_CUT = "doc_id bigint, n_words bigint, n_removed bigint, kept string"
_CUT_ARROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def paths(named: DataFrame, window: int, anchor: int) -> DataFrame:
    """The paths of every text: minimizer, hash of the words, where it begins and its number of edges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in kernels.slices(batch):
                words = kernels.Words(texts)
                edges = np.maximum(words.count - window + 1, 0)
                if not edges.any():
                    continue
                hashes = words.hashes()
                runs = kernels.Sequences(hashes)
                least = kernels.sliding_min(runs.grams(anchor), window - anchor + 1)
                at = kernels.ragged(words.first[:-1], edges)
                owner = np.repeat(np.arange(len(texts)), edges)
                value = least[at]
                new = np.ones(len(at), bool)
                new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
                first = np.flatnonzero(new)
                n = np.diff(np.append(first, len(at)))
                begin, who = at[first], owner[first]
                path = runs.of(begin, begin + n + window - 1)
                ids, keys = (kernels.column(part, c).to_numpy() for c in ("id", "key"))
                yield kernels.rows(_PATHS_ARROW, _signed(value[first]), _signed(path), ids[who], keys[who], begin - words.first[who], n)

    return named.mapInArrow(run, _PATHS)


def edges(opened: DataFrame, window: int) -> DataFrame:
    """The edges of chosen paths (column ``chosen``: list of start and number) as 128 bits of their words.

    ``begin`` is the start of the edge's path.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in kernels.slices(batch):
                words = kernels.Words(texts)
                hashes = words.hashes()
                one, two = kernels.Sequences(hashes), kernels.Sequences(kernels.mix(hashes))
                chosen = kernels.column(part, "chosen")
                lists = chosen.value_lengths().to_numpy()
                pairs = chosen.flatten()
                start, n = (pairs.field(k).to_numpy() for k in (0, 1))
                who = np.repeat(np.repeat(np.arange(len(texts)), lists), n)
                at = kernels.ragged(start, n)
                begin = words.first[who] + at
                ids, keys = (kernels.column(part, c).to_numpy()[who] for c in ("id", "key"))
                yield kernels.rows(
                    _EDGES_ARROW, _signed(one.of(begin, begin + window)), _signed(two.of(begin, begin + window)), ids, keys, np.repeat(start, n), at
                )

    return opened.mapInArrow(run, _EDGES)


def _cut(marked: DataFrame, window: int) -> DataFrame:
    """The texts without the words of their removed edges (column ``removed``: list of start and number)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in kernels.slices(batch):
                total, gone, kept = [], [], []
                for i, removed in enumerate(kernels.column(part, "removed").to_pylist()):
                    words = texts.raw(i).split()
                    left, done = [], 0
                    for start, n in sorted((r["at"], r["n"]) for r in removed or ()):
                        if start > done:
                            left += words[done:start]
                        done = max(done, start + n + window - 1)
                    left += words[done:]
                    total.append(len(words))
                    gone.append(len(words) - len(left))
                    kept.append(b" ".join(left).decode())
                ids = [None if i == LAST_ID else i for i in kernels.column(part, "id").to_pylist()]
                yield kernels.rows(_CUT_ARROW, ids, total, gone, kept)

    return marked.mapInArrow(run, _CUT)


def _named(docs: DataFrame) -> DataFrame:
    return docs.select(id_or_last().alias("id"), text_key().alias("key"), text_or_empty().alias("text"))


def repeated_spans(docs: DataFrame, window: int = 50, anchor: int = 10) -> DataFrame:
    """Runs of removable edges: ``id``, ``key`` (of the text), ``at`` (first word) and ``n`` (edges).

    An edge is removable if its words also begin an edge of a document with a smaller id. A null id
    counts as larger than all others; rows with equal ids do not remove each other's words.
    """
    named = _named(docs)
    found = paths(named, window, anchor)
    # most minimizers are in one document only; their paths go no further
    shared = found.groupBy("m").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("m")
    found = stored(found.join(shared, "m", "left_semi"), "paths")
    here = F.struct("id", "key", "at", "n")
    # written, so that the joins below are between plain shuffles, which adaptive execution splits where one
    # path or minimizer has very many rows
    latest = F.max(F.struct(F.bitwise_not("id").alias("id"), "key", "at"))  # of those with the smallest id
    groups = found.groupBy("m", "path").agg(F.min(here).alias("source"), F.max("id").alias("last"), latest.alias("latest"))
    several = (F.col("latest.key") != F.col("source.key")) | (F.col("latest.at") != F.col("source.at"))
    each = stored(groups.select("m", "path", "source", "last", several.alias("several")), "path-groups")
    # the same path again: gone in every document but the smallest
    again = each.where(F.col("last") > F.col("source.id")).select("m", "path", F.col("source.id").alias("first"))
    same = found.join(again, ["m", "path"]).where(F.col("id") > F.col("first")).select("id", "key", "at", "n")
    # several paths with one minimizer in several documents: open one occurrence of each
    forks = (
        each.groupBy("m")
        .agg(F.count("*").alias("paths"), F.min("source.id").alias("lo"), F.max("source.id").alias("hi"))
        .where((F.col("paths") > 1) & (F.col("hi") > F.col("lo")))
        .select("m")
    )
    forked = each.join(forks, "m")
    open_ = forked.select("source.*").groupBy("id", "key").agg(F.collect_list(F.struct("at", "n")).alias("chosen"))
    single = edges(named.join(open_, ["id", "key"]), window)
    first = single.groupBy("edge", "check").agg(F.min("id").alias("first"), F.max("id").alias("last")).where(F.col("last") > F.col("first"))
    some = stored(
        single.join(first, ["edge", "check"]).where(F.col("id") > F.col("first")).select("id", "key", "begin", "at"), "edges"
    )
    # the opened path again under its own id: its edges go from there as well
    opened = forked.where("several").select("m", "path", "source.id", F.col("source.key").alias("from"), F.col("source.at").alias("begin"))
    others = (
        found.join(opened, ["m", "path", "id"])
        .where((F.col("key") != F.col("from")) | (F.col("at") != F.col("begin")))
        .select("id", F.col("from").alias("key"), "begin", F.col("key").alias("to"), (F.col("at") - F.col("begin")).alias("by"))
        .distinct()
    )
    more = some.join(others, ["id", "key", "begin"]).select("id", F.col("to").alias("key"), (F.col("at") + F.col("by")).alias("at"))
    return same.unionByName(some.drop("begin").unionByName(more).withColumn("n", F.lit(1)))


def remove_repeats(docs: DataFrame, window: int = 50, anchor: int = 10) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and ``kept``: the text without words of repeated windows.

    Each word goes that lies in a window of ``window`` words which also starts in a document with
    a smaller id, judged on the texts as given; kept words are joined by one space. A null text
    has no words; texts shorter than a window stay whole; a null id counts as larger than all and
    equal ids do not remove from each other; equal rows each get the same answer. Other columns
    are not read.
    """
    gone = repeated_spans(docs, window, anchor).distinct()
    per_text = gone.groupBy("id", "key").agg(F.collect_list(F.struct("at", "n")).alias("removed"))
    # the same exchange of the texts serves the edges and the cut
    marked = _named(docs).join(per_text, ["id", "key"], "left").select("id", "text", "removed")
    return _cut(marked, window)
