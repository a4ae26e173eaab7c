"""Prefix trie of rebuilt conversations from composable fingerprints of their turns."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storelens.llm import kernels
from storelens.llm.common import stored
from storelens.operators.runs import RUN, sorted_runs, spread_join

#: a fingerprint is one residue for each of these primes
PRIMES = (2147483647, 2147483629, 2147483587)
LANES = range(len(PRIMES))
#: conversations that share a base, and the most turns taken from it
GROUP, MOST = 20, 3
#: ids joined to one string by a task
PIECE = 8192
_DIGIT = 7


def _longs(values) -> Column:
    return F.expr(f"array({', '.join(f'{x}L' for x in values)})")


class Powers:
    """Powers of one base per lane, modulo the lane's prime."""

    def __init__(self, seed: int):
        spread = kernels.mix(np.arange(1, len(PRIMES) + 1, dtype=np.uint64) + np.uint64(seed * 64))
        self.base = [(1 << 20) + int(x) % (p - (1 << 21)) for x, p in zip(spread, PRIMES, strict=True)]

    def of(self, n: Column, lane: int) -> Column:
        """base ** n for n below 2 ** 35: a table for each seven bits."""
        b, p = self.base[lane], PRIMES[lane]
        out = None
        for digit in range(5):
            table = _longs(pow(b, j << (_DIGIT * digit), p) for j in range(1 << _DIGIT))
            part = F.get(table, F.shiftright(n, _DIGIT * digit).bitwiseAND(F.lit((1 << _DIGIT) - 1)).cast("int"))
            out = part if out is None else out * part % p
        return out

    def back(self, steps: Column, lane: int) -> Column:
        """base ** -steps for 0 to MOST steps."""
        p = PRIMES[lane]
        inverse = pow(self.base[lane], -1, p)
        return F.get(_longs(pow(inverse, j, p) for j in range(MOST + 1)), steps.cast("int"))


def _turns(conversations: DataFrame) -> DataFrame:
    """One compact row per turn: order, a 120-bit name of role and text, and words; no text goes on."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    name = F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256)
    number = lambda at: F.conv(F.substring(name, at, 15), 16, 10).cast("bigint")
    return conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("c"),
        F.col("turn").cast("bigint").alias("turn"),
        role.alias("role"),
        F.sha2(text, 256).alias("tie"),
        number(1).alias("v1"),
        number(16).alias("v2"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("w"),
        F.monotonically_increasing_id().alias("copy"),
    )


def _symbol(lane: int) -> Column:
    """A residue of the turn's name."""
    piece = [F.col("v1") % (1 << 30), F.shiftright("v1", 30), F.col("v2") % (1 << 30)][lane]
    return piece + 1


def _lanes(make) -> list[Column]:
    return [make(lane) for lane in LANES]


def scanned(turns: DataFrame, powers: Powers) -> tuple[DataFrame, DataFrame]:
    """Turns with their products within a range, and for each conversation and range the product of all turns before it.

    The product of turns 1 to i is the sum of symbol_j * base ** j; two products combine by a power of the base,
    so ranges are multiplied out apart, and a conversation of any length needs no task of its own.
    """
    inside = Window.partitionBy("c", RUN).orderBy("turn", "role", "tie", "copy")
    placed = turns.withColumn("k", F.row_number().over(inside).cast("bigint"))
    terms = placed.select("c", RUN, "turn", "role", "tie", "copy", "k", "v1", "v2", "w", *_lanes(lambda m: (_symbol(m) * powers.of(F.col("k"), m) % PRIMES[m]).alias(f"t{m}")))
    whole = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = terms.select(
        "c", RUN, "k", "v1", "v2", "w", *(f"t{m}" for m in LANES), F.sum("w").over(whole).alias("words"), *_lanes(lambda m: (F.sum(f"t{m}").over(whole) % PRIMES[m]).alias(f"s{m}"))
    )
    local = stored(local, "trie-turns")
    runs = local.groupBy("c", RUN).agg(F.count("*").alias("n"), F.sum("w").alias("words"), *_lanes(lambda m: (F.sum(f"t{m}") % PRIMES[m]).alias(f"s{m}")))
    before = Window.partitionBy("c").orderBy(RUN).rowsBetween(Window.unboundedPreceding, -1)
    first = runs.withColumns({"n0": F.coalesce(F.sum("n").over(before), F.lit(0)), "w0": F.coalesce(F.sum("words").over(before), F.lit(0))})
    raised = first.withColumns({f"p{m}": powers.of(F.col("n0"), m) for m in LANES}).withColumns({f"s{m}": F.col(f"s{m}") * F.col(f"p{m}") % PRIMES[m] for m in LANES})
    carry = raised.withColumns({f"h{m}": F.coalesce(F.sum(f"s{m}").over(before), F.lit(0)) % PRIMES[m] for m in LANES})
    return local, stored(carry, "trie-runs")


def _whole(local: DataFrame) -> DataFrame:
    """Rows of ranges, joined with what came before: place ``i``, term, product and words within the conversation."""
    return local.withColumns(
        {"i": F.col("n0") + F.col("k"), "words": F.col("w0") + F.col("words")}
        | {f"t{m}": F.col(f"t{m}") * F.col(f"p{m}") % PRIMES[m] for m in LANES}
        | {f"s{m}": (F.col(f"h{m}") + F.col(f"s{m}") * F.col(f"p{m}")) % PRIMES[m] for m in LANES}
    )


def rebuilt(local: DataFrame, carry: DataFrame, powers: Powers) -> tuple[DataFrame, DataFrame]:
    """One row per conversation, and one per rebuilt conversation and prefix of it.

    A rebuilt conversation is the product of its base's head and of its own turns after the head; no turn is copied.
    """
    known = carry.select("c", RUN, "n0", "w0", *(f"p{m}" for m in LANES), *(f"h{m}" for m in LANES))
    early = _whole(local.where(F.col("k") <= MOST).join(known.where(F.col("n0") < MOST), ["c", RUN]))
    fields = F.struct("v1", "v2", "w", "words", *(f"s{m}" for m in LANES))
    heads = early.where(F.col("i") <= MOST).groupBy("c").agg(*(F.max(F.when(F.col("i") == j, fields)).alias(f"head{j}") for j in range(1, MOST + 1)))
    sizes = carry.groupBy("c").agg(F.sum("n").alias("n"), F.sum("words").alias("all_words"), *_lanes(lambda m: (F.sum(f"s{m}") % PRIMES[m]).alias(f"s{m}")))
    convs = stored(sizes.join(heads, "c").withColumn("h", F.crc32(F.col("c").cast("string")) % (MOST + 1)), "trie-conversations")
    bases = convs.where(F.col("c") % GROUP == 0).select(F.col("c").alias("base"), F.col("n").alias("base_n"), *(F.col(f"head{j}").alias(f"base{j}") for j in range(1, MOST + 1)))
    joined = convs.withColumn("base", F.col("c") - F.col("c") % GROUP).join(bases, "base", "left")
    taken, skipped = F.least("h", F.coalesce("base_n", F.lit(0))), F.least("h", "n")

    def pick(kind: str, place: Column, field: str) -> Column:
        return reduce(lambda rest, j: F.when(place == j, F.col(f"{kind}{j}")[field]).otherwise(rest), range(1, MOST + 1), F.lit(0).cast("bigint"))

    info = joined.withColumns({"taken": taken, "skipped": skipped}).withColumns(
        {"head_words": pick("base", F.col("taken"), "words"), "gone_words": pick("head", F.col("skipped"), "words")}
        | {f"b{m}": pick("base", F.col("taken"), f"s{m}") for m in LANES}
        | {f"o{m}": pick("head", F.col("skipped"), f"s{m}") for m in LANES}
        | {f"r{m}": powers.back(F.col("h") - F.col("taken"), m) for m in LANES}
    )
    info = info.withColumns(
        {"depth": F.col("taken") + F.col("n") - F.col("skipped"), "total": F.col("head_words") + F.col("all_words") - F.col("gone_words")}
        | {f"f{m}": _shifted(F.col(f"s{m}"), m) for m in LANES}
    )
    info = stored(info.select("c", "h", "n", "taken", "depth", "total", "head_words", "gone_words", *(f"base{j}" for j in range(1, MOST + 1)), *(f"{x}{m}" for x in "borf" for m in LANES)), "trie-rebuilt")

    at = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("taken"))).alias("d")
    head = info.select("c", at, *(f"base{j}" for j in range(1, MOST + 1))).select(
        "c",
        F.lit(-1).alias(RUN),
        "d",
        *_lanes(lambda m: pick("base", F.col("d"), f"s{m}").alias(f"f{m}")),
        *_lanes(lambda m: pick("base", F.col("d") - 1, f"s{m}").alias(f"q{m}")),
        *(pick("base", F.col("d"), x).alias(x) for x in ("v1", "v2", "w", "words")),
    )
    kept = ["c", "h", "taken", "head_words", "gone_words", *(f"{x}{m}" for x in "bor" for m in LANES)]
    here = known.join(info.where(F.col("n") > F.col("h")).select(*kept), "c")
    own = _whole(local.join(here, ["c", RUN])).where(F.col("i") > F.col("h")).select(
        "c",
        RUN,
        (F.col("taken") + F.col("i") - F.col("h")).alias("d"),
        *_lanes(lambda m: _shifted(F.col(f"s{m}"), m).alias(f"f{m}")),
        *_lanes(lambda m: _shifted(F.col(f"s{m}") - F.col(f"t{m}") + PRIMES[m], m).alias(f"q{m}")),
        "v1",
        "v2",
        "w",
        (F.col("head_words") + F.col("words") - F.col("gone_words")).alias("words"),
    )
    return info, stored(head.unionByName(own), "trie-prefixes")


def _shifted(product: Column, m: int) -> Column:
    """The base's head, then the own product without its own head, moved to the place after it."""
    rest = (product - F.col(f"o{m}") + PRIMES[m]) % PRIMES[m]
    return (F.col(f"b{m}") + rest * F.col(f"r{m}") % PRIMES[m]) % PRIMES[m]


_KEY = ["d", *(f"f{m}" for m in LANES)]


def trie(conversations: DataFrame, seed: int = 1) -> DataFrame:
    """Nodes of the trie of rebuilt conversations.

    Turns go by ``turn`` (null first), then role, then the SHA-256 of the text; rows without a ``conv_id`` belong to no conversation; null role or text
    is empty; repeated rows are turns of their own; other columns are not read; an empty table gives no nodes.

    A node's members are grouped by depth and fingerprint. Groups are checked: all members must name the same last turn and the same parent group, so by
    induction they have the same turns; should two sequences ever share a fingerprint, everything is done again with other bases.

    Sums over subtrees need no walk of the tree. A node is charged to its smallest member, its owner; the nodes that a
    conversation owns are the lower end of its path. So what a subtree holds is a sum, over the members of its top, of differences of words.
    """
    turns = stored(_turns(conversations), "trie-input")
    turns = sorted_runs(turns, ["c", "turn", "role", "tie", "copy"], "trie-order")
    while True:
        powers = Powers(seed)
        local, carry = scanned(turns, powers)
        info, prefixes = rebuilt(local, carry, powers)
        same = ["v1", "v2", *(f"q{m}" for m in LANES)]
        grouped = prefixes.groupBy(*_KEY).agg(
            F.min("c").alias("conv_id"),
            F.count("*").alias("n_convs"),
            F.min("w").alias("w"),
            F.min("words").alias("words"),
            *(F.min(x).alias(x) for x in same),
            *(F.max(x).alias(f"{x}_max") for x in same),
        )
        nodes = stored(grouped, "trie-nodes")
        differs = reduce(lambda a, b: a | b, [F.col(x) != F.col(f"{x}_max") for x in same])
        if nodes.where(differs).isEmpty():
            break
        seed += 1
    up = [(F.col("d") - 1).alias("d"), *(F.col(f"q{m}").alias(f"f{m}") for m in LANES)]
    children = nodes.where("d > 0").groupBy(*up).agg(F.count("*").alias("n_children"))
    full = nodes.join(children, _KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    full = stored(full.select(*_KEY, "conv_id", "n_convs", "n_children", "w", "words", *(f"q{m}" for m in LANES)), "trie-counted")
    owners = full.groupBy(F.col("conv_id").alias("c")).agg(
        F.min(F.struct("d", (F.col("words") - F.col("w")).alias("above"))).alias("top"), F.max((F.col("n_children") == 0).cast("bigint")).alias("leaf")
    )
    charged = info.join(owners, "c", "left").select(
        "c",
        F.coalesce("top.d", F.lit((1 << 62))).alias("top"),
        F.coalesce("top.above", "total").alias("above"),
        F.coalesce("leaf", F.lit(0)).alias("leaf"),
    )
    saved = F.when(F.col("d") < F.col("top"), F.col("above") - F.col("words") + F.col("w")).otherwise(0)
    sums = spread_join(prefixes, charged, ["c"], RUN).groupBy(*_KEY).agg(F.sum("leaf").alias("n_leaves"), F.sum(saved).alias("saved_tokens"))
    # a node with a third of all nodes below it meets them in 64 parts
    below = full.where("d > 0").select(*(F.col(c).alias(f"n_{c}") for c in _KEY), *up, F.pmod(F.xxhash64(*_KEY), F.lit(64)).alias("part"))
    parents = spread_join(below, full.select(*_KEY, F.col("conv_id").alias("parent_conv_id")), _KEY, "part").select(*(F.col(f"n_{c}").alias(c) for c in _KEY), "parent_conv_id")
    ended = info.select("c", F.col("depth").alias("d"), *(f"f{m}" for m in LANES))
    found = full.join(sums, _KEY).join(parents, _KEY, "left").join(end_hashes(ended), _KEY, "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return found.select(
        "conv_id",
        F.col("d").alias("depth"),
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
    )


def end_hashes(ended: DataFrame) -> DataFrame:
    """SHA-256 of the ascending ids ``c`` of each node's key, joined by commas.

    Ids are ordered by ranges over all nodes and joined there to strings of at most PIECE ids; a node's strings are then
    hashed one after the other as they stream by, so no task holds a node's ids.
    """
    key_fields = [(c, pa.int64()) for c in _KEY]
    pieces = pa.schema([*key_fields, ("first", pa.int64()), ("ids", pa.string())])

    def join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PIECE):
                part = batch.slice(at, PIECE)
                keys = np.stack([kernels.column(part, c).to_numpy() for c in _KEY])
                cuts = np.flatnonzero(np.append(True, (keys[:, 1:] != keys[:, :-1]).any(0)))
                names = kernels.column(part, "c").cast(pa.string()).to_pylist()
                ends = np.append(cuts[1:], len(names))
                texts = [",".join(names[a:b]) for a, b in zip(cuts, ends, strict=True)]
                yield kernels.rows(pieces, *(k[cuts] for k in keys), kernels.column(part, "c").to_numpy()[cuts], texts)

    hashes = pa.schema([*key_fields, ("ends_sha256", pa.string())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, running = None, None
        for batch in batches:
            keys, out = list(zip(*(kernels.column(batch, c).to_pylist() for c in _KEY), strict=True)), []
            for key, ids in zip(keys, kernels.column(batch, "ids").to_pylist(), strict=True):
                if key == now:
                    running.update(b",")
                else:
                    if now is not None:
                        out.append((*now, running.hexdigest()))
                    now, running = key, hashlib.sha256()
                running.update(ids.encode())
            if out:
                yield kernels.rows(hashes, *map(list, zip(*out, strict=True)))
        if now is not None:
            yield kernels.rows(hashes, *([x] for x in now), [running.hexdigest()])

    types = ", ".join(f"{c} bigint" for c in _KEY)
    ordered = ended.repartitionByRange(*_KEY, "c").sortWithinPartitions(*_KEY, "c").select(*_KEY, "c")
    strings = ordered.mapInArrow(join_ids, f"{types}, first bigint, ids string")
    return strings.repartition(*_KEY).sortWithinPartitions(*_KEY, "first").mapInArrow(digest, f"{types}, ends_sha256 string")
