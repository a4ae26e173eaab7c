"""SpotSigs: fingerprints from chains of content words that follow common words."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.llm import kernels
from storelens.llm.common import id_or_last, text_key, text_or_empty

# The common words at which signatures begin, by language.
ANCHORS = {
    "en": "a an and are as at be been but by can do for from had has have he her his if in is it its not of on or she that the their there they this to was we were what when which who will with would you",
    "de": "als am an auch auf aus bei das dass dem den der des die du ein eine einem einen einer er es für hat ich im ist man mit nach nicht noch oder sich sie sind so um und von war wie wir wird zu zum zur über",
    "fr": "au aux avec ce ces cette dans de des du elle en est et il ils la le les leur lui mais ne nous on ou où par pas plus pour qu que qui sa se ses son sont sur un une vous à été être",
    "es": "al como con de del desde el ella en entre era es esta este fue ha hay la las le lo los más no o para pero por que se ser si sin sobre su sus también un una uno y ya",
}
_INSIDE = np.zeros(256, bool)
_INSIDE[48:58] = _INSIDE[65:91] = _INSIDE[97:123] = _INSIDE[128:] = True
_APART = ~_INSIDE
_COMMON = np.array([], np.uint64)
#: a text with fewer common words than one in so many is anchored at every word
_SPARSE = 50
#: in a text of fewer words every single word is a signature as well
_SHORT = 16


def _common() -> np.ndarray:
    global _COMMON
    if not len(_COMMON):
        raw = [w.encode() for w in sorted({w for words in ANCHORS.values() for w in words.split()})]
        ends = np.cumsum([len(r) for r in raw])
        _COMMON = np.sort(kernels.hash_spans(np.frombuffer(b"".join(raw), np.uint8), ends - [len(r) for r in raw], ends))
    return _COMMON


def signatures(texts: kernels.Texts, chain: int = 3) -> list[np.ndarray]:
    """The set of spot signatures of each text: ascending 32-bit hashes.

    A spot is the beginning of the text or a common word; its signature is a hash of that word and the
    next ``chain`` words that are not common, fewer at the end of the text. Texts that hardly have common
    words are anchored at every word, and in short texts each word is a signature too. Words are
    lower-cased runs of ASCII letters, digits and non-ASCII characters.
    """
    words = kernels.Words(texts.lowered(), _APART)
    if not len(words):
        return [np.zeros(0, np.uint32)] * len(texts)
    hashes, owner = words.hashes(), words.owner()
    common = _common()
    spot = common[np.minimum(np.searchsorted(common, hashes), len(common) - 1)] == hashes
    anchored = np.zeros(len(texts), np.int64)
    np.add.at(anchored, owner[spot], 1)
    sparse = (anchored * _SPARSE < words.count)[owner]
    content = ~spot
    place = np.cumsum(content)
    of = np.append(hashes[content], np.zeros(chain, np.uint64))
    owner_of = np.append(owner[content], np.full(chain, -1))
    heads = words.first[:-1][words.count > 0]

    def chains(at: np.ndarray, value: np.ndarray, nxt: np.ndarray) -> np.ndarray:
        for k in range(chain):
            here = owner_of[nxt + k] == owner[at]
            value = kernels.mix(value * np.uint64(31) + np.where(here, of[nxt + k], np.uint64(k + 1)))
        return value

    at = np.flatnonzero(spot | sparse)
    short = np.flatnonzero((words.count < _SHORT)[owner])
    value = np.concatenate(
        [
            kernels.mix(hashes[short]),
            chains(at, np.where(spot[at], hashes[at], np.uint64(7)), place[at] - content[at]),
            chains(heads, np.zeros(len(heads), np.uint64), place[heads] - content[heads]),
        ]
    )
    who = np.concatenate([owner[short], owner[at], owner[heads]]).astype(np.uint64)
    keys = np.unique((who << np.uint64(32)) | (value >> np.uint64(32)))
    cuts = np.searchsorted(keys >> np.uint64(32), np.arange(len(texts) + 1, dtype=np.uint64))
    low = (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return [low[cuts[i] : cuts[i + 1]] for i in range(len(texts))]


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two ascending sets; 1 for two empty ones."""
    if not len(a) and not len(b):
        return 1.0
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared)


def packed(spots: np.ndarray) -> str:
    return base64.b64encode(spots.astype("<u4").tobytes()).decode()


def unpacked(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), "<u4")


def fingerprints(docs: DataFrame, chain: int = 3) -> DataFrame:
    """``docs`` with ``fingerprint`` (the packed set) and ``n_spots``; columns of those names are replaced.

    Equal texts have equal fingerprints. Null and empty texts have the empty set; repeated rows stay.
    """
    from storelens.llm.byte_bpe import _arrow, _ddl

    docs = docs.drop("fingerprint", "n_spots")
    schema = _arrow(docs, ("fingerprint", pa.string()), ("n_spots", pa.int64()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in kernels.slices(batch):
                sets = signatures(texts, chain)
                yield kernels.rows(schema, *part.columns, [packed(s) for s in sets], [len(s) for s in sets])

    return docs.mapInArrow(run, _ddl(docs, "fingerprint string", "n_spots bigint"))


def similar(fingerprinted: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Pairs of different fingerprints at or above ``threshold``: ``left``, ``right``, ``likeness``, each set once.

    Sets are partitioned by length, in bands within which sizes differ by less than the threshold; a set can only be
    like those of its own and the next band. Of a set of n spots only the first
    n - ceil(threshold * n) + 1 by rising frequency are joined on, so two sets that share none of them are pruned
    unseen; pairs whose sizes differ too much are pruned before the comparison. Empty sets are like no other.
    """
    sets = fingerprinted.where("n_spots > 0").select("fingerprint", "n_spots").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spots = [unpacked(f) for f in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([s.astype(np.int64) for s in spots])], names=["fingerprint", "n_spots", "spots"])

    opened = sets.mapInArrow(run, "fingerprint string, n_spots bigint, spots array<bigint>").withColumn("id", F.xxhash64("fingerprint"))
    each = opened.select("id", "n_spots", F.explode("spots").alias("spot"))
    often = each.groupBy("spot").agg(F.count("*").alias("often"))
    ranked = each.join(often, "spot").groupBy("id", "n_spots").agg(F.sort_array(F.collect_list(F.struct("often", "spot"))).alias("spots"))
    prefix = F.slice("spots", 1, (F.col("n_spots") - F.ceil(F.lit(threshold) * F.col("n_spots")) + 1).cast("int"))
    band = F.floor(F.log(F.col("n_spots").cast("double")) / F.lit(-float(np.log(threshold))))
    keyed = ranked.select("id", "n_spots", band.alias("band"), F.explode(prefix).alias("p")).select("id", "n_spots", "band", "p.spot")
    left = keyed.select(F.col("id").alias("a"), F.col("n_spots").alias("na"), "band", "spot")
    right = keyed.select(F.col("id").alias("b"), F.col("n_spots").alias("nb"), F.explode(F.array("band", F.col("band") + 1)).alias("band"), "spot")
    fits = (F.least("na", "nb") >= F.lit(threshold) * F.greatest("na", "nb")) & ((F.col("nb") < F.col("na")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b"))))
    pairs = left.join(right, ["band", "spot"]).where(fits).select("a", "b").distinct()
    some = opened.select("id", "fingerprint", "spots")
    full = pairs.join(some.select(F.col("id").alias("a"), F.col("fingerprint").alias("left"), F.col("spots").alias("l")), "a").join(
        some.select(F.col("id").alias("b"), F.col("fingerprint").alias("right"), F.col("spots").alias("r")), "b"
    )
    shared = F.size(F.array_intersect("l", "r"))
    likeness: Column = shared / (F.size("l") + F.size("r") - shared)
    return full.select("left", "right", likeness.alias("likeness")).where(F.col("likeness") >= threshold)


_PAIRED = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_PAIRED_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
    ]
)
_KEYS_ARROW = pa.schema([("range", pa.int64()), ("id", pa.int64()), ("key", pa.int64())])


def _ranges(cuts: np.ndarray, nulls: int, ids: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The range of each row: by id, or by its text's hash among ``nulls`` ranges for the rows without an id."""
    last = np.uint64((1 << 63) - 1)
    by_key = ((keys.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)) >> np.uint64(33)).astype(np.int64) * nulls >> 31
    return np.where(ids.view(np.uint64) == last, len(cuts) + 1 + by_key, np.searchsorted(cuts, ids, "right"))


def with_next(docs: DataFrame, rows_per_range: int = 2048, most_ranges: int = 50_000) -> DataFrame:
    """Rows in order of id, each range of ids one block in which the row after the last is at hand.

    ``range, peek, id, key, doc_id, text``: ranges hold about ``rows_per_range`` rows, or more if there would be more than
    ``most_ranges`` of them; the cut points and the first row of each range (numbers only) are all the driver gets. The first row
    of the next range comes again at the end of a range, as a row to peek at; after the last range follows the first. Rows without
    an id come last, in ranges by their text's hash.
    """
    spark = docs.sparkSession
    named = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), id_or_last().alias("id"), text_key().alias("key"), text_or_empty().alias("text"))
    n, nulls = named.agg(F.count("doc_id"), F.count("*") - F.count("doc_id")).first()
    parts = min(max(1, n // rows_per_range), most_ranges)
    points = [i / parts for i in range(1, parts)]
    cuts = np.unique(np.array(named.agg(F.percentile_approx("doc_id", points, 10 * parts)).first()[0] or [], np.int64)) if points and n else np.zeros(0, np.int64)
    null_parts = int(min(max(1, nulls // rows_per_range), most_ranges))
    shared = spark.sparkContext.broadcast((cuts, null_parts))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, key = (kernels.column(batch, c).to_numpy() for c in ("id", "key"))
            yield kernels.rows(_KEYS_ARROW, _ranges(*shared.value, ids, key), ids, key)

    ranged = named.select("id", "key").mapInArrow(keys, "range bigint, id bigint, key bigint")
    firsts = sorted(tuple(r) for r in ranged.groupBy("range").agg(F.min(F.struct("id", "key")).alias("f")).select("range", "f.id", "f.key").collect())
    # where the first row of a range is to be seen again: at the end of the range before
    peeks = {(firsts[i][1], firsts[i][2]): firsts[i - 1][0] for i in range(len(firsts))}
    seen = spark.sparkContext.broadcast(peeks)
    arrow = pa.schema([("range", pa.int64()), ("peek", pa.bool_()), ("id", pa.int64()), ("key", pa.int64()), ("doc_id", pa.int64()), ("text", pa.string())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, _ in kernels.slices(batch):
                ids, key = (kernels.column(part, c).to_numpy() for c in ("id", "key"))
                where = _ranges(*shared.value, ids, key)
                own = [kernels.column(part, c) for c in ("id", "key", "doc_id", "text")]
                yield kernels.rows(arrow, where, np.zeros(len(ids), bool), *own)
                again = [(i, seen.value[x]) for i, x in enumerate(zip(ids.tolist(), key.tolist(), strict=True)) if x in seen.value]
                if again:
                    take = pa.array([i for i, _ in again])
                    yield kernels.rows(arrow, [r for _, r in again], [True] * len(again), *(c.take(take) for c in own))

    placed = named.mapInArrow(place, "range bigint, peek boolean, id bigint, key bigint, doc_id bigint, text string")
    return placed.repartition("range").sortWithinPartitions("range", "peek", "id", "key")


def compare_with_edits(docs: DataFrame, chain: int = 3) -> DataFrame:
    """Every text against its edited form and the next text.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``. The edited text is the
    text with its last half (rounded down, code points) replaced by as many of the first of the next document's in order of id,
    or all it has; after the last follows the first. Likeness is the Jaccard similarity of the sets. Null texts count as
    empty; rows with equal ids are in order of their text's hash and rows without an id come last, likewise; a single row is its own next one; an
    empty table gives no rows. Other columns are not read.
    """

    def flush(pending: list[tuple[int | None, str]], after: str) -> pa.RecordBatch:
        own = [t for _, t in pending]
        following = [*own[1:], after]
        edited = [t[: len(t) - len(t) // 2] + n[: len(t) // 2] for t, n in zip(own, following, strict=True)]
        sets = [_sets(x, chain) for x in (own, edited, [after])]
        nxt = [*sets[0][1:], sets[2][0]]
        return kernels.rows(
            _PAIRED_ARROW,
            [i for i, _ in pending],
            [len(t) for t in own],
            [hashlib.sha256(t.encode()).hexdigest() for t in edited],
            [packed(s) for s in sets[0]],
            [packed(s) for s in sets[1]],
            [jaccard(a, b) for a, b in zip(sets[0], sets[1], strict=True)],
            [jaccard(a, b) for a, b in zip(sets[0], nxt, strict=True)],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows of one range wait for the row after them, a slice at a time
        pending: list[tuple[int | None, str]] = []
        size, at = 0, None
        for batch in batches:
            for part, _ in kernels.slices(batch):
                cells = (kernels.column(part, c).to_pylist() for c in ("range", "peek", "doc_id", "text"))
                for rng, peek, doc_id, text in zip(*cells, strict=True):
                    if peek:
                        if pending:
                            yield flush(pending, text)
                            pending, size = [], 0
                        continue
                    if rng == at and pending and size > kernels.SLICE:
                        yield flush(pending, text)
                        pending, size = [], 0
                    at = rng
                    pending.append((doc_id, text))
                    size += len(text)

    return with_next(docs).mapInArrow(run, _PAIRED)


def _sets(texts: list[str], chain: int) -> list[np.ndarray]:
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.large_string())], names=["text"])
    out: list[np.ndarray] = []
    for _, part in kernels.slices(batch):
        out += signatures(part, chain)
    return out
