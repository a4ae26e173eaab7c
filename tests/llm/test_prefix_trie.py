"""The prefix trie of rebuilt conversations against one built from whole turn lists."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from storelens.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", hashlib.sha256((text or "").encode()).hexdigest(), text or ""))
    own = {c: [(t[2], t[4]) for t in sorted(v)] for c, v in own.items()}
    members, whole = defaultdict(list), {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = own.get(c - abs(c) % 20 * (1 if c >= 0 else -1), [])
        whole[c] = base[:h] + turns[h:]
        for d in range(len(whole[c]) + 1):
            members[tuple(whole[c][:d])].append(c)
    children = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        for d in range(len(k) + 1):
            leaves[k[:d]] += children[k] == 0
            saved[k[:d]] += (len(m) - 1) * words
    out = Counter()
    for k, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(whole[c]) == len(k))
        parent = min(members[k[:-1]]) if k else None
        out[(min(m), len(k), parent, len(m), children[k], leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest())] += 1
    return out


def made(seed):
    rnd = random.Random(seed)
    rows = [(None, 1, "user", "of no conversation")]
    for c in rnd.sample(range(-45, 90), 60):
        rows += [(c, rnd.choice([None, t, t, t]), rnd.choice(["u", "a", None, ""]), rnd.choice([None, "", "a b", "x", "y  z", "q"])) for t in range(rnd.randrange(1, 7))]
    # a conversation with a third of all turns, one turn repeated, and a group that ends alike
    rows += [(40, i, "u", rnd.choice(["a", "a a"])) for i in range(250)] + [(61, None, "u", "a")] * 40
    rows += [(c, t, "u", f"same {t}") for c in range(200, 300) for t in range(3)]
    rnd.shuffle(rows)
    return rows


def rows_of(df):
    return Counter(tuple(r) for r in df.select(*NAMES).collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_trie(spark, seed, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 7)
    rows = made(seed)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = prefix_trie.trie(docs)
    assert got.columns == NAMES
    assert rows_of(got) == brute(rows)


def test_clashing_fingerprints_are_done_again(spark, monkeypatch):
    rows = made(3)[:250]
    # with the same residue for every turn, depth alone tells prefixes apart
    tried = []

    def symbol(lane):
        if lane == 0:
            tried.append(1)
        return prefix_trie.F.lit(1).cast("bigint") if len(tried) <= 1 else real(lane)

    real = prefix_trie._symbol
    monkeypatch.setattr(prefix_trie, "_symbol", symbol)
    assert rows_of(prefix_trie.trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    assert len(tried) == 2


def test_names_that_clash_and_no_rows(spark):
    rows = made(4)[:150]
    names = "c string, d string, _run string, n_convs string, words string"
    wide = spark.createDataFrame([(*r, "c", "d", "r", "n", "w") for r in rows], f"{SCHEMA}, {names}")
    assert rows_of(prefix_trie.trie(wide)) == brute(rows)
    assert prefix_trie.trie(wide.limit(0)).count() == 0


def test_powers(spark):
    powers = prefix_trie.Powers(5)
    df = spark.createDataFrame([(n,) for n in (0, 1, 127, 128, 20_000, (1 << 35) - 1)], "n long")
    for m in prefix_trie.LANES:
        for r in df.withColumn("v", powers.of(df.n, m)).collect():
            assert r.v == pow(powers.base[m], r.n, prefix_trie.PRIMES[m])
