"""Phrases against counting every n-gram one by one, and the cells that rule out rare ones."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from storelens.llm import collocations, kernels
from storelens.llm.cells import frequent_cells

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def brute(rows, least, top):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 6):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, count in f.items():
        found = {p: a for p, a in count.items() if a >= least}
        longer = Counter()
        for p, a in found.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    longer[p[i : i + size]] = max(longer[p[i : i + size]], a)
        rows = []
        for p, a in found.items():
            if len(p) > 1 and longer[p] < a:
                score, k = min((1000 * a * n[lang] // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def texts(seed):
    rnd = random.Random(seed)
    words = ["new", "York", "city", "of", "The", "é", "漢字", "a b", "x" * 300, "Ämter", "the"]
    rows = []
    for _ in range(150):
        lang = rnd.choice(["en", "de", None, ""])
        text = "".join(rnd.choice(words) + rnd.choice([" ", " ", " ", "\t", "  ", ", ", ".\n", "\r\n", "!?"]) for _ in range(rnd.randrange(60)))
        rows.append((lang, rnd.choice([text, text, text, None, "", " . , "])))
    # words that are named as a language
    rows += [(lang, f"{lang or 'und'} {lang or 'und'} de. en und") for lang in ("en", "de", None) for _ in range(60)]
    return rows + [("en", "new york new york new york city " * 30)] * 3


@pytest.mark.parametrize("bits", [8, 24])
def test_phrases(spark, bits):
    rows = texts(bits)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    for least, top in ((12, 2000), (40, 5)):
        got = sorted(tuple(r) for r in collocations.collocations(docs, least, top, bits).collect())
        want = brute(rows, least, top)
        assert want and got == want


def test_messy_and_empty(spark, messy, empty):
    rows = [(r.lang, r.text) for r in messy.collect()]
    clash = messy.withColumns({"w1": messy.a, "n": messy.b, "p": messy.b, "rank": messy.b, "f": messy.a})
    assert sorted(tuple(r) for r in collocations.collocations(clash, 10).collect()) == brute(rows, 10, 2000)
    assert collocations.collocations(empty).count() == 0


def test_products_past_64_bits(spark):
    # floor(1000 * a * n / (l * r)) for counts of a very large corpus
    F = collocations.F
    a, n, left, right = 9_000_000_000_001, 99_999_999_999_999_9, 9_000_000_000_007, 9_000_000_000_003
    wide = lambda x: F.lit(x).cast("decimal(17,0)")
    row = spark.range(1).select((F.lit(1000).cast("decimal(4,0)") * (wide(a) * wide(n))).alias("x"), (wide(left) * wide(right)).alias("y")).select(F.expr("x div y").alias("v"))
    assert row.first().v == 1000 * a * n // (left * right)


def test_cells_never_hide_a_frequent_hash(spark):
    draw = np.random.default_rng(4)
    rows = [(" ".join(f"w{x}" for x in draw.zipf(1.3, 80) % 5000),) for _ in range(300)]
    count = Counter(w for (t,) in rows for w in t.split())
    docs = spark.createDataFrame(rows, "text string").repartition(4)
    for least in (2, 60, 400):
        marks = frequent_cells(docs, lambda part, texts: kernels.Words(texts).hashes(), 16, least)
        for word, n in count.items():
            raw = np.frombuffer(word.encode(), np.uint8)
            cell = int(kernels.hash_spans(raw, np.array([0]), np.array([len(raw)]))[0]) >> 48
            assert marks[cell] or n < least
        assert marks.sum() <= sum(count.values()) / least
    assert not frequent_cells(docs.limit(0), lambda part, texts: kernels.Words(texts).hashes(), 16, 2).any()


def test_a_window_is_one_row_whatever_the_tasks(spark):
    rows = texts(3)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(8)
    windows = collocations.longest_windows(docs, 12).collect()
    assert len({tuple(r)[:-1] for r in windows}) == len(windows)
    n = Counter()
    for lang, text in rows:
        n["und" if lang is None else lang] += sum(len(re.findall(r"[^\x20\x09]+", p)) for p in re.split(r"[.,;:!?\x0A-\x0D]", text or ""))
    assert n == sum((Counter({r.lang: r.n}) for r in windows), Counter())


def test_blocks_are_merged_in_steps(monkeypatch):
    row = lambda b, key, n, at: kernels.rows(collocations._BLOCKS, [b], [key], [n], [["en"]], [[0] * len(n)], [["a", "b"]], [at])
    none = [-1] * 6
    given = [row(0, [1, 2], [3, 4], [0, 1, *none, -1, -1]), row(0, [2], [5], [1, -1, -1, -1, -1]), row(9, [7], [1], [0, 1, 0, 1, 0])]
    got = [tuple(r.values()) for b in collocations._merge_blocks(iter(given)) for r in b.to_pylist()]
    assert got == [("en", "a", None, None, None, None, 3), ("en", "b", None, None, None, None, 9), ("en", "a", "b", "a", "b", "a", 1)]
