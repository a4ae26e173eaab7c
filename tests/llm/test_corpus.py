"""Operators over the whole corpus, and the pipeline, against brute force."""

import hashlib
import itertools
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from storelens.llm import components, kernels, language_model, mixing, near_dedup, repeats, secrets, substring_dedup, toxicity

LAST = (1 << 63) - 1


def as_rows(df, *names):
    return Counter(tuple(r) for r in df.select(*names).collect())


# mixing


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = dict(zip(names, itertools.cycle((5, 2, 1))))
    total, free = 1.5 * sum(sizes.values()), set(names)
    while free:
        level = (total - sum(2 * sizes[s] for s in names if s not in free)) / sum(weight[s] for s in free)
        full = {s for s in free if level * weight[s] > 2 * sizes[s]}
        if not full:
            break
        free -= full
    return {s: level * weight[s] if s in free else 2 * sizes[s] for s in names}


def test_mix_plan(messy, empty, documents, split):
    for docs in (documents, messy):
        rows = mixing.plan(docs).collect()
        assert Counter((r.doc_id, r.source, r.size) for r in rows) == Counter((r.doc_id, r.source, len(split(r.text))) for r in docs.collect())
        sizes, taken, largest = Counter(), Counter(), Counter()
        for r in rows:
            sizes[r.source] += r.size
            taken[r.source] += r.taken
            largest[r.source] = max(largest[r.source], r.size)
            assert r.taken in (0, r.size, 2 * r.size)
        want = brute_targets(sizes)
        for r in rows:
            assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert all(abs(taken[s] - want[s]) <= largest[s] for s in want)
        again = as_rows(mixing.plan(docs.repartition(7)), "doc_id", "size", "taken")
        assert again == Counter((r.doc_id, r.size, r.taken) for r in rows)
    assert mixing.plan(empty).count() == 0 == mixing.mix(empty).count()


def test_mix_rows_follow_the_plan(messy, documents, split):
    for docs in (documents, messy):
        out = mixing.mix(docs)
        assert out.columns == docs.columns
        words = Counter()
        for r in out.collect():
            words[r.source] += len(split(r.text))
        want = Counter()
        for r in mixing.plan(docs).collect():
            want[r.source] += r.taken
        assert +words == +want


def test_small_leaves_and_levels_keep_the_targets(documents):
    rows = mixing.copies(documents, (5, 2, 1), leaf_rows=3, fan_in=2).collect()
    assert sum(r.times for r in rows) == documents.count()
    for _, group in itertools.groupby(sorted(rows, key=lambda r: r.source), key=lambda r: r.source):
        group = list(group)
        assert abs(sum(r.copies * r.size for r in group) - group[0].target) <= max(r.size for r in group)


def test_shares_keep_their_means():
    size = np.array([900.0, 300, 200, 150, 100, 60, 30, 10])
    draws = np.random.default_rng(1).random((4000, len(size)))
    total, mean = size.sum() * 0.3, np.zeros(len(size))
    for draw in draws:
        shares, _ = mixing._against_pool(size, 0.3, draw)
        assert (shares * size).sum() == pytest.approx(total)
        mean += shares / len(draws)
    assert np.abs(mean - 0.3).max() < 0.03


# substring dedup


def brute_cut(rows, split, window):
    texts = [(LAST if i is None else i, split(t)) for i, t in rows]
    first = {}
    for i, w in texts:
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            first[key] = min(first.get(key, LAST), i)
    out = Counter()
    for (doc_id, _), (i, w) in zip(rows, texts, strict=True):
        gone = {k + j for k in range(len(w) - window + 1) if first[tuple(w[k : k + window])] < i for j in range(window)}
        out[doc_id, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)] += 1
    return out


def test_substring_dedup(spark, messy, empty, documents, split):
    passage = [f"p{i}" for i in range(90)]
    cases = [
        (3, " ".join(passage)), (1, "own start " + " ".join(passage[:55]) + " own end"), (2, " ".join(passage[20:])),
        (5, " ".join(passage + passage)), (4, "x " * 130), (6, "x " * 55 + "y"), (None, " ".join(passage[30:])), (7, " ".join(passage[:49])),
        (8, " ".join(passage[:70] + ["changed"] + passage[30:])), (9, "\n\n".join(passage)),
    ]
    more = spark.createDataFrame(cases, "doc_id long, text string")
    for docs, window, anchor in ((more, 50, 10), (more, 12, 4), (messy.where("text is null or length(text) < 60000"), 50, 10), (documents, 50, 10), (documents, 20, 5)):
        got = as_rows(substring_dedup.remove_repeats(docs, window, anchor), "doc_id", "n_words", "n_removed", "kept")
        assert got == brute_cut([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], split, window)
    assert substring_dedup.remove_repeats(messy).count() == messy.count()
    assert substring_dedup.remove_repeats(empty).count() == 0


def test_substring_dedup_of_a_passage_twice_in_one_document(spark, split):
    passage = [f"p{i}" for i in range(200)]
    twice = " ".join(passage + passage)
    for shared in (60, 75, 112, 150, 199):
        cases = [
            (1, " ".join(passage[:shared])), (5, twice), (5, twice), (5, "under the same id " + " ".join(passage)), (8, "own " + twice),
            (None, " ".join(passage[20:] + passage)), (None, twice), (2, "q " * 70), (6, " ".join(("r " * 60 + "q " * 55).split() * 2)),
        ]
        docs = spark.createDataFrame(cases, "doc_id long, text string")
        for window, anchor in ((50, 10), (12, 4)):
            got = as_rows(substring_dedup.remove_repeats(docs, window, anchor), "doc_id", "n_words", "n_removed", "kept")
            assert got == brute_cut(cases, split, window), (shared, window)


# near duplicates


def brute_classes(docs, threshold, split):
    """Shingles as tuples of words, with frequencies counted one by one."""
    rows = [(LAST if r.doc_id is None else r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
    grams = []
    for _, text in rows:
        w = split(text)
        grams.append(Counter([tuple(w[i : i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] * bool(w)))
    n, holders = len(rows), Counter(g for gs in grams for g in gs)
    least = max(2, -(-n // 200))

    def rarity(g):
        return 1 + 0.25 * (min(max(math.log(n / holders[g]) / math.log(200), 0), 1) if holders[g] >= least else 1)

    sets = [{g: k * rarity(g) for g, k in gs.items()} for gs in grams]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        shared = sum(min(w, b[h]) for h, w in a.items() if h in b)
        if rows[i][1] == rows[j][1] or shared and shared >= threshold * (sum(a.values()) + sum(b.values()) - shared):
            parent[root(i)] = root(j)
    least = defaultdict(lambda: LAST)
    for i, (doc_id, _) in enumerate(rows):
        least[root(i)] = min(least[root(i)], doc_id)
    back = lambda x: None if x == LAST else x
    return Counter((back(doc_id), back(least[root(i)])) for i, (doc_id, _) in enumerate(rows))


def near_copies(spark, seed=2):
    """A base text with variants of many distances, so that hubs alone do not link them all."""
    draw = np.random.default_rng(seed)
    rows = []
    for base in range(4):
        words = [f"b{base}w{i}" for i in range(150)]
        for v in range(25):
            changed = list(words)
            for k in draw.choice(150, draw.integers(0, 9), replace=False):
                changed[k] = f"v{base}x{v}x{k}"
            rows.append((len(rows), " ".join(changed)))
    rows += [(len(rows) + i, t) for i, t in enumerate(["one two three", "one two  three", "", " ", "one two three four five six"])]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_near_duplicates(spark, messy, empty, documents, split):
    for docs in (near_copies(spark), messy, documents):
        assert as_rows(near_dedup.near_duplicates(docs), "doc_id", "class_id") == brute_classes(docs, 0.8, split)
    assert near_dedup.near_duplicates(empty).count() == 0


def test_keep_one_of_each_class(spark, messy, empty):
    for docs in (near_copies(spark), messy):
        kept = near_dedup.keep_one(docs)
        assert kept.columns == docs.columns
        classes = near_dedup.classes(docs).select("root").distinct().count()
        assert kept.count() == classes
    assert near_dedup.keep_one(empty).count() == 0


def test_samples_agree_as_often_as_sets_are_alike():
    rng = np.random.default_rng(4)
    hashes = np.sort(rng.choice(1 << 47, 400, replace=False)).astype(np.uint64)
    a, b = rng.uniform(0.5, 3, 400), rng.uniform(0.5, 3, 400)
    alike = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    owner = np.zeros(400, np.int64)
    one, two = (near_dedup.samples(owner, hashes, w, 1, 3000)[0] for w in (a, b))
    assert (one == two).mean() == pytest.approx(alike, abs=0.04)


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 200), (200, 300)], "a long, b long")
    got = {r.node: r.root for r in components.components(links).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 200: 100, 300: 100}


# toxicity


def labelled(spark):
    draw = np.random.default_rng(9)
    words = [f"word{i}" for i in range(400)]
    rows = []
    for i in range(1200):
        text = list(draw.choice(words, 40))
        insult, group = draw.random() < 0.4, draw.random() < 0.4
        text += ["fools"] * insult + ["neighbours"] * group
        draw.shuffle(text)
        rows.append((i, " ".join(text), int(insult and group)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_toxicity_of_held_out_texts(spark, messy, empty):
    docs = labelled(spark)
    labels = docs.select("doc_id", "toxic").union(spark.createDataFrame([(None, 1), (3, None)], "doc_id long, toxic int"))
    held_out = toxicity.id_fold(4) == 2
    model = toxicity.learn(docs.drop("toxic"), labels, ~held_out)
    rows = toxicity.score(docs, model).join(labels.dropna(), "doc_id").where(held_out).collect()
    good = [r.score for r in rows if not r.toxic]
    assert np.mean([np.mean(np.array(good) < r.score) for r in rows if r.toxic]) > 0.9
    # an insult with a group mention says more than the two alone
    probe = {r.doc_id: r.score for r in toxicity.score(spark.createDataFrame([(1, "fools neighbours"), (2, "fools"), (3, "neighbours"), (4, "")], "doc_id long, text string"), model).collect()}
    assert probe[1] > max(probe[2], probe[3]) and probe[4] < 0.3
    scored = toxicity.score(messy, model).collect()
    assert len(scored) == messy.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in scored)
    assert toxicity.score(empty, model).count() == 0
    bare = toxicity.learn(empty, labels.limit(0), F.lit(True))
    assert toxicity.score(messy, bare).where("predicted = 1").count() == 0


def arrays(texts, bits=18):
    raw = [t.encode() for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    return toxicity.terms_of(kernels.Texts(np.frombuffer(b"".join(raw), np.uint8), bounds), bits)


def either_but_not_both(n, seed):
    """Two words that say nothing alone; a text is toxic if it has exactly one of them."""
    draw, texts, labels = np.random.default_rng(seed), [], []
    for _ in range(n):
        text = list(draw.choice([f"word{i}" for i in range(400)], 40))
        one, two = draw.random(2) < 0.5
        text += ["fools"] * int(one) + ["neighbours"] * int(two)
        draw.shuffle(text)
        texts.append(" ".join(text))
        labels.append(float(one != two))
    return texts, np.array(labels)


def area(scores, labels):
    good, bad = scores[labels == 1], scores[labels == 0]
    return (good[:, None] > bad).mean()


def test_toxicity_learns_what_only_pairs_say():
    texts, labels = either_but_not_both(1600, 1)
    held, truth = either_but_not_both(500, 2)
    model = toxicity.fit(*arrays(texts), labels, 18, 4, 2500)
    owner, terms = arrays(held)
    assert area(model.log_odds(owner, terms, len(held)), truth) > 0.95
    # without factors nothing is left
    flat = toxicity.Model(model.bias, model.weight, model.scale, 0 * model.factors, model.paired, 0 * model.constant)
    assert 0.4 < area(flat.log_odds(owner, terms, len(held)), truth) < 0.6


def test_log_odds_and_slopes_by_loops():
    texts, labels = either_but_not_both(40, 3)
    texts += ["", "fools", "zzz"]
    owner, terms = arrays(texts, 8)
    model = toxicity.fit(owner, terms, np.append(labels, [1.0, 0.0, 1.0]), 8, 3, 50, 50, support=5)
    got = model.log_odds(owner, terms, len(texts))

    def by_loops(i, factors, constant):
        own = terms[owner == i]
        z = model.bias + sum(float(model.weight[t]) * float(model.scale[t]) for t in own)
        pairs = [t for t in own if model.paired[t]]
        rows = [factors[t] * max(len(pairs), 1) ** -0.25 for t in pairs] + [constant]
        return z + sum(float(a @ b) for a, b in itertools.combinations(rows, 2))

    factors, constant = model.factors.astype(float), model.constant
    want = [by_loops(i, factors, constant) for i in range(len(texts))]
    assert got == pytest.approx(want, abs=1e-4)
    # the gradient of the summed log-odds against small steps
    some = model.paired[terms]
    _, sums, share = toxicity.products(owner[some], factors[terms[some]], constant, len(texts))
    slope, slope_constant, which = toxicity.pair_slopes(owner[some], terms[some], factors, constant, sums, share, np.ones(len(texts)))
    total = lambda f, c: sum(by_loops(i, f, c) for i in range(len(texts)))
    for j, f in ((0, 0), (len(which) // 2, 1), (len(which) - 1, 2)):
        nudged = factors.copy()
        nudged[which[j], f] += 1e-5
        assert (total(nudged, constant) - total(factors, constant)) / 1e-5 == pytest.approx(slope[j, f], rel=1e-3, abs=1e-3)
    nudged = constant + np.array([1e-5, 0, 0])
    assert (total(factors, nudged) - total(factors, constant)) / 1e-5 == pytest.approx(slope_constant[0], rel=1e-3, abs=1e-3)


# language model


def test_language_model(spark, messy, empty, documents, split):
    lower = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    path = public_tokenizers.path("piece_bpe_32k.model")
    held_out = toxicity.id_fold(10) == 0
    for docs, frequent in ((documents, 500), (messy, 2_000_000)):
        rows = [(r.doc_id, [*split((r.text or "").translate(lower)), None]) for r in docs.select("doc_id", "text").collect()]
        c = Counter()
        for i, w in rows:
            if i is not None and zlib.crc32(str(i).encode()) % 10:
                c.update(w)
        n = sum(c.values())
        size = n + 0.1 * (len(c) + 1)
        want = sorted((i is None, i or 0, len(w), sum(c[x] > 0 for x in w), n, round(sum(math.log10((c[x] + 0.1) / size) for x in w), 4)) for i, w in rows)
        got = language_model.score(docs, ~held_out, path, fit_texts=100, fit_ids=300, frequent=frequent).collect()
        assert want == sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got)
        assert all(r.score < 0 for r in got)
    assert language_model.score(empty, ~held_out, path).count() == 0


def test_each_id_is_scored_once_and_shares_sum_to_one():
    rng = np.random.default_rng(3)
    texts = [np.append(rng.integers(0, 30, n), 30).astype(np.int32) for n in (0, 1, 5, 40, 200)]
    model = language_model.train(texts, np.bincount(np.concatenate(texts), minlength=31).astype(float), classes=5, steps=20)
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    together = model.text_logs(np.concatenate(texts), bounds)
    alone = [model.text_logs(t, np.array([0, len(t)]))[0] for t in texts]
    assert together == pytest.approx(alone, rel=1e-4)
    every = [model.text_logs(np.array([i], np.int32), np.array([0, 1]))[0] for i in range(31)]
    assert np.exp(every).sum() == pytest.approx(1, rel=1e-3)


def test_language_model_learns_from_every_id(spark):
    # only what lies past the first thousand ids, and in more than 3,000 texts, tells what follows "alpha"
    path = public_tokenizers.path("piece_bpe_32k.model")
    late = " ".join(["zero"] * 1200 + ["alpha beta"] * 400)
    rows = [(i, late if i < 5 else "zero zero") for i in range(3600)]
    rows += [(5000, "alpha beta " * 20), (5001, "alpha zero " * 20), (5002, "beta alpha " * 20), (5003, "zero alpha " * 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3, "doc_id")
    got = {r.doc_id: r.score for r in language_model.score(docs, F.col("doc_id") < 5000, path).where("doc_id >= 5000").collect()}
    assert got[5000] > got[5001] + 5 and got[5002] > got[5003] + 5
    # counts hold all texts, also those that the weights are not fitted on
    raw = open(path, "rb").read()
    ids = language_model.encoded(docs, F.col("doc_id") < 5000, raw)
    texts = [np.frombuffer(r.ids, np.uint16).astype(np.int32) for r in ids.collect()]
    counts = np.bincount(np.concatenate(texts), minlength=int(texts[0][-1]) + 1).astype(float)
    whole = language_model.learn(ids, counts, 10, 50, steps=5)
    alone = language_model.train(texts, counts, steps=5)
    assert (whole.class_of == alone.class_of).all()
    assert np.allclose(whole.direct, alone.direct, atol=1e-5) and np.allclose(whole.log_share, alone.log_share, atol=1e-5)


# pipeline


def test_stages(spark, documents, split):
    kept = {}
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:4]:
        after = stage(spark, docs, "").persist()
        assert after.columns == documents.columns
        kept[name] = after
        docs = after
    good = {r.doc_id for r in repeats.quality(documents).where("kept").collect()}
    assert {r.doc_id for r in kept["quality"].collect()} == good
    classes = brute_classes(kept["quality"], 0.8, split)
    assert {r.doc_id for r in kept["near_dedup"].collect()} == {c for _, c in classes}
    assert kept["secrets"].count() == kept["near_dedup"].count()
    assert all(not r.base for r in secrets.scan(kept["secrets"]).collect())
    assert {r.doc_id for r in kept["mixing"].collect()} <= {r.doc_id for r in kept["secrets"].collect()}
    last = corpus_pipeline.STAGES[4][1](spark, docs, "").collect()
    assert len(last) == docs.count() and all(len(r.ids) == 4 * r.n_tokens for r in last)
    assert hashlib.sha256(b"").hexdigest() not in {hashlib.sha256(r.ids).hexdigest() for r in last}
    for df in kept.values():
        df.unpersist()


# every name that a stage works with or gives out, as a user's own column
CLASHES = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered", "longest_repeat", "base_failed", "kept", "node", "root", "class_id",
    "bands", "best", "row", "found", "spans", "mark", "part", "copies", "times", "copy", "taken", "target", "leaf", "block", "n_tokens", "ids", "decoded",
]


def test_stages_on_messy_rows(spark, messy, empty, split):
    wide = messy.withColumns({c: F.concat(F.lit(f"my {c} "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))) for c in CLASHES})
    rows = as_rows(wide, *wide.columns)
    text, size = wide.columns.index("text"), wide.columns.index("n_chars")
    for name, stage in corpus_pipeline.STAGES[:4]:
        after = stage(spark, wide, "")
        assert after.schema.simpleString() == wide.schema.simpleString(), name
        got = as_rows(after, *wide.columns)
        if name == "quality":
            good = Counter(r.text for r in repeats.quality(messy.select("text")).where("kept").collect())
            assert got == Counter({r: n for r, n in rows.items() if r[text] in good}) and got
        elif name == "near_dedup":
            assert set(got) <= set(rows) and set(got.values()) == {1}
            assert {r[0] for r in got} == {c for _, c in brute_classes(wide, 0.8, split)}
        elif name == "secrets":
            want = Counter()
            for r, n in rows.items():
                masked = r[text] and r[text].replace("token: abcdefgh12", "[SECRET]")
                want[(*r[:text], masked, *r[text + 1 : size], r[size] if masked is None else len(masked), *r[size + 1 :])] += n
            assert got == want
        else:
            assert set(got) <= set(rows)
            assert all(n <= 2 * rows[r] for r, n in got.items())
        assert stage(spark, wide.limit(0), "").count() == 0, name
    last = corpus_pipeline.STAGES[4][1](spark, wide, "")
    assert last.columns == ["doc_id", "source", "n_tokens", "ids"] and last.count() == messy.count()
    assert all(r.n_tokens == 0 for r in last.join(messy.where("coalesce(text, '') = ''"), "doc_id", "left_semi").collect())
    assert corpus_pipeline.STAGES[4][1](spark, empty, "").count() == 0


def test_stages_take_small_batches(spark):
    """Long texts come in batches of a few MB, not 10,000 rows at once."""
    long = spark.range(0, 3000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.col("id").cast("string"), 3000).alias("text"), *(F.lit("en").alias(c) for c in ("lang", "source")), F.lit(1).cast("bigint").alias("n_chars"))
    schema = pa.schema([("size", pa.int64())])
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    try:
        for name, stage in corpus_pipeline.STAGES:
            if name == "secrets":  # works in the JVM alone
                continue
            spark.conf.unset(key)
            stage(spark, long, "")
            sizes = [r.size for r in long.mapInArrow(lambda batches: (kernels.rows(schema, [b.nbytes]) for b in batches), "size bigint").collect()]
            assert len(sizes) > 1 and max(sizes) < 6 << 20, name
    finally:
        spark.conf.set(key, before)
