"""Attention and its gradient against plain loops, and what rounds of averaging give on held-out texts."""

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from storelens.llm import language_model as lm

PATH = public_tokenizers.path("piece_bpe_32k.model")


def small(seed=1, n=12, classes=4, width=3, window=5):
    rng = np.random.default_rng(seed)
    w = {
        "embed": rng.normal(0, 0.5, (n + 1, width)),
        **{k: rng.normal(0, 0.5, (width, width)) for k in ("q", "k", "v", "skip")},
        "near": np.triu(np.full((window, window), -1e9), 1) + np.tril(rng.normal(0, 0.5, (window, window))),
        "shift": rng.normal(0, 0.5, width),
        "out": rng.normal(0, 0.5, (width, classes)),
    }
    class_of = np.append(np.arange(n) % classes, (n - 1) % classes).astype(np.int32)
    direct = rng.normal(0, 0.5, (n + 1, classes))
    return lm.Attention(class_of, rng.normal(-2, 0.3, (classes, n)).astype(np.float32), w["embed"], direct, w, window)


def naive(model, before, w):
    """log P(class) after each place of one window, one number at a time."""
    e, out = [w["embed"][i] for i in before], []
    for i in range(len(before)):
        scores = np.array([(e[i] @ w["q"]) @ (e[j] @ w["k"]) + w["near"][i, j] for j in range(i + 1)])
        share = np.exp(scores - scores.max())
        share /= share.sum()
        mixed = sum(share[j] * (e[j] @ w["v"]) for j in range(i + 1))
        z = np.tanh(mixed + e[i] @ w["skip"] + w["shift"]) @ w["out"] + model.direct[before[i]]
        out.append(z - np.log(np.exp(z).sum()))
    return np.array(out)


def test_attention_by_loops():
    model = small()
    before = np.array([[12, 3, 7, 7, 1], [0, 5, 11, 2, 9]])
    got = model.class_logs(before)
    for row, want in zip(got, before, strict=True):
        assert row == pytest.approx(naive(model, want, model.weights), abs=1e-6)


def test_scores_use_each_window_as_context():
    model, rng = small(), np.random.default_rng(2)
    for length in (1, 2, 5, 6, 9, 23):
        ids = rng.integers(0, 12, length)
        before = np.append(12, ids[:-1])
        total, scored, at = 0.0, 0, 0
        while scored < length:
            logs = naive(model, before[at : at + 5], model.weights)
            for i in range(scored - at, len(logs)):
                target = ids[at + i]
                total += logs[i, model.class_of[target]] + model.log_share[model.class_of[before[at + i]], target]
                scored += 1
            at += 4
        assert model.text_logs(ids, np.array([0, length]))[0] == pytest.approx(total, rel=1e-4)


def test_gradient_by_small_steps(monkeypatch):
    model = small()
    fit = lm.Fit(model, 1)
    x, y = np.array([[12, 3, 7, 7, 1], [0, 5, 11, 2, 9]]), np.array([[1, 0, 3, 2, 2], [3, 1, 0, 0, 1]])
    ok = np.ones((2, 5), bool)
    ok[1, 3:] = False
    slopes = {}
    # the first step of the optimizer goes against the sign of the gradient, so the gradient is taken from its first moment
    before = {k: v.copy() for k, v in fit.w.items()}
    fit.learn(x, y, ok)
    slopes = {k: v / 0.1 for k, v in fit.first.items()}

    def loss(w):
        said = [naive(model, row, w) for row in x]
        return -sum(said[b][i, y[b, i]] for b in range(2) for i in range(5) if ok[b, i]) / ok.sum()

    for name, at in (("out", (1, 2)), ("q", (0, 1)), ("k", (2, 0)), ("v", (1, 1)), ("skip", (0, 2)), ("shift", (1,)), ("near", (3, 1)), ("embed", (7, 2)), ("embed", (9, 0)), ("embed", (4, 1))):
        up, down = ({k: v.copy() for k, v in before.items()} for _ in range(2))
        up[name][at] += 1e-5
        down[name][at] -= 1e-5
        assert slopes[name][at] == pytest.approx((loss(up) - loss(down)) / 2e-5, abs=2e-4), (name, at)


@pytest.fixture(scope="module")
def follows(spark):
    """The word after "turn" is told by the word two before it, which counts of neighbours don't know."""
    rng, rows = np.random.default_rng(5), []
    pairs = [("red", "apple"), ("blue", "water"), ("green", "grass"), ("white", "paper")]
    for i in range(2000):
        text = []
        for _ in range(30):
            a, b = pairs[rng.integers(4)]
            text += [a, "turn", b]
        rows.append((i, " ".join(text)))
    return spark.createDataFrame(rows, "doc_id long, text string")


def scores(docs, rounds, steps=80):
    """Little text, so at least ``steps`` steps a learner and round."""
    kept = lm.learn.__defaults__
    lm.learn.__defaults__ = (*kept[:3], steps, *kept[4:6], rounds)
    try:
        return {r.doc_id: r.score for r in lm.score(docs, F.col("doc_id") % 10 != 0, PATH).collect()}
    finally:
        lm.learn.__defaults__ = kept


def test_rounds_beat_the_counts_whatever_the_layout(follows, monkeypatch):
    monkeypatch.setattr(lm, "LEARNER_IDS", 1 << 17)
    held = lambda found: sum(v for k, v in found.items() if k % 10 == 0)
    counts, one = scores(follows.coalesce(1), 0), scores(follows.coalesce(1), 4)
    assert held(one) > 0.9 * held(counts)
    # sixteen tasks, with several learners: the same weights, so the same scores
    many = scores(follows.repartition(16), 4)
    assert [many[i] for i in sorted(many)] == pytest.approx([one[i] for i in sorted(one)], rel=1e-4)


def test_shuffle_files_go_with_each_round(spark, follows):
    """What rounds and counts have shuffled is gone when the scores are handed out."""
    tracker = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    before = tracker.shuffleStatuses().size()
    found = lm.score(follows, F.col("doc_id") % 10 != 0, PATH)
    assert tracker.shuffleStatuses().size() <= before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    assert found.count() == 2000
    assert found.where("score < 0").count() == 2000


def test_driver_gets_weights_once_whatever_the_learners(spark, follows, monkeypatch):
    """What comes to the driver after a round is one set of weights, not some of the learners'."""
    monkeypatch.setattr(lm, "LEARNER_IDS", 1 << 12)
    sent, collect = [], type(follows).toArrow

    def counted(df):
        found = collect(df)
        if "weights" in found.column_names:
            sent.append((found.nbytes, found.num_rows))
        return found

    monkeypatch.setattr(type(follows), "toArrow", counted)
    lm.score(follows, F.col("doc_id") % 10 != 0, PATH)
    whole = 4 * (32_002 * 8 + 4 * 64 + 16 * 16 + 8 + 8 * 64)
    assert len(sent) == lm.ROUNDS
    assert max(n for n, _ in sent) < 1.1 * whole


def single(seed=1, scale=1.0):
    """``small`` in 32 bits, as models are fitted."""
    model = small(seed)
    w = {k: (v * (scale if k in ("q", "out") else 1)).astype(np.float32) for k, v in model.weights.items()}
    return lm.Attention(model.class_of, model.log_share, w["embed"], model.direct.astype(np.float32), w, model.window)


@pytest.mark.parametrize("scale", [1, 5, 400])
def test_scores_in_32_bits_by_loops(scale):
    """Also where scores are too far from 0 for powers without their highest."""
    model, rng = single(2, scale), np.random.default_rng(3)
    w = {k: v.astype(np.float64) for k, v in model.weights.items()}
    for length in (1, 5, 6, 30):
        ids = rng.integers(0, 12, length)
        before = np.append(12, ids[:-1])
        total, scored, at = 0.0, 0, 0
        while scored < length:
            logs = naive(model, before[at : at + 5], w)
            for i in range(scored - at, len(logs)):
                total += logs[i, model.class_of[ids[at + i]]] + model.log_share[model.class_of[before[at + i]], ids[at + i]]
                scored += 1
            at += 4
        assert model.text_logs(ids, np.array([0, length]))[0] == pytest.approx(total, rel=3e-5)


@pytest.mark.parametrize("scale", [1, 400])
def test_a_step_in_32_bits_goes_as_in_64(scale):
    x, y = np.array([[12, 3, 7, 7, 1], [0, 5, 11, 2, 9]]), np.array([[1, 0, 3, 2, 2], [3, 1, 0, 0, 1]])
    ok = np.ones((2, 5), bool)
    ok[1, 3:] = False
    first = []
    for model in (single(1, scale), lm.Attention(*(lambda m: (m.class_of, m.log_share, m.embed.astype(float), m.direct.astype(float), {k: v.astype(float) for k, v in m.weights.items()}, m.window))(single(1, scale)))):
        fit = lm.Fit(model, 1)
        fit.learn(x, y, ok)
        first.append({k: v.copy() for k, v in fit.first.items()})
    for k, v in first[1].items():
        assert first[0][k] == pytest.approx(v, rel=1e-4, abs=2e-6 * max(1, scale / 10)), k


def test_classes_take_no_exponential_each(monkeypatch):
    """numpy's exp takes 2.6 ns a number without vector units of Intel's, which was most of the time of fitting and scoring."""
    model, taken, plain = single(), [], np.exp
    model.shares  # noqa: B018
    monkeypatch.setattr(np, "exp", lambda a, *rest, **named: taken.append(np.size(a)) or plain(a, *rest, **named))
    ids = np.arange(1000) % 12
    model.text_logs(ids, np.array([0, 1000]))
    fit = lm.Fit(model, 1)
    fit.all(iter([(ids, np.array([0, 1000]))]))
    assert sum(taken) == 0


def test_powers_of_two():
    x = np.random.default_rng(4).uniform(-90, 90, 10_000).astype(np.float32)
    assert lm._exp2(x.copy()) == pytest.approx(np.exp2(x.astype(float)), rel=4e-6)


def test_remembered_words_keep_their_ids():
    """Also when they are forgotten in between, and when a batch has more than is remembered."""
    from storelens.llm import kernels

    with open(PATH, "rb") as f:
        raw = f.read()
    rng, few, model = np.random.default_rng(6), lm.Subwords(raw, 20), lm._model(raw)
    for _ in range(6):
        texts = [" ".join(f"w{n}" for n in rng.integers(0, 30, rng.integers(0, 40))) for _ in range(5)]
        data = [t.encode() for t in texts]
        words = kernels.Words(kernels.Texts(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)])))
        flat, bounds = few.sequences(words, *np.unique(words.hashes(), return_index=True, return_inverse=True))
        for t, a, b in zip(texts, bounds[:-1], bounds[1:], strict=True):
            assert flat[a:b].tolist() == [*(i for w in t.split() for i in model.encode(w)), few.end]
