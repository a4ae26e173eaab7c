"""Language-model scores: corpus counts for the base, a causal self-attention model on subword ids."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.llm import kernels
from storelens.llm.common import shuffles_dropped, stored, text_or_empty
from storelens.llm.token_counts import _model

_COUNTS_ARROW = pa.schema([("kind", pa.int32()), ("h", pa.int64()), ("n", pa.int64())])
_CELLS_ARROW = pa.schema([("cell", pa.int64()), ("n", pa.int64())])
_FITTED = "part bigint, block bigint, pieces bigint, weights binary"
_FITTED_ARROW = pa.schema([("part", pa.int64()), ("block", pa.int64()), ("pieces", pa.int64()), ("weights", pa.binary())])
_BUCKETS, _DIMS = 512, 32
_ROWS = "ref bigint, o bigint, learns boolean, doc_id bigint, n_tokens bigint, known bigint, base double, rest array<struct<h: bigint, times: bigint>>, ids binary"


class Subwords:
    """Subword ids of the words of many texts; each distinct word is encoded once while it is remembered."""

    def __init__(self, raw: bytes, most: int = 1_000_000):
        self.model, self.most = _model(raw), most
        self.end = len(self.model)
        self.forget()

    def forget(self) -> None:
        # hashes in order, and where in ``pool`` the ids of each are
        self.seen = np.zeros(0, np.uint64)
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool, self.filled = np.zeros(1 << 16, np.int32), 0

    def of(self, words: kernels.Words, unique: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``pool`` and numbers of the ids of distinct words, given by their hashes in order and a place of each."""
        at = np.searchsorted(self.seen, unique)
        new = at == len(self.seen)
        new[~new] = self.seen[at[~new]] != unique[~new]
        if len(self.seen) and len(self.seen) + new.sum() > self.most:
            self.forget()
            return self.of(words, unique, first)
        if new.any():
            data, a, b = words.texts.data, words.starts[first[new]].tolist(), words.ends[first[new]].tolist()
            ids = self.model.encode([data[x:y].tobytes() for x, y in zip(a, b, strict=True)], num_threads=1)
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            stop = self.filled + int(sizes.sum())
            if stop > len(self.pool):
                self.pool = np.concatenate([self.pool[: self.filled], np.zeros(max(stop, len(self.pool)), np.int32)])
            self.pool[self.filled : stop] = np.fromiter(chain.from_iterable(ids), np.int32, stop - self.filled)
            self.seen = np.insert(self.seen, at[new], unique[new])
            self.starts = np.insert(self.starts, at[new], self.filled + np.cumsum(sizes) - sizes)
            self.sizes = np.insert(self.sizes, at[new], sizes)
            self.filled = stop
            at += np.cumsum(new) - new
        return self.starts[at], self.sizes[at]

    def sequences(self, words: kernels.Words, unique: np.ndarray, first: np.ndarray, back: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of every text, each closed by the end id, and where each text begins; ``back`` tells which distinct word each is."""
        starts, sizes = self.of(words, unique, first)
        n = sizes[back]
        per_text = np.diff(np.concatenate([[0], np.cumsum(n)])[words.first])
        bounds = np.concatenate([[0], np.cumsum(per_text + 1)])
        out = np.full(bounds[-1], self.end, np.int32)
        inside = np.ones(len(out), bool)
        inside[bounds[1:] - 1] = False
        if len(back):
            out[inside] = self.pool[kernels.ragged(starts[back], n)]
        return out, bounds


_LOG2E = float(np.log2(np.e))
#: 2**f for f from -0.5 to 0.5, highest power first; off by 3 in a million at most
_POWERS = (0.00957009748, 0.0559178666, 0.24024745, 0.693121814, 0.999999261)
#: exponents within this neither overflow nor underflow in 32 bits, times shares of classes that are not below exp(-50)
_CALM = 30


def _exp2(x: np.ndarray) -> np.ndarray:
    """2**x in the place of ``x``. Of 32-bit numbers, which have to be within 100 of 0, by a polynomial, in a third of the time."""
    if x.dtype != np.float32:
        return np.exp2(x, out=x)
    whole = np.rint(x)
    x -= whole
    out = x * _POWERS[0]
    for c in _POWERS[1:-1]:
        out += c
        out *= x
    out += _POWERS[-1]
    bits = whole.astype(np.int32)
    bits <<= 23
    np.add(out.view(np.int32), bits, out=out.view(np.int32))
    return out


def _powers(logs: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """exp of scores where ``seen`` (the last and all before) is 1; else 0. Each row may be times a number."""
    given = logs
    logs = np.clip(given, -80, np.where(seen, np.inf, 0).astype(given.dtype))
    if logs.max(initial=0) > 2 * _CALM or np.diagonal(logs, seen.shape[1] - seen.shape[0], 1, 2).min(initial=0) < -2 * _CALM:
        logs = np.where(seen, given, -np.inf)
        return np.exp(logs - logs.max(2, keepdims=True))
    logs *= _LOG2E
    logs = _exp2(logs)
    logs *= seen
    return logs


@dataclass(frozen=True)
class Attention:
    """P(id | before) = P(class of the id | before) P(id | its class, class of the id before).

    The class is predicted from the id before (``direct``) and by one causal attention head over the window. Within
    a class ids have their share of the corpus, moved towards their share after the class before.
    """

    class_of: np.ndarray
    log_share: np.ndarray
    embed: np.ndarray
    direct: np.ndarray
    weights: dict[str, np.ndarray]
    window: int

    @property
    def begin(self) -> int:
        return len(self.embed) - 1

    @cached_property
    def shares(self) -> np.ndarray:
        """``direct`` as shares."""
        return np.exp(self.direct)

    @cached_property
    def lower(self) -> tuple[np.ndarray, np.ndarray]:
        """``near`` where a place may look, and where that is."""
        near = self.weights["near"]
        seen = np.tri(self.window, dtype=near.dtype)
        return near * seen, seen

    @cached_property
    def lowest(self) -> float:
        return float(self.direct.min())

    def calm(self, out: np.ndarray) -> bool:
        """Whether shares of classes by the weights ``out`` need no logarithms; the hidden state is within 1."""
        return self.lowest > -50 and np.abs(out).sum(0).max() < _CALM

    @cached_property
    def turned(self) -> np.ndarray:
        """The query, key, value, a 1 and the skipped part of each id."""
        w = self.weights
        return np.append(self.embed, np.ones((len(self.embed), 1), self.embed.dtype), 1) @ _side_by_side(w)

    def hidden(self, x: np.ndarray, w: dict[str, np.ndarray]) -> tuple:
        """Masked attention over a batch of windows, and what its gradient needs."""
        e = self.embed[x] if w is self.weights else w["embed"][x]
        q, k, v = e @ w["q"], e @ w["k"], e @ w["v"]
        a = q @ k.transpose(0, 2, 1)
        a += w["near"][: x.shape[1], : x.shape[1]]
        a -= a.max(2, keepdims=True)
        np.exp(a, out=a)
        a /= a.sum(2, keepdims=True)
        m = a @ v
        return e, q, k, v, a, m, np.tanh(m + e @ w["skip"] + w["shift"])

    def class_logs(self, x: np.ndarray) -> np.ndarray:
        """log P(class) after each place of a batch of windows."""
        z = self.hidden(x, self.weights)[-1] @ self.weights["out"]
        z += self.direct[x]
        z -= z.max(2, keepdims=True)
        z -= np.log(np.exp(z).sum(2, keepdims=True))
        return z

    def text_logs(self, ids: np.ndarray, bounds: np.ndarray, block: int = 256) -> np.ndarray:
        """Natural log probability of every text. Windows overlap by a quarter and each id is scored once."""
        size, shared = self.window, self.window // 4
        step, length = size - shared, np.diff(bounds)
        before = _before(ids, bounds, self.begin) if len(ids) else ids
        n = 1 + np.maximum(0, -(-(length - size) // step))
        who = np.repeat(np.arange(len(length)), n)
        at = kernels.ragged(np.zeros(len(n), np.int64), n) * step
        start, width = bounds[who] + at, np.minimum(length[who] - at, size)
        logs = np.zeros(len(ids), np.float32)
        # what the window before has scored is only context
        for rows, context in ((np.flatnonzero(at == 0), 0), (np.flatnonzero(at > 0), shared)):
            rows = rows[np.argsort(width[rows], kind="stable")]
            for row in range(0, len(rows), block):
                some = rows[row : row + block]
                most = width[some[-1]]
                place = start[some][:, None] + np.minimum(np.arange(most), width[some][:, None] - 1)
                h, target = self._state(before[place], context), place[:, context:].ravel()
                if width[some[0]] < most:
                    inside = (np.arange(context, most) < width[some][:, None]).ravel()
                    h, target = h[inside], target[inside]
                logs[target] = self._chosen(h, before[target], self.class_of[ids[target]])
        logs += self.log_share[self.class_of[before], ids]
        return np.add.reduceat(logs.astype(np.float64), bounds[:-1]) if len(length) else np.zeros(0)

    def _state(self, x: np.ndarray, context: int) -> np.ndarray:
        """The hidden state after each place of windows of ids but the first ``context``, as ``hidden`` has it."""
        width, size = self.embed.shape[1], x.shape[1]
        t = self.turned.take(x, 0)
        a = t[:, context:, :width] @ t[:, :, width : 2 * width].transpose(0, 2, 1)
        a += self.lower[0][context:size, :size]
        a = _powers(a, self.lower[1][context:size, :size])
        m = a @ t[:, :, 2 * width : 3 * width + 1]
        h = m[:, :, :width] / m[:, :, width:]
        h += t[:, context:, 3 * width + 1 :]
        return np.tanh(h, out=h).reshape(-1, width)

    def _chosen(self, h: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """log P(class y) after the ids x."""
        if self.calm(self.weights["out"]):
            p = _exp2(h @ (self.weights["out"] * _LOG2E))
            p *= self.shares.take(x, 0)
            return np.log(p.reshape(-1)[np.arange(0, p.size, p.shape[1]) + y] / (p @ np.ones(p.shape[1], p.dtype)))
        z = h @ self.weights["out"]
        z += self.direct[x]
        z -= z.max(1, keepdims=True)
        said = z[np.arange(len(z)), y]
        return said - np.log(np.exp(z, out=z).sum(1))


def _side_by_side(w: dict[str, np.ndarray]) -> np.ndarray:
    """What turns an id's vector, followed by a 1, into its query, key, value, that 1 and the skipped part with the shift."""
    width = len(w["shift"])
    out = np.zeros((width + 1, 4 * width + 1), w["q"].dtype)
    for k, name in enumerate(("q", "k", "v")):
        out[:width, k * width : (k + 1) * width] = w[name]
    out[width, 3 * width] = 1
    out[:width, 3 * width + 1 :], out[width, 3 * width + 1 :] = w["skip"], w["shift"]
    return out


def _buckets(id_counts: np.ndarray) -> np.ndarray:
    """The bucket of each id as a neighbour: frequent ids have their own, the others share the last."""
    rank = np.empty(len(id_counts), np.int64)
    rank[np.argsort(-id_counts, kind="stable")] = np.arange(len(id_counts))
    return np.minimum(rank, _BUCKETS - 1)


def _before(flat: np.ndarray, bounds: np.ndarray, begin: int) -> np.ndarray:
    out = np.empty_like(flat)
    out[1:] = flat[:-1]
    out[bounds[:-1]] = begin
    return out


def _neighbours(flat: np.ndarray, bounds: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """A cell for each id with the bucket before it and with the bucket after it; the beginning counts as an end."""
    before = _before(flat, bounds, len(bucket) - 1)
    return np.concatenate([flat * 2 * _BUCKETS + bucket[before], before * 2 * _BUCKETS + _BUCKETS + bucket[flat]])


def _points(cells: np.ndarray, n: np.ndarray, id_counts: np.ndarray, bucket: np.ndarray, space: np.ndarray) -> np.ndarray:
    """What cells of neighbour counts add to the places of their ids: positive pointwise information, projected."""
    who, column = cells // (2 * _BUCKETS), cells % (2 * _BUCKETS)
    # each id has as many neighbours on either side as it has occurrences
    beside = np.bincount(bucket, id_counts, _BUCKETS)[column % _BUCKETS]
    value = np.maximum(np.log((n + 1e-6) / (id_counts[who] * beside / id_counts.sum() + 1e-6)), 0)
    return np.stack([np.bincount(who, value * d[column], len(id_counts)) for d in space.T], 1)


def _classes(points: np.ndarray, id_counts: np.ndarray, count: int, rng: np.random.Generator) -> np.ndarray:
    """Ids that stand beside alike ids share a class: k-means over weighted neighbour counts.

    Ids seen less than five times go with the nearest rank of frequency; the last id, the end, is alone.
    """
    n = len(id_counts)
    seen = np.flatnonzero(id_counts[: n - 1] >= 5)
    out = np.arange(n, dtype=np.int64) % max(1, count - 1)
    out[n - 1] = count - 1
    if len(seen) <= count:
        return out.astype(np.int32)
    points = points[seen].astype(np.float32)
    points /= np.linalg.norm(points, axis=1, keepdims=True) + 1e-9
    weight = np.sqrt(id_counts[seen]).astype(np.float32)
    centres = points[rng.choice(len(points), count - 1, replace=False, p=weight / weight.sum())]
    for _ in range(25):
        near = (points @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points * weight[:, None])
        centres = sums / (np.linalg.norm(sums, axis=1, keepdims=True) + 1e-9)
    out[seen] = near
    return out.astype(np.int32)


def _follows(flat: np.ndarray, bounds: np.ndarray, class_of: np.ndarray, classes: int) -> np.ndarray:
    """A cell for each id's class after the id before, and one for each id after the class before."""
    n = len(class_of) - 1
    before = _before(flat, bounds, n)
    return np.concatenate([before * classes + class_of[flat], (n + 1) * classes + class_of[before].astype(np.int64) * n + flat])


def _counted(follows: np.ndarray, id_counts: np.ndarray, class_of: np.ndarray, width: int, window: int, pull: float, rng: np.random.Generator) -> Attention:
    """The model with all that is counted; the weights as they are before fitting."""
    n, classes = len(id_counts), len(follows) // (2 * len(id_counts) + 1)
    after, pairs = follows[: (n + 1) * classes].reshape(n + 1, classes), follows[(n + 1) * classes :].reshape(classes, n)
    share = id_counts + 0.1
    share /= np.bincount(class_of[:n], share, classes)[class_of[:n]]
    within = np.stack([np.bincount(class_of[:n], row, classes) for row in pairs])
    log_share = np.log((pairs + pull * share) / (within[:, class_of[:n]] + pull)).astype(np.float32)
    prior = (after.sum(0) + 1.0) / (after.sum() + classes)
    direct = np.log((after + 5 * prior) / (after.sum(1, keepdims=True) + 5)).astype(np.float32)
    w = {
        "embed": rng.normal(0, 0.3, (n + 1, width)),
        **{k: rng.normal(0, 0.3, (width, width)) for k in ("q", "k", "v", "skip")},
        "near": np.triu(np.full((window, window), -1e9), 1),
        "shift": np.zeros(width),
        "out": np.zeros((width, classes)),
    }
    w = {k: v.astype(np.float32) for k, v in w.items()}
    return Attention(class_of, log_share, w["embed"], direct, w, window)


#: windows of a step
BATCH = 256
#: ids that a learner has of all, as long as that makes no more learners than LEARNERS; and how often their weights are averaged
LEARNER_IDS, LEARNERS, ROUNDS = 1 << 22, 4096, 4
#: weights that are averaged together
BLOCK = 1 << 12


class Fit:
    """Adam on the cross-entropy of the classes over batches of windows, from the weights of ``model``."""

    def __init__(self, model: Attention, seed: int):
        ids, width = model.weights["embed"].shape
        # an id's vector is followed by a 1, the other weights are one array
        self.vectors = np.append(model.weights["embed"], np.ones((ids, 1), model.weights["embed"].dtype), 1)
        self.other = np.concatenate([v.ravel() for k, v in model.weights.items() if k != "embed"])
        self.first_other, self.second_other = np.zeros_like(self.other), np.zeros_like(self.other)
        self.w, self.first, self.second = {}, {}, {}
        at = 0
        for k, v in model.weights.items():
            if k == "embed":
                self.w[k], self.first[k], self.second[k] = self.vectors[:, :width], np.zeros_like(v), np.zeros_like(v)
                continue
            for kept, flat in ((self.w, self.other), (self.first, self.first_other), (self.second, self.second_other)):
                kept[k] = flat[at : at + v.size].reshape(v.shape)
            at += v.size
        self.inside, self.begin = model, model.begin
        self.rng, self.step, self.pieces = np.random.default_rng(seed), 0, 0
        self.row, self.here = np.zeros(ids, np.int64), np.zeros(ids, bool)

    def windows(self, flat: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids before, classes wanted, and which places are in the text, of windows that have every id once."""
        size, length = self.inside.window, np.diff(bounds)
        n = -(-length // size)
        before, last = _before(flat, bounds, self.begin), np.repeat(bounds[1:] - 1, n)
        x, y = (np.repeat(v[last], size) for v in (before, self.inside.class_of[flat]))
        real = np.zeros(len(x), bool)
        place = np.arange(len(flat)) + np.repeat((np.cumsum(n) - n) * size - bounds[:-1], length)
        x[place], y[place], real[place] = before, self.inside.class_of[flat], True
        return x.reshape(-1, size), y.reshape(-1, size), real.reshape(-1, size)

    def once(self, x: np.ndarray, y: np.ndarray, ok: np.ndarray, batch: int) -> None:
        """Every window once, in random order."""
        order = self.rng.permutation(len(x))
        for k in range(0, len(x), batch):
            rows = order[k : k + batch]
            self.learn(x[rows], y[rows], ok[rows])
        self.pieces += len(x)

    def learn(self, x: np.ndarray, y: np.ndarray, ok: np.ndarray) -> None:
        w, (count, size), width = self.w, x.shape, self.vectors.shape[1] - 1
        x, y, turn, seen = x.ravel(), y.ravel(), _side_by_side(w), self.inside.lower[1][:size, :size]
        e = self.vectors.take(x, 0)
        t = (e @ turn).reshape(count, size, -1)
        q, k, v = t[:, :, :width], t[:, :, width : 2 * width], t[:, :, 2 * width : 3 * width + 1]
        a = q @ k.transpose(0, 2, 1)
        a += w["near"][:size, :size] * seen
        a = _powers(a, seen)
        m = a @ v
        # the value is followed by a 1, so the sum of a row is beside its mean
        under = 1 / m[:, :, width:]
        a *= under
        m = m[:, :, :width] * under
        h = m + t[:, :, 3 * width + 1 :]
        h = np.tanh(h, out=h).reshape(-1, width)
        p = self._shares(h, x)
        back, total = p @ w["out"].T, p @ np.ones(p.shape[1], p.dtype)
        part = (ok.ravel() / ok.sum()).astype(p.dtype)
        p.reshape(-1)[np.arange(0, p.size, p.shape[1]) + y] -= total
        scale = (part / total)[:, None]
        g = {"out": (h * scale).T @ p}
        d = np.zeros((count, size, 4 * width + 1), p.dtype)
        dm = back * scale
        dm -= np.ascontiguousarray(w["out"].T).take(y, 0) * part[:, None]
        dm *= 1 - h * h
        dm = dm.reshape(m.shape)
        # what the mean takes off each weight goes with that 1
        ds = np.concatenate([dm, -np.einsum("bik,bik->bi", dm, m)[:, :, None]], 2) @ v.transpose(0, 2, 1)
        ds *= a
        g["near"] = np.zeros_like(w["near"])
        g["near"][:size, :size] = ds.sum(0) * seen
        d[:, :, 3 * width + 1 :] = dm
        np.matmul(ds, k, out=d[:, :, :width])
        np.matmul(ds.transpose(0, 2, 1), q, out=d[:, :, width : 2 * width])
        np.matmul(a.transpose(0, 2, 1), dm, out=d[:, :, 2 * width : 3 * width])
        d = d.reshape(len(x), -1)
        turned = e.T @ d
        g["q"], g["k"], g["v"], _, g["skip"] = np.split(turned[:width], [width, 2 * width, 3 * width, 3 * width + 1], 1)
        g["shift"] = turned[width, 3 * width + 1 :]
        # of the ids' vectors only those in the batch move
        self.here[x] = True
        some = np.flatnonzero(self.here)
        self.here[some], self.row[some] = False, np.arange(len(some)) * width
        cells = self.row.take(x)[:, None] + np.arange(width)
        embed = np.bincount(cells.ravel(), (d @ turn[:width].T).ravel(), len(some) * width).reshape(-1, width).astype(d.dtype)
        self.step += 1
        rate = 0.01 * min(1, self.step / 50) / (1 - 0.9**self.step) * float(np.sqrt(1 - 0.99**self.step))
        self._move(self.other, self.first_other, self.second_other, rate, np.concatenate([g[k].ravel() for k in w if k != "embed"]))
        held = [self.vectors.take(some, 0), self.first["embed"].take(some, 0), self.second["embed"].take(some, 0)]
        self._move(held[0][:, :width], *held[1:], rate, embed)
        self.vectors[some], self.first["embed"][some], self.second["embed"][some] = held

    def _move(self, w: np.ndarray, first: np.ndarray, second: np.ndarray, rate: float, d: np.ndarray) -> None:
        first += 0.1 * (d - first)
        second += 0.01 * (d * d - second)
        w -= rate * first / (np.sqrt(second) + 1e-7)

    def _shares(self, h: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Shares of the classes after the ids x, each row times a number."""
        out = self.w["out"]
        if self.inside.calm(out):
            p = _exp2(h @ (out * _LOG2E))
            p *= self.inside.shares.take(x, 0)
            return p
        p = h @ out
        p += self.inside.direct[x]
        p -= p.max(1, keepdims=True)
        return np.exp(p, out=p)

    def all(self, sequences: Iterator[tuple[np.ndarray, np.ndarray]], steps: int = 0, batch: int = BATCH) -> None:
        """Every window of the sequences once; again only while that makes fewer than ``steps`` steps."""
        held = []
        for flat, bounds in sequences:
            held.append(self.windows(flat, bounds))
            self.once(*held[-1], batch)
            if steps == 0:
                held.clear()
        while held and self.step < steps:
            self.once(*(np.concatenate(c) for c in zip(*held, strict=True)), batch)


def train(
    texts: list[np.ndarray], id_counts: np.ndarray, classes: int = 64, width: int = 8, window: int = 16, steps: int = 300, pull: float = 20.0, seed: int = 7
) -> Attention:
    """Fit on id sequences that are at hand, as ``learn`` does on those of a frame; ``id_counts`` has the end id last."""
    rng = np.random.default_rng(seed)
    n, flat = len(id_counts), np.concatenate([*texts, np.zeros(0, np.int32)]).astype(np.int64)
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
    bucket, space = _buckets(id_counts), rng.normal(0, 1, (2 * _BUCKETS, _DIMS))
    cells, times = np.unique(_neighbours(flat, bounds, bucket), return_counts=True)
    class_of = _classes(_points(cells, times, id_counts, bucket, space), id_counts, classes, rng)
    class_of = np.append(class_of, class_of[-1])
    follows = np.bincount(_follows(flat, bounds, class_of, classes), minlength=(2 * n + 1) * classes)
    model = _counted(follows, id_counts, class_of, width, window, pull, rng)
    fit = Fit(model, seed)
    fit.all(iter([(flat, bounds)] if len(flat) else []), steps)
    return Attention(class_of, model.log_share, fit.w["embed"], model.direct, fit.w, window)


def encoded(docs: DataFrame, learnable: Column, model: bytes) -> DataFrame:
    """``o, ids``: the ids of every learnable text, closed by the end id, as bytes; ``o`` is a hash of the row."""
    rows = _rows(docs, F.coalesce(learnable, F.lit(False)), model, np.zeros(0, np.uint64), np.zeros(0), 0.0, 0)
    return rows.where("learns").select("o", "ids")


def _rows(docs: DataFrame, learnable: Column, raw: bytes, table: np.ndarray, logs: np.ndarray, end_log: float, end_known: int) -> DataFrame:
    """The ids of every text, and its base score and known tokens as far as words are in ``table`` (hashes in order); the others are in ``rest``."""
    shared = docs.sparkSession.sparkContext.broadcast((raw, table, logs))
    of_rest = pa.struct([("h", pa.int64()), ("times", pa.int64())])
    schema = pa.schema(
        [
            ("ref", pa.int64()), ("o", pa.int64()), ("learns", pa.bool_()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("known", pa.int64()),
            ("base", pa.float64()), ("rest", pa.list_(of_rest)), ("ids", pa.binary()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, table, logs = shared.value
        subwords = Subwords(raw)
        kind = _kind(subwords.end + 1)
        # a number for each row, kept with the rows once they are written
        ref = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part, texts in kernels.slices(batch):
                words_ = kernels.Words(texts.lowered())
                unique, first, back = np.unique(words_.hashes(), return_index=True, return_inverse=True)
                owner = words_.owner()
                if len(table):
                    at = np.minimum(np.searchsorted(table, unique), len(table) - 1)
                    in_table = table[at] == unique
                    known = in_table[back]
                    base = np.bincount(owner[known], logs[at][back[known]], len(texts))
                else:
                    known, base = np.zeros(len(back), bool), np.zeros(len(texts))
                # the other words of each text, once each
                cell, times = np.unique(owner[~known] * max(1, len(unique)) + back[~known], return_counts=True)
                rest = pa.StructArray.from_arrays([pa.array(unique[cell % max(1, len(unique))].view(np.int64)), pa.array(times)], fields=list(of_rest))
                ends = np.searchsorted(cell, np.arange(len(texts) + 1) * max(1, len(unique)))
                flat, bounds = subwords.sequences(words_, unique, first, back)
                flat = flat.astype(kind)
                yield kernels.rows(
                    schema,
                    ref + np.arange(len(texts)),
                    kernels.column(part, "o"),
                    kernels.column(part, "learns"),
                    kernels.column(part, "doc_id"),
                    words_.count + 1,
                    np.bincount(owner[known], minlength=len(texts)) + end_known,
                    base + end_log,
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rest),
                    [flat[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)],
                )
                ref += len(texts)

    named = docs.select(_row_hash().alias("o"), learnable.alias("learns"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return named.mapInArrow(run, _ROWS)


def _row_hash() -> Column:
    return F.xxhash64("doc_id", text_or_empty())


def _kind(n: int) -> type:
    return np.uint16 if n <= 1 << 16 else np.int32


def _sequences(batches: Iterator[pa.RecordBatch], n: int, most: int | None = None, block: int = 1 << 19) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Whole sequences of about ``block`` ids together, and where each begins; ``most`` ids of each, if that is given."""
    held, size = [], 0

    def joined() -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate(held).astype(np.int64), np.concatenate([[0], np.cumsum([len(x) for x in held], dtype=np.int64)])

    for batch in batches:
        for one in kernels.column(batch, "ids"):
            held.append(np.frombuffer(one.as_buffer(), _kind(n))[:most])
            size += len(held[-1])
            if size >= block:
                yield joined()
                held, size = [], 0
    if held:
        yield joined()


def _tallied(ids: DataFrame, n: int, size: int, cells, *given) -> DataFrame:
    """``cell, n`` over all sequences, counted in each task first; ``cells`` gives a cell below ``size`` for each thing to count."""
    shared = ids.sparkSession.sparkContext.broadcast(given)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, seen = np.zeros(size, np.uint32), 0

        def rows() -> Iterator[pa.RecordBatch]:
            some = np.flatnonzero(table)
            for k in range(0, len(some), 1 << 20):
                yield kernels.rows(_CELLS_ARROW, some[k : k + (1 << 20)], table[some[k : k + (1 << 20)]].astype(np.int64))

        for flat, bounds in _sequences(batches, n):
            np.add.at(table, cells(flat, bounds, *shared.value), np.uint32(1))
            seen += len(flat)
            if seen > 1 << 30:
                yield from rows()
                table[:], seen = 0, 0
        yield from rows()

    return ids.select("ids").mapInArrow(run, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))


def _placed(cells: DataFrame, id_counts: np.ndarray, bucket: np.ndarray, space: np.ndarray) -> np.ndarray:
    """The place of each id by all its neighbour counts."""
    names = [f"p{k}" for k in range(_DIMS)]
    shared = cells.sparkSession.sparkContext.broadcast((id_counts, bucket, space))
    schema = pa.schema([("id", pa.int64()), *((c, pa.float64()) for c in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((len(id_counts), _DIMS))
        for batch in batches:
            out += _points(*(kernels.column(batch, c).to_numpy() for c in ("cell", "n")), *shared.value)
        some = np.flatnonzero(out.any(1))
        yield kernels.rows(schema, some, *out[some].T.copy())

    parts = cells.mapInArrow(run, ", ".join(["id bigint", *(f"{c} double" for c in names)]))
    got = parts.groupBy("id").agg(*(F.sum(c).alias(c) for c in names)).toArrow()
    out = np.zeros((len(id_counts), _DIMS))
    out[got.column("id").to_numpy()] = np.stack([got.column(c).to_numpy() for c in names], 1)
    return out


def _mean(block: pa.Table) -> pa.Table:
    """The mean of what learners have in one block of their weights, by their pieces; in the order of the learners."""
    block, total, mean = block.sort_by("part"), 0, 0.0
    for n, raw in zip(block.column("pieces").to_pylist(), block.column("weights"), strict=True):
        one = np.frombuffer(raw.as_buffer(), np.float32).astype(np.float64)
        total += n
        mean = mean + (one - mean) * (n / total)
    return pa.table([[0], [block.column("block")[0].as_py()], [total], [mean.astype(np.float32).tobytes()]], schema=_FITTED_ARROW)


def _fitted(ids: DataFrame, model: Attention, all_ids: int, most: int | None, rounds: int, steps: int, seed: int) -> dict[str, np.ndarray]:
    """Weights fitted in ``rounds`` rounds, each over a share of the texts, that begin at the mean of the round before.

    Texts are dealt by their hash to rounds and learners, whose number follows from the ids there are and not from how files or
    tasks are cut; a learner takes its windows in the order of the hash. So neither has a part in the result, and every window is
    learnt from once.
    """
    spark = ids.sparkSession
    learners = max(1, min(LEARNERS, -(-all_ids // LEARNER_IDS)))
    weights = model.weights
    cuts = np.cumsum([v.size for v in weights.values()])[:-1]

    for r in range(rounds):
        shared = spark.sparkContext.broadcast(Attention(model.class_of, model.log_share, weights["embed"], model.direct, weights, model.window))

        def run(batches: Iterator[pa.RecordBatch], shared=shared, r=r) -> Iterator[pa.RecordBatch]:
            part = TaskContext.get().partitionId()
            fit = Fit(shared.value, seed + r * LEARNERS + part)
            fit.all(_sequences(batches, fit.begin, most), steps)
            if fit.pieces:
                flat = np.concatenate([v.ravel() for v in fit.w.values()])
                blocks = [flat[k : k + BLOCK].tobytes() for k in range(0, len(flat), BLOCK)]
                yield kernels.rows(_FITTED_ARROW, [part] * len(blocks), np.arange(len(blocks)), [fit.pieces] * len(blocks), blocks)

        share = ids.where(F.pmod(F.shiftright("o", 20), F.lit(rounds)) == r).select("o", "ids")
        parts = share.repartition(learners, "o").sortWithinPartitions("o", "ids").select("ids").mapInArrow(run, _FITTED)
        # whatever number of learners and tasks there are, the driver gets each block once
        merged = parts.groupBy("block").applyInArrow(_mean, _FITTED).toArrow().sort_by("block")
        shared.destroy()
        if len(merged):
            mean = np.frombuffer(b"".join(merged.column("weights").to_pylist()), np.float32)
            weights = {k: x.reshape(v.shape).astype(np.float32) for (k, v), x in zip(weights.items(), np.split(mean, cuts), strict=True)}
    return weights


def learn(
    ids: DataFrame, id_counts: np.ndarray, fit_texts: int | None, fit_ids: int | None, classes: int = 64, width: int = 8, window: int = 16, steps: int = 0, pull: float = 20.0, seed: int = 7, rounds: int = ROUNDS
) -> Attention:
    """Classes, counts and weights from all sequences of ``ids`` (``o, ids``); a learner makes ``steps`` steps a round at least, more with its windows."""
    rng = np.random.default_rng(seed)
    n = len(id_counts)
    bucket, space = _buckets(id_counts), rng.normal(0, 1, (2 * _BUCKETS, _DIMS))
    beside = _tallied(ids, n, n * 2 * _BUCKETS, _neighbours, bucket)
    class_of = _classes(_placed(beside, id_counts, bucket, space), id_counts, classes, rng)
    # the beginning counts as an end
    class_of = np.append(class_of, class_of[-1])
    got = _tallied(ids, n, (2 * n + 1) * classes, _follows, class_of, classes).toArrow()
    follows = np.zeros((2 * n + 1) * classes)
    follows[got.column("cell").to_numpy()] = got.column("n").to_numpy()
    model = _counted(follows, id_counts, class_of, width, window, pull, rng)
    if fit_texts is not None:
        ids = ids.orderBy("o", "ids").limit(fit_texts)
    w = _fitted(ids, model, int(id_counts.sum()), fit_ids, rounds, steps, seed)
    return Attention(class_of, model.log_share, w["embed"], model.direct, w, window)


def corpus_counts(docs: DataFrame, learnable: Column) -> DataFrame:
    """``kind, h, n`` over all learnable texts: how often each word (0) occurs, and the texts (2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts_seen = 0
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            h, back = np.unique(np.concatenate([x for x, _ in held]), return_inverse=True)
            return h, np.bincount(back, np.concatenate([n for _, n in held]), len(h)).astype(np.int64)

        for batch in batches:
            for _, texts in kernels.slices(batch):
                words = kernels.Words(texts.lowered())
                texts_seen += len(texts)
                if not len(words):
                    continue
                held.append(np.unique(words.hashes(), return_counts=True))
                if sum(len(h) for h, _ in held) > 1_500_000:
                    held = [merged()]
                    if len(held[0][0]) > 1_000_000:
                        yield _count_rows(0, *held[0])
                        held = []
        if held:
            yield _count_rows(0, *merged())
        yield _count_rows(2, np.zeros(1, np.uint64), np.array([texts_seen]))

    found = docs.where(learnable).select("text").mapInArrow(run, "kind int, h bigint, n bigint")
    return found.groupBy("kind", "h").agg(F.sum("n").alias("n")).where("n > 0")


def _count_rows(kind: int, h: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return kernels.rows(_COUNTS_ARROW, np.full(len(h), kind, np.int32), h.view(np.int64), n)


def _net_scores(rows: DataFrame, net: Attention, size: int, block: int = 1 << 20) -> DataFrame:
    """``rows`` with the log10 probability of every sequence in the place of ``ids``, which is their last column."""
    shared = rows.sparkSession.sparkContext.broadcast(net)
    kept = rows.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = _kind(size)
        for batch in batches:
            ids = kernels.column(batch, "ids")
            _, offsets, data = ids.buffers()
            ends = np.frombuffer(offsets, np.int32)[ids.offset : ids.offset + len(ids) + 1].astype(np.int64) // np.dtype(kind).itemsize
            flat, row = np.frombuffer(data, kind), 0
            while row < len(ids):
                last = max(row + 1, int(np.searchsorted(ends, ends[row] + block, "right")) - 1)
                logs = shared.value.text_logs(flat[ends[row] : ends[last]].astype(np.int64), ends[row : last + 1] - ends[row])
                columns = [kernels.column(batch, c).slice(row, last - row) for c in kept]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(logs / np.log(10))], names=[*kept, "score"])
                row = last

    return rows.mapInArrow(run, ", ".join([*(f"{c} {rows.schema[c].dataType.simpleString()}" for c in kept), "score double"]))


def score(
    docs: DataFrame, learnable: Column, model_file: str, fit_texts: int | None = None, fit_ids: int | None = None, frequent: int = 2_000_000, add: float = 0.1
) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` of every text.

    Tokens are the words, A-Z in lower case, and one end. The base score is the sum of log10((c + add) / (N + add (V + 1)))
    over them; c, N, V are counts over all learnable texts. Words in at least one of ``frequent`` of all learnable tokens, so that
    many at most, are looked up in a table that every task has; the others are joined by their 64-bit hash. ``score`` is
    the attention model's log10 probability of the text's subword ids and end. Its classes, what
    follows an id and the shares within classes are counts over all learnable texts, and its weights are fitted on all of their ids;
    only if ``fit_texts`` or ``fit_ids`` is given are the weights (not the counts) from that many texts or ids of each. A
    null or empty text is just the end; repeated rows stay; rows whose ``learnable`` is null are not learnt from; without learnable rows
    the counts are zero. Other columns are not read.
    """
    with shuffles_dropped(docs.sparkSession):
        return _score(docs, learnable, model_file, fit_texts, fit_ids, frequent, add)


def _score(docs: DataFrame, learnable: Column, model_file: str, fit_texts: int | None, fit_ids: int | None, frequent: int, add: float) -> DataFrame:
    spark = docs.sparkSession
    with open(model_file, "rb") as f:
        raw = f.read()
    learnable = F.coalesce(learnable, F.lit(False))
    counts = stored(corpus_counts(docs, learnable), "lm-counts")
    words = counts.where("kind = 0")
    n_words, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    n_texts = counts.where("kind = 2").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    total, kinds = n_words + n_texts, distinct + (n_texts > 0)
    below = float(np.log10(total + add * (kinds + 1)))
    often = words.where(F.col("n") >= total / frequent).select("h", "n").toArrow()
    h, n = (often.column(c).to_numpy().copy() for c in ("h", "n"))
    order = np.argsort(h.view(np.uint64))
    h, n = h.view(np.uint64)[order], n[order].astype(np.float64)
    size = len(_model(raw)) + 1
    end_log = float(np.log10(n_texts + add) - below)
    rows = stored(_rows(docs, learnable, raw, h, np.log10(n + add) - below, end_log, int(n_texts > 0)), "lm-rows")
    learnt = rows.where("learns").select("o", "ids")
    id_rows = _tallied(learnt, size, size, lambda flat, bounds: flat).toArrow()
    id_counts = np.zeros(size)
    id_counts[id_rows.column("cell").to_numpy()] = id_rows.column("n").to_numpy()
    fitted = learn(learnt, id_counts, fit_texts, fit_ids)
    scored = _net_scores(rows.select("ref", "doc_id", "n_tokens", "known", "base", "ids"), fitted, size)
    rest = rows.select("ref", F.explode("rest").alias("rest")).select("ref", "rest.h", "rest.times")
    # a word that no learnable text has is not in the table of counts
    met = rest.join(words.select("h", "n"), "h", "left").select(
        "ref",
        F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0).alias("known"),
        (F.col("times") * (F.log10(F.coalesce(F.col("n"), F.lit(0)) + F.lit(add)) - F.lit(below))).alias("base"),
    )
    per_row = met.groupBy("ref").agg(F.sum("known").alias("known_rest"), F.sum("base").alias("base_rest"))
    return scored.join(per_row, "ref", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("known") + F.coalesce("known_rest", F.lit(0))).alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("base_rest", F.lit(0.0))).alias("base_score"),
        "score",
    )
