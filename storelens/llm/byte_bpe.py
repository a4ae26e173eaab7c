"""Byte-level BPE as a transducer: encoding to ids and streaming decoding.

A cut of a byte string into tokens is its BPE encoding exactly if every two neighbours stay apart
when they are encoded alone. So a left-to-right machine can carry every cut that may still win.
Its state is the set of trie nodes of the vocabulary at which the open cuts stand, determinised
lazily: the arc of a byte, made when a text first needs it, says which cuts live on and which
tokens end there. Each open cut has a register with its tokens so far, as a linked list that the
cuts share. What all registers begin with is settled and leaves; that is at most one longest token
behind the byte just read.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from storelens.llm import kernels


def read_ranks(raw: bytes) -> dict[bytes, int]:
    """The lines ``base64-token rank`` of a rank file."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines()) if a}


class Transducer:
    """Encodes one pre-token at a time; ``settle_every`` bytes it lets go of settled tokens."""

    def __init__(self, ranks: dict[bytes, int], settle_every: int = 256):
        self.ranks, self.settle_every = ranks, settle_every
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.children: list[dict[int, int]] = [{}]
        self.token_at = [-1]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                node = self.children[node].setdefault(byte, len(self.children))
                if node == len(self.children):
                    self.children.append({})
                    self.token_at.append(-1)
            self.token_at[node] = rank
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.pairs: dict[int, bool] = {}
        self.number: dict[tuple[int, ...], int] = {(0,): 0}
        self.states: list[tuple[int, ...]] = [(0,)]
        self.arcs: list[dict[int, tuple]] = [{}]

    def merged(self, text: bytes, until: int = 1) -> list[int]:
        """BPE by its definition: the lowest rank merges first, leftmost among equals."""
        parts = [text[i : i + 1] for i in range(len(text))]
        while len(parts) > until:
            rank, at = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def halves_of(self, token: int) -> tuple[int, int] | None:
        """The two tokens of the last merge that makes this one; None for a byte or if none does."""
        if token not in self.halves:
            text = self.bytes_of[token]
            last = self.merged(text, 2)
            made = len(text) > 1 and len(last) == 2 and self.merged(text) == [token]
            self.halves[token] = (last[0], last[1]) if made else None
        return self.halves[token]

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether two neighbours stay as they are.

        Goes back in time: the later of the two is taken apart again, and the parts that then
        touch must not have a merge that comes before that one.
        """
        if (said := self.pairs.get(left << 20 | right)) is None:
            if len(self.pairs) > 1_000_000:
                self.pairs.clear()
            a, b, limit = left, right, 1 << 60
            while True:
                joint = self.ranks.get(self.bytes_of[a] + self.bytes_of[b], 1 << 60)
                if joint < limit:
                    said = False
                    break
                at_a, at_b = self.halves_of(a), self.halves_of(b)
                if at_a is None and at_b is None:
                    said = True
                    break
                # among equal ranks the left one merges first, so a right part undone lets its own rank through
                if at_b is None or at_a is not None and a > b:
                    a, limit = at_a[1], a
                else:
                    b, limit = at_b[0], b + 1
            self.pairs[left << 20 | right] = said
        return said

    def arc(self, number: int, byte: int) -> tuple[int, tuple[int, ...], tuple[tuple[int, int], ...]]:
        """The next state, the cuts that live on, and the tokens that end here with their cuts."""
        nodes, keep, done = [], [], []
        for at, node in enumerate(self.states[number]):
            if (child := self.children[node].get(byte)) is None:
                continue
            if self.children[child]:
                nodes.append(child)
                keep.append(at)
            token = self.token_at[child]
            if token >= 0 and (len(self.bytes_of[token]) == 1 or self.halves_of(token)):
                done.append((at, token))
        state = (*nodes, 0)
        if (after := self.number.get(state)) is None:
            after = self.number[state] = len(self.states)
            self.states.append(state)
            self.arcs.append({})
        made = self.arcs[number][byte] = (after, tuple(keep), tuple(done))
        return made

    def encode(self, piece: bytes) -> list[int]:
        """The ids of one pre-token; a pre-token that is itself in the vocabulary is its id."""
        if not piece:
            return []
        if (rank := self.ranks.get(piece)) is not None:
            return [rank]
        out: list[int] = []
        state, cuts = 0, [None]
        arcs, pairs = self.arcs, self.pairs
        for row in range(0, len(piece), self.settle_every):
            for byte in piece[row : row + self.settle_every]:
                state, keep, done = arcs[state].get(byte) or self.arc(state, byte)
                for at, token in done:
                    link = cuts[at]
                    if link is None:
                        grown = (None, token, 1)
                        break
                    if (said := pairs.get(link[1] << 20 | token)) is None:
                        said = self.stay_apart(link[1], token)
                    if said:
                        grown = (link, token, link[2] + 1)
                        break
                cuts = [cuts[i] for i in keep]
                cuts.append(grown)
            if row + self.settle_every < len(piece):
                cuts = self.settle(cuts, out)
        out += self.tokens(cuts[-1])
        return out

    @staticmethod
    def tokens(link: tuple | None) -> list[int]:
        out = []
        while link is not None:
            if link[2] > 0:
                out.append(link[1])
            link = link[0]
        return out[::-1]

    def settle(self, cuts: list[tuple], out: list[int]) -> list[tuple]:
        """Move what all registers begin with to ``out``; its last token stays as the left neighbour (place 0)."""
        shared = cuts[-1]
        chain = {id(shared): shared}
        while (shared := shared[0]) is not None:
            chain[id(shared)] = shared
        for link in cuts[:-1]:
            seen = {}
            while link is not None:
                seen[id(link)] = link
                link = link[0]
            chain = {k: v for k, v in chain.items() if k in seen}
        if not chain:
            return cuts
        last = max(chain.values(), key=lambda x: x[2])
        if last[2] == 0:
            return cuts
        out += self.tokens(last)
        made = {id(last): (None, last[1], 0)}

        def anew(link: tuple) -> tuple:
            todo = []
            while id(link) not in made:
                todo.append(link)
                link = link[0]
            for x in reversed(todo):
                made[id(x)] = (made[id(x[0])], x[1], made[id(x[0])][2] + 1)
            return made[id(todo[0])] if todo else made[id(link)]

        return [anew(x) for x in cuts]


class Utf8Machine:
    """Bytes to text across any cuts: carries the open bytes of an unfinished character.

    Ill-formed bytes become U+FFFD, one for each longest ill-formed beginning.
    """

    #: lead byte: (bytes that follow, least and greatest second byte)
    LEADS = (
        {b: (1, 0x80, 0xBF) for b in range(0xC2, 0xE0)}
        | {b: (2, 0x80, 0xBF) for b in range(0xE0, 0xF0)}
        | {b: (3, 0x80, 0xBF) for b in range(0xF0, 0xF5)}
        | {0xE0: (2, 0xA0, 0xBF), 0xED: (2, 0x80, 0x9F), 0xF0: (3, 0x90, 0xBF), 0xF4: (3, 0x80, 0x8F)}
    )

    def __init__(self):
        self.open = b""

    def feed(self, data: bytes) -> str:
        data = self.open + data
        out, i = [], 0
        self.open = b""
        while i < len(data):
            if data[i] < 0x80:
                out.append(chr(data[i]))
                i += 1
                continue
            follow, low, high = self.LEADS.get(data[i], (0, 0, 0))
            j = i + 1
            while j <= i + follow and j < len(data) and low <= data[j] <= high:
                j, low, high = j + 1, 0x80, 0xBF
            if follow and j == i + 1 + follow:
                out.append(data[i:j].decode())
            elif follow and j == len(data):
                self.open = data[i:]
                break
            else:
                out.append("�")
            i = j
        return "".join(out)

    def end(self) -> str:
        out, self.open = "�" if self.open else "", b""
        return out


class Decoder:
    """Token ids to text; each (open bytes, token) is worked out once."""

    def __init__(self, ranks: dict[bytes, int]):
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.steps: dict[bytes, dict[int, tuple[str, bytes]]] = {b"": {}}

    def step(self, open_: bytes, token: int) -> tuple[str, bytes]:
        machine = Utf8Machine()
        machine.open = open_
        made = machine.feed(self.bytes_of[token]), machine.open
        self.steps.setdefault(open_, {})[token] = made
        self.steps.setdefault(made[1], {})
        return made

    def text(self, ids: list[int]) -> str:
        out, open_ = [], b""
        table = self.steps[b""]
        for token in ids:
            said, after = table.get(token) or self.step(open_, token)
            out.append(said)
            if after is not open_:
                open_, table = after, self.steps[after]
        if open_:
            out.append("�")
        return "".join(out)


_made: dict[tuple, object] = {}


def _once(kind: type, raw: bytes):
    """One machine of a kind and rank file in each worker process."""
    if (key := (kind, hash(raw))) not in _made:
        _made[key] = kind(read_ranks(raw))
    return _made[key]


def encode(docs: DataFrame, ranks_file: str, pattern: str, max_cached: int = 300_000) -> DataFrame:
    """``docs`` with ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit integers, packed).

    ``docs`` needs ``text``; the other columns pass through, except that a column named
    ``n_tokens`` or ``ids`` is replaced. Each match of ``pattern`` is encoded on its own and
    special strings are ordinary text. A null or empty text has no ids; repeated rows stay. Each
    worker keeps the ids of at most ``max_cached`` pre-tokens. The rank file is read on the driver.
    """
    docs = docs.drop("n_tokens", "ids")
    with open(ranks_file, "rb") as f:
        raw = docs.sparkSession.sparkContext.broadcast(f.read())
    schema = _arrow(docs, ("n_tokens", pa.int64()), ("ids", pa.binary()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, find, cache = _once(Transducer, raw.value), regex.compile(pattern).findall, {}

        def packed(piece: str) -> bytes:
            if len(cache) >= max_cached:
                cache.clear()
            ids = machine.encode(piece.encode())
            out = cache[piece] = struct.pack(f"<{len(ids)}I", *ids)
            return out

        get = cache.get
        for batch in batches:
            for part, _ in kernels.slices(batch):
                out = [b"".join([get(p) or packed(p) for p in find(t)]) if t else b"" for t in kernels.column(part, "text").to_pylist()]
                yield kernels.rows(schema, *part.columns, [len(x) // 4 for x in out], out)

    return docs.mapInArrow(run, _ddl(docs, "n_tokens bigint", "ids binary"))


def decode(encoded: DataFrame, ranks_file: str) -> DataFrame:
    """``encoded`` with ``decoded``, the text of its packed ``ids``; null ids decode to an empty text."""
    encoded = encoded.drop("decoded")
    with open(ranks_file, "rb") as f:
        raw = encoded.sparkSession.sparkContext.broadcast(f.read())
    schema = _arrow(encoded, ("decoded", pa.string()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _once(Decoder, raw.value)
        for batch in batches:
            for row in range(0, batch.num_rows, 512):
                part = batch.slice(row, 512)
                out = [machine.text(np.frombuffer(x or b"", "<u4").tolist()) for x in kernels.column(part, "ids").to_pylist()]
                yield kernels.rows(schema, *part.columns, out)

    return encoded.mapInArrow(run, _ddl(encoded, "decoded string"))


def _arrow(docs: DataFrame, *more: tuple[str, pa.DataType]) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return pa.schema([*to_arrow_schema(docs.schema), *(pa.field(n, t) for n, t in more)])


def _ddl(docs: DataFrame, *more: str):
    from pyspark.sql.types import StructType

    return StructType([*docs.schema.fields, *StructType.fromDDL(", ".join(more)).fields])
