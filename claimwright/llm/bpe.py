"""Byte-level BPE by a lazily built finite-state transducer, and a streaming decoder.

Encoding reads a piece byte by byte. Every prefix of a text has exactly one valid token
sequence: one whose adjacent tokens each come out again when their bytes are encoded
together. So each position has one last token, and the sequences of all prefixes form a
tree. A token is emitted once it lies on the paths to all positions from which a longer
token could still start; what is left to decide is a few bytes of lookahead. The last
emitted token and the undecided bytes are the state; states and transitions are made when
they are first needed. Where a bounded number of states is used up, the rest of a piece is
simulated without storing more.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from claimwright.llm.memo import Memo
from claimwright.llm.storage import give_back_memory

# The Unicode white space of the splitting pattern.
WHITE = "\t-\r \x85\xa0  -     　"

# Bounds of what a worker keeps; encoding does not depend on them.
MAX_STATES = 80_000
MAX_PAIRS = 400_000
MAX_CHUNKS = 450_000


def newer_letters() -> str:
    """Letters and numbers that the reference library does not know as such yet.

    The two libraries follow different editions of Unicode. Asked for the letters among all
    characters, the reference library returns their bytes.
    """
    every = "".join(chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000)
    one_byte = {bytes((k,)): k for k in range(256)}
    newer: set[str] = set()
    for kind in (r"\p{L}", r"\p{N}"):
        reference = tiktoken.Encoding(
            "letters", pat_str=kind, mergeable_ranks=one_byte, special_tokens={}
        )
        known = bytes(reference.encode_ordinary(every)).decode()
        newer |= set(regex.findall(kind, every)) - set(known)
    return "".join(sorted(newer))


@dataclass(frozen=True, slots=True)
class Vocabulary:
    """The content of a rank file, the pattern that splits a text, and ``newer_letters``."""

    ranks_file: bytes
    pattern: str
    newer: str

    @classmethod
    def read(cls, path: str, pattern: str) -> Vocabulary:
        return cls(Path(path).read_bytes(), pattern, newer_letters())

    def ranks(self) -> dict[bytes, int]:
        rows = (line.split() for line in self.ranks_file.splitlines() if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in rows}


@dataclass(slots=True, eq=False)
class State:
    """What is undecided after some bytes of a piece.

    ``last`` is the last emitted token and ``pending`` the bytes after it. ``ends`` has, for
    positions in ``pending``, the token that ends there; ``open`` has the positions from
    which a token could still reach beyond the end. ``rest`` is what the end of the piece
    emits.
    """

    last: bytes
    pending: bytes
    ends: dict[int, bytes]
    open: tuple[int, ...]
    rest: bytes
    steps: dict[int, tuple[bytes, State]] = field(default_factory=dict)


class Transducer:
    """Encodes pieces under one table of ranks; ids come as packed little-endian integers."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.dtype = np.dtype("<u2" if max(ranks.values()) < 1 << 16 else "<u4")
        self.packed = {
            token: rank.to_bytes(self.dtype.itemsize, "little") for token, rank in ranks.items()
        }
        self.beginnings = {token[:k] for token in ranks for k in range(1, len(token) + 1)}
        self._adjacent: dict[tuple[bytes, bytes], bool] = {}
        self.states: dict[tuple[bytes, bytes], State] = {}
        self.start = State(b"", b"", {}, (0,), b"")
        self._follows = Memo(self._stay, MAX_PAIRS)

    def encode(self, piece: bytes) -> bytes:
        """The packed ids of one piece."""
        whole = self.packed.get(piece)
        if whole is not None:
            return whole
        state, out = self.start, []
        for at, byte in enumerate(piece):
            step = state.steps.get(byte)
            if step is None:
                if len(self.states) >= MAX_STATES:
                    out.append(self._simulated(state, piece[at:]))
                    return b"".join(out)
                step = state.steps[byte] = self._advance(state, byte)
            if step[0]:
                out.append(step[0])
            state = step[1]
        out.append(state.rest)
        return b"".join(out)

    def merged(self, data: bytes) -> list[bytes]:
        """Tokens by repeated merging of the leftmost pair of least rank."""
        parts = [data[k : k + 1] for k in range(len(data))]
        while len(parts) > 1:
            pairs = [self.ranks.get(a + b) for a, b in zip(parts, parts[1:])]
            known = [rank for rank in pairs if rank is not None]
            if not known:
                break
            at = pairs.index(min(known))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _stay(self, pair: tuple[bytes, bytes]) -> bool:
        """Whether two tokens stay as they are side by side; the first is empty at the start."""
        return self.merged(pair[0] + pair[1]) == [token for token in pair if token]

    def _simulated(self, state: State, tail: bytes) -> bytes:
        """The rest of a piece from a state, without making further states."""
        data, at = state.pending + tail, len(state.pending)
        ends, open_at = dict(state.ends), list(state.open)
        ends[0] = state.last
        follows, ranks, beginnings = self._follows, self.ranks, self.beginnings
        for end in range(at + 1, len(data) + 1):
            still = []
            for k in open_at:
                token = data[k:end]
                if token in beginnings:
                    still.append(k)
                    if end not in ends and token in ranks and follows[ends[k], token]:
                        ends[end] = token
            still.append(end)
            open_at = still
        path = self._path(ends, len(data))
        return b"".join(self.packed[ends[k]] for k in reversed(path[:-1]))

    def _advance(self, state: State, byte: int) -> tuple[bytes, State]:
        """The output and the next state for one more byte."""
        data = state.pending + bytes((byte,))
        end = len(data)
        ends = dict(state.ends)
        still = [k for k in state.open if data[k:] in self.beginnings]
        for k in still:
            token = data[k:]
            if token in self.ranks and self._follows[ends.get(k, state.last), token]:
                ends[end] = token
                break
        else:
            raise ValueError(f"no token for the byte {byte}")
        # The last position that lies on the paths to all open positions is settled.
        paths = [self._path(ends, k) for k in (*still, end)]
        settled = max(set(paths[0]).intersection(*paths[1:]))
        chain = [k for k in paths[-1] if 0 < k <= settled]
        emitted = b"".join(self.packed[ends[k]] for k in reversed(chain))
        last = ends[settled] if settled else state.last
        key = (last, data[settled:])
        found = self.states.get(key)
        if found is None:
            alive = {k for path in paths for k in path if k > settled}
            rest = [ends[k] for k in paths[-1] if k > settled]
            found = self.states[key] = State(
                last,
                key[1],
                {k - settled: ends[k] for k in alive},
                tuple(k - settled for k in (*still, end)),
                b"".join(self.packed[token] for token in reversed(rest)),
            )
        return emitted, found

    @staticmethod
    def _path(ends: dict[int, bytes], at: int) -> list[int]:
        """Token boundaries from ``at`` back to the settled position 0."""
        path = [at]
        while at:
            at -= len(ends[at])
            path.append(at)
        return path


class Encoder:
    """Encodes whole texts. Words are split once and kept with their ids."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.transducer = Transducer(vocabulary.ranks())
        self.dtype = self.transducer.dtype
        self._piece = regex.compile(vocabulary.pattern)
        # In splitting, a private character stands for them: neither letter, number nor white.
        self._newer = frozenset(vocabulary.newer)
        self._stand_ins = dict.fromkeys(map(ord, vocabulary.newer), "\ue000")
        # A run of non-white characters with the space before it is split alike anywhere.
        self._chunks = re.compile(
            f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
        ).findall
        self.known = Memo(self._chunk, MAX_CHUNKS)

    def _chunk(self, chunk: str) -> bytes:
        if not self._newer.isdisjoint(chunk):
            spans = self._piece.finditer(chunk.translate(self._stand_ins))
            pieces = [chunk[m.start() : m.end()] for m in spans]
        else:
            pieces = self._piece.findall(chunk)
        return b"".join(self.transducer.encode(p.encode("utf-8", "replace")) for p in pieces)

    def encode(self, text: str | None) -> np.ndarray:
        packed = b"".join(map(self.known.__getitem__, self._chunks(text or "")))
        return np.frombuffer(packed, self.dtype)


class _Steps(dict):
    """Transitions of the UTF-8 machine from one state: token id to text and next state."""

    def __init__(self, decoder: Decoder, held: bytes) -> None:
        super().__init__()
        self.decoder, self.held = decoder, held

    def __missing__(self, token: int) -> tuple[str, _Steps]:
        text, held = [], self.held
        for byte in self.decoder.tokens[token]:
            out, held = _utf8_step(held, byte)
            text.append(out)
        found = self[token] = ("".join(text), self.decoder.after(held))
        return found


def _utf8_step(held: bytes, byte: int) -> tuple[str, bytes]:
    """One byte of the UTF-8 machine: text to emit, and the held start of a character."""
    if not held:
        if byte < 0x80:
            return chr(byte), b""
        if 0xC2 <= byte <= 0xF4:
            return "", bytes((byte,))
        return "�", b""
    lead = held[0]
    low, high = 0x80, 0xBF
    if len(held) == 1:
        low = {0xE0: 0xA0, 0xF0: 0x90}.get(lead, low)
        high = {0xED: 0x9F, 0xF4: 0x8F}.get(lead, high)
    if not low <= byte <= high:
        out, held = _utf8_step(b"", byte)
        return "�" + out, held
    held += bytes((byte,))
    if len(held) == (2 if lead < 0xE0 else 3 if lead < 0xF0 else 4):
        return held.decode(), b""
    return "", held


class Decoder:
    """Turns a stream of ids into text; a broken sequence becomes U+FFFD."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.tokens = {rank: token for token, rank in ranks.items()}
        self._states: dict[bytes, _Steps] = {}

    def after(self, held: bytes) -> _Steps:
        if held not in self._states:
            self._states[held] = _Steps(self, held)
        return self._states[held]

    def stream(self, ids: Iterable[int]) -> Iterator[str]:
        """Text as soon as its characters are complete."""
        steps = self.after(b"")
        for token in ids:
            text, steps = steps[token]
            yield text
        if steps.held:
            yield "�"

    def decode(self, ids: Iterable[int]) -> str:
        steps, out = self.after(b""), []
        for token in ids:
            text, steps = steps[token]
            out.append(text)
        return "".join(out) + ("�" if steps.held else "")


# One encoder and decoder a worker process and vocabulary.
_WORKER: dict[Vocabulary, tuple[Encoder, Decoder]] = {}


def codec(vocabulary: Vocabulary) -> tuple[Encoder, Decoder]:
    if vocabulary not in _WORKER:
        encoder = Encoder(vocabulary)
        _WORKER[vocabulary] = encoder, Decoder(encoder.transducer.ranks)
    return _WORKER[vocabulary]


def _mapped(df: DataFrame, keep: list[str], source: str, fields: list, run) -> DataFrame:
    """``keep`` and new fields, from a function of a worker's codec and one column."""
    kept = [df.schema[name] for name in keep]
    inputs = df.select(*(df[f"`{name}`"] for name in [*keep, source]))
    names = [f.name for f in [*kept, *fields]]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back_memory()
        for batch in batches:
            found = run(batch.column(batch.num_columns - 1))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *found], names=names)

    return inputs.mapInArrow(each, T.StructType([*kept, *fields]))


def encode_documents(
    docs: DataFrame, vocabulary: Vocabulary, keep: list[str], into: str = "ids"
) -> DataFrame:
    """The columns ``keep`` and the ids of every whole text; a null or empty text has none.

    The vocabulary travels to the executors by broadcast: it is a file of fixed size.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(texts: pa.Array) -> list[pa.Array]:
        encoder, _ = codec(shared.value)
        ids = [encoder.encode(text) for text in texts.to_pylist()]
        ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
        flat = np.concatenate([*ids, np.empty(0, encoder.dtype)]).astype(np.int32)
        return [pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))]

    return _mapped(docs, keep, "text", [T.StructField(into, T.ArrayType(T.IntegerType()))], run)


def each_row(lists: pa.ListArray) -> Iterator[np.ndarray]:
    """The values of every list."""
    values = lists.values.to_numpy(zero_copy_only=False)
    ends = lists.offsets.to_numpy()
    for a, b in zip(ends[:-1], ends[1:]):
        yield values[a:b]


def decode_documents(
    encoded: DataFrame, vocabulary: Vocabulary, keep: list[str], ids: str = "ids", into: str = "text"
) -> DataFrame:
    """The columns ``keep`` and the text that the ids stand for; null ids give an empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary)

    def run(lists: pa.ListArray) -> list[pa.Array]:
        _, decoder = codec(shared.value)
        return [pa.array([decoder.decode(row.tolist()) for row in each_row(lists)], pa.string())]

    return _mapped(encoded, keep, ids, [T.StructField(into, T.StringType())], run)
