"""Token ids in binary shard files with a perfect-hash index of their documents.

A shard holds documents of a range of ids in ascending order. Its file is the raw ids of
all of them, then arrays that say which document lies where, and a description of these
parts at the end. The index leads from a document key to its place in the payload without
a search.
"""

from __future__ import annotations

import json
import re
import unicodedata
import uuid
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.fs
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from claimwright.llm.memo import Memo
from claimwright.llm.perfect_hash import PerfectHash, fingerprints, mixed
from claimwright.llm.storage import shared_folder, written

MAGIC = b"CWIDS001"
MAX_WORDS = 1_000_000
# Texts whose words are held together, and asked of the library together where unknown.
TEXTS_AT_ONCE = 500

# White space of the tokenizer's patterns, a word's end, its special tokens.
WHITE = "\t-\r \x85\xa0  -     　"
WORD_END = "</w>"
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class WordEncoder:
    """Whole texts through a tokenizer that never merges across words.

    The tokenizer brings a text into composed form, drops white space and lowers case, so
    the ids of a text are those of its words in turn. Words are kept with their ids; those
    not yet known go through the library many at a time.
    """

    def __init__(self, definition: bytes) -> None:
        self.library = Tokenizer.from_buffer(definition)
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if max(vocabulary.values()) < 1 << 16 else "<u4")
        self._ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self._ends[[k for token, k in vocabulary.items() if token.endswith(WORD_END)]] = True
        added = [token.content for token in self.library.get_added_tokens_decoder().values()]
        self._special = re.compile("|".join(map(re.escape, added)) or r"(?!)")
        # Split by any white space; str.split() also takes four control characters for it.
        self._odd = re.compile("[\x1c-\x1f]")
        self._words = re.compile(f"[^{WHITE}]+").findall
        self._latin = re.compile("[\x00-\u024f]*").fullmatch
        self._split_latin = regex.compile(PIECES).findall
        self.known = Memo(self._alone, MAX_WORDS)

    def _packed(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype=self.dtype).tobytes()

    def _alone(self, word: str) -> bytes:
        return self._packed(self.library.encode(word, add_special_tokens=False).ids)

    def _learn(self, words: list[str]) -> None:
        """Ids of many new words. A word of letters is one piece; others join those of theirs."""
        joined = {word: self._split_latin(word) for word in words if not word.isalpha()}
        known, old = self.known, self.known.old
        fresh = dict.fromkeys([word for word in words if word not in joined])
        for pieces in joined.values():
            fresh.update(dict.fromkeys([p for p in pieces if p not in known and p not in old]))
        listed = list(fresh)
        found = dict(zip(listed, self._of_pieces(listed))) if listed else {}
        # Before the new ones are kept, which may let old ones go.
        made = {
            word: b"".join([found[p] if p in found else known[p] for p in pieces])
            for word, pieces in joined.items()
        }
        known.put_all(found | made)

    def _of_pieces(self, pieces: list[str]) -> list[bytes]:
        """One call for many pieces: the ids of each end in a token that ends a word."""
        ids = np.array(
            self.library.encode(" ".join(pieces), add_special_tokens=False).ids, dtype=self.dtype
        )
        ends = np.flatnonzero(self._ends[ids]) + 1
        if len(ends) != len(pieces):
            return [self._alone(piece) for piece in pieces]
        size = self.dtype.itemsize
        packed, cuts = ids.tobytes(), [0, *(ends * size).tolist()]
        return [packed[x:y] for x, y in zip(cuts, cuts[1:])]

    def _split(self, text: str) -> list[str]:
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        # The library lowers each character by itself; a final sigma has no form of its own.
        text = text.replace("Σ", "σ").lower()
        return self._words(text) if self._odd.search(text) else text.split()

    def encode_all(self, texts: list[str]) -> Iterator[bytes]:
        """The packed ids of every text; the words of few texts at a time are held."""
        for k in range(0, len(texts), TEXTS_AT_ONCE):
            yield from self._encode_some(texts[k : k + TEXTS_AT_ONCE])

    def _encode_some(self, texts: list[str]) -> Iterator[bytes]:
        """Each word that is known is looked up once."""
        known, rows = self.known, []
        unseen: dict[str, None] = {}
        for text in texts:
            if self._special.search(text):
                rows.append(None)
                continue
            words = self._split(text)
            packed = list(map(known.get, words))
            missing = [word for word, ids in zip(words, packed) if ids is None]
            unseen.update(dict.fromkeys(missing))
            rows.append((words, packed, bool(missing)))
        old = known.old
        # Other than Latin words go alone, so that they cannot unsettle the count of ends.
        latin = [word for word in unseen if word not in old and self._latin(word)]
        for k in range(0, len(latin), 4_000):
            self._learn(latin[k : k + 4_000])
        for text, row in zip(texts, rows):
            if row is None:
                yield self._alone(text)
                continue
            words, packed, lacking = row
            if lacking:
                packed = [known[w] if ids is None else ids for w, ids in zip(words, packed)]
            yield b"".join(packed)


_WORKER: dict[bytes, WordEncoder] = {}


def word_encoder(definition: bytes) -> WordEncoder:
    if definition not in _WORKER:
        _WORKER[definition] = WordEncoder(definition)
    return _WORKER[definition]


def _opened(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a folder or file that driver and executors share, and its path."""
    if uri.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(uri)


def row_keys(ids: np.ndarray, is_null: np.ndarray) -> np.ndarray:
    """A key for each row of a shard: of the document id, and of the copy if it repeats."""
    keys = mixed(ids, 7) ^ np.where(is_null, np.uint64(0x5BF03635), np.uint64(0))
    same = np.r_[False, (ids[1:] == ids[:-1]) & (is_null[1:] == is_null[:-1])]
    first = np.maximum.accumulate(np.where(same, 0, np.arange(len(ids))))
    copy = np.arange(len(ids)) - first
    return np.where(copy > 0, mixed(keys + copy.astype(np.uint64), 9), keys)


class ShardWriter:
    """Appends documents to a shard file and closes it with the index."""

    def __init__(self, uri: str, dtype: np.dtype) -> None:
        system, path = _opened(uri)
        system.create_dir(path.rpartition("/")[0], recursive=True)
        self.out, self.dtype = system.open_output_stream(path), dtype
        self.out.write(MAGIC)
        self.ids: list[int | None] = []
        self.lengths: list[int] = []

    def append(self, doc_id: int | None, packed: bytes) -> None:
        self.out.write(packed)
        self.ids.append(doc_id)
        self.lengths.append(len(packed) // self.dtype.itemsize)

    def close(self) -> tuple[int, int]:
        """Write the index; the documents and ids of the shard."""
        is_null = np.array([i is None for i in self.ids], dtype=bool)
        ids = np.array([i or 0 for i in self.ids], dtype=np.int64)
        lengths = np.array(self.lengths, dtype=np.int64)
        keys = row_keys(ids, is_null)
        hashed = PerfectHash.build(keys)
        slots = hashed.slots(keys)
        by_slot = np.empty(len(ids), dtype=np.int64)
        by_slot[slots] = np.arange(len(ids))
        starts = np.cumsum(lengths) - lengths
        parts = {
            "levels": hashed.sizes,
            "bits": hashed.words,
            "fingerprints": fingerprints(keys)[by_slot],
            "starts": starts[by_slot],
            "lengths": lengths[by_slot],
            "doc_ids": ids,
            "nulls": is_null.astype(np.uint8),
        }
        described, at = {}, len(MAGIC) + int(lengths.sum()) * self.dtype.itemsize
        for name, values in parts.items():
            data = np.ascontiguousarray(values).tobytes()
            described[name] = [values.dtype.str, at, len(data)]
            self.out.write(data)
            at += len(data)
        footer = json.dumps({"dtype": self.dtype.str, "parts": described}).encode()
        self.out.write(footer + len(footer).to_bytes(8, "little") + MAGIC)
        self.out.close()
        return len(ids), int(lengths.sum())


class Shard:
    """Keyed access to a shard file; only what is asked for is read."""

    def __init__(self, uri: str) -> None:
        system, path = _opened(uri)
        self.file = system.open_input_file(path)
        size = self.file.size()
        tail = self.file.read_at(16, size - 16)
        if tail[8:] != MAGIC:
            raise ValueError(f"{uri} is not a finished shard")
        length = int.from_bytes(tail[:8], "little")
        footer = json.loads(self.file.read_at(length, size - 16 - length))
        self.dtype = np.dtype(footer["dtype"])
        self._parts = footer["parts"]
        self.hashed = PerfectHash(self.part("bits"), self.part("levels"))
        self._prints, self._starts = self.part("fingerprints"), self.part("starts")
        self._lengths = self.part("lengths")

    def part(self, name: str) -> np.ndarray:
        kind, at, length = self._parts[name]
        return np.frombuffer(self.file.read_at(length, at), kind)

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and length of every key's document; length -1 where there is none."""
        if not len(self._prints):
            return np.zeros(len(keys), np.int64), np.full(len(keys), -1)
        slots = self.hashed.slots(keys)
        found = (slots >= 0) & (self._prints[slots] == fingerprints(keys))
        return self._starts[slots], np.where(found, self._lengths[slots], -1)

    def read(self, start: int, length: int) -> np.ndarray:
        """Ids from a place of the payload."""
        size = self.dtype.itemsize
        return np.frombuffer(self.file.read_at(length * size, len(MAGIC) + start * size), self.dtype)

    def document(self, doc_id: int) -> list[np.ndarray]:
        """The ids of every row of a document; several if it was written repeatedly."""
        found: list[np.ndarray] = []
        while True:
            copies = np.full(len(found) + 1, doc_id, dtype=np.int64)
            key = row_keys(copies, np.zeros(len(copies), dtype=bool))[-1:]
            start, length = self.places(key)
            if length[0] < 0:
                return found
            found.append(self.read(int(start[0]), int(length[0])))


def write_id_files(docs: DataFrame, tokenizer_path: str, end_id: int, folder: str) -> DataFrame:
    """Encode all documents in ascending ``doc_id`` order into shard files under ``folder``.

    Returns the manifest, one row a shard: ``shard, path, first_id, last_id, docs, ids,
    base``, where ``base`` counts the ids of all shards before. Null texts are empty and
    rows without an id come first; rows that share an id are ordered by a hash of their text. Every
    document ends in ``end_id``.

    A file gets a name of its own in every attempt of a task, and only the names that a
    finished attempt returned are in the manifest.
    """
    definition = Path(tokenizer_path).read_bytes()
    shared = docs.sparkSession.sparkContext.broadcast(definition)
    target = f"{folder.rstrip('/')}/ids-{uuid.uuid4().hex}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(shared.value)
        end = np.array([end_id], dtype=encoder.dtype).tobytes()
        shard = TaskContext.get().partitionId()
        path = f"{target}/shard-{shard:06d}-{uuid.uuid4().hex[:8]}.bin"
        writer = None
        for batch in batches:
            writer = writer or ShardWriter(path, encoder.dtype)
            texts = [text or "" for text in batch.column(1).to_pylist()]
            ids = batch.column(0).to_pylist()
            for doc_id, packed in zip(ids, encoder.encode_all(texts)):
                writer.append(doc_id, packed + end)
        if writer:
            bounds = [i for i in writer.ids if i is not None] or [None]
            n_docs, n_ids = writer.close()
            row = [shard, path, bounds[0], bounds[-1], n_docs, n_ids]
            names = ["shard", "path", "first_id", "last_id", "docs", "ids"]
            yield pa.RecordBatch.from_pydict(
                {
                    name: pa.array([value], pa.string() if name == "path" else pa.int64())
                    for name, value in zip(names, row)
                }
            )

    # A document id with very many rows is dealt by text and, where these agree, by the row.
    salt = F.xxhash64(F.monotonically_increasing_id())
    ordered = (
        docs.select("doc_id", "text", F.xxhash64("text").alias("text_id"), salt.alias("salt"))
        .repartitionByRange("doc_id", "text_id", "salt")
        .sortWithinPartitions("doc_id", "text_id", "salt")
        .select("doc_id", "text")
    )
    manifest = written(
        ordered.mapInArrow(
            write, "shard long, path string, first_id long, last_id long, docs long, ids long"
        ),
        "id-manifest",
    )
    # One short row a shard.
    rows = sorted(manifest.collect(), key=lambda r: r.shard)
    bases = np.cumsum([0] + [r.ids for r in rows])
    return docs.sparkSession.createDataFrame(
        [(*row, int(base)) for row, base in zip(rows, bases)],
        "shard long, path string, first_id long, last_id long, docs long, ids long, base long",
    )


def read_all(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, by its key from the files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                shard = Shard(path)
                ids, nulls = shard.part("doc_ids"), shard.part("nulls").astype(bool)
                starts, lengths = shard.places(row_keys(ids, nulls))
                sums = [
                    zlib.crc32(shard.read(int(a), int(n)).astype("<u4").tobytes())
                    for a, n in zip(starts, lengths)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64(), mask=nulls),
                        pa.array(starts + base),
                        pa.array(lengths),
                        pa.array(sums, pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    # With a number of their own, which adaptive execution does not merge into one task.
    shards = max(1, manifest.count())
    spread = manifest.select("path", "base").repartition(shards, "path")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_documents(manifest: DataFrame, keys: DataFrame) -> DataFrame:
    """``doc_id, ids`` of the documents asked for in ``keys.doc_id``; absent ones give no row.

    Keys are led to their shards by the ranges of the manifest, one short row a shard; each
    shard then reads only its index and the documents asked for.
    """
    shards = sorted(manifest.where("first_id is not null").collect(), key=lambda r: r.shard)
    first = np.array([r.first_id for r in shards], dtype=np.int64)
    last = np.array([r.last_id for r in shards], dtype=np.int64)
    paths = [r.path for r in shards]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            at = np.searchsorted(last, ids)
            inside = at < len(first)
            inside[inside] = first[at[inside]] <= ids[inside]
            yield pa.RecordBatch.from_pydict(
                {"doc_id": pa.array(ids[inside]), "path": [paths[k] for k in at[inside]]}
            )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: dict[str, Shard] = {}
        for batch in batches:
            found = []
            for doc_id, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if path not in opened:
                    opened = {path: Shard(path)}
                found += [(doc_id, ids.tolist()) for ids in opened[path].document(doc_id)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([d for d, _ in found], pa.int64()),
                    pa.array([i for _, i in found], pa.list_(pa.int32())),
                ],
                names=["doc_id", "ids"],
            )

    asked = keys.select("doc_id").where(F.col("doc_id").isNotNull()).distinct()
    routed = asked.mapInArrow(route, "doc_id long, path string")
    by_shard = routed.repartition(max(1, len(paths)), "path").sortWithinPartitions("path", "doc_id")
    return by_shard.mapInArrow(read, "doc_id long, ids array<int>")


def id_files(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """Write all documents to files in the shared folder and read each back by its key.

    ``doc_id, start, n_tokens, ids_crc32`` of every row; no rows give no rows. Other columns
    are ignored. Special tokens in a text are taken as the library takes them by default.
    """
    folder = shared_folder(docs.sparkSession)
    return read_all(write_id_files(docs, tokenizer_path, end_id, folder))
