"""Token ids of all documents in Arrow files of equal-length sequences.

Every task writes the documents of one key range, in order, as one stream of
ids cut into sequences of ``length``. A file in the Arrow IPC file format has
record batches of two fixed-size-list columns, ``tokens`` and ``mask`` (true
for ids, false for the filling of the last sequence), so any sequence of any
batch is found by arithmetic and mapped without copying. A second small file
beside it has the key, first position and number of ids of every document.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from lendsight.session import materialise, scratch_path

LENGTH = 2048
#: Sequences in a record batch.
BATCH = 256
#: Words in each of the two generations that a worker remembers.
MAX_WORDS = 450_000


class TokenizerMemo:
    """A tokenizer file applied to whole texts, encoding each distinct word once.

    A byte-level tokenizer's pieces never reach across a space between two
    characters that are not white space, so a text without white space beside
    white space or added token is the concatenation of its words, each with the
    space before it. Any other text is encoded as it is. New words are encoded many at a
    time as one text, which is cut again at the tokens that begin with a space.
    """

    WIDE = regex.compile(r"\s\s")
    AT_ONCE = 20_000

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # A token that is cut out of a text before its words are looked at; a text that holds one is encoded as it is.
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        space = self.tokenizer.encode(" ", add_special_tokens=False).tokens[0]
        self.opens = np.array([(self.tokenizer.id_to_token(i) or "").startswith(space) for i in range(size)])
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _is_whole(self, text: str) -> bool:
        return any(token in text for token in self.added) or self.WIDE.search(text) is not None

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=self.dtype) for e in encoded]

    def _word_ids(self, words: list[str]) -> list[bytes]:
        ids = self._ids([" " + " ".join(words)])[0]
        begins = np.flatnonzero(self.opens[ids])
        if len(begins) != len(words):
            return [x.tobytes() for x in self._ids([" " + w for w in words])]
        raw, size = ids.tobytes(), self.dtype.itemsize
        cuts = [*(begins * size).tolist(), len(raw)]
        return [raw[i:j] for i, j in zip(cuts, cuts[1:])]

    def _learn(self, words: set[str]) -> None:
        if len(self.known) > MAX_WORDS:
            self.older, self.known = self.known, {}
        new = words.difference(self.known)
        again = new.intersection(self.older)
        self.known.update((w, self.older[w]) for w in again)
        if "" in new and "" not in again:
            self.known[""] = self._ids([" "])[0].tobytes()
        new = list(new - again - {""})
        for at in range(0, len(new), self.AT_ONCE):
            some = new[at: at + self.AT_ONCE]
            self.known.update(zip(some, self._word_ids(some), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        words = [None if self._is_whole(t) else t.split(" ") for t in texts]
        self._learn({w for own in words if own for w in own[1:]})
        whole = self._ids([t if own is None else own[0] for t, own in zip(texts, words, strict=True)])
        return [
            first.tobytes() + b"".join([self.known[w] for w in own[1:]]) if own else first.tobytes()
            for first, own in zip(whole, words, strict=True)
        ]


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> TokenizerMemo:
    return TokenizerMemo(path)


def _schema(dtype: np.dtype, length: int) -> pa.Schema:
    return pa.schema([("tokens", pa.list_(pa.from_numpy_dtype(dtype), length)), ("mask", pa.list_(pa.bool_(), length))])


class SequenceWriter:
    """Packs ids into sequences and writes a batch whenever one is full."""

    def __init__(self, sink, dtype: np.dtype, length: int):
        self.dtype, self.length = dtype, length
        self.schema = _schema(dtype, length)
        self.writer = pa.ipc.new_file(sink, self.schema)
        self.held: list[bytes] = []
        self.size = self.written = 0

    def add(self, ids: bytes) -> None:
        self.held.append(ids)
        self.size += len(ids) // self.dtype.itemsize
        if self.size >= BATCH * self.length:
            self._flush(self.size // (BATCH * self.length) * BATCH * self.length)

    def _flush(self, count: int) -> None:
        tokens = np.frombuffer(b"".join(self.held), dtype=self.dtype)
        self.held, self.size = [tokens[count:].tobytes()], self.size - count
        for at in range(0, count, BATCH * self.length):
            self._write(tokens[at: min(at + BATCH * self.length, count)])

    def _write(self, tokens: np.ndarray) -> None:
        filling = -len(tokens) % self.length
        mask = np.ones(len(tokens) + filling, dtype=bool)
        mask[len(tokens):] = False
        tokens = np.concatenate([tokens, np.zeros(filling, dtype=self.dtype)])
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (tokens, mask)]
        self.writer.write_batch(pa.record_batch(columns, schema=self.schema))

    def close(self) -> None:
        if self.size:
            self._flush(self.size)
        self.writer.close()


def write_token_files(
    docs: DataFrame, key: str, text: str, tokenizer: str, end_id: int, folder: str | None = None, length: int = LENGTH
) -> DataFrame:
    """Writes the files; returns one row per file: file, slice (its place in the order of keys), n_docs, n_tokens.

    A NULL text is empty and has the end id alone; NULL keys come first;
    documents that share a key follow each other. A file name is never used
    twice, and only files of tasks that succeeded are returned, so a lost
    executor or a second attempt leaves at most a file that nobody reads.
    Texts meet no other task than their range's; a task holds one batch.
    """
    folder = folder or scratch_path(docs.sparkSession, "tokens")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _tokenizer(tokenizer)
        end = np.array([end_id], dtype=memo.dtype).tobytes()
        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        keys, counts = [], []
        with system.open_output_stream(f"{root}/{name}.arrow") as sink:
            writer = SequenceWriter(sink, memo.dtype, length)
            for batch in batches:
                for at in range(0, batch.num_rows, 500):
                    part = batch.slice(at, 500)
                    encoded = memo.encode([t or "" for t in part.column(1).to_pylist()])
                    for ids in encoded:
                        writer.add(ids + end)
                    keys.append(part.column(0))
                    counts.append(np.array([len(ids) // memo.dtype.itemsize + 1 for ids in encoded], dtype=np.int64))
            writer.close()
        if not keys:
            system.delete_file(f"{root}/{name}.arrow")
            return
        lengths = np.concatenate(counts)
        index = pa.table({
            "key": pa.concat_arrays(keys), "first": pa.array(np.cumsum(lengths) - lengths), "n_tokens": pa.array(lengths),
        })
        with system.open_output_stream(f"{root}/{name}.index.arrow") as sink, pa.ipc.new_file(sink, index.schema) as out:
            out.write_table(index)
        yield pa.record_batch({
            "file": pa.array([f"{folder}/{name}"]), "slice": pa.array([TaskContext.get().partitionId()], pa.int32()),
            "n_docs": pa.array([len(lengths)], pa.int64()), "n_tokens": pa.array([int(lengths.sum())], pa.int64()),
        })

    ordered = docs.select(key, text).repartitionByRange(key).sortWithinPartitions(key)
    return materialise(ordered.mapInArrow(write, "file string, slice int, n_docs long, n_tokens long"), "token-files")


def open_file(path: str) -> pa.ipc.RecordBatchFileReader:
    """A file of either kind; on a local or mounted disk it is mapped, not read."""
    system, name = fs.FileSystem.from_uri(path)
    return pa.ipc.open_file(pa.memory_map(name) if isinstance(system, fs.LocalFileSystem) else system.open_input_file(name))


def document_ids(file: str) -> Iterator[tuple[object, int, np.ndarray]]:
    """(key, first position, ids) of every document of a file, in order; holds a batch and a document."""
    index, tokens = open_file(f"{file}.index.arrow").read_all(), open_file(f"{file}.arrow")
    batch = -1
    ids = np.empty(0)
    start = 0
    for key, first, count in zip(*(index[c].to_pylist() for c in ("key", "first", "n_tokens")), strict=True):
        parts, at, end = [], first, first + count
        while at < end:
            while batch < 0 or at >= start + len(ids):
                start += len(ids)
                batch += 1
                ids = _flat(tokens.get_batch(batch))
            parts.append(ids[at - start: end - start])
            at += len(parts[-1])
        yield key, first, parts[0] if len(parts) == 1 else np.concatenate(parts)


def _flat(batch: pa.RecordBatch) -> np.ndarray:
    """The ids of a batch, without the filling."""
    ids = batch.column("tokens").flatten().to_numpy()
    mask = batch.column("mask").flatten()
    return ids if mask.true_count == len(mask) else ids[mask.to_numpy(zero_copy_only=False)]


def read_token_files(files: DataFrame, key_type: str = "long") -> DataFrame:
    """Per document of the files: key, start (ids of all documents before it), n_tokens, ids_crc32.

    The sum is the unsigned crc32 of the ids as little-endian 32-bit integers.
    One row per file meets in one task for the running total of ids.
    """
    before = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("file", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("start"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, start in zip(*(batch.column(i).to_pylist() for i in (0, 1)), strict=True):
                rows = [(k, start + first, len(ids), zlib.crc32(ids.astype("<u4").tobytes())) for k, first, ids in document_ids(file)]
                names = ["key", "start", "n_tokens", "ids_crc32"]
                yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema=schema)

    kind = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}[key_type]
    schema = pa.schema([("key", kind), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
    spread = starts.repartition(max(1, files.count()))
    return spread.mapInArrow(read, f"key {key_type}, start long, n_tokens long, ids_crc32 long")
