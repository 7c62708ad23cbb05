"""Token ids in Arrow IPC files of fixed-size-list batches, for random access without copies.

All documents' ids, in ascending doc_id order, form one stream. Each file holds a
contiguous run of it, cut into sequences of equal length: column `ids` is a
fixed-size list of unsigned integers (16 bits where the vocabulary allows it, else
32), column `mask` a fixed-size list of bits (set: an id, clear: padding after the
last one). Sequence k of a file starts k * length ids
after the file's own start, so it is found by arithmetic in a memory-mapped file.
Beside it lies an index file with a row for each document: doc_id, start, n_tokens.
"""

from __future__ import annotations

import json
import os
import unicodedata
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.ipc as ipc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import Workspace, arrow_limits, only, texts
from .ordering import prefix_sums, range_parts

VOCABULARY = "word_bpe_49k.json"

#: Id that ends each document.
END_ID = 1
#: Ids of a sequence, and sequences of a record batch.
SEQUENCE, BATCH_SEQUENCES = 2048, 32
#: Bytes of text that a file is to hold, about.
FILE_TEXT_BYTES = 256 << 20
#: Chunks whose ids a worker keeps; beyond it only those that come again are carried on. Longer chunks are not kept.
KEPT_CHUNKS, KEPT_CHARS = 400_000, 64

#: Words of letters that go to the library as one text.
TOGETHER = 64
#: Fixed value: marks a token that ends a word.
WORD_END = "</w>"

#: Marks that end many chunks; after letters they are words of their own to the tokenizer.
_MARKS = ".,!?:;"


#: The normaliser and the split for which a text's ids are those of its chunks.
_NORMALISER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_SPLIT = {"type": "Sequence", "pretokenizers": [{"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}


@cache
def splits_at_blanks(path: str) -> bool:
    """Whether the vocabulary's normaliser and split are the known ones, and no added token takes white space; else whole texts go to the library."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    plain = all(not (t["lstrip"] or t["rstrip"] or t["normalized"] or regex.search(r"\s", t["content"])) for t in spec["added_tokens"])
    return plain and spec["normalizer"] == _NORMALISER and spec["pre_tokenizer"] == _SPLIT and spec["post_processor"] is None and spec["truncation"] is None


def _letters(word: str) -> bool:
    """Whether the word is still all letters when normalised (NFC, lower case); a combining mark would join what follows."""
    return word.isalpha() and (word.isascii() or unicodedata.normalize("NFC", word).lower().isalpha())


@cache
def _library(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


class Encoder:
    """Ids of texts by the tokenizers library, called once for each distinct chunk.

    Where splits_at_blanks(), the normaliser and the split never look across ASCII
    white space, which itself gives no ids, so a text's ids are those of its chunks in
    turn. With any other vocabulary the library gets whole texts.
    """

    def __init__(self, path: str):
        self.path = path
        self.id_type = "<u2" if max(_library(path).get_vocab().values(), default=0) < 1 << 16 else "<u4"
        self.by_chunk = splits_at_blanks(path)
        self.ends = np.zeros(1 << 16 if self.id_type == "<u2" else max(_library(path).get_vocab().values()) + 1, bool)
        self.ends[[i for t, i in _library(path).get_vocab().items() if t.endswith(WORD_END)]] = True
        self.end = np.array([END_ID], self.id_type).tobytes()
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _library_ids(self, chunks: list[str]) -> list[bytes]:
        found = _library(self.path).encode_batch_fast(chunks, add_special_tokens=False)
        kind = "H" if self.id_type == "<u2" else "I"
        return [array(kind, e.ids).tobytes() for e in found]

    def _ids_of_letters(self, words: list[str]) -> list[bytes]:
        """The same for words of letters alone, some at a time: each is one piece to the library, so a token that ends a word ends its ids."""
        texts = [" ".join(words[at : at + TOGETHER]) for at in range(0, len(words), TOGETHER)]
        out: list[bytes] = []
        width = np.dtype(self.id_type).itemsize
        for at, packed in zip(range(0, len(words), TOGETHER), self._library_ids(texts)):
            own = words[at : at + TOGETHER]
            cuts = ((np.flatnonzero(self.ends[np.frombuffer(packed, self.id_type)]) + 1) * width).tolist()
            if len(cuts) == len(own):
                out += map(packed.__getitem__, map(slice, [0, *cuts], cuts))
            else:
                out += self._library_ids(own)
        return out

    def _learn(self, chunks: list[str]) -> list[bytes]:
        """The ids of distinct chunks, kept for the batches to come."""
        if len(self.known) > KEPT_CHUNKS:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        new = [p for p in chunks if p not in known]
        if older:
            known.update((p, older[p]) for p in new if p in older)
            new = [p for p in new if p not in known]
        parts: list[tuple[str, str, str]] = []  # chunks, their letters (in lower case where that is plain) and mark
        plain: set[str] = set()
        need: set[str] = set()
        for p in new:
            whole = p.isalpha()
            word, mark = (p, "") if whole else (p[:-1], p[-1:])
            if mark and mark not in _MARKS or not (whole and p.isascii() or _letters(word)):
                need.add(p)
                continue
            if word.isascii():
                word = word.lower()
            plain.add(word)
            if mark:
                need.add(mark)
                parts.append((p, word, mark))
            elif word != p:
                parts.append((p, word, mark))
        need, plain = list(need.difference(known)), list(plain.difference(known))
        known.update(zip(need, self._library_ids(need)))
        known.update(zip(plain, self._ids_of_letters(plain)))
        known.update((p, known[word] + known[mark] if mark else known[word]) for p, word, mark in parts)
        out = list(map(known.__getitem__, chunks))
        if max(map(len, new), default=0) > KEPT_CHARS:
            for p in (*new, *need, *plain):
                if len(p) > KEPT_CHARS:
                    known.pop(p, None)
        return out

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids one after the other, the end id after each text's; and how many each text has. Null is empty.

        Chunks are numbered in Arrow, so each distinct one is looked up once for a batch.
        """
        if not self.by_chunk:
            packed = [ids + self.end for ids in self._library_ids(texts(column))]
            sizes = np.array([len(p) for p in packed], np.int64) // np.dtype(self.id_type).itemsize
            return np.frombuffer(b"".join(packed), self.id_type), sizes
        split = pc.ascii_split_whitespace(column.fill_null(""))
        coded = split.flatten().dictionary_encode()
        values = self._learn(coded.dictionary.to_pylist())
        values.append(self.end)
        lens = np.array([len(v) for v in values], np.int64) // np.dtype(self.id_type).itemsize
        pool, starts = np.frombuffer(b"".join(values), self.id_type), np.cumsum(lens) - lens
        bounds = split.offsets.to_numpy().astype(np.int64) - split.offsets[0].as_py()
        # The end counts as one more chunk of each text.
        which = np.insert(coded.indices.to_numpy(zero_copy_only=False), bounds[1:], len(values) - 1)
        n = lens[which]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        kind = np.int32 if max(total, len(pool)) < 1 << 31 else np.int64
        at = np.repeat((starts[which] - (ends - n)).astype(kind), n)
        at += np.arange(total, dtype=kind)
        text_ends = ends[bounds[1:] + np.arange(len(bounds) - 1)] if len(bounds) > 1 else np.zeros(0, np.int64)
        return pool[at], np.diff(text_ends, prepend=0)

    def __call__(self, batch: list[str]) -> list[bytes]:
        """Each text's ids, packed little-endian in id_type, the end id last."""
        flat, sizes = self.encode(pa.array(batch, pa.string()))
        return [x.tobytes() for x in np.split(flat, np.cumsum(sizes)[:-1])] if batch else []


@cache
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def _layout(length: int, id_type: str) -> pa.Schema:
    kind = pa.uint16() if id_type == "<u2" else pa.uint32()
    return pa.schema([pa.field("ids", pa.list_(kind, length), False), pa.field("mask", pa.list_(pa.bool_(), length), False)])


_INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


class _Writer:
    """One file and its index, written under a name of this attempt and moved when whole."""

    def __init__(self, folder: str, part: int, length: int, id_type: str):
        self.fs, root = pafs.FileSystem.from_uri(folder)
        self.names = [f"{root}/part-{part:06d}.{kind}.arrow" for kind in ("tokens", "index")]
        self.tries = [f"{root}/.try-{uuid.uuid4().hex}-{kind}" for kind in ("tokens", "index")]
        self.length, self.id_type = length, id_type
        self.layout = _layout(length, id_type)
        self.outs = [self.fs.open_output_stream(t) for t in self.tries]
        self.data, self.index = ipc.new_file(self.outs[0], self.layout), ipc.new_file(self.outs[1], _INDEX)
        self.held, self.n_held, self.total = [], 0, 0

    def add(self, doc_ids: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> None:
        starts = self.total + np.cumsum(sizes) - sizes
        self.index.write_batch(pa.RecordBatch.from_arrays([doc_ids, pa.array(starts), pa.array(sizes)], schema=_INDEX))
        self.held.append(ids)
        self.n_held += len(ids)
        self.total += len(ids)
        if self.n_held >= self.length * BATCH_SEQUENCES:
            self._flush(last=False)

    def _flush(self, last: bool) -> None:
        flat = np.concatenate(self.held) if self.held else np.zeros(0, self.id_type)
        step = self.length * BATCH_SEQUENCES
        whole = len(flat) // step * step
        for at in range(0, whole, step):
            self._batch(flat[at : at + step], step)
        rest = flat[whole:]
        if last and len(rest):
            self._batch(rest, -(-len(rest) // self.length) * self.length)
            rest = rest[:0]
        self.held, self.n_held = [rest], len(rest)

    def _batch(self, ids: np.ndarray, room: int) -> None:
        padded, mask = np.zeros(room, self.id_type), np.zeros(room, bool)
        padded[: len(ids)], mask[: len(ids)] = ids, True
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (padded, mask)]
        self.data.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.layout))

    def close(self) -> int:
        self._flush(last=True)
        for x in (self.data, self.index, *self.outs):
            x.close()
        for a, b in zip(self.tries, self.names):
            self.fs.move(a, b)  # the same bytes whichever attempt wins
        return self.total


def write_files(docs: DataFrame, folder: str, length: int = SEQUENCE, path: str | None = None) -> DataFrame:
    """Encodes docs(doc_id, text), writes the files and returns a row for each: part, base, n_tokens.

    Files follow ascending doc_id, null ids first; rows with equal ids stand by their
    texts' checksums. Empty and null texts are their end id alone. folder: a URI that
    the driver and all executors reach; whoever names it removes it. Rows of files stay
    distributed, and so do the sums that give each file's base.
    """
    spark = docs.sparkSession
    fs, root = pafs.FileSystem.from_uri(folder)
    fs.create_dir(root, recursive=True)
    arrow_limits(spark)
    space = Workspace(spark, "token-files")
    path = path or public_tokenizers.path(VOCABULARY)
    weight = docs.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    parts = max(1, -(-weight // FILE_TEXT_BYTES), min(weight // (1 << 20), spark.sparkContext.defaultParallelism))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        coder, writer, part = _encoder(path), None, 0
        for batch in batches:
            if batch.num_rows:
                if writer is None:
                    part = batch.column(0)[0].as_py()
                    writer = _Writer(folder, part, length, coder.id_type)
                writer.add(batch.column(1), *coder.encode(batch.column(2)))
        if writer is not None:
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "n_tokens": pa.array([writer.close()], pa.int64())})

    docs = only(docs, "doc_id", "text").selectExpr("cast(doc_id as bigint) doc_id", "text", "xxhash64(text) same")
    order = [F.col("doc_id").asc_nulls_first(), F.col("same")]
    dealt = docs.repartitionByRange(parts, *order).sortWithinPartitions(*order)  # texts move: they pack better than ids
    written = dealt.select(F.spark_partition_id().cast("bigint").alias("part"), "doc_id", "text").mapInArrow(run, "part bigint, n_tokens bigint")
    files = space.save(written.withColumn("all", F.lit(0)), "files")  # a row for each file
    order = [F.col("all"), F.col("part")]
    based = prefix_sums(range_parts(files, order, space, "parted"), "all", order[1:], {"base": F.col("n_tokens")})
    return based.select("part", "base", "n_tokens").repartitionByRange(parts, "part")


class TokenFile:
    """Random access to one file's sequences; in a local or mounted folder they are not copied."""

    def __init__(self, folder: str, part: int):
        fs, root = pafs.FileSystem.from_uri(folder)
        names = [f"{root}/part-{part:06d}.{kind}.arrow" for kind in ("tokens", "index")]
        local = isinstance(fs, pafs.LocalFileSystem)
        self._open = [pa.memory_map(n) if local else fs.open_input_file(n) for n in names]
        self.data, self.index = (ipc.open_file(f) for f in self._open)
        self.length = self.data.schema.field("ids").type.list_size
        self._at, self._held = -1, None

    def _child(self, batch: int) -> np.ndarray:
        if self._at != batch:
            self._at, self._held = batch, self.data.get_batch(batch).column(0).flatten().to_numpy(zero_copy_only=True)
        return self._held

    def sequence(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of sequence k."""
        b, r = divmod(k, BATCH_SEQUENCES)
        ids, mask = (c.flatten()[r * self.length : (r + 1) * self.length] for c in self.data.get_batch(b).columns)
        return ids.to_numpy(zero_copy_only=True), mask.to_numpy(zero_copy_only=False)  # bits become bytes

    def span(self, start: int, n: int) -> Iterator[np.ndarray]:
        """Ids start to start + n, in runs that lie together."""
        step = self.length * BATCH_SEQUENCES
        while n > 0:
            b, r = divmod(start, step)
            take = min(n, step - r)
            yield self._child(b)[r : r + take]
            start, n = start + take, n - take


READ_SCHEMA = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def read_documents(files: DataFrame, folder: str) -> DataFrame:
    """A row for each document in the files of write_files(): its place in the whole stream and its ids' checksum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                file = TokenFile(folder, part)
                for b in range(file.index.num_record_batches):
                    own = file.index.get_batch(b)
                    starts, sizes = own.column(1).to_numpy(), own.column(2).to_numpy()
                    sums = []
                    for start, n in zip(starts.tolist(), sizes.tolist()):
                        crc = 0
                        for run_ in file.span(start, n):
                            crc = zlib.crc32(run_.astype("<u4"), crc)
                        sums.append(crc)
                    yield pa.RecordBatch.from_arrays([own.column(0), pa.array(starts + base), own.column(2), pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return only(files, "part", "base").mapInArrow(run, READ_SCHEMA)


def round_trip(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Writes docs to token files in the shared folder and reads every document back from them."""
    folder = Workspace(spark, "tokens").path("files")  # removed when the driver ends
    if folder.startswith("/"):
        folder = f"file://{folder}"
    return read_documents(write_files(docs, folder), folder)
