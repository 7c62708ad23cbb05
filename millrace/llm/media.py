"""Media columns of progressive JPEGs: payloads kept in them, and their decoded tensors."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import jpeg
from .common import BATCH_BYTES, Workspace, arrow_limits, only

#: Media rows of one Arrow batch.
ROWS = 256


def store_texts(docs: DataFrame) -> DataFrame:
    """doc_id, media: every whole text of docs(doc_id, text) as a progressive JPEG.

    The text's UTF-8 bytes (null: none) are filled up with zero bytes to a positive
    multiple of 64; the picture's comment notes how many bytes were the text's own.
    Equal texts give equal media; repeated rows and null ids come back as they are.
    """
    arrow_limits(docs.sparkSession, ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for raw in batch.column(1).to_pylist():
                raw = raw or b""
                padded = raw + bytes(64 - len(raw) % 64 if len(raw) % 64 or not raw else 0)
                out.append(jpeg.encode_payload(padded, b"bytes=%d payload=%d" % (len(raw), len(padded))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["doc_id", "media"])

    return only(docs, "doc_id", "text").selectExpr("cast(doc_id as bigint) doc_id", "cast(text as binary) text").mapInArrow(run, "doc_id bigint, media binary")


def decode_tensors(media: DataFrame) -> DataFrame:
    """Every progressive JPEG of media(doc_id, media) as a full-resolution tensor: height, width, rgb (row-major bytes).

    A null picture, one that is not a progressive JPEG of one or three components, and
    a damaged one give nulls.
    """
    arrow_limits(media.sparkSession, 32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for data in batch.column(1).to_pylist():
                try:
                    rgb = jpeg.decode(data or b"").rgb()
                    out.append((rgb.shape[0], rgb.shape[1], rgb.tobytes()))
                except ValueError:
                    out.append((None, None, None))
            h, w, t = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(h, pa.int32()), pa.array(w, pa.int32()), pa.array(t, pa.binary())], ["doc_id", "height", "width", "rgb"])

    return only(media, "doc_id", "media").selectExpr("cast(doc_id as bigint) doc_id", "media").mapInArrow(run, "doc_id bigint, height int, width int, rgb binary")


def feature(height: int, width: int, rgb: bytes) -> str:
    """Size, means and deviations of a stored tensor, from whole-number sums."""
    flat, n = np.frombuffer(rgb, np.uint8), height * width
    sums, squares = np.zeros(3, np.int64), np.zeros(3, np.int64)
    for at in range(0, len(flat), 3 << 16):  # in cache
        part = flat[at : at + (3 << 16)].reshape(-1, 3).astype(np.int32)
        sums += part.sum(0)
        squares += np.einsum("ij,ij->j", part, part, dtype=np.int64)
    means = [x / n for x in sums.tolist()]
    devs = [max(0.0, sq / n - m * m) ** 0.5 for m, sq in zip(means, squares.tolist())]
    return f"{width}x{height} " + " ".join(f"{c}={m:.3f}/{d:.3f}" for c, m, d in zip("rgb", means, devs))


KEPT = "doc_id bigint, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string"


def read_tensors(media: DataFrame) -> DataFrame:
    """What store_texts() stored: the payload's digests, and the picture as a tensor (height, width, rgb)."""
    arrow_limits(media.sparkSession, ROWS)
    schema = f"{KEPT}, height int, width int, rgb binary"
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            ids = batch.column(0)
            at = 0

            def given(end: int) -> pa.RecordBatch:
                cols = list(zip(*rows)) if rows else [()] * len(kinds)
                return pa.RecordBatch.from_arrays([ids[at:end], *(pa.array(c, k) for c, k in zip(cols, kinds))], names)

            for k, data in enumerate(batch.column(1).to_pylist()):
                image = jpeg.decode(data)
                sizes = jpeg.noted(image.comment)
                rgb = image.rgb()
                payload = jpeg.payload_of(image, sizes["payload"])  # changes the coefficients
                rows.append((sizes["bytes"], len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(data), hashlib.sha256(data).hexdigest(), rgb.shape[0], rgb.shape[1], rgb.tobytes()))
                held += rgb.size
                if held >= BATCH_BYTES:
                    yield given(k + 1)
                    rows, held, at = [], 0, k + 1
            if rows:
                yield given(len(ids))

    return only(media, "doc_id", "media").mapInArrow(run, schema)


def read_texts(media: DataFrame) -> DataFrame:
    """Decodes what store_texts() stored and digests the payload, the stored bytes and the picture's tensor."""
    names = [x.split()[0] for x in KEPT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [feature(*t) for t in zip(*(batch.column(n).to_pylist() for n in ("height", "width", "rgb")))]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(found, pa.string())], [*names, "feature"])

    return read_tensors(media).mapInArrow(run, f"{KEPT}, feature string")


def round_trip(docs: DataFrame) -> DataFrame:
    """Stores every text as a picture in a table of the shared folder and reads that table back.

    Tensors pass to the features as a column; as a table they would take some four
    times the documents' own disk.
    """
    space = Workspace(docs.sparkSession, "media")
    return read_texts(space.save(store_texts(docs), "media"))
