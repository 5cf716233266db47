"""Arrays that travel through shuffles as binary columns, one row for each task and bucket.

Millions of small fixed-width records cost a few rows this way, and stay numpy arrays at both ends.
"""

import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, types as T

from goldquarry.llm.kernels import U64, mix, run_ends


def pack_columns(rows: np.ndarray) -> bytes:
    """A structured array column by column, which compresses better than row by row."""
    return b"".join(np.ascontiguousarray(rows[name]).tobytes() for name in rows.dtype.names)


def packed_parts(rows: np.ndarray, order: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """`pack_columns` of parts of rows[order], each column brought in order once for all of them."""
    columns = [rows[name][order] for name in rows.dtype.names]
    return [b"".join([column[a:b].tobytes() for column in columns]) for a, b in zip(begins.tolist(), ends.tolist())]


def unpack_columns(blobs, kind: np.dtype) -> np.ndarray:
    blobs = list(blobs)
    counts = [len(blob) // kind.itemsize for blob in blobs]
    rows = np.empty(sum(counts), kind)
    columns, first = [(rows[name], kind[name], kind[name].itemsize) for name in kind.names], 0
    for blob, n in zip(blobs, counts):
        at = 0
        for column, own, size in columns:
            column[first : first + n] = np.frombuffer(blob, own, n, at)
            at += size * n
        first += n
    return rows


def dealt(rows: np.ndarray, bucket: np.ndarray, kind: str) -> pa.RecordBatch:
    """One row (kind, bucket, rows) for each bucket."""
    # Small numbers are sorted by their digits.
    few = len(bucket) and bucket.min() >= 0 and bucket.max() < 1 << 16
    order = np.argsort(bucket.astype(np.uint16) if few else bucket, kind="stable")
    bucket = bucket[order]
    cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[: len(rows)])
    blobs = packed_parts(rows, order, cuts, run_ends(cuts, len(rows)))
    return pa.RecordBatch.from_arrays(
        [pa.array([kind] * len(cuts), pa.string()), pa.array(bucket[cuts], pa.int64()), pa.array(blobs, pa.binary())],
        names=["kind", "bucket", "rows"],
    )


DEALT = "kind string, bucket long, rows binary"


def doc_bucket(docs: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(docs.astype(np.int64).view(U64)) % U64(buckets)).astype(np.int64)


def packed_texts(docs: DataFrame) -> DataFrame:
    """doc_id, crc (a checksum of the text) and data (the compressed text) of rows (doc_id, text, ...); other columns stay."""
    names = [c for c in docs.columns if c != "text"]

    def pack(batches):
        compress = zstandard.ZstdCompressor(level=1).compress
        for part in (b.slice(at, 512) for b in batches for at in range(0, b.num_rows, 512)):
            data = [(text or "").encode() for text in part.column("text").to_pylist()]
            columns = [pa.array([zlib.crc32(d) for d in data], pa.int64()), pa.array([compress(d) for d in data], pa.binary())]
            yield pa.RecordBatch.from_arrays([part.column(n) for n in names] + columns, names=[*names, "crc", "data"])

    schema = T.StructType([f for f in docs.schema.fields if f.name in names])
    return docs.mapInArrow(pack, schema.add("crc", "long").add("data", "binary"))
