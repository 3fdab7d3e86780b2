"""Token files with random access: directly addressable variable-length codes.

An id is cut into 8-bit chunks, lowest first. Level 0 holds the first chunk of
every id; a bit per chunk says whether the id goes on; level 1 holds the next
chunk of those that do, and so on. A rank directory (ones before every 512th
bit) finds an id's place on the next level in constant time, so any id is read
without decoding its neighbours.

File: ``DACT``, version, then little-endian sections: counts, document ids with
a null flag each, document starts, and per level chunks, bitmap and directory.

Edge cases: a special string of the vocabulary in a text has its own id, as in
the library; a null text is empty and holds the end id alone; documents with a
null id come first; repeated document ids stay separate documents, ordered by
text; an empty table writes no file and reads back as no rows.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.chunks import ByteLevelEncoder
from riskweave.llm.common import exclusive_sum, gather_runs, staged, text_column, text_slices
from riskweave.session import scratch_path

MAGIC, VERSION = b"DACT", 1
BITS, BLOCK = 8, 512


def pack_ids(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray | None, np.ndarray | None]]:
    """Levels (chunks, bitmap words, rank directory); the last level has no bitmap."""
    levels, left = [], np.asarray(ids, dtype=np.uint32)
    while True:
        chunk, high = (left & ((1 << BITS) - 1)).astype(np.uint8), left >> BITS
        more = high > 0
        if not more.any():
            levels.append((chunk, None, None))
            return levels
        blocks = -(-len(more) // BLOCK)
        bits = np.zeros(blocks * BLOCK, bool)
        bits[:len(more)] = more
        ranks = exclusive_sum(bits.reshape(blocks, BLOCK).sum(axis=1))[:-1].astype(np.uint64)
        levels.append((chunk, np.packbits(bits, bitorder="little"), ranks))
        left = high[more]


def to_bytes(ids: np.ndarray, doc_ids: np.ndarray, doc_null: np.ndarray, starts: np.ndarray) -> bytes:
    """One file: ids of documents one after another, and where each begins."""
    levels = pack_ids(ids)
    out = [MAGIC, struct.pack("<IQQI", VERSION, len(ids), len(doc_ids), len(levels)),
           struct.pack(f"<{len(levels)}Q", *(len(c) for c, _, _ in levels)),
           doc_ids.astype("<i8").tobytes(), doc_null.astype(np.uint8).tobytes(), starts.astype("<u8").tobytes()]
    for chunk, bitmap, ranks in levels:
        out.append(chunk.tobytes())
        if bitmap is not None:
            out += [bitmap.tobytes(), ranks.astype("<u8").tobytes()]
    return b"".join(out)


class TokenFile:
    """Reads a file made by :func:`to_bytes`; ``ids[i]`` by :meth:`get` touches one chunk per level."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a token file")
        version, self.n_ids, self.n_docs, n_levels = struct.unpack_from("<IQQI", data, 4)
        if version != VERSION:
            raise ValueError(f"token file version {version} is not known")
        at = 4 + struct.calcsize("<IQQI")
        sizes = struct.unpack_from(f"<{n_levels}Q", data, at)
        at += 8 * n_levels

        def take(kind, n):
            nonlocal at
            found = np.frombuffer(data, kind, n, at)
            at += found.nbytes
            return found
        self.doc_ids, self.doc_null = take("<i8", self.n_docs), take(np.uint8, self.n_docs)
        self.starts = take("<u8", self.n_docs + 1).astype(np.int64)
        self.levels = []
        for k, n in enumerate(sizes):
            chunk = take(np.uint8, n)
            blocks = -(-n // BLOCK)
            self.levels.append((chunk, take(np.uint8, blocks * BLOCK // 8), take("<u8", blocks))
                               if k + 1 < n_levels else (chunk, None, None))

    def get(self, i: int) -> int:
        """The id at position ``i`` (0 <= i < n_ids)."""
        if not 0 <= i < self.n_ids:
            raise IndexError(i)
        value = 0
        for k, (chunk, bitmap, ranks) in enumerate(self.levels):
            value |= int(chunk[i]) << (BITS * k)
            if bitmap is None or not bitmap[i >> 3] >> (i & 7) & 1:
                return value
            block = i // BLOCK
            before = np.unpackbits(bitmap[block * BLOCK // 8:(i >> 3) + 1], bitorder="little")
            i = int(ranks[block]) + int(before[:i - block * BLOCK].sum())
        return value

    def all(self) -> np.ndarray:
        """Every id, level by level from the last."""
        value = np.zeros(0, np.uint32)
        for chunk, bitmap, _ in reversed(self.levels):
            here = chunk.astype(np.uint32)
            if bitmap is not None:
                here[np.unpackbits(bitmap, count=len(chunk), bitorder="little").astype(bool)] |= value << BITS
            value = here
        return value

    def document(self, k: int) -> np.ndarray:
        """Ids of the file's k-th document, by position."""
        return np.array([self.get(i) for i in range(self.starts[k], self.starts[k + 1])], dtype=np.uint32)


def write_file(uri: str, data: bytes) -> None:
    """Write under another name, then rename: readers never see half a file."""
    fs, path = pafs.FileSystem.from_uri(uri)
    part = f"{path}.{uuid.uuid4().hex}.part"
    with fs.open_output_stream(part) as f:
        f.write(data)
    fs.move(part, path)


@dataclass
class TokenStore:
    """A written folder: ``manifest`` has a row per file (file, start, n_docs, n_ids)."""

    folder: str
    manifest: DataFrame

    def documents(self, digest) -> DataFrame:
        """Read the files back; ``digest(ids)`` makes an int64 of a document's ids.

        Returns doc_id, start (ids of all documents before it), n_tokens and digest.
        """
        spark = self.manifest.sparkSession

        def read(batches):
            for b in batches:
                for name, data in zip(b.column("path").to_pylist(), b.column("content")):
                    f = TokenFile(data.as_py())
                    ids = f.all()
                    lengths = np.diff(f.starts)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([name.rpartition("/")[2]] * f.n_docs, pa.string()),
                        pa.array(f.doc_ids, pa.int64(), mask=f.doc_null.astype(bool)),
                        pa.array(f.starts[:-1], pa.int64()), pa.array(lengths, pa.int64()),
                        pa.array([digest(ids[a:a + n]) for a, n in zip(f.starts, lengths)], pa.int64()),
                    ], names=["file", "doc_id", "local", "n_tokens", "digest"])
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.dact").load(self.folder)
        docs = files.select("path", "content").mapInArrow(
            read, "file string, doc_id long, local long, n_tokens long, digest long")
        return (docs.join(self.manifest.select("file", F.col("start").alias("before")), "file")
                .select("doc_id", (F.col("before") + F.col("local")).alias("start"), "n_tokens", "digest"))


def write_tokens(docs: DataFrame, vocabulary: str, end_id: int, ids_per_file: int = 4_000_000) -> TokenStore:
    """Encode ``docs`` (doc_id, text) and write token files in ascending doc_id order.

    Documents are range-partitioned by id, so a task writes the files of one
    id range; a file ends once it holds ``ids_per_file`` ids. Only the manifest,
    a row per file, is summed to give global starts. Files of a failed or
    repeated task attempt are in no manifest row and are not read.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "llm-tokens")
    fs, path = pafs.FileSystem.from_uri(folder)
    fs.create_dir(path, recursive=True)
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text"))
               .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text"))

    def write(batches):
        part, held, size, k = TaskContext.get().partitionId(), [], 0, 0
        encoder = _encoder(vocabulary)

        def flush():
            nonlocal held, size, k
            counts = np.concatenate([h[2] for h in held])
            ids = np.concatenate([h[3] for h in held])
            name = f"tokens-{part:06d}-{k:06d}-{uuid.uuid4().hex[:8]}.dact"
            write_file(f"{folder}/{name}", to_bytes(ids, np.concatenate([h[0] for h in held]),
                                                    np.concatenate([h[1] for h in held]), exclusive_sum(counts)))
            row = pa.RecordBatch.from_pydict({"file": [name], "part": [part], "piece": [k], "n_docs": [len(counts)],
                                              "n_ids": [len(ids)]}, schema=_FILE_SCHEMA)
            held, size, k = [], 0, k + 1
            return row
        for batch in batches:
            for rows in text_slices(batch, "text"):
                ids, offsets = with_end(*encoder.encode(rows.column("text")), end_id)
                doc = rows.column("doc_id")
                held.append((np.asarray(doc.fill_null(0)), np.asarray(doc.is_null()), np.diff(offsets), ids))
                size += len(ids)
                if size >= ids_per_file:
                    yield flush()
        if held:
            yield flush()
    files = staged(ordered.mapInArrow(write, "file string, part long, piece long, n_docs long, n_ids long"),
                   "token-manifest")
    # Two levels: files within a part, then parts (as many as shuffle partitions).
    within = Window.partitionBy("part").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n")).withColumn(
        "before", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    manifest = (files.withColumn("inside", F.coalesce(F.sum("n_ids").over(within), F.lit(0)))
                .join(parts.select("part", "before"), "part")
                .select("file", (F.col("before") + F.col("inside")).alias("start"), "n_docs", "n_ids"))
    return TokenStore(folder, manifest)


_FILE_SCHEMA = pa.schema([("file", pa.string()), *((c, pa.int64()) for c in ("part", "piece", "n_docs", "n_ids"))])
_ENCODERS: dict = {}


def _encoder(path: str, kind=ByteLevelEncoder):
    """One encoder, and so one memo, per worker process and vocabulary."""
    if (kind, path) not in _ENCODERS:
        _ENCODERS[kind, path] = kind(path)
    return _ENCODERS[kind, path]


def with_end(ids: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Append ``end_id`` to every document."""
    n = len(offsets) - 1
    out = np.full(len(ids) + n, end_id, dtype=np.uint32)
    spread = offsets + np.arange(n + 1)
    keep = np.ones(len(out), bool)
    keep[spread[1:] - 1] = False
    out[keep] = ids
    return out, spread


def crc_of(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4"))


__all__ = ["TokenFile", "TokenStore", "crc_of", "gather_runs", "pack_ids", "to_bytes", "with_end", "write_tokens"]
