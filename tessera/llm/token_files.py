"""Token ids as flat unsigned integer files with 64-bit document offsets.

``write_token_files`` cuts the documents into ranges of (has an id, doc_id, row hash) -
cut points come from a bounded sample of keys - encodes each text, sends the
ids to their range, sorts there and writes per range

* ``part-NNNNN-<attempt>.ids``   the ids, little-endian uint16 or uint32,
* ``part-NNNNN-<attempt>.docs``  int64 triples (1 or 0: has an id, doc_id, end
  of its ids in the file).

File names carry the task attempt, so a task that runs again after a lost
executor never touches a file of another; only the attempts that the manifest
names count.  The manifest (a small Parquet table, a row a range) also holds
the first id number and first document number of each range: prefix sums over
the ranges' totals.  ``read_token_files`` maps the files into memory.

The folder must be one that executors reach as files (a shared mount): memory
mapping needs that.  The default is ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from tokenizers import Tokenizer

from tessera.llm.bpe import CACHE_BYTES, ChunkEncoder, built, uint32_bytes
from tessera.llm.common import emit, part_count, part_of, range_cuts, shared_path

_SENT = pa.schema([("part", pa.int32()), ("given", pa.int32()), ("doc_id", pa.int64()), ("salt", pa.int64()),
                   ("ids", pa.binary())])
_DONE = pa.schema([("part", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])
_READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                   ("ids_crc32", pa.int64())])


class LibraryEncoder:
    """Encodes with the tokenizers library.  For files whose words are parted
    by white space its model is given each word that its normalizer and
    pre-tokenizer make once, and the ids are kept."""

    def __init__(self, text: str):
        self.tokenizer = Tokenizer.from_str(text)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        try:
            self.encode = ChunkEncoder(text, self._word, 2 * CACHE_BYTES).encode
        except ValueError:
            self.encode = self._ids

    def _word(self, symbols: str) -> bytes:
        return uint32_bytes([token.id for token in self.model.tokenize(symbols)])

    def _ids(self, text: str | None) -> bytes:
        return np.asarray(self.tokenizer.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()


def local_folder(path: str) -> str:
    """The mounted folder of a path or file: URI; ValueError for other schemes."""
    at = urlparse(path)
    if at.scheme not in ("", "file"):
        raise ValueError(f"{path}: token files need a folder that is mounted on every machine")
    return unquote(at.path) if at.scheme else path


def write_token_files(docs: DataFrame, tokenizer_path: str, end_id: int | None, folder: str | None = None,
                      parts: int | None = None) -> str:
    """Writes the token files of ``docs(doc_id, text)`` and returns their
    folder.

    Ascending doc_id, rows without one first; rows with equal doc_id stand in
    order of a text hash.  Null and empty texts hold only ``end_id`` (nothing if
    that is None).  An empty table gives an empty manifest.  Other columns are
    ignored.  Long texts are encoded whole.
    """
    spark = docs.sparkSession
    folder = folder or shared_path(spark, "tokens")
    target = local_folder(folder)
    parts = parts or part_count(spark)
    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(doc_id.isNotNull().cast("int").alias("given"), F.coalesce(doc_id, F.lit(0)).alias("doc_id"),
                       F.xxhash64("text").alias("salt"), F.col("text").cast("string").alias("text"))
    cuts = spark.sparkContext.broadcast(range_cuts(rows, ["given", "doc_id", "salt"], parts))
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    wide = Tokenizer.from_str(spec.value).get_vocab_size(with_added_tokens=True) > 1 << 16 or (end_id or 0) >= 1 << 16
    kind = "<u4" if wide else "<u2"
    end = b"" if end_id is None else np.asarray([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = built(LibraryEncoder, spec.value)

        def out():
            for b in batches:
                for *key, text in zip(*(b.column(i).to_pylist() for i in range(3)), b.column(3), strict=True):
                    ids = np.frombuffer(enc.encode(text.as_py()) + end, "<u4").astype(kind).tobytes()
                    yield (part_of(cuts.value, tuple(key)), *key, ids), len(ids)
        yield from emit(_SENT, out())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.makedirs(target, exist_ok=True)
        attempt = f"{os.getpid()}-{TaskContext.get().taskAttemptId()}"
        done: list[tuple] = []
        open_part, ids_file, docs_file, n_docs, n_ids = None, None, None, 0, 0

        def close():
            if open_part is not None:
                for f in (ids_file, docs_file):
                    f.flush()
                    os.fsync(f.fileno())
                    f.close()
                done.append((open_part, f"part-{open_part:05d}-{attempt}", n_docs, n_ids))

        for b in batches:
            for part, given, doc, ids in zip(*(b.column(i).to_pylist() for i in range(3)), b.column(4), strict=True):
                if part != open_part:
                    close()
                    open_part, n_docs, n_ids = part, 0, 0
                    name = os.path.join(target, f"part-{part:05d}-{attempt}")
                    ids_file, docs_file = open(name + ".ids", "wb"), open(name + ".docs", "wb")  # noqa: SIM115
                raw = ids.as_buffer()
                ids_file.write(raw)
                n_ids += len(raw) // np.dtype(kind).itemsize
                n_docs += 1
                docs_file.write(np.asarray([given, doc, n_ids], "<i8").tobytes())
        close()
        yield from emit(_DONE, ((row, 100) for row in done))

    placed = (rows.mapInArrow(encode, "part int, given int, doc_id long, salt long, ids binary")
              .repartitionById(parts, F.col("part")).sortWithinPartitions("part", "given", "doc_id", "salt")
              .mapInArrow(write, "part int, file string, n_docs long, n_ids long"))
    placed.write.parquet(f"{folder}/written")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    (spark.read.schema(placed.schema).parquet(f"{folder}/written")
     .withColumn("first_id", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
     .withColumn("first_doc", F.coalesce(F.sum("n_docs").over(before), F.lit(0)))
     .withColumn("kind", F.lit(kind))
     .write.parquet(f"{folder}/manifest"))
    return folder


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, read back by
    mapping the files that the manifest names into memory.  ``start`` counts
    the ids of all documents before it; the crc is over uint32 ids."""
    target = local_folder(folder)
    manifest = spark.read.parquet(f"{folder}/manifest").select("part", "file", "n_docs", "first_id", "kind")
    ranges = max(1, manifest.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            for b in batches:
                for row in b.to_pylist():
                    yield from _documents(os.path.join(target, row["file"]), row["first_id"], row["kind"])
        yield from emit(_READ, out())

    return manifest.repartitionById(ranges, F.col("part")).mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _documents(name: str, first: int, kind: str):
    docs = np.memmap(name + ".docs", "<i8", "r").reshape(-1, 3)
    ids = np.memmap(name + ".ids", kind, "r") if os.path.getsize(name + ".ids") else np.empty(0, kind)
    start = 0
    for given, doc, end in docs:
        own = np.asarray(ids[start:end], "<u4").tobytes()
        yield (int(doc) if given else None, first + start, int(end) - start, zlib.crc32(own)), 32
        start = int(end)


def token_file_round_trip(docs: DataFrame, tokenizer_path: str, end_id: int = 1) -> DataFrame:
    """Writes the files and returns what is read back from them."""
    spark = docs.sparkSession
    return read_token_files(spark, write_token_files(docs, tokenizer_path, end_id))
