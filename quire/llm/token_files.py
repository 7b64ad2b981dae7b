"""Token-ID / binary output: concatenated ids with Elias-Fano document boundaries.

One file per range of doc_id, numbered in ascending order:

    ids of all its documents, little-endian u16 (u32 for larger vocabularies)
    footer: Elias-Fano of the documents' end offsets in the file, in ids
            Elias-Fano of doc_id minus the file's smallest one
    trailer: smallest doc_id, documents with a null doc_id, item size, bytes of the footer, magic

The offset of a document is found by `select` on the boundaries, in about
2 + log2(mean length) bits a document, without a table of 64-bit offsets. A
manifest (one row per file) holds documents and ids of each file; its running
sums place every file in the whole id array.

Null or empty texts are the end id alone. A null doc_id sorts first. Rows that
repeat a doc_id are kept, in text order. An empty table gives no files and an
empty result. Other columns of the input are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import AtomicFile, batches, open_fs, shared_folder, stage
from quire.llm.elias_fano import EliasFano
from quire.llm.tokens import default_tokenizer, encoder

MAGIC = b"QTOKEF1\0"
_TRAILER = "<qQBQ8s"
_MANIFEST = "shard int, path string, n_docs long, n_tokens long"
_DOCS = "doc_id long, start long, n_tokens long, ids_crc32 long"
READ_IDS = 1 << 22


def write_token_files(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = 0) -> DataFrame:
    """Encode every whole text of `docs` (doc_id, text) and write the files to
    `folder`, a shared one. Returns the manifest, one row per file."""
    tokenizer = tokenizer or default_tokenizer()
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.xxhash64("text").alias("__h")) \
        .repartitionByRange(n, "doc_id", "__h").sortWithinPartitions("doc_id", "__h", "text") \
        .select("doc_id", "text", F.spark_partition_id().alias("shard"))

    def write(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, out, ends, ids, shard = encoder(tokenizer), None, [], [], None
        end, total, nulls = np.array([end_id], enc.dtype).tobytes(), 0, 0
        for part in parts:
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                if out is None:
                    shard = part.column(2)[0].as_py()
                    out = AtomicFile(f"{folder}/shard-{shard:07d}.qtok")
                data = enc.encode(text) + end
                out.write(data)
                total += len(data) // enc.dtype.itemsize
                ends.append(total)
                nulls += doc_id is None
                if doc_id is not None:
                    ids.append(doc_id)
        if out is None:
            return
        known = np.array(ids, np.int64)
        least = int(known[0]) if ids else 0
        footer = EliasFano.encode(np.array(ends, np.uint64)).to_bytes() \
            + EliasFano.encode((known - least).astype(np.uint64)).to_bytes()
        out.write(footer)
        out.write(struct.pack(_TRAILER, least, nulls, enc.dtype.itemsize, len(footer), MAGIC))
        out.commit()
        yield pa.RecordBatch.from_pydict({
            "shard": pa.array([shard], pa.int32()), "path": [f"{folder}/shard-{shard:07d}.qtok"],
            "n_docs": pa.array([len(ends)], pa.int64()), "n_tokens": pa.array([total], pa.int64())})

    return stage(ordered.mapInArrow(write, _MANIFEST), "token-manifest")


class TokenFile:
    """A written file: `len`, `bounds(i, count)` by select, `ids(begin, end)`."""

    def __init__(self, path: str):
        fs, name = open_fs(path)
        self.file = fs.open_input_file(name)
        size = self.file.size()
        least, self.nulls, self.item, n_footer, magic = struct.unpack(_TRAILER, 
            self.file.read_at(struct.calcsize(_TRAILER), size - struct.calcsize(_TRAILER)))
        if magic != MAGIC:
            raise ValueError(f"not a token file: {path}")
        footer = self.file.read_at(n_footer, size - struct.calcsize(_TRAILER) - n_footer)
        self.ends, at = EliasFano.from_bytes(footer)
        self.keys, _ = EliasFano.from_bytes(footer, at)
        self.least = least

    def __len__(self) -> int:
        return self.ends.n

    def bounds(self, i: int, count: int) -> np.ndarray:
        """Start of document i, then the ends of documents i .. i+count-1."""
        first = self.ends[i - 1] if i else 0
        return np.concatenate([[first], self.ends.slice(i, count)]).astype(np.int64)

    def doc_ids(self, i: int, count: int) -> list[int | None]:
        known = self.keys.slice(max(0, i - self.nulls), count - max(0, min(count, self.nulls - i)))
        return [None] * max(0, min(count, self.nulls - i)) + (known.astype(np.int64) + self.least).tolist()

    def ids(self, begin: int, end: int) -> np.ndarray:
        return np.frombuffer(self.file.read_at((end - begin) * self.item, begin * self.item), f"<u{self.item}")


def read_token_files(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start in the whole id array,
    n_tokens, unsigned crc32 of its ids as little-endian u32. One small row per
    file (at most the number of write tasks) passes through the driver."""
    rows, base, places = sorted(manifest.collect(), key=lambda r: r["shard"]), 0, []
    for r in rows:
        places.append((r["shard"], r["path"], base))
        base += r["n_tokens"]
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for path, start in zip(part.column("path").to_pylist(), part.column("base").to_pylist()):
                f, i = TokenFile(path), 0
                while i < len(f):
                    bounds = f.bounds(i, 4096)
                    fit = max(1, int(np.searchsorted(bounds, bounds[0] + READ_IDS, "right")) - 1)
                    bounds = bounds[:fit + 1]
                    ids = f.ids(int(bounds[0]), int(bounds[-1])).astype("<u4")
                    cut = (bounds - bounds[0]).tolist()
                    crcs = [zlib.crc32(ids[a:b]) for a, b in zip(cut, cut[1:])]
                    yield from batches({"doc_id": f.doc_ids(i, fit), "start": (bounds[:-1] + start).tolist(),
                                        "n_tokens": np.diff(bounds).tolist(), "ids_crc32": crcs}, schema)
                    i += fit

    frame = spark.createDataFrame(places, "shard int, path string, base long")
    return frame.repartition(max(1, len(places)), "shard").mapInArrow(read, _DOCS)


def token_table(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write the files to a new shared folder and read them back."""
    spark = docs.sparkSession
    return read_token_files(spark, write_token_files(docs, shared_folder(spark, "tokens"), tokenizer))
