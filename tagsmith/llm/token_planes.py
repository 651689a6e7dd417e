"""Token-id files in bit or byte planes.

The documents, in ascending id order, become one stream of token ids.  It is
kept as a Parquet table of *chunks* (so Spark commits it atomically on any
store).  A chunk holds whole documents: its ids, cut into blocks of a fixed
number of ids, each block transposed into bit planes (or byte planes) and
each plane compressed with zstandard on its own; leading zero planes are not
stored.  Beside the planes a chunk has its index: the ids and sizes of its
documents, the block sizes and where each plane ends.  A second small table
gives the first stream position of each part (write task), so the place of
any document is known from the index columns alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagsmith.llm.common import ship
from tagsmith.llm.tokens import encoder

CHUNK = """part int, chunk int, first long, n_ids long, doc_ids array<long>, sizes array<long>,
           block int, widths array<int>, ends array<long>, planes binary"""


def to_planes(ids: np.ndarray, block: int, layout: str, level: int = 1) -> tuple[list[int], list[int], bytes]:
    """(planes per block, end of each compressed plane, compressed planes)."""
    pack = zstandard.ZstdCompressor(level=level, write_content_size=True).compress
    widths, ends, out, at = [], [], [], 0
    for i in range(0, len(ids), block):
        part = np.ascontiguousarray(ids[i:i + block], "<u4")
        bits = int(part.max()).bit_length()
        raw = part.view(np.uint8).reshape(-1, 4)[:, :max(1, -(-bits // 8))]
        if layout == "bit":
            planes = np.packbits(np.unpackbits(np.ascontiguousarray(raw), axis=1, bitorder="little", count=max(1, bits)).T, axis=1)
        else:
            planes = np.ascontiguousarray(raw.T)
        widths.append(len(planes))
        for p in planes:
            z = pack(p.tobytes())
            at += len(z)
            ends.append(at)
            out.append(z)
    return widths, ends, b"".join(out)


def from_planes(n_ids: int, block: int, layout: str, widths: list[int], ends: list[int], planes: bytes) -> np.ndarray:
    """Inverse of :func:`to_planes`."""
    unpack = zstandard.ZstdDecompressor().decompress
    out, k, at = np.zeros(n_ids, "<u4"), 0, 0
    for b, width in enumerate(widths):
        n = min(block, n_ids - b * block)
        raw = []
        for _ in range(width):
            raw.append(np.frombuffer(unpack(planes[at:ends[k]]), np.uint8))
            at, k = ends[k], k + 1
        if layout == "bit":
            bits = np.unpackbits(np.stack(raw), axis=1, count=n).T
            raw = np.packbits(bits, axis=1, bitorder="little").T
        whole = np.zeros((n, 4), np.uint8)
        for j, column in enumerate(raw):
            whole[:, j] = column
        out[b * block:b * block + n] = whole.view("<u4")[:, 0]
    return out


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, layout: str = "bit",
                 block: int = 32_768, chunk_ids: int = 262_144, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Tokenise ``docs`` (whole texts, ``end_id`` after each) and write the
    stream below ``path``.

    Documents are range-partitioned by id and text hash, so the parts follow
    one another in id order and the rows of a frequent id (or of the null id,
    which comes first) are spread over several parts, in the order of the hash.  Null text is empty (its end id only).  A chunk closes at the first
    document end beyond ``chunk_ids`` ids, so a task holds one chunk, or one
    document where that is longer.  Other columns are ignored; an empty table
    gives an empty stream."""
    if layout not in ("bit", "byte"):
        raise ValueError("layout is 'bit' or 'byte'")
    ship(docs.sparkSession)
    schema = CHUNK
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, enc = TaskContext.get().partitionId(), encoder(tokenizer)
        chunk = first = held = 0
        ids, doc_ids = [], []

        def close() -> pa.RecordBatch:
            nonlocal chunk, first, held
            widths, ends, planes = to_planes(np.frombuffer(b"".join(ids), "<u4"), block, layout)
            row = {"part": part, "chunk": chunk, "first": first, "n_ids": held, "doc_ids": list(doc_ids),
                   "sizes": [len(x) // 4 for x in ids], "block": block, "widths": widths, "ends": ends, "planes": planes}
            chunk, first, held = chunk + 1, first + held, 0
            ids.clear()
            doc_ids.clear()
            return pa.RecordBatch.from_pylist([row], _arrow_schema())
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                some = batch.slice(i, 512)
                for d, raw in zip(some.column(0).to_pylist(), enc.encode(some.column(1).to_pylist())):
                    ids.append(raw + end)
                    doc_ids.append(d)
                    held += len(raw) // 4 + 1
                    if held >= chunk_ids:
                        yield close()
        if held:
            yield close()
    (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
     .withColumn("hash", F.xxhash64("text")).repartitionByRange("id", "hash").sortWithinPartitions("id", "hash").select("id", "text")
     .mapInArrow(run, schema).write.parquet(f"{path}/chunks"))
    spark = docs.sparkSession
    # one row per write task
    sums = spark.read.schema(schema).parquet(f"{path}/chunks").groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    sums.select("part", F.coalesce(before, F.lit(0)).alias("start"), "n").coalesce(1).write.parquet(f"{path}/parts")


def _arrow_schema() -> pa.Schema:
    return pa.schema([("part", pa.int32()), ("chunk", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()),
                      ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("block", pa.int32()),
                      ("widths", pa.list_(pa.int32())), ("ends", pa.list_(pa.int64())), ("planes", pa.binary())])


def read_tokens(spark: SparkSession, path: str, layout: str = "bit", with_ids: bool = True) -> DataFrame:
    """Per document of the stream: doc_id, start (ids of all documents
    before it), n_tokens, ids_crc32 (unsigned, of the ids as little-endian
    uint32) and, if asked for, ids (array of long)."""
    ship(spark)
    chunks = spark.read.schema(CHUNK).parquet(f"{path}/chunks")
    parts = spark.read.schema("part int, start long, n long").parquet(f"{path}/parts").select("part", "start")
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                c = batch.slice(row, 1).to_pylist()[0]
                ids = from_planes(c["n_ids"], c["block"], layout, c["widths"], c["ends"], c["planes"])
                size = np.array(c["sizes"], np.int64)
                end = np.cumsum(size)
                begin = end - size
                made = [pa.array(c["doc_ids"], pa.int64()), pa.array(c["start"] + c["first"] + begin), pa.array(size),
                        pa.array([zlib.crc32(ids[a:b]) for a, b in zip(begin.tolist(), end.tolist())], pa.int64())]
                if with_ids:
                    made.append(pa.ListArray.from_arrays(pa.array(np.append(begin, len(ids)), pa.int32()), pa.array(ids, pa.int64())))
                yield pa.RecordBatch.from_arrays(made, ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][:len(made)])
    # one row per write task, a few bytes each: Spark broadcasts it below its threshold
    return chunks.join(parts, "part").drop("part").mapInArrow(run, schema)
