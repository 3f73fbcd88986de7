"""Shared scratch tables, code shipping and the packed exchange."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

#: Rows of one Arrow batch: packed rows and long texts are large, and a batch is held whole on both sides.
ARROW_ROWS = 1000


def ship(spark: SparkSession) -> None:
    """Give the executors this package once per application, and keep Arrow batches small."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= ARROW_ROWS:
        spark.conf.set(rows, str(ARROW_ROWS))
    sc = spark.sparkContext
    if getattr(sc, "_tickforge_shipped", False):
        return
    root = Path(__file__).resolve().parents[2]
    target = os.path.join(tempfile.mkdtemp(prefix="tickforge-"), "tickforge_pkg.zip")
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted((root / "tickforge").rglob("*.py")):
            z.write(p, p.relative_to(root))
        for p in [root / "corpus_pipeline.py"]:
            if p.exists():
                z.write(p, p.name)
    sc.addPyFile(target)
    sc._tickforge_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir.

    Where the setting is missing, a local session makes one of its own; on a
    cluster there is no folder that all machines are known to share.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tickforge-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/tickforge-{uuid.uuid4().hex}"


def settle(spark: SparkSession, df: DataFrame, name: str = "t") -> DataFrame:
    """df written to the shared folder and read again: cuts the lineage there."""
    path = f"{shared_dir(spark)}/{name}"
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a settled table that nothing reads any more."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        where = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of jobs that are done."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_only(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of documents, whatever other columns there are."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def named(column: str) -> str:
    """A column's name as SQL takes it, whatever is in it."""
    return f"`{column.replace('`', '``')}`"


def rest_of(docs: DataFrame):
    """The columns beside doc_id and text as a struct; one with the field _ where there is none."""
    others = [docs[named(c)].alias(c) for c in docs.columns if c not in ("doc_id", "text")]
    return F.struct(*others or [F.lit(0).alias("_")]).alias("rest")


def with_rest(docs: DataFrame) -> DataFrame:
    """doc_id, text and rest, a struct of the other columns, whatever their names."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), rest_of(docs))


def more_fields(schema: StructType, **kinds: DataType) -> StructType:
    """The schema with further fields; a schema object, as names may hold what a DDL string cannot."""
    return StructType([*schema.fields, *(StructField(n, k) for n, k in kinds.items())])


def reducers(spark: SparkSession, blocks: int) -> int:
    """Partitions of what is dealt out by hash: one for every two blocks of text at least, so that a task's share does not grow with the input."""
    return max(partitions(spark), blocks // 2)


def text_partitions(spark: SparkSession, docs: DataFrame, target: int = 16 << 20) -> int:
    """Partitions for work on whole texts: by their total size."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    return max(partitions(spark), -(-size // target))


def _bucket(x: np.ndarray, n: int) -> np.ndarray:
    """The bucket that Spark's hash (Murmur3, 32 bits, seed 42) gives int values."""
    u = lambda v: v & 0xFFFFFFFF
    turn = lambda v, k: u(v << k) | (v >> (32 - k))
    k = u(turn(u(x.astype(np.uint64) * np.uint64(0xCC9E2D51)), 15) * 0x1B873593)
    h = u(turn(42 ^ k, 13) * 5 + 0xE6546B64) ^ 4
    h = u((h ^ (h >> 16)) * 0x85EBCA6B)
    h = u((h ^ (h >> 13)) * 0xC2B2AE35)
    h ^= h >> 16
    return (h.astype(np.uint32).view(np.int32).astype(np.int64)) % n


#: Blocks that one bucketed table has at most (Spark refuses more than 100,000 buckets), and the range of their numbers.
SHELF, SHELF_RANGE = 32_768, 1 << 22


def shelf_slots(n: int, shelf: int = 0) -> np.ndarray:
    """n ints of a shelf's range, the k-th of which Spark's hash puts into bucket k of n."""
    out, at = np.full(n, -1, np.int64), shelf * SHELF_RANGE
    while (out < 0).any():
        x = np.arange(at, at + 16 * n + 64)
        b, first = np.unique(_bucket(x, n), return_index=True)
        new = out[b] < 0
        out[b[new]] = x[first[new]]
        at = x[-1] + 1
    return out.astype(np.int32)


def shelves(blocks: int) -> list[int]:
    """The number of blocks on each shelf."""
    return [min(SHELF, blocks - a) for a in range(0, max(1, blocks), SHELF)]


def slots(blocks: int) -> np.ndarray:
    """The number that each block is stored under: blocks fill the buckets of their shelf's table evenly."""
    return np.concatenate([shelf_slots(n, k) for k, n in enumerate(shelves(blocks))])


# --- packed arrays ---------------------------------------------------------

_MISSING = np.iinfo(np.int64).min


def ids(column: pa.Array) -> np.ndarray:
    """int64 values, null as the smallest."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.int64()).fill_null(_MISSING).to_numpy(zero_copy_only=False)


def id_array(values: np.ndarray) -> pa.Array:
    return pa.array(values, type=pa.int64(), mask=values == _MISSING)


def _planes(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def _from_planes(raw: bytes, dtype, n: int) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, n).T).view(dtype).ravel()


def pack(docs: np.ndarray, values: np.ndarray, hashes: np.ndarray | None = None, extra: np.ndarray | None = None, check: np.ndarray | None = None) -> bytes:
    """Arrays of equal length as bytes; docs and values (int32) are delta-coded and compressed.  check: further 32 bits of the hashes."""
    n = len(docs)
    step = np.diff(docs, prepend=np.int64(0))
    gap = np.where(step == 0, np.diff(values, prepend=np.int32(0)), values).astype(np.int32)
    body = _planes(step) + _planes(gap) + (extra.astype(np.uint8).tobytes() if extra is not None else b"")
    small = zstandard.ZstdCompressor(level=1).compress(body)
    head = np.array([n, len(small), (hashes is not None) + (check is not None), extra is not None], np.int64).tobytes()
    return head + small + (hashes.tobytes() if hashes is not None else b"") + (check.tobytes() if check is not None else b"")


def unpack(raw: bytes, hash_type=np.uint64) -> tuple[np.ndarray, np.ndarray, np.ndarray | None, np.ndarray | None, np.ndarray | None]:
    """(docs, values, hashes, extra, check)"""
    n, size, hashed, more = np.frombuffer(raw, np.int64, 4)
    body = zstandard.ZstdDecompressor().decompress(raw[32 : 32 + size])
    step = _from_planes(body[: 8 * n], np.int64, n)
    gap = _from_planes(body[8 * n : 12 * n], np.int32, n).astype(np.int64)
    docs = np.cumsum(step)
    # values restart at each document: the running sum less the sum before the document's first entry
    total, new = np.cumsum(gap), step != 0
    new[:1] = True
    start = np.flatnonzero(new)
    before = np.repeat(total[start] - gap[start], np.diff(np.append(start, n)))
    extra = np.frombuffer(body[12 * n : 13 * n], np.uint8) if more else None
    hashes = np.frombuffer(raw, hash_type, n, 32 + size) if hashed else None
    check = np.frombuffer(raw, np.uint32, n, 32 + size + 8 * n) if hashed == 2 else None
    return docs, (total - before).astype(np.int32), hashes, extra, check


def split_by(keys: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(key, indices) for each of the keys, which are below n, in order; the order inside a key is kept."""
    order = np.argsort(keys.astype(np.uint16 if n < 65536 else np.int64), kind="stable")
    own = keys[order]
    cuts = np.flatnonzero(np.append(True, own[1:] != own[:-1])) if len(own) else np.zeros(0, np.int64)
    for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(own)], strict=True) if len(own) else ():
        yield int(own[a]), order[a:b]


def ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which, index) of all index in lo[k]:hi[k]."""
    counts = hi - lo
    which = np.repeat(np.arange(len(lo)), counts)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(lo, counts)
