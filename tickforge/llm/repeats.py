"""Repeated windows of fixed length, found by difference-cover anchors.

A window of ``length`` symbols (words or bytes) that occurs at positions i and
j has, for a difference cover D modulo ``period``, a shift s < period such
that (i+s) mod period and (j+s) mod period both lie in D.  So both occurrences
share an *anchor*: a shorter string of length-period+1 symbols that starts at
a cover position.  Hashing only cover positions therefore loses no match.

Three passes over the texts, which are stored once, bucketed by document:

1. anchors are hashed and dealt out by hash; those seen twice go back to
   their documents;
2. around such anchors each match is extended: the full windows there are
   hashed, dealt out by hash (in ``rounds`` hash ranges, so that a range's
   shuffle is small) and compared;
3. the repeated windows go back to their documents.

Windows are equal where 96 bits of two independent hashes of them are; anchors,
which only narrow the search, go by 64.

Hot keys: each map task first settles what repeats inside its own data and
sends one entry per hash, so a passage in a third of all documents costs a
reducer one entry per map batch.  No pair of documents is ever emitted.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegerType, StructType

from tickforge.llm import scratch as S
from tickforge.llm.textcore import BYTE_VALUES, CHECK_BASE, Rolling, Words, mix, row_chunks

#: Entries a task gathers before it sends them.
BATCH = 1 << 20


@dataclass(frozen=True)
class Windows:
    """unit: word or byte.  later_only: the first start of a window is no repeat."""

    unit: str
    length: int
    period: int
    cover: tuple[int, ...]
    later_only: bool
    rounds: int = 1

    def __post_init__(self):
        missing = set(range(self.period)) - {(a - b) % self.period for a in self.cover for b in self.cover}
        if missing or self.length < self.period:
            raise ValueError(f"no difference cover: {sorted(missing)}")

    @property
    def anchor(self) -> int:
        return self.length - self.period + 1


class Symbols:
    """The symbols of a run of documents; those of document d are first[d]:first[d+1]."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, spec: Windows):
        if spec.unit == "byte":
            self.words, self.first = None, offsets
        else:
            self.words = Words(data, offsets)
            self.first = self.words.first
        self.data, self.counts = data, np.diff(self.first)

    @cached_property
    def symbols(self) -> np.ndarray:
        return self.words.hashes if self.words else BYTE_VALUES[self.data]

    @cached_property
    def roll(self) -> Rolling:
        return Rolling(self.symbols)

    def anchors(self, spec: Windows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, position in it, hash)"""
        row = np.repeat(np.arange(len(self.counts), dtype=np.int32), self.counts)
        at = np.arange(self.first[0], self.first[-1])
        pos = at - self.first[:-1][row]
        lut = np.zeros(spec.period, bool)
        lut[list(spec.cover)] = True
        keep = lut[pos % spec.period] & (pos + spec.anchor <= self.counts[row])
        at = at[keep]
        return row[keep], pos[keep].astype(np.int32), self.roll(at, at + spec.anchor)

    def marked(self, rows: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """For each symbol, whether it is in one of the ranges lo:hi of its document."""
        n, base = int(self.first[-1]), self.first[:-1][rows]
        edge = np.bincount(base + lo, minlength=n + 1) - np.bincount(base + hi, minlength=n + 1)
        return np.cumsum(edge[:n]) > 0

    def windows(self, spec: Windows, rows: np.ndarray, pos: np.ndarray, which: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(document, position, hash, check) of the windows that hold an anchor at (rows, pos) and whose hash is in range ``which`` of spec.rounds."""
        last = self.counts[rows] - spec.length + 1
        hi = np.minimum(pos.astype(np.int64) + 1, last)
        lo = np.minimum(np.maximum(0, pos.astype(np.int64) - (spec.length - spec.anchor)), hi)
        ok = hi > 0
        at = np.flatnonzero(self.marked(rows[ok], lo[ok], hi[ok]))
        h = self.roll(at, at + spec.length)
        if spec.rounds > 1:
            own = (h >> np.uint64(20)) % np.uint64(spec.rounds) == which
            at, h = at[own], h[own]
        row = np.repeat(np.arange(len(self.counts), dtype=np.int32), self.counts)[at]
        check = (Rolling(self.symbols, CHECK_BASE)(at, at + spec.length) >> np.uint64(32)).astype(np.uint32)
        return row, (at - self.first[:-1][row]).astype(np.int32), h, check


def repeated(docs: np.ndarray, pos: np.ndarray, hashes: np.ndarray, check: np.ndarray | None, many: np.ndarray | None, later_only: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, entry is a repeat, entry is the first of its hash), in an order by hash and check, with the least start first where later_only.  many: entry stands for further starts."""
    order = np.argsort(hashes)
    h = hashes[order]
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    if check is not None and len(h):
        c = check[order]
        if (~new[1:] & (c[1:] != c[:-1])).any():
            # different windows of one hash
            order = np.lexsort((check, hashes))
            h, c = hashes[order], check[order]
            new[1:] = (h[1:] != h[:-1]) | (c[1:] != c[:-1])
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, len(h)))
    if later_only:
        # only entries that share a hash need an order among themselves
        shared = np.flatnonzero(np.repeat(size > 1, size))
        own = order[shared]
        order[shared] = own[np.lexsort((pos[own], docs[own], *([] if check is None else [check[own]]), hashes[own]))]
    d, p = docs[order], pos[order]
    first = np.repeat(start, size)
    other = (d != d[first]) | (p != p[first])
    if later_only:
        return order, other, new
    twice = np.add.reduceat(other, start) > 0 if len(start) else np.zeros(0, bool)
    if many is not None and len(start):
        twice |= np.add.reduceat(many[order].astype(np.int64), start) > 0
    return order, np.repeat(twice, size), new


class Sender:
    """Gathers entries, settles what repeats among them, yields packed rows."""

    SCHEMA = "kind int, bucket int, payload binary"

    def __init__(self, buckets: int, blocks: int, later_only: bool):
        self.n, self.blocks, self.later_only, self.held, self.size = buckets, blocks, later_only, [], 0

    def add(self, block: np.ndarray, docs: np.ndarray, pos: np.ndarray, hashes: np.ndarray, check: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
        self.held.append((block, docs, pos, hashes, *([] if check is None else [check])))
        self.size += len(docs)
        if self.size >= BATCH:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.size:
            block, docs, pos, hashes, *more = (np.concatenate(x) for x in zip(*self.held, strict=True))
            check = more[0] if more else None
            order, again, new = repeated(docs, pos, hashes, check, None, self.later_only)
            rows = []
            keep = np.sort(order[new])
            many = np.zeros(len(docs), bool)
            many[order] = again
            settled = np.flatnonzero(many)
            for b, i in S.split_by((hashes[keep] >> np.uint64(32)) % np.uint64(self.n), self.n):
                i = keep[i]
                rows.append((0, b, S.pack(docs[i], pos[i], hashes[i], many[i], None if check is None else check[i])))
            for b, i in S.split_by(block[settled], self.blocks):
                i = settled[i]
                rows.append((1, b, S.pack(docs[i], pos[i])))
            yield as_batch(rows)
        self.held, self.size = [], 0


def as_batch(rows: list[tuple]) -> pa.RecordBatch:
    kind, bucket, payload = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(bucket, pa.int32()), pa.array(payload, pa.binary())], names=["kind", "bucket", "payload"])


def settle_bucket(blocks: int, later_only: bool) -> Callable:
    """Compares all entries of a partition; yields (block, payload) of the repeats."""
    slot = S.slots(blocks)

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, hits = [], []
        for batch in batches:
            for kind, raw in zip(batch["kind"].to_pylist(), batch["payload"], strict=True):
                docs, pos, *more = S.unpack(raw.as_py())
                if kind:
                    hits.append((docs, pos))
                else:
                    parts.append((docs, pos, *more))
        if parts:
            checked = parts[0][4] is not None
            docs, pos, hashes, many, *more = (np.concatenate(x) for x in zip(*(p[: 4 + checked] for p in parts), strict=True))
            parts.clear()
            order, again, _ = repeated(docs, pos, hashes, more[0] if checked else None, many, later_only)
            hit = order[again]
            hits.append((docs[hit], pos[hit]))
        if hits:
            docs, pos = (np.concatenate(x) for x in zip(*hits, strict=True))
            order = np.lexsort((pos, docs))
            docs, pos = docs[order], pos[order]
            out = [(slot[b], S.pack(docs[i], pos[i])) for b, i in S.split_by(block_of(docs, blocks), blocks)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int32()), pa.array([r[1] for r in out], pa.binary())], names=["block", "payload"])

    return f


def block_of(docs: np.ndarray, blocks: int) -> np.ndarray:
    """The block of each document, 0 to blocks - 1, by a hash of its id; tables have slots(blocks) of it."""
    return (mix(docs.view(np.uint64) + np.uint64(0x5851F42D4C957F2D)) % np.uint64(blocks)).astype(np.int64)


def flagged_rows(doc_ids: np.ndarray, payloads: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(row, position) for packed (document, position) entries that concern these rows."""
    if not payloads:
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    docs, pos = (np.concatenate(x) for x in zip(*(S.unpack(p)[:2] for p in payloads), strict=True))
    order = np.argsort(docs, kind="stable")
    docs, pos = docs[order], pos[order]
    which, index = S.ranges(np.searchsorted(docs, doc_ids, "left"), np.searchsorted(docs, doc_ids, "right"))
    return which, pos[index]


class Texts:
    """Documents by block, with their other columns as one struct, in bucketed tables (shelves), so that each later pass leaves the texts in place."""

    def __init__(self, shelves: list[DataFrame], blocks: int):
        self.shelves, self.blocks = shelves, blocks

    def rows(self) -> DataFrame:
        return reduce(DataFrame.unionByName, self.shelves)

    def beside(self, payloads: DataFrame, f: Callable, schema: StructType | str, *columns: str) -> DataFrame:
        """f(documents, payloads) for each block, of the documents' columns named (all without any)."""
        out = []
        for k, texts in enumerate(self.shelves):
            own = payloads if len(self.shelves) == 1 else payloads.where(F.col("block").between(k * S.SHELF_RANGE, (k + 1) * S.SHELF_RANGE - 1))
            texts = texts.select("block", *columns) if columns else texts
            out.append(texts.groupBy("block").cogroup(own.groupBy("block")).applyInArrow(f, schema))
        return reduce(DataFrame.unionByName, out)


def store(spark: SparkSession, docs: DataFrame) -> Texts:
    """Writes documents by block.  The tables' names are dropped at once: their files are what is read."""
    S.ship(spark)
    blocks = S.text_partitions(spark, docs)
    slot, sizes = S.slots(blocks), S.shelves(blocks)

    def f(batches):
        for b in batches:
            yield b.append_column("block", pa.array(slot[block_of(S.ids(b["doc_id"]), blocks)], pa.int32()))

    table = S.with_rest(docs)
    table = table.mapInArrow(f, S.more_fields(table.schema, block=IntegerType()))
    if len(sizes) > 1:
        # one pass deals the texts to their shelves
        folder, schema = f"{S.shared_dir(spark)}/shelves", table.schema
        table.withColumn("shelf", F.floor(F.col("block") / S.SHELF_RANGE).cast("int")).write.partitionBy("shelf").option("compression", "zstd").parquet(folder)
        whole = spark.read.schema(S.more_fields(schema, shelf=IntegerType())).parquet(folder)
    shelves = []
    for k, n in enumerate(sizes):
        own = table if len(sizes) == 1 else whole.where(F.col("shelf") == k).drop("shelf")
        name = f"tickforge_{uuid.uuid4().hex}"
        own.repartition(n, "block").write.bucketBy(n, "block").option("compression", "zstd").option("path", f"{S.shared_dir(spark)}/{name}").format("parquet").saveAsTable(name)
        shelves.append(spark.table(name))
        spark.sql(f"DROP TABLE {name}")
    S.release(spark)
    return Texts(shelves, blocks)


def sent(texts: DataFrame, f: Callable, n: int, blocks: int, later_only: bool) -> DataFrame:
    """(block, payload) of the entries that f's batches of (kind, bucket, payload) repeat."""
    return texts.mapInArrow(f, Sender.SCHEMA).repartitionById(n, F.col("bucket") % n).mapInArrow(settle_bucket(blocks, later_only), "block int, payload binary")


def find(spark: SparkSession, docs: DataFrame, spec: Windows) -> tuple[Texts, DataFrame, DataFrame]:
    """(texts by block, packed starts of repeated windows by block, those of repeated anchors), all stored in the shared folder."""
    texts = store(spark, docs)
    blocks = texts.blocks
    n = S.reducers(spark, blocks)

    def anchors(batches):
        out = Sender(n, blocks, False)
        for batch in batches:
            docs_of = S.ids(batch["doc_id"])
            for a, e, data, off in row_chunks(batch["text"]):
                row, pos, h = Symbols(data, off, spec).anchors(spec)
                d = docs_of[a:e][row]
                yield from out.add(block_of(d, blocks), d, pos, h)
        yield from out.flush()

    found = S.settle(spark, sent(texts.rows().select("doc_id", "text"), anchors, n, blocks, False), "anchors")
    S.release(spark)

    def extended(which: int):
        def f(left: pa.Table, right: pa.Table) -> pa.Table:
            out, made = Sender(n, blocks, spec.later_only), []
            docs_of = S.ids(left["doc_id"]) if len(left) else np.zeros(0, np.int64)
            rows, at = flagged_rows(docs_of, right["payload"].to_pylist())
            # documents without a repeated anchor have no repeated window
            some, rows = np.unique(rows, return_inverse=True)
            order = np.argsort(rows, kind="stable")
            rows, at, docs_of = rows[order], at[order], docs_of[some]
            for a, e, data, off in row_chunks(left["text"].take(pa.array(some))) if len(some) else ():
                lo, hi = np.searchsorted(rows, [a, e])
                row, pos, h, check = Symbols(data, off, spec).windows(spec, rows[lo:hi] - a, at[lo:hi], which)
                d = docs_of[a:e][row]
                made += out.add(block_of(d, blocks), d, pos, h, check)
            made += out.flush()
            return pa.Table.from_batches(made or [as_batch([])])

        return f

    starts = None
    for k in range(spec.rounds):
        sends = texts.beside(found, extended(k), Sender.SCHEMA, "doc_id", "text")
        part = S.settle(spark, sends.repartitionById(n, F.col("bucket") % n).mapInArrow(settle_bucket(blocks, spec.later_only), "block int, payload binary"), f"windows{k}")
        S.release(spark)
        starts = part if starts is None else starts.unionByName(part)
    return texts, starts, found


def apply(texts: Texts, starts: DataFrame, spec: Windows, f: Callable[..., dict], anchors: DataFrame | None = None, **columns: DataType) -> DataFrame:
    """doc_id, rest and the columns f(symbols, data, offsets, covered) makes of each run of documents; with anchors, f also gets what they cover."""

    n_kinds = 1 if anchors is None else 2

    def g(left: pa.Table, right: pa.Table) -> pa.Table:
        docs_of = S.ids(left["doc_id"]) if len(left) else np.zeros(0, np.int64)
        kinds, payloads = right["kind"].to_pylist(), right["payload"].to_pylist()
        flags = []
        for kind in range(n_kinds):
            rows, at = flagged_rows(docs_of, [p for k, p in zip(kinds, payloads, strict=True) if k == kind])
            order = np.argsort(rows, kind="stable")
            flags.append((rows[order], at[order].astype(np.int64), spec.anchor if kind else spec.length))
        made = []
        runs = row_chunks(left["text"]) if len(left) else [(0, 0, np.zeros(0, np.uint8), np.zeros(1, np.int64))]
        for a, e, data, off in runs:
            s, marks = Symbols(data, off, spec), []
            for rows, at, length in flags:
                lo, hi = np.searchsorted(rows, [a, e])
                marks.append(s.marked(rows[lo:hi] - a, at[lo:hi], at[lo:hi] + length))
            made.append(pa.table({"doc_id": left["doc_id"].slice(a, e - a), "rest": left["rest"].slice(a, e - a), **f(s, data, off, *marks)}))
        return pa.concat_tables(made)

    own = texts.shelves[0].schema
    payloads = starts.withColumn("kind", F.lit(0))
    if anchors is not None:
        payloads = payloads.unionByName(anchors.withColumn("kind", F.lit(1)))
    return texts.beside(payloads, g, S.more_fields(StructType([own["doc_id"], own["rest"]]), **columns))


def binary_column(data: np.ndarray, keep: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    """The kept bytes of each document."""
    total = np.zeros(len(data) + 1, np.int64)
    np.cumsum(keep, out=total[1:])
    cuts = total[offsets]
    return pa.Array.from_buffers(kind, len(offsets) - 1, [None, pa.py_buffer(cuts.astype(np.int32).tobytes()), pa.py_buffer(data[keep].tobytes())])
