"""Exact top-k search: BM25 over an inverted index with block-max WAND.

Each shard (a run of documents) has its own inverted index in document order;
each list knows its largest impact in each block of BLOCK like documents.  Under
a floor, the k-th best score known so far, block maxima rule out the blocks that
cannot reach it.  In the others rare terms are added first; where documents can
still reach the floor with the maxima of the block's frequent terms, those are
added by one matrix product for many like queries.  What is left is scored
exactly.  A floor rises from block to block, and from shard to shard of a task.
Document frequencies, the number of documents and their mean length are those of
all shards, so shards' results merge exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.llm import scratch as S
from tickforge.llm.textcore import LOWER_VALUES, SPACE, U64, Words, row_chunks

K1, B = 1.2, 0.75
#: Documents of a block; entries of at least one in DENSE of them are dense rows, for at most CELLS cells of a shard.
BLOCK, DENSE, CELLS = 2048, 40, 24_000_000
#: Documents and postings of one shard, about, and terms of one round of queries.
SHARD, POSTINGS, ROUND_TERMS = 8192, 1 << 22, 6_000_000
#: Shards that a task searches one after the other, at least and at most.
TOGETHER = 4, 32
#: Queries that a shard takes together, and their terms, about; how much dearer a posting is that is read for one document alone.
BATCH, BATCH_TERMS, ALONE = 256, 1 << 18, 8
#: How much dearer a posting is than a cell of a matrix product.
FEW = 500
#: Share of a query's whole bound that each addition may be off by (single precision, rounded up).
ROUNDED = 7e-8
_SHARD_SCHEMA = "docs long, words long, terms binary, counts binary, postings binary"


def term_counts(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, count) of distinct lower-cased words by row and term, and each row's words."""
    w = Words(data, off, SPACE, LOWER_VALUES)
    row = w.row_of()
    order = np.lexsort((w.hashes, row))
    row, h = row[order], w.hashes[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    return row[first], h[first], np.diff(np.append(first, len(h))), w.counts


def _z(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(S._planes(x)) if len(x) else b""


def _un(raw: bytes, dtype) -> np.ndarray:
    if not raw:
        return np.zeros(0, dtype)
    x = zstandard.ZstdDecompressor().decompress(raw)
    return S._from_planes(x, dtype, len(x) // np.dtype(dtype).itemsize)


def build_index(docs: DataFrame) -> DataFrame:
    """One row per shard: its documents and words, terms with their document counts, and postings."""

    def f(batches):
        held: list = []
        n = size = 0

        def out():
            nonlocal n, size
            if held:
                ids, lens, row, h, c = (np.concatenate(x) for x in zip(*held, strict=True))
                held.clear()
                n = size = 0
                # like documents side by side: by their most frequent word, then their length
                top = np.zeros(len(ids), U64)
                if len(row):
                    order = np.lexsort((h, c, row))
                    last = np.flatnonzero(np.append(row[order][1:] != row[order][:-1], True))
                    top[row[order][last]] = h[order][last]
                place = np.empty(len(ids), np.int64)
                by = np.lexsort((ids, lens, top))
                place[by] = np.arange(len(ids))
                row = place[row]
                order = np.lexsort((row, h))
                row, h, c = row[order].astype(np.int32), h[order], c[order].astype(np.int32)
                first = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, np.int64)
                each = np.diff(np.append(first, len(h))).astype(np.int32)
                parts = [_z(ids[by]), _z(lens[by].astype(np.int32)), _z(np.diff(row, prepend=np.int32(0))), _z(c)]
                postings = np.array([len(p) for p in parts], np.int64).tobytes() + b"".join(parts)
                yield pa.RecordBatch.from_arrays([pa.array([len(ids)]), pa.array([int(lens.sum())]), pa.array([_z(h[first])], pa.binary()), pa.array([_z(each)], pa.binary()), pa.array([postings], pa.binary())], names=["docs", "words", "terms", "counts", "postings"])

        for b in batches:
            ids = S.ids(b["doc_id"])
            for a, e, data, off in row_chunks(b["text"]):
                row, h, c, lens = term_counts(data, off)
                if n + e - a > SHARD or size + len(row) > POSTINGS:
                    yield from out()
                held.append((ids[a:e], lens, row + n, h, c))
                n, size = n + e - a, size + len(row)
        yield from out()

    return docs.mapInArrow(f, _SHARD_SCHEMA)


def kth(scores: np.ndarray, k: int) -> np.ndarray:
    """At most the k-th largest of each row: that of the larger ones of documents far apart."""
    while (half := scores.shape[1] // 2) >= 32 * k:
        scores = np.maximum(scores[:, :half], scores[:, half : 2 * half])
    return np.partition(scores, -k, axis=1)[:, -k] if scores.shape[1] >= k else np.zeros(len(scores), np.float32)


class Shard:
    """The index of one shard, its lists by term and, of the same postings, by document.

    A list's postings in one block are an entry.  Entries that hold a good part of
    their block's documents are kept as dense rows, which a matrix product reads
    for many queries at once.  ``scored`` counts the postings that searches have
    read.
    """

    def __init__(self, terms: bytes, counts: bytes, postings: bytes, mean: float):
        sizes = np.frombuffer(postings, np.int64, 4)
        at = np.cumsum([32, *sizes])
        part = [postings[at[k] : at[k + 1]] for k in range(4)]
        self.terms, size = _un(terms, U64), _un(counts, np.int32)
        self.ids, lens = _un(part[0], np.int64), _un(part[1], np.int32)
        self.doc, tf = np.cumsum(_un(part[2], np.int32), dtype=np.int32), _un(part[3], np.int32)
        self.scored = 0
        if not len(self.doc):
            return
        self.norm = K1 * (1 - B + B * lens / mean)
        self.impact = (tf * (K1 + 1) / (tf + self.norm[self.doc])).astype(np.float32)
        # entries, with the largest impact of each
        term, block = np.repeat(np.arange(len(size), dtype=np.int32), size), self.doc // np.int32(BLOCK)
        self.start = np.flatnonzero(np.append(True, (term[1:] != term[:-1]) | (block[1:] != block[:-1])))
        self.block, self.most = block[self.start], np.maximum.reduceat(self.impact, self.start)
        self.entry = np.searchsorted(self.start, np.append(0, np.cumsum(size, dtype=np.int64)))
        self.top = np.maximum.reduceat(self.most, self.entry[:-1]).astype(np.float64)
        self.end = np.append(self.start[1:], len(self.doc))
        # the same postings by document
        by = np.argsort(self.doc.astype(np.uint16) if len(self.ids) <= 1 << 16 else self.doc, kind="stable")
        self.own_term, self.own_tf = term[by], tf[by]
        self.own = np.append(0, np.cumsum(np.bincount(self.doc, minlength=len(self.ids))))
        self.weight = np.zeros(len(size))
        # dense rows of each block, of the fullest entries where not all have room
        self.blocks = -(-len(self.ids) // BLOCK)
        width = np.minimum(BLOCK, len(self.ids) - np.arange(self.blocks) * BLOCK)
        each = self.end - self.start
        full = np.flatnonzero(each >= np.maximum(8, width // DENSE)[self.block])
        if len(full) * BLOCK > CELLS:
            full = np.sort(full[np.argsort(-each[full], kind="stable")[: CELLS // BLOCK]])
        self.row = np.full(len(self.start), -1, np.int32)
        self.dense = []
        for b, x in enumerate(width.tolist()):
            e = full[self.block[full] == b]
            self.row[e] = np.arange(len(e))
            rows = np.zeros((len(e), x), np.float32)
            which, p = S.ranges(self.start[e], self.end[e])
            rows[which, self.doc[p] - b * BLOCK] = self.impact[p]
            self.dense.append(rows)

    def places(self, terms: np.ndarray) -> np.ndarray:
        """The list of each term, or -1."""
        i = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[i] == terms, i, -1)

    def exact(self, docs: np.ndarray) -> np.ndarray:
        """Scores of documents under the weights in self.weight, each summed in the order of terms."""
        which, p = S.ranges(self.own[docs], self.own[docs + 1])
        self.scored += len(p)
        w = self.weight[self.own_term[p]]
        asked = np.flatnonzero(w)
        which, p, w = which[asked], p[asked], w[asked]
        tf = self.own_tf[p]
        return np.bincount(which, weights=tf * (K1 + 1) / (tf + self.norm[docs][which]) * w, minlength=len(docs))

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int, floor: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
        """(document, score) of the shard's k best that reach floor, scores rounded to nine places, ties by doc_id; terms ascending."""
        return self.search_all([(self.places(terms), weights)], k, np.array([floor]))[0]

    def search_all(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int, floors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """search for several queries, of which each has its lists (-1: none) and their weights.

        Block-max WAND with all documents of the shard as cursors at once.  Blocks
        whose maxima together stay below a query's floor are never touched.  In the
        others, short entries are added first; where no document can reach the
        floor with the maxima of its block's dense rows, or few can, those rows are
        not read.  They are for the other queries together, from the blocks that
        promise most on, with floors that rise from block to block.  What can
        still reach the floor at the end is scored exactly.
        """
        nq, nd = len(queries), len(self.ids)
        none = np.zeros(0, np.int64), np.zeros(0)
        lists = np.concatenate([i for i, _ in queries])
        q = np.repeat(np.arange(nq), [len(i) for i, _ in queries])
        w = np.concatenate([x for _, x in queries])
        there = lists >= 0
        lists, q, w = lists[there], q[there], w[there]
        if not len(lists):
            return [none] * nq
        cut = np.searchsorted(q, np.arange(nq + 1))
        # what rounded sums may be off by: an error of 2**-24 for each addition
        slack = ROUNDED * (np.diff(cut) + 8) * np.bincount(q, weights=w * self.top[lists], minlength=nq) + 1e-9
        which, e = S.ranges(self.entry[lists], self.entry[lists + 1])
        cell, x = q[which] * self.blocks + self.block[e], w[which]
        most = np.bincount(cell, weights=x * self.most[e], minlength=nq * self.blocks)
        floor = floors.astype(np.float64)
        open_ = np.flatnonzero((most >= np.repeat(floor - slack, self.blocks))[cell])
        e, cell, x = e[open_], cell[open_], x[open_]
        # short entries
        dense = self.row[e] >= 0
        short = np.flatnonzero(~dense)
        lo = self.start[e[short]]
        each = self.end[e[short]] - lo
        p = np.repeat(lo - np.cumsum(each) + each, each)
        p += np.arange(len(p))
        self.scored += len(p)
        total = np.zeros((nq, nd), np.float32)
        np.add.at(total.reshape(-1), np.repeat(cell[short] // self.blocks * nd, each) + self.doc[p], np.repeat(x[short].astype(np.float32), each) * self.impact[p])
        low = np.flatnonzero(np.count_nonzero(total > floor[:, None].astype(np.float32), axis=1) >= k)
        floor[low] = np.maximum(floor[low], kth(total[low], k) - slack[low])
        # dense rows, block by block
        e, cell, x = e[dense], cell[dense], x[dense]
        by = np.argsort(cell % self.blocks, kind="stable")
        e, cell, x = e[by], cell[by], x[by]
        rest = np.bincount(cell, weights=x * self.most[e], minlength=nq * self.blocks).reshape(nq, self.blocks)
        sizes = np.bincount(cell, weights=self.end[e] - self.start[e], minlength=nq * self.blocks).reshape(nq, self.blocks)
        alone = ALONE * len(self.doc) / nd
        at = np.searchsorted(cell % self.blocks, np.arange(self.blocks + 1))
        best = np.zeros((nq, k), np.float32)
        for b in np.argsort(-rest.sum(0), kind="stable"):
            part, lo, hi = total[:, b * BLOCK : (b + 1) * BLOCK], at[b], at[b + 1]
            if lo == hi:
                continue
            need = floor - slack - rest[:, b]
            maybe = np.flatnonzero((rest[:, b] > 0) & (part.max(1) >= need))
            maybe = maybe[np.count_nonzero(part[maybe] >= need[maybe, None].astype(np.float32), axis=1) * alone > sizes[maybe, b]]
            if not len(maybe):
                continue
            to = np.full(nq, -1)
            to[maybe] = np.arange(len(maybe))
            i = to[cell[lo:hi] // self.blocks]
            read = np.flatnonzero(i >= 0)
            i, u, v = i[read], e[lo:hi][read], x[lo:hi][read]
            r, each = self.row[u], self.end[u] - self.start[u]
            self.scored += int(each.sum())
            now = part[maybe]
            # rows that few of the queries ask for are added posting by posting
            asked = np.bincount(r, minlength=len(self.dense[b]))
            few = asked[r] * each * FEW < now.size
            which, p = S.ranges(self.start[u[few]], self.end[u[few]])
            np.add.at(now.reshape(-1), (i[few] * now.shape[1] - b * BLOCK)[which] + self.doc[p], v[few].astype(np.float32)[which] * self.impact[p])
            i, r, v = i[~few], r[~few], v[~few]
            used = np.flatnonzero(np.bincount(r, minlength=len(asked)))
            back = np.zeros(len(asked), np.int64)
            back[used] = np.arange(len(used))
            weight = np.zeros((len(maybe), len(used)), np.float32)
            weight[i, back[r]] = v
            now += weight @ (self.dense[b] if len(used) == len(back) else self.dense[b][used])
            part[maybe] = now
            rest[maybe, b] = 0
            # the k best of the blocks read so far
            up = np.flatnonzero(now.max(1) > np.maximum(best[maybe].min(1), floor[maybe]))
            rows = maybe[up]
            best[rows] = np.partition(np.concatenate([best[rows], now[up]], axis=1), -k, axis=1)[:, -k:]
            floor[rows] = np.maximum(floor[rows], best[rows].min(1) - slack[rows])
        # a document found nowhere is no result
        need = np.maximum((floor - slack)[:, None] - rest, 1e-30).astype(np.float32)
        rows, docs = np.nonzero(total >= np.repeat(need, BLOCK, axis=1)[:, :nd])
        out, ends = [], np.searchsorted(rows, np.arange(nq + 1))
        for j in range(nq):
            found = docs[ends[j] : ends[j + 1]]
            if not len(found):
                out.append(none)
                continue
            i = lists[cut[j] : cut[j + 1]]
            self.weight[i] = w[cut[j] : cut[j + 1]]
            score = np.round(self.exact(found), 9)
            self.weight[i] = 0
            ids = self.ids[found]
            order = np.lexsort((ids, -score))[:k]
            order = order[(score[order] > 0) & (score[order] >= floors[j])]
            out.append((ids[order], score[order]))
        return out


def search(spark: SparkSession, docs: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, doc_id, score): the k best documents for each query, by BM25 over the query's distinct words.

    docs and queries have doc_id and text.  Scores are rounded to nine places;
    ties go to the smaller doc_id.  Documents that share no word with a query
    are no result, so a query may have fewer than k rows, and one without words
    (or with null text) has none.  Rows without doc_id are neither searched nor
    found; rows that repeat a doc_id are documents of their own.  Empty tables
    give an empty result.  Very long texts count whole, as documents and as
    queries.  Other columns are not read, whatever their names.

    Queries are taken in rounds of about ROUND_TERMS terms; a round is held by
    each task, so its size is bounded whatever their number.
    """
    S.ship(spark)
    docs = S.text_only(docs).where("doc_id is not null")
    index = S.settle(spark, build_index(docs), "index")
    n, words, shards = index.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0)), F.count(F.lit(1))).first()
    mean = max(1.0, words / max(1, n))

    def terms_of(batches):
        for b in batches:
            ids = b["doc_id"].to_pylist()
            for a, e, data, off in row_chunks(b["text"]):
                row, h, _, _ = term_counts(data, off)
                cut = np.searchsorted(row, np.arange(e - a + 1))
                yield pa.RecordBatch.from_arrays([pa.array(ids[a:e], pa.int64()), pa.array([h[cut[j] : cut[j + 1]].tobytes() for j in range(e - a)], pa.binary())], names=["q", "terms"])

    wanted = S.settle(spark, S.text_only(queries).where("doc_id is not null").mapInArrow(terms_of, "q long, terms binary"), "queries")
    # rounds by a hash of the query, each of about the same number of terms
    total = wanted.agg(F.coalesce(F.sum(F.octet_length("terms")), F.lit(0))).first()[0] // 8
    rounds = -(-total // ROUND_TERMS) or 1
    found = None
    for r in range(rounds):
        own = [(x["q"], np.frombuffer(x["terms"], U64)) for x in wanted.where(F.pmod(F.xxhash64("q"), F.lit(rounds)) == r).toLocalIterator() if len(x["terms"])]
        part = S.settle(spark, one_round(index, own, shards, n, mean, k), f"round{r}")
        found = part if found is None else found.unionByName(part)
    return found.select("query_id", F.posexplode("best").alias("pos", "b")).select("query_id", (F.col("pos") + 1).alias("rank"), F.col("b.doc_id").alias("doc_id"), (-F.col("b.minus")).alias("score"))


def batches_of(sizes: list[int]) -> list[int]:
    """Where batches of queries of these sizes begin, and the end of the last."""
    cuts, held = [0], 0
    for j, size in enumerate(sizes):
        if j - cuts[-1] == BATCH or (j > cuts[-1] and held + size > BATCH_TERMS):
            cuts.append(j)
            held = 0
        held += size
    return [*cuts, len(sizes)] if sizes else [0]


def merged(rows: DataFrame, k: int, *keys: str) -> DataFrame:
    """The k best of all lists of a key."""
    return rows.groupBy(*keys).agg(F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, k).alias("best"))


def one_round(index: DataFrame, queries: list[tuple[int, np.ndarray]], shards: int, n: int, mean: float, k: int) -> DataFrame:
    """Each task's k best for each query, with the global document frequencies of the queries' terms."""
    spark = index.sparkSession
    vocabulary = np.unique(np.concatenate([t for _, t in queries])) if queries else np.zeros(0, U64)
    known = spark.sparkContext.broadcast(vocabulary)
    piece = 1 << 16

    def frequencies(batches):
        v = known.value
        df = np.zeros(len(v), np.int64)
        for b in batches:
            for t, c in zip(b["terms"].to_pylist(), b["counts"].to_pylist(), strict=True):
                t, c = _un(t, U64), _un(c, np.int32)
                i = np.minimum(np.searchsorted(v, t), max(0, len(v) - 1))
                there = v[i] == t if len(v) else np.zeros(len(t), bool)
                df[i[there]] += c[there]
        parts = range(0, len(v), piece)
        yield pa.RecordBatch.from_arrays([pa.array([p // piece for p in parts], pa.int32()), pa.array([_z(df[p : p + piece]) for p in parts], pa.binary())], names=["piece", "payload"])

    def add(t: pa.Table) -> pa.Table:
        return pa.table({"piece": t["piece"].slice(0, 1), "payload": pa.array([_z(sum(_un(x.as_py(), np.int64) for x in t["payload"]))], pa.binary())})

    df = np.zeros(len(vocabulary), np.int64)
    for x in index.select("terms", "counts").mapInArrow(frequencies, "piece int, payload binary").groupBy("piece").applyInArrow(add, "piece int, payload binary").toLocalIterator():
        own = _un(x["payload"], np.int64)
        df[x["piece"] * piece : x["piece"] * piece + len(own)] = own
    # like queries side by side, by their two most widespread terms; a query's terms go by their place in the vocabulary
    placed = [(q, np.searchsorted(vocabulary, t).astype(np.int32)) for q, t in queries]
    placed.sort(key=lambda x: (*x[1][np.argsort(-df[x[1]], kind="stable")[:2]].tolist(), len(x[1]), x[0]))
    asked = spark.sparkContext.broadcast((placed, batches_of([len(i) for _, i in placed]), np.log(1 + (n - df + 0.5) / (df + 0.5))))

    def best(batches):
        # what a query has found in a task's first shards is its floor in the others
        queries, cuts, idf = asked.value
        floors = np.zeros(len(queries))
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        none = np.zeros(0, np.int64), np.zeros(0)
        for b in batches:
            for t, c, p in zip(b["terms"].to_pylist(), b["counts"].to_pylist(), b["postings"].to_pylist(), strict=True):
                shard = Shard(t, c, p, mean)
                if not len(shard.terms):
                    continue
                place = shard.places(known.value)
                for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                    found = shard.search_all([(place[i], idf[i]) for _, i in queries[lo:hi]], k, floors[lo:hi])
                    for j, (more, own) in enumerate(found, lo):
                        if len(more):
                            docs, score = held.get(j, none)
                            docs, score = np.concatenate([docs, more]), np.concatenate([score, own])
                            order = np.lexsort((docs, -score))[:k]
                            held[j] = docs[order], score[order]
                            if len(order) >= k:
                                floors[j] = score[order[-1]]
        if held:
            from pyspark import TaskContext

            found = [(queries[j][0], *held[j]) for j in sorted(held)]
            cuts = np.cumsum([0, *(len(f[1]) for f in found)])
            inner = pa.StructArray.from_arrays([pa.array(-np.concatenate([f[2] for f in found])), pa.array(np.concatenate([f[1] for f in found]))], names=["minus", "doc_id"])
            lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), inner)
            part = TaskContext.get().partitionId() % 64
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([part] * len(found), pa.int32()), lists], names=["query_id", "part", "best"])

    # tasks' lists meet in two steps, so that no key gathers those of all tasks
    together = min(max(TOGETHER[0], shards // (2 * spark.sparkContext.defaultParallelism)), TOGETHER[1])
    lists = index.select("terms", "counts", "postings").repartition(-(-shards // together) or 1).mapInArrow(best, "query_id long, part int, best array<struct<minus:double,doc_id:bigint>>")
    return merged(merged(lists, k, "query_id", "part"), k, "query_id")
