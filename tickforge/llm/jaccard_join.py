"""N-gram Jaccard join by vertical partitioning, and its components.

A document's n-grams are a set of hashes.  One global order of n-grams gives
each document a prefix; two documents that link share an n-gram of both
prefixes.  Documents without a shared prefix n-gram drop out; of the others
all n-grams are compared, and those with too few shared ones drop out too.
For the pairs that the lists of prefix n-grams then give, the order of hashes
is cut into fragments: each fragment of the sets goes to a task of its own,
which counts the partial overlaps of the pairs there, and a second shuffle
brings the partial counts together and sums them per pair.  Before that, pairs
are held against small sketches of their sets: a bound that no pair at the
threshold misses drops most of them, and equal sets link at once, so that whole
sets are only sent for what is left.

Links inside a group of near copies are far too many to list, and components
don't need them.  So round one cuts each list into classes of like sizes and
pairs each document only with the middle one of its class (first inside a map
task, then among those middle ones).  Round two takes, of the lists again, all
pairs whose documents are not yet in one component.  After it every pair that
shares a prefix n-gram is counted or already connected: the components are
exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.llm import repeats
from tickforge.llm import scratch as S
from tickforge.llm.components import components
from tickforge.llm.textcore import LOWER_VALUES, SPACE, Rolling, Words, mix, row_chunks

#: The order of hashes is cut into 2**FRAGMENT_BITS fragments.
FRAGMENT_BITS = 3
FRAGMENTS = 1 << FRAGMENT_BITS
#: Kinds of packed rows: parts of sets, pairs, what pairs ask for, sizes of sets, partial counts, sketches, links.
_SETS, _TWO, _ASKED, _SIZES, _PARTIAL, _SKETCHES, _LINKED = range(7)
#: Bits of a set's sketch, and how many pairs are compared at once.
SKETCH, COMPARED = 4096, 1 << 13
#: The n-grams that stand last in the order are found in a sample of about so many documents: those in HOT of them or more.
SAMPLE, HOT = 8000, 6
BATCH = 1 << 20
#: Pairs that a task holds at once in round two.
PAIRS = 1 << 17
#: Marks labels among packed flags, which begin with a count.
_LABELS = np.array([-1], np.int64).tobytes()
_OTHER = np.uint64(0xA0761D6478BD642F)
_PAIRS = "kind int, bucket int, payload binary"


def ngram_sets(data: np.ndarray, off: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct word n-grams of each document, by row and hash; fewer words than n are one n-gram."""
    w = Words(data, off, SPACE, LOWER_VALUES)
    roll = Rolling(w.hashes)
    row = w.row_of()
    at = np.arange(len(row))
    end = w.first[1:][row]
    keep = (at + n <= end) | (at == w.first[:-1][row])
    at, row = at[keep], row[keep]
    h = roll(at, np.minimum(at + n, end[keep]))
    # by row and hash in one sort; where hashes differ in their last bits alone, by both
    bits = max(1, int(len(off)).bit_length())
    key = (row.astype(np.uint64) << np.uint64(64 - bits)) | (h >> np.uint64(bits))
    order = np.argsort(key)
    key = key[order]
    if ((key[1:] == key[:-1]) & (h[order][1:] != h[order][:-1])).any():
        order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return row[new], h[new]


def prefixes(row: np.ndarray, h: np.ndarray, hot: np.ndarray, weight: np.ndarray, percent: int, alone: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, set size, place in all rows) of each set's prefix in the global order: n-grams that no other document has (alone) first, hot ones last, else by hash."""
    late = np.zeros(len(h), np.int64)
    if len(hot):
        i = np.minimum(np.searchsorted(hot, h), len(hot) - 1)
        late = np.where(hot[i] == h, weight[i], 0)
    if alone is not None:
        late = np.where(alone, -1, late)
    order = np.argsort((row << 32) + late, kind="stable")
    size = np.bincount(row)[row] if len(row) else row
    rank = np.arange(len(row)) - np.searchsorted(row, row)  # row is sorted, and the same in the new order
    at = order[rank < size - (-(-percent * size // 100)) + 1]
    return row[at], h[at], size[at], at


def count_sets(docs: DataFrame, n: int) -> DataFrame:
    """docs with n_shingles."""

    def f(batches):
        for b in batches:
            parts = [np.bincount(ngram_sets(data, off, n)[0], minlength=e - a) for a, e, data, off in row_chunks(b["text"])]
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(np.concatenate(parts) if parts else [], pa.int64())], names=["doc_id", "n_shingles"])

    return docs.select("doc_id", "text").mapInArrow(f, "doc_id long, n_shingles long")


def frequent(docs: DataFrame, n: int, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes that stand last, sorted, with their weight.  Only the order hangs on the sample, never a result; what comes to the driver is bounded by it."""
    share = min(1.0, SAMPLE / max(1, total))
    sample = docs.select("doc_id", "text").where(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1_000_000)) < int(share * 1_000_000))

    def f(batches):
        for b in batches:
            for _, _, data, off in row_chunks(b["text"]):
                h, c = np.unique(ngram_sets(data, off, n)[1], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c)], names=["h", "c"])

    found = sample.mapInArrow(f, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")).where(F.col("c") >= HOT).toPandas()
    h, c = found["h"].to_numpy(np.int64).view(np.uint64), found["c"].to_numpy(np.int64)
    order = np.argsort(h)
    return h[order], c[order]


class Shared:
    """Gathers a block's n-grams, settles what repeats among them, yields packed rows.

    A document goes by its rank among the block's, and a hash by its last 32
    bits inside its bucket, so that an n-gram takes some six bytes however many
    buckets there are.  Different n-grams of one bucket that end alike only make
    more documents be compared.
    """

    def __init__(self, buckets: int, block: int):
        self.n, self.block, self.held, self.size = buckets, block, [], 0

    def add(self, rank: np.ndarray, pos: np.ndarray, hashes: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.held.append((rank, pos, hashes))
        self.size += len(rank)
        if self.size >= BATCH:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.size:
            rank, pos, hashes = (np.concatenate(x) for x in zip(*self.held, strict=True))
            by = np.argsort((rank << 32) + pos)
            rank, pos, hashes = rank[by], pos[by], hashes[by]
            order, again, new = repeats.repeated(rank, pos, hashes, None, None, False)
            keep, many, head = np.sort(order[new]), np.zeros(len(rank), bool), np.array([self.block], np.int64).tobytes()
            many[order] = again
            rows = [(1, self.block % self.n, head + S.pack(rank[many], pos[many]))] if many.any() else []
            for b, i in S.split_by((hashes[keep] >> np.uint64(32)) % np.uint64(self.n), self.n):
                i = keep[i]
                rows.append((0, b, head + S.pack(rank[i], pos[i], hashes[i].astype(np.uint32), many[i])))
            yield repeats.as_batch(rows)
        self.held, self.size = [], 0


def settle_ranks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compares all entries of a partition; yields (block, payload) of the n-grams that several documents have, by rank and position."""
    parts, hits = [], []
    for batch in batches:
        for kind, bucket, raw in zip(batch["kind"].to_pylist(), batch["bucket"].to_pylist(), batch["payload"].to_pylist(), strict=True):
            rank, pos, h, many, _ = S.unpack(raw[8:], np.uint32)
            at = (np.frombuffer(raw, np.int64, 1) << 32) + rank
            if kind:
                hits.append((at, pos))
            else:
                parts.append((at, pos, h.astype(np.uint64) + (np.uint64(bucket) << np.uint64(32)), many))
    if parts:
        at, pos, h, many = (np.concatenate(x) for x in zip(*parts, strict=True))
        parts.clear()
        order, again, _ = repeats.repeated(at, pos, h, None, many, False)
        hits.append((at[order[again]], pos[order[again]]))
    if hits:
        at, pos = (np.concatenate(x) for x in zip(*hits, strict=True))
        order = np.lexsort((pos, at))
        at, pos = at[order], pos[order]
        block = at >> 32
        cuts = np.append(np.flatnonzero(np.append(True, block[1:] != block[:-1])), len(at)) if len(at) else [0]
        out = [(int(block[x]), S.pack(at[x:y] & 0xFFFFFFFF, pos[x:y])) for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int32()), pa.array([r[1] for r in out], pa.binary())], names=["block", "payload"])


class Lists:
    """Gathers (hash, doc, size, label); yields packed rows by hash, with local pairs beside them."""

    def __init__(self, buckets: int, cells: int, stars: bool, percent: int):
        self.n, self.cells, self.stars, self.percent, self.held, self.size = buckets, cells, stars, percent, [], 0

    def add(self, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.held.append(columns)
        self.size += len(columns[0])
        if self.size >= BATCH:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.size:
            h, docs, size, label = (np.concatenate(x) for x in zip(*self.held, strict=True))
            rows = []
            if self.stars:
                keep, a, b = star(h, docs, size, self.percent)
                rows += packed_pairs(a, b, self.cells)
                h, docs, size, label = h[keep], docs[keep], size[keep], label[keep]
            for k, i in S.split_by((h >> np.uint64(32)) % np.uint64(self.n), self.n):
                rows.append((0, k, S.pack(docs[i], size[i].astype(np.int32), h[i]) + (b"" if self.stars else label[i].tobytes())))
            yield repeats.as_batch(rows)
        self.held, self.size = [], 0


def star(h: np.ndarray, docs: np.ndarray, size: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entries that are a centre of their hash, pairs of the others with theirs).

    The documents of a hash, by size, are cut into classes whose sizes allow
    links; each class has its middle document as centre.
    """
    order = np.lexsort((docs, size, h))
    h, d, s = h[order], docs[order], size[order].astype(np.int64)
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(h))
    starts = [begin]
    at = begin[end - begin > 1]
    stop = end[end - begin > 1]
    while len(at):
        # the first entry of each hash that is too large for the class begun at ``at``
        limit = s[at] * 100 // percent
        lo, hi = at + 1, stop.copy()
        while (lo < hi).any():
            mid = (lo + hi) // 2
            fits = s[np.minimum(mid, len(s) - 1)] <= limit
            open_ = lo < hi
            lo = np.where(open_ & fits, mid + 1, lo)
            hi = np.where(open_ & ~fits, mid, hi)
        more = lo < stop
        at, stop = lo[more], stop[more]
        starts.append(at)
    begin = np.sort(np.concatenate(starts))
    count = np.diff(np.append(begin, len(h)))
    middle = np.repeat(begin + count // 2, count)
    other = d != d[middle]
    x, y = d[middle][other], d[other]
    return np.sort(order[begin + count // 2]), np.minimum(x, y), np.maximum(x, y)


def unique_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(a):
        return a, b
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[new], b[new]


def groups_of(cells: int) -> int:
    return cells * (cells + 1) // 2


def group_of(a: np.ndarray, b: np.ndarray, cells: int) -> np.ndarray:
    """The group of each pair, by the cells of both documents: whatever a document is paired with, it is in one group for each cell at most."""
    x, y = repeats.block_of(a, cells), repeats.block_of(b, cells)
    return groups_of(np.maximum(x, y)) + np.minimum(x, y)


def packed_pairs(a: np.ndarray, b: np.ndarray, cells: int) -> list[tuple]:
    """Rows of kind 1 by group."""
    a, b = unique_pairs(a, b)
    return [(1, g, a[i].tobytes() + b[i].tobytes()) for g, i in S.split_by(group_of(a, b, cells), groups_of(cells))] if len(a) else []


def read_pairs(payloads: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = [np.frombuffer(p, np.int64).reshape(2, -1) for p in payloads]
    a, b = np.concatenate(both, axis=1) if both else np.zeros((2, 0), np.int64)
    return unique_pairs(a, b)


def across(h: np.ndarray, docs: np.ndarray, size: np.ndarray, label: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of one hash whose labels differ and whose sizes allow a link; in blocks."""
    order = np.lexsort((docs, size, h))
    h, docs, size, label = h[order], docs[order], size[order], label[order]
    cuts = np.append(np.flatnonzero(np.append(True, h[1:] != h[:-1])), len(h))
    held, count = [], 0
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        if hi - lo < 2 or (label[lo:hi] == label[lo]).all():
            continue
        s, l, d = size[lo:hi], label[lo:hi], docs[lo:hi]
        end = np.searchsorted(s, s * 100 // percent, side="right")
        for k in range(hi - lo - 1):
            other = np.arange(k + 1, end[k])
            other = other[l[other] != l[k]]
            if len(other):
                held.append((np.minimum(d[other], d[k]), np.maximum(d[other], d[k])))
                count += len(other)
            if count > PAIRS:
                yield tuple(np.concatenate(x) for x in zip(*held, strict=True))
                held, count = [], 0
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


def paired(cells: int, stars: bool, percent: int) -> Callable:
    """From the lists of a partition to (1, group, pairs)."""

    def f(batches):
        parts = []
        for batch in batches:
            for kind, g, raw in zip(batch["kind"].to_pylist(), batch["bucket"].to_pylist(), batch["payload"], strict=True):
                raw = raw.as_py()
                if kind:
                    yield repeats.as_batch([(kind, g, raw)])
                    continue
                docs, size, h = S.unpack(raw if stars else raw[: _body(raw)])[:3]
                parts.append((h, docs, size, np.zeros(len(h), np.int64) if stars else np.frombuffer(raw[_body(raw) :], np.int64)))
        if parts:
            h, docs, size, label = (np.concatenate(x) for x in zip(*parts, strict=True))
            parts.clear()
            if stars:
                _, a, b = star(h, docs, size, percent)
                yield repeats.as_batch(packed_pairs(a, b, cells))
            else:
                for a, b in across(h, docs, size.astype(np.int64), label, percent):
                    yield repeats.as_batch(packed_pairs(a, b, cells))

    return f


def _body(raw: bytes) -> int:
    n, small, _, _ = np.frombuffer(raw, np.int64, 4)
    return int(32 + small + 8 * n)


def join(spark: SparkSession, docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles and component_id per input row.

    Two documents link when 100 * intersection >= percent * union of their
    sets of lower-cased (A-Z) word n-grams; component_id is the smallest doc_id
    reachable by links.  Null texts and texts without words have an empty set
    and no links.  Rows without doc_id link with nothing and get a null
    component.  Rows that repeat a doc_id count as one document, by one
    of its texts.  An empty table gives an empty result.  Very long texts are
    taken whole, in one task each.  A pair just at the threshold links.  Other
    columns are not read, whatever their names.
    """
    texts = repeats.store(spark, docs)
    blocks, rows = texts.blocks, texts.rows()
    hot, weight = frequent(rows, n, rows.count())
    width = S.reducers(spark, blocks)
    # pairs are dealt to so many groups that groups times fragments make as many tasks at least
    cells = next(c for c in range(1, width + 1) if groups_of(c) * FRAGMENTS >= width)

    def first_prefixes(batches):
        out = repeats.Sender(width, blocks, False)
        for batch in batches:
            ids = S.ids(batch["doc_id"])
            for a, e, data, off in row_chunks(batch["text"]):
                row, h, _, at = prefixes(*ngram_sets(data, off, n), hot, weight, percent)
                d = ids[a:e][row]
                known = d != S._MISSING
                yield from out.add(repeats.block_of(d[known], blocks), d[known], at[known].astype(np.int32), h[known])
        yield from out.flush()

    seen = S.settle(spark, repeats.sent(rows.select("doc_id", "text"), first_prefixes, width, blocks, False), "seen")
    S.release(spark)

    def whole_sets(left: pa.Table, right: pa.Table) -> pa.Table:
        made = []
        if len(left) and len(right):
            out, known = Shared(width, left["block"][0].as_py()), np.unique(S.ids(left["doc_id"]))
            for ids, data, off in flagged_texts(left, right):
                row, h = ngram_sets(data, off, n)
                made += out.add(np.searchsorted(known, ids)[row], (np.arange(len(row)) - np.searchsorted(row, row)).astype(np.int32), h)
            made += out.flush()
        return pa.Table.from_batches(made or [repeats.as_batch([])])

    sends = texts.beside(seen, whole_sets, _PAIRS, "doc_id", "text")
    shared = S.settle(spark, sends.repartitionById(width, F.col("bucket") % width).mapInArrow(settle_ranks, "block int, payload binary"), "shared")
    S.release(spark)

    def lists(stars: bool):
        """Prefix n-grams of the documents that share enough of their set with any others to link at all; labels come with the flags in round two."""

        def f(left: pa.Table, right: pa.Table) -> pa.Table:
            out, made = Lists(width, cells, stars, percent), []
            payloads = right["payload"].to_pylist()
            label_of = [p for p in payloads if p[:8] == _LABELS]
            flags = [p for p in payloads if p[:8] != _LABELS]
            known, labels = (np.concatenate(x) for x in zip(*(np.frombuffer(p, np.int64, -1, 8).reshape(2, -1) for p in label_of), strict=True)) if label_of else (np.zeros(0, np.int64), np.zeros(0, np.int64))
            order = np.argsort(known)
            known, labels = known[order], labels[order]
            for ids, data, off, rows, pos in flagged_texts(left, pa.table({"payload": pa.array(flags, pa.binary())}), True):
                row, h = ngram_sets(data, off, n)
                size = np.bincount(row, minlength=len(ids))
                first = np.append(0, np.cumsum(size))
                alone = np.ones(len(row), bool)
                alone[first[rows] + pos] = False
                met = np.bincount(row[~alone], minlength=len(ids))
                able = (100 * met >= percent * size)[row]
                r, x, s, at = prefixes(row, h, hot, weight, percent, alone)
                use = able[at] & ~alone[at]
                r, x, s = r[use], x[use], s[use]
                d = ids[r]
                if stars:
                    own = np.zeros(len(d), np.int64)
                else:
                    i = np.minimum(np.searchsorted(known, d), max(0, len(known) - 1))
                    own = np.where(known[i] == d, labels[i], d) if len(known) else d
                made += out.add(x, d, s, own)
            made += out.flush()
            return pa.Table.from_batches(made or [repeats.as_batch([])])

        return f

    def linked(flags: DataFrame, stars: bool, name: str) -> DataFrame:
        sent = texts.beside(flags, lists(stars), _PAIRS, "doc_id", "text")
        pairs = gathered(spark, sent.repartitionById(width, F.col("bucket") % width).mapInArrow(paired(cells, stars, percent), _PAIRS), groups_of(cells), blocks, name)
        pairs = S.settle(spark, sketched(texts, pairs, n, percent), f"{name}_left")
        S.release(spark)
        links = pairs.where(F.col("kind") == _LINKED).select("payload").mapInArrow(unpacked_links, "a long, b long")
        return overlaps(spark, texts, pairs, n, percent).unionByName(links)

    # Round one, then round two with the components so far.
    label = S.settle(spark, components(spark, linked(shared, True, "stars")), "label")
    more = linked(shared.unionByName(packed_labels(label, blocks)), False, "across")
    if not more.isEmpty():
        label = S.settle(spark, components(spark, label.select(F.col("u").alias("a"), F.col("component").alias("b")).unionByName(more)), "label")
    S.release(spark)
    out = count_sets(rows, n).join(label.withColumnRenamed("u", "doc_id"), "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def flagged_texts(left: pa.Table, right: pa.Table, with_flags: bool = False) -> Iterator[tuple]:
    """(ids, bytes, offsets) of runs of those documents of a block that have flags, each document once; with_flags: flags go by documents' ranks, and (row, position) of them come along."""
    if not len(left) or not len(right):
        return
    ids = S.ids(left["doc_id"])
    once = np.zeros(len(ids), bool)
    _, first, rank = np.unique(ids, return_index=True, return_inverse=True)
    once[first] = True
    which, pos = repeats.flagged_rows(rank if with_flags else ids, right["payload"].to_pylist())
    keep = once[which]
    which, pos = which[keep], pos[keep].astype(np.int64)
    order = np.argsort(which, kind="stable")
    which, pos = which[order], pos[order]
    want = np.unique(which)
    back = np.searchsorted(want, which)
    ids = ids[want]
    for a, e, data, off in row_chunks(left["text"].take(pa.array(want))):
        lo, hi = np.searchsorted(back, [a, e])
        yield (ids[a:e], data, off, back[lo:hi] - a, pos[lo:hi]) if with_flags else (ids[a:e], data, off)


def packed_labels(label: DataFrame, blocks: int) -> DataFrame:
    """(block, payload) of labels: the mark, then documents and components."""
    slot = S.slots(blocks)

    def f(batches):
        for b in batches:
            d, c = S.ids(b["u"]), S.ids(b["component"])
            rows = [(int(slot[k]), _LABELS + d[i].tobytes() + c[i].tobytes()) for k, i in S.split_by(repeats.block_of(d, blocks), blocks)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["block", "payload"])

    return label.select("u", "component").mapInArrow(f, "block int, payload binary")


def gathered(spark: SparkSession, found: DataFrame, width: int, blocks: int, name: str) -> DataFrame:
    """Distinct pairs by group (kind 1), and by block the (document, group) that they ask for (kind 2)."""

    slot = S.slots(blocks)

    def f(batches):
        held: dict[int, list[bytes]] = {}
        for b in batches:
            for g, raw in zip(b["bucket"].to_pylist(), b["payload"].to_pylist(), strict=True):
                held.setdefault(g, []).append(raw)
        for g in sorted(held):
            yield repeats.as_batch(asking(g, *read_pairs(held.pop(g)), slot))

    out = S.settle(spark, found.repartitionById(width, F.col("bucket") % width).mapInArrow(f, _PAIRS), name)
    S.release(spark)
    return out


def asking(g: int, a: np.ndarray, b: np.ndarray, slot: np.ndarray) -> list[tuple]:
    """A group's pairs (kind 1), and by block the documents that they ask for (kind 2)."""
    wanted = np.unique(np.concatenate([a, b]))
    return [(_TWO, g, a.tobytes() + b.tobytes())] + [(_ASKED, int(slot[k]), S.pack(wanted[i], np.full(len(i), g, np.int32))) for k, i in S.split_by(repeats.block_of(wanted, len(slot)), len(slot))]


def sketch(row: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(sketches, digests) of n sets.  Each n-gram turns one bit of its set's sketch, so two sketches differ in no more bits than their sets do in n-grams; digests are 128 bits of the whole set."""
    bit, bits = ((h >> np.uint64(20)) % np.uint64(SKETCH)).astype(np.int64), []
    for lo in range(0, n, 1024):
        hi = min(n, lo + 1024)
        x, y = np.searchsorted(row, [lo, hi])
        bits.append(np.packbits((np.bincount((row[x:y] - lo) * SKETCH + bit[x:y], minlength=(hi - lo) * SKETCH) & 1).astype(bool).reshape(-1, SKETCH), axis=1))
    total = np.zeros((2, len(h) + 1), np.uint64)
    np.cumsum([mix(h), mix(h ^ _OTHER)], axis=1, out=total[:, 1:])
    first = np.searchsorted(row, np.arange(n + 1))
    return np.concatenate(bits) if bits else np.zeros((0, SKETCH // 8), np.uint8), (total[:, first[1:]] - total[:, first[:-1]]).T.copy()


def compared(a: np.ndarray, b: np.ndarray, size: np.ndarray, bits: np.ndarray, digest: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(pair may link, its sets are equal) of pairs of rows: sets that differ in d n-grams at least share (size + size - d) / 2 of them at most."""
    may, same = np.zeros(len(a), bool), np.zeros(len(a), bool)
    words = bits.view(np.uint64)
    for k in range(0, len(a), COMPARED):
        x, y = a[k : k + COMPARED], b[k : k + COMPARED]
        both = size[x] + size[y]
        most = (both - np.bitwise_count(words[x] ^ words[y]).sum(1, dtype=np.int64)) // 2
        may[k : k + COMPARED] = 100 * most >= percent * (both - most)
        same[k : k + COMPARED] = (size[x] == size[y]) & (digest[x] == digest[y]).all(1)
    return may, same


def unpacked_links(batches):
    for batch in batches:
        for raw in batch["payload"]:
            a, b = np.frombuffer(raw.as_py(), np.int64).reshape(2, -1)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def asked_texts(left: pa.Table, right: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, Iterator[tuple[int, np.ndarray]]]]:
    """(ids, bytes, offsets, (group, rows that it asks for)) of runs of those documents of a block that pairs ask for, each document once."""
    if not len(left) or not len(right):
        return
    ids = S.ids(left["doc_id"])
    which, group = repeats.flagged_rows(ids, right["payload"].to_pylist())
    # repeated rows of one document: the first is enough
    want = np.unique(which)
    want = want[np.sort(np.unique(ids[want], return_index=True)[1])]
    own = np.isin(which, want)
    back, group = np.searchsorted(want, which[own]), group[own]
    part, ids = left["text"].take(pa.array(want)), ids[want]
    for a, e, data, off in row_chunks(part):
        own = (back >= a) & (back < e)
        r, g = back[own] - a, group[own]
        order = np.argsort(g, kind="stable")
        r, g = r[order], g[order]
        yield ids[a:e], data, off, ((k, r[np.searchsorted(g, k) : np.searchsorted(g, k, side="right")]) for k in np.unique(g).tolist())


def sketched(texts: repeats.Texts, pairs: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs whose sketches allow a link, with what they ask for, by group; pairs of equal sets are links (kind _LINKED)."""
    slot = S.slots(texts.blocks)

    def made_of(left: pa.Table, right: pa.Table) -> pa.Table:
        made = []
        for ids, data, off, asked in asked_texts(left, right):
            row, h = ngram_sets(data, off, n)
            size, (bits, digest) = np.bincount(row, minlength=len(ids)), sketch(row, h, len(ids))
            made += [(_SKETCHES, k, np.concatenate([ids[r, None].view(np.uint8), size[r, None].view(np.uint8), digest[r].view(np.uint8), bits[r]], axis=1).tobytes()) for k, r in asked]
        return pa.Table.from_batches([repeats.as_batch(made)])

    def left_over(t: pa.Table) -> pa.Table:
        kinds, raws = t["kind"].to_pylist(), t["payload"].to_pylist()
        a, b = read_pairs([r for k, r in zip(kinds, raws, strict=True) if k == _TWO])
        rows = np.frombuffer(b"".join(r for k, r in zip(kinds, raws, strict=True) if k == _SKETCHES), np.uint8).reshape(-1, 32 + SKETCH // 8)
        ids = rows[:, :8].copy().view(np.int64).ravel()
        order = np.argsort(ids)
        ids, rows = ids[order], rows[order]
        size, digest, bits = rows[:, 8:16].copy().view(np.int64).ravel(), rows[:, 16:32].copy().view(np.uint64), rows[:, 32:].copy()
        may, same = compared(np.searchsorted(ids, a), np.searchsorted(ids, b), size, bits, digest, percent)
        out, more = [(_LINKED, 0, a[same].tobytes() + b[same].tobytes())] if same.any() else [], may & ~same
        if more.any():
            out += asking(t["bucket"][0].as_py(), a[more], b[more], slot)
        return pa.Table.from_batches([repeats.as_batch(out)])

    wanted = pairs.where(F.col("kind") == _ASKED).select(F.col("bucket").alias("block"), "payload")
    rows = texts.beside(wanted, made_of, _PAIRS, "doc_id", "text").unionByName(pairs.where(F.col("kind") == _TWO))
    return rows.groupBy("bucket").applyInArrow(left_over, _PAIRS)


def segments(texts: repeats.Texts, pairs: DataFrame, n: int) -> DataFrame:
    """The sets that pairs ask for, cut into fragments: parts by (group, fragment), and the sets' sizes with the first."""

    def made_of(left: pa.Table, right: pa.Table) -> pa.Table:
        made = []
        for ids, data, off, asked in asked_texts(left, right):
            row, h = ngram_sets(data, off, n)
            size = np.bincount(row, minlength=len(ids))
            first = np.append(0, np.cumsum(size))
            for k, rs in asked:
                w, i = S.ranges(first[rs], first[rs + 1])
                d, x = ids[rs], h[i]
                parts = dict(S.split_by((x >> np.uint64(64 - FRAGMENT_BITS)).astype(np.int64), FRAGMENTS))
                sizes = np.array([len(d)], np.int64).tobytes() + d.tobytes() + size[rs].astype(np.int64).tobytes()
                for f in range(FRAGMENTS):
                    at = parts.get(f, np.zeros(0, np.int64))
                    if len(at) or not f:
                        # the first fragment brings the sizes of the sets along
                        made.append((_SETS, k * FRAGMENTS + f, (b"" if f else sizes) + S.pack(d[w[at]], np.zeros(len(at), np.int32), x[at])))
        return pa.Table.from_batches([repeats.as_batch(made)])

    wanted = pairs.where(F.col("kind") == _ASKED).select(F.col("bucket").alias("block"), "payload")
    return texts.beside(wanted, made_of, _PAIRS, "doc_id", "text")


def common(a: np.ndarray, b: np.ndarray, docs: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Sizes of the intersections for pairs sorted by a, of sets sorted by (docs, h)."""
    o = np.zeros(len(a), np.int64)
    lo_a, hi_a = np.searchsorted(docs, a), np.searchsorted(docs, a, side="right")
    lo_b, hi_b = np.searchsorted(docs, b), np.searchsorted(docs, b, side="right")
    cuts = np.append(np.flatnonzero(np.append(True, a[1:] != a[:-1])), len(a)) if len(a) else np.zeros(1, np.int64)
    for x, y in zip(cuts[:-1], cuts[1:], strict=True):
        own = h[lo_a[x] : hi_a[x]]
        for s in range(x, y, 4096) if len(own) else ():  # blocks of the documents paired with this one
            z = min(y, s + 4096)
            which, i = S.ranges(lo_b[s:z], hi_b[s:z])
            at = np.minimum(np.searchsorted(own, h[i]), len(own) - 1)
            o[s:z] = np.bincount(which, weights=own[at] == h[i], minlength=z - s)
    return o


def of_first(docs: np.ndarray, values: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Value at each document's first entry; 0 for documents that have none."""
    at = np.searchsorted(docs, which)
    there = np.append(docs, 0)[at] == which
    return np.where(there & (at < len(docs)), np.append(values, 0)[at], 0)


def overlaps(spark: SparkSession, texts: repeats.Texts, pairs: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) that link: partial overlaps are counted by (group of pairs, fragment), then summed per pair."""

    def counted(t: pa.Table) -> pa.Table:
        kinds, raws = t["kind"].to_pylist(), t["payload"].to_pylist()
        of = lambda kind: [r for k, r in zip(kinds, raws, strict=True) if k == kind]
        a, b = read_pairs(of(_TWO))
        group, fragment = divmod(t["bucket"][0].as_py(), FRAGMENTS)
        out, sets, sizes = [], of(_SETS), []
        if not fragment:
            ends = [8 + 16 * int(np.frombuffer(r, np.int64, 1)[0]) for r in sets]
            sizes, sets = [r[8:e] for r, e in zip(sets, ends, strict=True)], [r[e:] for r, e in zip(sets, ends, strict=True)]
        if len(a) and sets:
            docs, h = (np.concatenate(x) for x in zip(*(S.unpack(r)[::2][:2] for r in sets), strict=True))
            order = np.lexsort((h, docs))
            partial = S._planes(common(a, b, docs[order], h[order]).astype(np.int32))
            out.append((_PARTIAL, group, zstandard.ZstdCompressor(level=1).compress(partial)))
        if not fragment:
            out += [(_TWO, group, a.tobytes() + b.tobytes()), *((_SIZES, group, r) for r in sizes)]
        return pa.Table.from_batches([repeats.as_batch(out)])

    def summed(t: pa.Table) -> pa.Table:
        kinds, raws = t["kind"].to_pylist(), t["payload"].to_pylist()
        of = lambda kind: [r for k, r in zip(kinds, raws, strict=True) if k == kind]
        a, b = read_pairs(of(_TWO))
        docs, size = np.concatenate([np.frombuffer(r, np.int64).reshape(2, -1) for r in of(_SIZES)] or [np.zeros((2, 0), np.int64)], axis=1)
        order = np.argsort(docs)
        docs, size = docs[order], size[order]
        o = np.zeros(len(a), np.int64)
        for r in of(_PARTIAL):
            o += S._from_planes(zstandard.ZstdDecompressor().decompress(r), np.int32, len(a))
        ok = 100 * o >= percent * (of_first(docs, size, a) + of_first(docs, size, b) - o)
        return pa.table({"a": a[ok], "b": b[ok]})

    everywhere = pairs.where(F.col("kind") == _TWO).select("kind", F.explode(F.sequence(F.col("bucket") * FRAGMENTS, (F.col("bucket") + 1) * FRAGMENTS - 1)).alias("bucket"), "payload")
    partial = segments(texts, pairs, n).unionByName(everywhere).groupBy("bucket").applyInArrow(counted, _PAIRS)
    out = S.settle(spark, partial.groupBy("bucket").applyInArrow(summed, "a long, b long"), "linked")
    S.release(spark)
    return out
