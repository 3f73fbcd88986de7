"""N-gram Jaccard join, components, decontamination and search against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tickforge.llm import components, decontamination, jaccard_join, topk_search
from tickforge.llm.textcore import string_buffers


def near_copies(seed=4):
    r = random.Random(seed)
    words = [f"v{k}" for k in range(900)]
    out = []
    for _ in range(12):
        base = [r.choice(words) for _ in range(r.randint(3, 160))]
        out.append(" ".join(base))
        for _ in range(r.randint(0, 6)):
            w = list(base)
            for _ in range(r.randint(0, 4)):
                w[r.randrange(len(w))] = r.choice(words)
            if r.random() < 0.3:
                w = w[: int(len(w) * r.uniform(0.7, 1))]
            out.append(("  " if r.random() < 0.2 else " ").join(x.upper() if r.random() < 0.1 else x for x in w))
    passage = " ".join(r.choice(words) for _ in range(25))
    out += [passage + " " + " ".join(r.choice(words) for _ in range(60)) for _ in range(25)]
    return out + [None, "", "one two", "ONE two", "one  two", "one", " "]


def sets_of(texts, n=5):
    out = []
    for t in texts:
        w = (t or "").encode().lower().split()
        out.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    return out


def groups(texts):
    s = sets_of(texts)
    root = list(range(len(s)))
    changed = True
    links = [(a, b) for b in range(len(s)) for a in range(b) if s[a] and s[b] and 100 * len(s[a] & s[b]) >= 80 * len(s[a] | s[b])]
    while changed:
        changed = False
        for a, b in links:
            m = min(root[a], root[b])
            changed |= root[a] != m or root[b] != m
            root[a] = root[b] = m
    return [(len(x), r) for x, r in zip(s, root, strict=True)]


@pytest.mark.parametrize("seed", [4, 5])
def test_join_against_brute_force(spark, make, seed):
    texts = near_copies(seed)
    got = jaccard_join.join(spark, make(texts)).orderBy("doc_id").collect()
    assert [(r.n_shingles, r.component_id) for r in got] == groups(texts)


def test_join_cases(spark, make):
    t = " ".join(f"a{k}" for k in range(40))
    got = jaccard_join.join(spark, make([t], [(0, t, None, None, None, None, None, None), (None, t, None, None, None, None, None, None), (7, t, "", "", 0, "", "", 0)])).collect()
    assert sorted((str(r.doc_id), str(r.component_id)) for r in got) in ([("0", "0"), ("7", "0"), ("None", "None")], [("0", "0"), ("0", "0"), ("7", "0"), ("None", "None")])
    assert jaccard_join.join(spark, make([])).count() == 0


def test_sketches_lose_no_link():
    r = random.Random(6)
    words = [f"w{k}" for k in range(4000)]
    base = [r.choice(words) for _ in range(400)]
    texts = [" ".join(x if r.random() >= share else r.choice(words) for x in base) for share in (0, 0, 0.01, 0.02, 0.03, 0.04, 0.05, 0.08, 0.1, 0.2, 0.3) for _ in range(6)] + ["", "one two"]
    data, off = string_buffers(pa.array(texts))
    row, h = jaccard_join.ngram_sets(data, off, 5)
    sets, size = sets_of(texts), np.bincount(row, minlength=len(texts))
    a, b = np.triu_indices(len(texts), 1)
    may, same = jaccard_join.compared(a, b, size, *jaccard_join.sketch(row, h, len(texts)), 80)
    links = np.array([100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y]) for x, y in zip(a, b, strict=True)])
    assert may[links].all() and (same == [sets[x] == sets[y] for x, y in zip(a, b, strict=True)]).all()
    assert 20 < links.sum() < (~links).sum() and may[~links].mean() < 0.2


def test_what_is_sent_follows_the_input_alone():
    # a document's pairs are in a few groups, whatever their number
    a, b = np.zeros(5000, np.int64), np.arange(1, 5001)
    assert len(np.unique(jaccard_join.group_of(a, b, 12))) == 12 and jaccard_join.group_of(a, b, 12).max() < jaccard_join.groups_of(12) == 78
    # bytes of an n-gram with few and with many buckets
    row, pos = np.divmod(np.arange(600_000), 300)
    h = np.random.default_rng(1).integers(0, 2**63, len(row)).astype(np.uint64)
    each = []
    for n in (50, 600):
        out = jaccard_join.Shared(n, 5)
        each.append(sum(len(x) for batch in [*out.add(row, pos.astype(np.int32), h), *out.flush()] for x in batch["payload"].to_pylist()) / len(row))
    assert max(each) < 6.5


def test_components(spark):
    r = random.Random(0)
    edges = [(k, k + 1) for k in range(30)] + [(100, x) for x in range(101, 140)] + [(r.randint(200, 300), r.randint(200, 300)) for _ in range(60)]
    got = {x.u: x.component for x in components.components(spark, spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}
    find = lambda x: x if root.get(x, x) == x else find(root[x])
    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    assert got == {x: find(x) for e in edges for x in e if e[0] != e[1]}


_ITEM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_decontamination_against_brute_force(spark, make):
    r = random.Random(6)
    words = [f"u{k}" for k in range(60)] + ["É", "ß1"]
    items = [" ".join(r.choice(words) for _ in range(r.randint(1, 25))) for _ in range(12)] + [None, "", "--", "u1", "u1 u1 u1 u1 u1 u1 u1 u1 u1 u1 u1"]
    texts = []
    for _ in range(40):
        w = [r.choice(words) for _ in range(r.randint(0, 60))]
        if r.random() < 0.6:
            x = (r.choice(items) or "").split()
            w[len(w) // 2 : len(w) // 2] = x[r.randint(0, 2) :]
        texts.append(r.choice([" ", ", ", "-"]).join(x.upper() if r.random() < 0.2 and x.isascii() else x for x in w))
    texts += [None, "", "u1 " * 30, "..."]
    bench = spark.createDataFrame([(k, t) for k, t in enumerate(items)] + [(3, "u5 u6"), (None, "u2"), (1, items[1])], "item_id long, text string")
    known = [(k, _ITEM.findall((t or "").translate(_LOW))) for k, t in [*enumerate(items), (3, "u5 u6")]]
    want = []
    for t in texts:
        w, hit, ids = _ITEM.findall((t or "").translate(_LOW)), set(), set()
        for k, x in known:
            n = min(10, len(x))
            for i in range(len(x) - n + 1) if n else ():
                for s in range(len(w) - n + 1):
                    if w[s : s + n] == x[i : i + n]:
                        ids.add(k)
                        hit |= set(range(s, s + n))
        want.append((len(w), len(hit), sorted(ids)))
    got = decontamination.exact_matches(spark, make(texts), bench).orderBy("doc_id").collect()
    assert [(g.n_words, g.n_hit, sorted(g.item_ids)) for g in got] == want
    assert all(g.n_hit == 0 for g in decontamination.exact_matches(spark, make(texts[:3]), bench.limit(0)).collect())
    assert decontamination.exact_matches(spark, make([]), bench).count() == 0


def test_proximity(spark, make):
    bench = spark.createDataFrame([(1, "alpha beta gamma delta")], "item_id long, text string")
    got = decontamination.proximity_matches(spark, make(["x alpha y beta gamma z delta", "delta gamma beta alpha", "alpha beta x x x x x x x x gamma delta"]), bench, slop=3).collect()
    assert {r.doc_id for r in got} == {0, 1}


def test_proximity_against_brute_force(spark, make):
    """A document and an item meet where some span of a window's length plus slop holds all its words."""
    r = random.Random(11)
    words = [f"p{k}" for k in range(25)]
    items = [" ".join(r.choice(words) for _ in range(r.randint(1, 8))) for _ in range(10)] + [None, "..."]
    texts = [" ".join(r.choice(words) for _ in range(r.randint(0, 40))) for _ in range(30)] + [None, "", items[0], items[1].upper() + " x " + items[2]]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    want = set()
    for d, text in enumerate(texts):
        w = _ITEM.findall((text or "").translate(_LOW))
        for k, item in enumerate(items):
            x = _ITEM.findall((item or "").translate(_LOW))
            n = min(4, len(x))
            for need in ({*x[i : i + n]} for i in range(len(x) - n + 1) if n):
                if any(need <= {*w[s : s + n + 2]} for s in range(len(w))):
                    want.add((d, k))
    got = decontamination.proximity_matches(spark, make(texts), bench, width=4, slop=2).collect()
    assert {(g.doc_id, g.item_id) for g in got} == want and len(want) > 20


def test_index(spark, make):
    got = decontamination.index(make(["a b a", None])).collect()
    assert sorted((r.term, r.doc_id, r.pos) for r in got) == [("a", 0, 0), ("a", 0, 2), ("b", 0, 1)]


@pytest.mark.parametrize("terms", [2_000_000, 300])
def test_search_against_brute_force(spark, make, monkeypatch, terms):
    r = random.Random(8)
    words = [f"t{int(r.paretovariate(0.8))}" for _ in range(3000)]
    texts = [" ".join(r.choice(words) for _ in range(r.randint(0, 50))) for _ in range(80)] + [None, "", "zzz"]
    texts += texts[:4] * 4
    monkeypatch.setattr(topk_search, "ROUND_TERMS", terms)
    d = make(texts)
    tf = [Counter((t or "").encode().lower().split()) for t in texts]
    size = [sum(c.values()) for c in tf]
    mean, df = sum(size) / len(tf), Counter(w for c in tf for w in c)
    want = []
    for q in range(0, len(tf), 5):
        s = []
        for k, c in enumerate(tf):
            x = sum(math.log(1 + (len(tf) - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * size[k] / mean)) for w in tf[q] if w in c)
            if x:
                s.append((-round(x, 7), k))
        want.append((q, [round(-x, 6) for x, _ in sorted(s)[:6]]))
    got = topk_search.search(spark, d, d.where("doc_id % 5 = 0"), k=6).orderBy("query_id", "rank").collect()
    for q, scores in want:
        assert [round(g.score, 6) for g in got if g.query_id == q] == pytest.approx(scores, abs=2e-6)
    assert topk_search.search(spark, make([]), make(["a"]), k=3).count() == 0
    assert topk_search.search(spark, make(["a"]), make([]), k=3).count() == 0


def test_search_reads_fewer_postings_than_there_are(spark, make):
    r = random.Random(3)
    texts = [f"{'rare ' * (k % 97 == 5)}{' '.join(r.choice(['a', 'b', 'c', 'd']) for _ in range(r.randint(3, 30)))}" for k in range(3000)]
    row = topk_search.build_index(make(texts).select("doc_id", "text").coalesce(1)).collect()[0]
    shard = topk_search.Shard(row.terms, row.counts, row.postings, row.words / row.docs)
    words = sorted((int(topk_search.term_counts(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w)]))[1][0]), w) for w in ("rare", "a", "b"))
    terms = np.array([h for h, _ in words], np.uint64)
    df = [sum(w in t.split() for t in texts) for _, w in words]
    weights = np.array([math.log(1 + (3000 - n + 0.5) / (n + 0.5)) for n in df])
    docs, score = shard.search(terms, weights, 5)
    assert shard.scored < sum(df) / 2
    want = []
    for k, t in enumerate(texts):
        c, n = Counter(t.split()), len(t.split())
        want.append((-sum(x * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * n / (row.words / row.docs))) for x, (_, w) in zip(weights, words, strict=True) if c[w]), k))
    best = sorted((round(s, 9), k) for s, k in want)[:5]
    assert [-s for s, _ in best] == pytest.approx(list(score), abs=1e-8)
    assert len(shard.search(terms, weights, 5, floor=1e9)[0]) == 0


@pytest.mark.parametrize(("block", "dense", "cells", "batch"), [(2048, 40, 24_000_000, 128), (64, 10, 24_000_000, 7), (64, 40, 640, 128), (1, 1, 10**6, 3)])
def test_queries_searched_together_get_what_each_gets_alone(spark, make, monkeypatch, block, dense, cells, batch):
    for name, x in (("BLOCK", block), ("DENSE", dense), ("CELLS", cells), ("BATCH", batch)):
        monkeypatch.setattr(topk_search, name, x)
    r = random.Random(21)
    # two languages without a common word, and copies, whose scores tie
    texts = [" ".join(f"{'ab'[k % 2]}{int(r.paretovariate(0.7)) % 500}" for _ in range(r.randint(0, 60))) for k in range(700)]
    texts += texts[:5] * 20
    row = topk_search.build_index(make(texts).select("doc_id", "text").coalesce(1)).collect()[0]
    shard = topk_search.Shard(row.terms, row.counts, row.postings, row.words / row.docs)
    ids = lambda t: topk_search.term_counts(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)]))[1]
    df = Counter(int(h) for t in texts for h in ids(t))
    norm = {k: 1.2 * (0.25 + 0.75 * len(t.split()) / (row.words / row.docs)) for k, t in enumerate(texts)}
    weight = lambda h: math.log(1 + (len(texts) - df[h] + 0.5) / (df[h] + 0.5))
    tf = [Counter({int(ids(w)[0]): c for w, c in Counter(t.split()).items()}) for t in texts]
    queries = [ids(texts[q]) for q in range(0, 800, 9)] + [ids("zzz"), ids("")]
    floors, want = [], []
    for j, t in enumerate(queries):
        own = [int(h) for h in t]
        s = sorted((-round(x, 9), k) for k, c in enumerate(tf) if (x := sum(weight(h) * c[h] * 2.2 / (c[h] + norm[k]) for h in own if c[h])))
        floors.append((0.0, -s[3][0] - 1e-7, -s[-1][0])[j % 3] if len(s) > 9 else 0.0)
        want.append([(k, -x) for x, k in s[:6] if -x >= floors[-1]])
    got = []
    cuts = topk_search.batches_of([len(t) for t in queries])
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        got += shard.search_all([(shard.places(t), np.array([weight(int(h)) for h in t])) for t in queries[lo:hi]], 6, np.array(floors[lo:hi]))
    assert len(got) == len(want) and sum(map(len, want)) > 300
    for (docs, score), own in zip(got, want, strict=True):
        assert [x for _, x in own] == pytest.approx(score.tolist(), abs=2e-9)
        assert sorted(k for k, x in own if x > own[-1][1] + 1e-8) == sorted(k for k, x in zip(docs.tolist(), score.tolist(), strict=True) if x > own[-1][1] + 1e-8)


def test_search_passes_over_blocks_that_cannot_reach_the_floor(spark, make):
    r = random.Random(4)
    # short texts of common words beside long ones of rare words: under a floor, only the latter are read
    texts = [" ".join(r.choice("abcd") for _ in range(r.randint(3, 9))) for _ in range(5000)] + [" ".join(f"x{r.randint(0, 40)}" for _ in range(40)) + " a b" for _ in range(60)]
    row = topk_search.build_index(make(texts).select("doc_id", "text").coalesce(1)).collect()[0]
    shard = topk_search.Shard(row.terms, row.counts, row.postings, row.words / row.docs)
    weights = np.log(1 + 5060 / np.maximum(np.frombuffer(topk_search._un(row.counts, np.int32), np.int32), 1))
    all_lists = np.arange(len(shard.terms))
    free = shard.search_all([(all_lists, weights)], 5, np.zeros(1))[0]
    floor = float(free[1][-1])
    before = shard.scored
    docs, score = shard.search_all([(all_lists, weights)], 5, np.array([floor]))[0]
    assert docs.tolist() == free[0].tolist() and score.tolist() == free[1].tolist()
    assert shard.scored - before < len(shard.doc) / 3
    # nothing below the floor is returned
    assert shard.search(shard.terms, weights, 5, floor + 1e-6)[1].tolist() == [x for x in score if x >= floor + 1e-6]
