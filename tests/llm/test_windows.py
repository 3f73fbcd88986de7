"""Substring dedup and suffix-array dedup against brute force."""

import random
from collections import Counter

import numpy as np
import pytest

from tickforge.llm import repeats, substring_dedup, suffix_dedup
from tickforge.llm import scratch as S


def corpus(seed=1, n=60):
    r = random.Random(seed)
    words = [f"w{k}" for k in range(400)] + ["é", "x" * 50]
    passages = [[r.choice(words) for _ in range(r.randint(15, 90))] for _ in range(6)]
    out = []
    for _ in range(n):
        w = [r.choice(words) for _ in range(r.randint(0, 120))]
        for _ in range(r.randint(0, 2)):
            at = r.randint(0, len(w))
            w[at:at] = r.choice(passages)
        out.append(r.choice([" ", "  ", "\n"]).join(w))
    out += [out[3], out[3], None, "", " \t ", "same " * 300, "same " * 300, "q " * 3000]
    return out


def words_brute(texts, window):
    seen, out = set(), []
    for t in texts:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            if key in seen:
                gone[i : i + window] = [True] * window
            seen.add(key)
        out.append((b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode(), len(w), sum(gone)))
    return out


def bytes_brute(texts, length):
    b = [(t or "").encode() for t in texts]
    n = Counter(x[i : i + length] for x in b for i in range(len(x) - length + 1))
    out = []
    for x in b:
        gone = bytearray(len(x))
        for i in range(len(x) - length + 1):
            if n[x[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(g and (not k or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((bytes(c for c, g in zip(x, gone, strict=True) if not g), len(x), sum(gone), spans))
    return out


def test_words_against_brute_force(spark, make):
    texts = corpus()
    got = substring_dedup.remove_repeats(spark, make(texts)).orderBy("doc_id").collect()
    assert [(r.text, r.n_words, r.n_removed) for r in got] == words_brute(texts, 20)
    assert got[0]["rest"]["rest"] == "x" and got[0]["rest"]["block"] == "y"


def test_bytes_against_brute_force(spark, make):
    texts = corpus(2, 30)
    for rounds in (1, 3):
        got = suffix_dedup.remove_repeats(spark, make(texts), rounds=rounds).orderBy("doc_id").collect()
        assert [(bytes(r.kept), r.n_bytes, r.n_removed, r.n_spans) for r in got] == bytes_brute(texts, 400)


def test_repeated_and_nameless_rows(spark, make):
    long = " ".join(f"a{k}" for k in range(30))
    more = [(0, long, "en", "s", 0, "x", "y", 1), (None, long, "en", "s", 0, "x", "y", 1), (None, None, None, None, None, None, None, None)]
    got = substring_dedup.remove_repeats(spark, make([long, "b"], more)).collect()
    # the rows without doc_id come first; both rows of document 0 are one document
    assert sorted((r.doc_id is None, r.n_removed) for r in got) == [(False, 0), (False, 30), (False, 30), (True, 0), (True, 0)]
    got = suffix_dedup.remove_repeats(spark, make(["x" * 50 + "abc" * 200], [(0, "x" * 50 + "abc" * 200, "en", "s", 0, "x", "y", 1)])).collect()
    assert len({r.n_removed for r in got}) == 1


def test_empty_tables(spark, make):
    assert substring_dedup.remove_repeats(spark, make([])).count() == 0
    assert suffix_dedup.remove_repeats(spark, make([])).count() == 0


@pytest.mark.parametrize("q", [2, 3, 5, 7, 13, 17])
def test_difference_sets(q):
    n, d = suffix_dedup.difference_set(q)
    assert n == q * q + q + 1 and {(a - b) % n for a in d for b in d} == set(range(n))
    with pytest.raises(ValueError):
        repeats.Windows("word", 20, 7, (0, 1), True)


def test_packed_arrays_and_slots(spark):
    r = np.random.default_rng(0)
    for n in (0, 1, 500):
        docs = np.sort(r.integers(-(2**62), 2**62, n // 3 + 1))[r.integers(0, n // 3 + 1, n)]
        pos, h = r.integers(0, 9999, n).astype(np.int32), r.integers(0, 2**63, n).astype(np.uint64)
        d, p, x, m, _ = S.unpack(S.pack(docs, pos, h, h % np.uint64(2)))
        assert (d == docs).all() and (p == pos).all() and (x == h).all() and (m == h % 2).all()
    for n in (1, 7, 211):
        from pyspark.sql import functions as F

        k = spark.createDataFrame([(int(v),) for v in S.slots(n)], "v int").select(F.pmod(F.hash("v"), F.lit(n))).collect()
        assert [x[0] for x in k] == list(range(n))


def test_columns_with_any_name(spark, make):
    """Extra columns named like inner ones, with a dot, a backtick, or an underscore alone."""
    texts = corpus(5, 20)
    rows = [(k, t, 1, "d", "b", 2) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _ int, `a.b` string, `c``d` string, payload int")
    got = substring_dedup.remove_repeats(spark, docs).orderBy("doc_id").collect()
    assert [(r.text, r.n_words, r.n_removed) for r in got] == words_brute(texts, 20)
    assert got[0]["rest"].asDict() == {"_": 1, "a.b": "d", "c`d": "b", "payload": 2}
    assert suffix_dedup.remove_repeats(spark, docs).count() == len(texts)


def test_several_shelves(spark, make, monkeypatch):
    """More blocks than one bucketed table takes."""
    texts = corpus(6, 40)
    monkeypatch.setattr(S, "SHELF", 3)
    monkeypatch.setattr(S, "text_partitions", lambda spark, docs: 8)
    assert S.shelves(8) == [3, 3, 2] and len(set(S.slots(8).tolist())) == 8
    got = substring_dedup.remove_repeats(spark, make(texts)).orderBy("doc_id").collect()
    assert [(r.text, r.n_words, r.n_removed) for r in got] == words_brute(texts, 20)


def test_no_table_is_left(spark, make):
    substring_dedup.remove_repeats(spark, make(corpus(7, 10))).collect()
    assert [t.name for t in spark.catalog.listTables()] == [t.name for t in spark.catalog.listTables() if not t.name.startswith("tickforge_")]


def test_windows_of_one_hash_are_told_apart():
    """Equal 64-bit hashes: the check decides."""
    h, check = np.array([5, 5, 5, 7], np.uint64), np.array([1, 2, 1, 1], np.uint32)
    docs, pos = np.array([4, 3, 2, 1]), np.zeros(4, np.int32)
    order, again, new = repeats.repeated(docs, pos, h, check, None, True)
    assert order[again].tolist() == [0] and new.sum() == 3
    order, again, _ = repeats.repeated(docs, pos, h, check, None, False)
    assert sorted(order[again].tolist()) == [0, 2]


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    class Conf:
        get = staticmethod(lambda key, default: None)

    class Session:
        conf = Conf
        sparkContext = type("C", (), {"master": "spark://host:7077"})

    with pytest.raises(ValueError, match="checkpoint"):
        S.shared_dir(Session)


def test_shared_bytes_show_short_passages(spark, make):
    """n_shared: a passage below 400 bytes stays, but shows where both copies have anchors at positions of the cover."""
    r = random.Random(9)
    alone = lambda n: "".join(r.choices("abcdefgh ", k=n))
    passage = alone(350)
    texts = [passage + alone(300), alone(307) + passage, alone(900), "", passage[:60] + alone(200)]
    got = suffix_dedup.remove_repeats(spark, make(texts)).orderBy("doc_id").collect()
    assert [g.n_removed for g in got] == [0] * 5
    assert got[0].n_shared == got[1].n_shared > 200 and [g.n_shared for g in got[2:]] == [0, 0, 0]
