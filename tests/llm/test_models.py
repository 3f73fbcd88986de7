"""Language ID, LM scoring, URL filter, toxicity and packing."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickforge.llm import bit_coder, language_id, lm_scoring, packing, queries, toxicity, url_filter
from tickforge.llm.queries import tokenizer_path
from tests.conftest import SF


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = language_id.identify(spark, docs).select("doc_id", "text", "rest.lang", "held_out", "lang_pred", "score").toPandas()
    held = out[out.held_out]
    assert len(held) > 10 and (held.lang == held.lang_pred).mean() > 0.95
    assert out.score.between(0, 1).all() and set(out.held_out) == {True, False}
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in zip(out.doc_id, out.held_out, strict=True))


def test_language_cases(spark, make):
    texts = ["the cat and the dog are in the house"] * 30 + [None, "", " 123 !?", "é", "a " * 60_000]
    out = {r.doc_id: r for r in language_id.identify(spark, make(texts)).collect()}
    assert [out[k].lang_pred for k in range(30, 35)] == ["und", "und", "und", "en", "en"]
    assert out[0].lang_pred == "en" and out[0]["rest"]["rest"] == "x" and out[30].score == 0
    nothing = language_id.identify(spark, make(["abc", None]).withColumn("lang", F.lit(None).cast("string"))).collect()
    assert [(r.lang_pred, r.score) for r in nothing] == [("und", 0), ("und", 0)]
    assert language_id.identify(spark, make([])).count() == 0
    same = language_id.identify(spark, make(["hola"], [(0, "hola", None, None, None, None, None, None), (None, "hola", "es", None, None, None, None, None)])).collect()
    assert len(same) == 3 and not [r for r in same if r.doc_id is None][0].held_out


def test_all_languages_are_learnt(spark, make):
    """More than 64, the last ones as rare as the rest."""
    r = random.Random(2)
    langs = [f"l{k:03}" for k in range(90)]
    rows = [(k, "".join(r.choices([chr(0x4E00 + 20 * (k % 90) + x) for x in range(20)], k=40)), langs[k % 90], None, None, None, None, None) for k in range(900)]
    out = language_id.identify(spark, make([], rows)).select("rest.lang", "held_out", "lang_pred").toPandas()
    assert set(out.lang_pred) == set(langs) and (out.lang == out.lang_pred).all()


def test_temperature_softens_overconfident_logits():
    r = np.random.default_rng(0)
    y = r.integers(0, 2, 500)
    logits = np.zeros((500, 2))
    right = r.random(500) < 0.7
    logits[np.arange(500), np.where(right, y, 1 - y)] = 20
    t = language_id.temperature(logits, y)
    p = language_id.softmax(logits / t).max(1).mean()
    assert abs(p - 0.7) < 0.05


def test_lm_against_counts(spark, make):
    r = random.Random(3)
    words = [f"W{int(r.paretovariate(0.7))}" for _ in range(400)] + ["é", "x" * 300]
    texts = [" \n".join(r.choice(words) for _ in range(r.randint(0, 60))) for _ in range(70)] + [None, "", " "]
    more = [(1, texts[1], None, None, None, None, None, None), (None, "w1 zz", None, None, None, None, None, None)]
    got = lm_scoring.score(spark, make(texts, more)).collect()
    rows = [*enumerate(texts), (1, texts[1]), (None, "w1 zz")]
    tokens = [(k, (t or "").encode().lower().split() + [b"\n"]) for k, t in rows]
    held = lambda k: k is not None and zlib.crc32(str(k).encode()) % 7 == 2
    c = Counter(w for k, t in tokens if k is not None and not held(k) for w in t)
    n, v = sum(c.values()), len(c)
    want = sorted((str(k), held(k), len(t), sum(c[w] > 0 for w in t), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), 6)) for k, t in tokens)
    assert sorted((str(g.doc_id), g.held_out, g.n_tokens, g.n_known, g.train_tokens, round(g.base_score, 6)) for g in got) == want
    assert all(g.score < 0 and g.bits_per_byte > 0 for g in got)
    assert lm_scoring.score(spark, make([])).count() == 0


def test_lm_counts_of_many_words_do_not_mix(spark, make):
    """Words that were seen five times cost little more than their share, however many there are."""
    r = random.Random(8)
    words = ["".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=12)) for _ in range(100_000)]
    texts = [" ".join(words[k : k + 400]) for _ in range(6) for k in range(0, len(words), 400)]
    held = lm_scoring.score(spark, make(texts)).where("held_out").agg(F.sum("score"), F.sum("n_tokens")).first()
    assert held[0] / held[1] > -8  # the share alone: -5


def lm_vocabulary(words, states, counts):
    """Vocabulary of words (bytes), each with a state and a count."""
    cuts = np.cumsum([0, *map(len, words)])
    data = np.frombuffer(b"".join(words), np.uint8)
    hashes = [hash(w) & (2**63 - 1) for w in words]
    return lm_scoring.Vocabulary.gather(np.array(hashes, np.uint64), np.array(states), np.array(counts), cuts[:-1], cuts[1:], data)


def lm_words(v):
    return [bytes(v.data[a:b]) for a, b in zip(v.cuts[:-1], v.cuts[1:], strict=True)]


def lm_contexts(word, i, state):
    """What each predictor sees before byte i of a word."""
    return [(k, knows, state if knows else None, word[max(0, i - k) if k else 0 : i]) for k, knows in lm_scoring.ORDERS]


def lm_counts(tokens):
    """Of (word with what follows it, state, times): how often a context came before a byte with some first bits."""
    out = Counter()
    for w, state, times in tokens:
        for i in range(len(w)):
            for c in lm_contexts(w, i, state):
                for j in range(9):
                    out[c, j, w[i] >> (8 - j)] += times
    return out


def test_lm_path_counts(spark):
    """Against counts by brute force, over chunks that share contexts."""
    r = random.Random(4)
    words = sorted({"".join(r.choices("abé", k=r.randint(1, 8))).encode() for _ in range(200)})
    v = lm_vocabulary(words, [r.randint(0, 2) for _ in words], [r.randint(0, 9) for _ in words])
    chunks = [v.take(np.arange(k, len(words), 3)) for k in range(3)]
    rows = spark.createDataFrame([(k, bytearray(c.pack()), bytearray(b"")) for k, c in enumerate(chunks)], "chunk long, payload binary, totals binary")
    want = lm_counts([(w + b" ", s, n) for w, s, n in zip(lm_words(v), v.state.tolist(), v.counts.tolist(), strict=True)])
    got = lm_scoring.with_paths(rows, 5).collect()
    assert len(got) == 3
    for g in got:
        part = lm_scoring.Vocabulary.unpack(bytes(g.payload))
        coded = lm_scoring.Coded(part)
        seen = lm_scoring.Paths(coded, lm_scoring._unpack_paths(bytes(g.paths)), 5)
        places = [(w + b" ", i, s) for w, s in zip(lm_words(part), part.state.tolist(), strict=True) for i in range(len(w) + 1)]
        for j in range(8):
            node, taken = seen(j)
            for o in range(len(lm_scoring.ORDERS)):
                assert node[o][coded.beginning].tolist() == [want[lm_contexts(w, i, s)[o], j, w[i] >> (8 - j)] for w, i, s in places]
                assert taken[o][coded.beginning].tolist() == [want[lm_contexts(w, i, s)[o], j + 1, w[i] >> (7 - j)] for w, i, s in places]


def lm_rounds(v):
    """The model of a vocabulary, in one process."""
    coded = lm_scoring.Coded(v)
    seen = lm_scoring.Paths(coded, lm_scoring.whole_paths(v), 1)
    weights = lm_scoring.START
    for _ in range(lm_scoring.ROUNDS):
        mixer = lm_scoring.Mixer(weights)
        mixer.learn(coded, seen, coded.weight(v.counts))
        model = mixer.model(mixer.sums())
        weights = model.weights.astype(np.float64)
    return model, mixer, coded, seen


def test_lm_mixer_learns_from_all_occurrences(spark):
    """However words are dealt to tasks, a few of them or very frequent ones, the weights are the same."""
    v = lm_vocabulary([b"the", b"of", b"rare", b"new"], [0, 1, 0, 0], [900_000, 50_000, 1, 0])
    rows = spark.createDataFrame([(k, bytearray(v.take(np.array([k])).pack()), bytearray(b"")) for k in range(4)], "chunk long, payload binary, totals binary")
    model, mixer, *_ = lm_rounds(v)
    got = lm_scoring.train(lm_scoring.with_paths(rows, 3), 3)
    assert mixer.seen.sum() == pytest.approx(8 * (900_000 * 4 + 50_000 * 3 + 5))
    assert got.weights == pytest.approx(model.weights, abs=1e-3) and got.refine == pytest.approx(model.refine, abs=1e-3)
    assert np.abs(got.weights).max() < 20


def test_lm_is_a_distribution():
    """Probabilities of all next bytes sum to 1, so do those of all words."""
    known, every = [b"ab", b"abc", b"b", b"abd"], [bytes([x]) for x in range(256)]
    v = lm_vocabulary([*known, *every], [0] * 260, [50, 20, 5, 1] + [0] * 256)
    model, _, coded, seen = lm_rounds(v)
    p = dict(zip(lm_words(v), 10 ** model.costs(coded, seen, len(v.words)), strict=True))
    assert sum(p[x] for x in every) < 1  # each is followed by a space
    assert p[b"ab"] > p[b"b"] > 1e-3 and sum(p.values()) < 1
    again = lm_scoring.Vocabulary.unpack(v.pack())
    assert all((getattr(again, c) == getattr(v, c)).all() for c in ("words", "state", "counts", "cuts", "data"))


def lm_corpus(seed=7, n=60):
    """Texts of two made languages."""
    r = random.Random(seed)
    tongues = [["".join(r.choices(letters, k=r.randint(1, 6))) for _ in range(80)] for letters in ("abcdefgh", "mnopqrstuvé")]
    texts = []
    for k in range(n):
        own = tongues[k % 2]
        texts.append(" \n".join(r.choice(own).upper() if r.random() < 0.1 else r.choice(own) for _ in range(r.randint(0, 40))))
    return [*texts, None, "", "x" * 60]


def test_lm_against_a_slow_scorer(spark, make):
    """Words one by one, bytes one by one, bits one by one, with counts from a dictionary; the learnt classes and weights are given."""
    texts = lm_corpus()
    train = [zlib.crc32(str(k).encode()) % 7 != 2 for k in range(len(texts))]
    docs = make(texts).withColumn("train", F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) != 2)
    known = lm_scoring.learn(spark, docs)
    states, model = known.states, known.model
    assert states.number >= 3

    def coded(text):
        """(word with what follows it, state) of each token."""
        low = bytes(x + 32 if 65 <= x <= 90 else x for x in (text or "").encode())
        votes, out = np.zeros(states.number - 1, np.int64), []
        for k, w in enumerate([*low.split(), b"\n"]):
            out.append((w if w == b"\n" else w + b" ", int(votes.argmax()) if k else states.number - 1))
            for x, y in zip(b" " + w[:-1], w, strict=True):
                votes += states.table[int(((x << 8 | y) * 0x9E3779B1 % 2**32) >> 22)]
        return out

    counts = lm_counts([(w, s, 1) for t, use in zip(texts, train, strict=True) if use for w, s in coded(t)])
    logistic = lambda z: 1 / (1 + math.exp(-z))

    def cost(w, state):
        total = 0.0
        for i, byte in enumerate(w):
            seen = lm_contexts(w, i, state)
            for j in range(8):
                node = [counts[c, j, byte >> (8 - j)] for c in seen]
                ones = [counts[c, j + 1, (byte >> (8 - j)) * 2 + 1] for c in seen]
                x = [min(14, max(-14, math.log((o + 0.2) / (n - o + 0.2)))) for n, o in zip(node, ones, strict=True)]
                step = [sum(n >= s for s in (1, 2, 4, 8, 16, 64, 256)) for n in node]
                coarse = [(s > 0) + (s > 3) for s in step]
                gate = ((step[-1] * 3 + coarse[-2]) * 3 + coarse[-3]) * 8 + j
                z = sum(float(a) * b for a, b in zip(model.weights[gate], x, strict=True))
                at = (min(7.999, max(-7.999, z)) + 8) * 2
                row = model.refine[w[i - 1] if i else 0]
                p = (row[int(at)] * (1 - at % 1) + row[int(at) + 1] * (at % 1) + logistic(z)) / 2
                p = min(1 - 1e-6, max(1e-6, p))
                total += math.log10(p if byte >> (7 - j) & 1 else 1 - p)
        return total

    want = [sum(cost(w, s) for w, s in coded(t)) for t in texts]
    got = [g.score for g in lm_scoring.score(spark, make(texts)).orderBy("doc_id").collect()]
    assert got == pytest.approx(want, rel=1e-4, abs=1e-3)


def test_lm_states_follow_the_text(spark, make):
    """A word's state is the class that the words before it speak for."""
    r = random.Random(9)
    first, second = (["".join(r.choices(letters, k=4)) for _ in range(40)] for letters in ("abcdefgh", "mnopqrst"))
    texts = [" ".join(r.choices(own, k=30)) for _ in range(100) for own in (first, second)]
    known = lm_scoring.learn(spark, make(texts).withColumn("train", F.lit(True)))

    def states(text):
        data = np.frombuffer(text.encode(), np.uint8)
        t = lm_scoring.Tokens.of(data, np.array([0, len(data)]), known.states)
        return (t.kind % t.states).tolist()

    a, b = (set().union(*(states(" ".join(own[k : k + 12]))[1:] for k in range(20))) for own in (first, second))
    assert not a & b
    mixed = states(" ".join(first[:4] + second[:20]))
    assert mixed[0] == known.states.number - 1 and mixed[1] in a and mixed[4] in a and mixed[-1] in b
    assert states("") == states("x")[:1] == [known.states.number - 1]
    # the same words cost less after words of their own language
    got = lm_scoring.score(spark, make([*texts, " ".join(first[:12]), " ".join([second[0], *first[1:12]])])).where(f"doc_id >= {len(texts)}").orderBy("doc_id").collect()
    assert got[0].score > got[1].score


def lm_slow_code(text, levels):
    """Bytes one by one, bits one by one; cells by their whole contexts, in dictionaries."""
    start = [(1, 0, 0, 0), (0.9, 0.2, 0, 0), (0.9, 0, 0.2, 0), (0.9, 0.1, 0.1, 0), (0.9, 0, 0, 0.3), (0.9, 0.1, 0, 0.2), (0.9, 0, 0.1, 0.2), (0.8, 0.1, 0.1, 0.3)]
    weights = {(g, k): list(start[g]) for g in range(8) for k in range(4)}
    squash = lambda z: 1 / (1 + math.exp(-z))
    table = {(c, k): squash(k * 0.75 - 12) for c in range(256) for k in range(33)}
    cells, total, word, before = {}, 0.0, b"", b""
    for at, byte in enumerate(text):
        contexts = [(b"   " + text[:at])[-3:], (1, word), (before, word)]
        for j in range(8):
            c, y, level = (byte | 256) >> (8 - j), byte >> (7 - j) & 1, int(levels[at][j])
            own = [cells.get((k, x, c), (32768, 0)) for k, x in enumerate(contexts)]
            x = [math.copysign(min(12, 2 ** (abs(level) / 4) - 1), level)] + [math.log(max(0.5, p >> 6) / (1024 - (p >> 6))) for p, _ in own]
            w = weights[sum((n > 0) << k for k, (_, n) in enumerate(own)), sum(abs(level) >= t for t in (5, 9, 12))]
            z = min(11.99, max(-11.99, sum(a * b for a, b in zip(w, x, strict=True))))
            mixed = squash(math.floor((z + 12) * 64) / 64 - 12)
            k, f = divmod((z + 12) / 0.75, 1)
            refined = min(1 - 1e-6, max(1e-6, (mixed + table[c, k] * (1 - f) + table[c, k + 1] * f) / 2))
            total += math.log10(refined if y else 1 - refined)
            for i in range(4):
                w[i] += 0.02 * (y - mixed) * x[i]
            for i, share in ((k, 1 - f), (k + 1, f)):
                table[c, i] += 0.02 * (y - table[c, i]) * share
            for i, (context, (p, n)) in enumerate(zip(contexts, own, strict=True)):
                cells[i, context, c] = p + ((65535 * y - p) * int(32768 / (min(n, 60) + 1.5)) >> 15), n + 1
        before, word = (word, b"") if byte in (0x20, 0x0A) else (before, word + bytes([byte]))
    return total


def test_lm_codes_byte_by_byte(spark, make, monkeypatch):
    """Against a slow coder, whatever share of the words is held by all tasks."""
    texts = lm_corpus()
    docs = make(texts).withColumn("train", F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) != 2)
    known = lm_scoring.learn(spark, docs)
    levels = {}
    for r in known.chunks.collect():
        v = lm_scoring.Vocabulary.unpack(bytes(r.payload))
        coded = lm_scoring.Coded(v)
        x = known.model.levels(coded, lm_scoring.Paths(coded, lm_scoring._unpack_paths(bytes(r.paths)), known.buckets)).view(np.int8).reshape(-1, 8)[coded.beginning]
        levels |= {k: x[coded.word == i] for i, k in enumerate(v.keys.tolist())}

    def slow(text):
        low = bytes(x + 32 if 65 <= x <= 90 else x for x in (text or "").encode())
        data = np.frombuffer((text or "").encode(), np.uint8)
        t = lm_scoring.Tokens.of(data, np.array([0, len(data)]), known.states)
        return lm_slow_code(b"".join(w + b" " for w in low.split()) + b"\n", np.concatenate([levels[k] for k in t.keys(t.kind).tolist()]))

    want = [slow(t) for t in texts]
    frozen = lm_scoring.score(spark, make(texts)).orderBy("doc_id").collect()
    for head in (1 << 19, 40, 0):
        monkeypatch.setattr(lm_scoring, "CODE_HEAD", head)
        got = lm_scoring.code(spark, make(texts)).orderBy("doc_id").collect()
        assert [g.score for g in got] == pytest.approx(want, rel=2e-3)
        assert [(g.doc_id, g.held_out, g.n_tokens, g.n_known, g.train_tokens) for g in got] == [(f.doc_id, f.held_out, f.n_tokens, f.n_known, f.train_tokens) for f in frozen]
        assert [g.base_score for g in got] == pytest.approx([f.base_score for f in frozen])


def test_lm_coder_keeps_lines_of_contexts_that_come_again(spark):
    """A text takes room for contexts that it repeats, not for all; one with more contexts than there are places takes no more lines than those."""
    bit_coder.register(spark)
    kind = spark._jvm.java.lang.Thread.currentThread().getContextClassLoader().loadClass("tickforge.BitCoder")
    coder = kind.getDeclaredConstructor(spark.sparkContext._gateway.new_array(spark._jvm.java.lang.Class, 0)).newInstance(spark.sparkContext._gateway.new_array(spark._jvm.java.lang.Object, 0))
    field = lambda name: spark._jvm.java.lang.reflect.Array.getLength(kind.getDeclaredField(name).get(coder))
    r = random.Random(3)
    for size, most in ((20_000, 1 << 18), (600_000, 16 * (3 << 19) * 2)):
        text = bytes(r.choices(range(97, 123), k=size))
        alone = coder.call(bytearray(text), bytearray(8 * size))
        assert -8 * size < alone < 0 and field("cells") <= most
        assert coder.call(bytearray(text), bytearray(8 * size)) == alone


def test_lm_learns_while_it_codes(spark, make, monkeypatch):
    """The query's score depends on the order of words, and what a text repeats costs less."""
    r = random.Random(5)
    words = ["".join(r.choices("abcdefgh", k=5)) for _ in range(300)]
    phrase = r.sample(words, 12)
    again = phrase * 6
    texts = [" ".join(r.choices(words, k=60)) for _ in range(80)] + [" ".join(again), " ".join(r.sample(again, len(again)))]
    monkeypatch.setattr(queries, "table", lambda *_: make(texts))
    got = {g.doc_id: g for g in queries.op2_lm_scoring(spark, "").where("doc_id >= 80").collect()}
    assert got[80].base_score == pytest.approx(got[81].base_score) and got[80].score > 0.8 * got[81].score > got[81].base_score
    assert lm_scoring.code(spark, make([])).count() == 0
    odd = lm_scoring.code(spark, make([None, "", "x " * 50_000, "é"], [(1, "a", None, None, None, None, None, None), (None, "a", None, None, None, None, None, None)])).collect()
    assert len(odd) == 6 and all(math.isfinite(g.score) and g.score < 0 for g in odd) and sorted(g.n_tokens for g in odd) == [1, 1, 2, 2, 2, 50_001]


def test_lm_beats_the_base_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = lm_scoring.score(spark, docs).where("held_out and n_tokens > 20").toPandas()
    assert (out.score > out.base_score).mean() > 0.5


def test_urls(spark):
    urls = ["https://a.NET/x", "http://x.example.net/en/1", "http://example.com/de/9?q", "http://z.org/fr/#t", "http://a.net", "no scheme", None, "", "http://www.casino-win.example.org/en/3", "https://news.example.com/en/5", "http://notexample.com/de/", "ftp://h?x://y/z", "http://A.example.COM/de/\nx"]
    got = url_filter.judge(spark, spark.createDataFrame([(k, u, "h") for k, u in enumerate(urls)], "page_id long, url string, host string")).orderBy("page_id").collect()
    assert [(g.host, g.path, g.rule) for g in got] == [
        ("a.net", "/x", "net/"), ("x.example.net", "/en/1", "example.net/en/"), ("example.com", "/de/9", "example.com/de/"), ("z.org", "/fr/", "org/fr/"), ("a.net", "", None), ("", "", None), ("", "", None), ("", "", None),
        ("www.casino-win.example.org", "/en/3", None), ("news.example.com", "/en/5", None), ("notexample.com", "/de/", None), ("h", "", None), ("a.example.com", "/de/\nx", "example.com/de/"),
    ]
    assert [g.verdict for g in got[:4]] == ["block", "allow", "block", "allow"]
    assert got[8].verdict == "block" and got[9].verdict == "allow" and got[5].verdict == got[6].verdict == "allow"
    assert url_filter.judge(spark, spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_url_method_on_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = url_filter.judge(spark, pages).where("rule is null").toPandas()
    name = got.host.str.replace(r"^(www|m|blog)\.", "", regex=True).str.split(".").str[0]
    assert (got.verdict[name.str.contains("-")] == "block").mean() > 0.9 and (got.verdict[~name.str.contains("-")] == "allow").mean() > 0.97


def toxic_corpus(n=400, seed=5):
    r = random.Random(seed)
    syllables = ["th", "er", "ing", "on", "re", "wh", "es", "ou", "an", "ha"]
    words = ["".join(r.choice(syllables) for _ in range(r.randint(1, 4))) for _ in range(500)]
    bad = ["moron", "idiot", "clownish"]
    texts, y = [], []
    for _ in range(n):
        w = [r.choice(words) for _ in range(r.randint(5, 60))]
        t = r.random() < 0.3
        if t:
            w[r.randrange(len(w))] = r.choice(bad) + r.choice(["", ".", "ing"])
        texts.append(" ".join(w))
        y.append(int(t))
    return texts, y


def test_toxicity(spark, make):
    texts, y = toxic_corpus()
    extra = ["you id-iot of the", "an i d i o t wh", "mo.ron er", "the er on", None, "", "IDIOT!!", "idiot " * 9000]
    labels = spark.createDataFrame([*enumerate(y), (3, None), (4, 7), (None, 1)], "doc_id long, toxic int")
    out = toxicity.score(spark, make(texts + extra), labels).orderBy("doc_id").collect()
    held = [(g.predicted, y[g.doc_id]) for g in out if g.held_out and g.doc_id < len(y)]
    assert np.mean([a == b for a, b in held]) > 0.95
    tail = [g.predicted for g in out[len(y) :]]
    assert tail == [1, 1, 1, 0, 0, 0, 1, 1]
    assert all(0 <= g.score <= 1 and g.predicted == int(g.score >= 0.5) for g in out)
    none = toxicity.score(spark, make(["a"]), labels.limit(0)).collect()
    assert none[0].predicted == 0
    assert toxicity.score(spark, make([]), labels).count() == 0


def test_toxicity_of_many_gaps(spark, make):
    texts, y = toxic_corpus()
    gapped = ["you i.d.i.o.t of the", "er m-o-r-o-n", "the c*l_o.w-n.i.s.h on", "an id iot wh", "er m  o\to\nr m o r\to\n n", "the ixdxixoxt on", "i-d-i-ot", "cl_ow.nish the"]
    clean = ["the on er an ha", "th-er.ing re_wh", "a b c d e f"]
    labels = spark.createDataFrame([*enumerate(y)], "doc_id long, toxic int")
    out = toxicity.score(spark, make(texts + gapped + clean), labels).orderBy("doc_id").collect()
    assert [g.predicted for g in out[len(y) :]] == [1] * len(gapped) + [0] * len(clean)


def test_toxic_words_of_few_documents_are_landmarks():
    docs = [{"the", f"a{k}"} for k in range(1000)] + [{"the", "moronic"} for _ in range(990)] + [{"the", "clownish"} for _ in range(6)]
    marks = toxicity.choose_landmarks(docs, np.array([0] * 1000 + [1] * 996), 64)
    assert any(m in "clownish" for m in marks)


def test_kernel_counts_gapped_subsequences():
    k = toxicity.Kernel(["idiot"])
    same, gap, other = k(["idiot", "idxiot", "thering"])[:, 0]
    assert same == pytest.approx(1) and 0.4 < gap < 1 and other < 0.1


def brute_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    return [[*t.encode(x or "", add_special_tokens=False).ids, 1] for x in texts]


def test_packing_round_trip(spark, make):
    r = random.Random(1)
    texts = [" ".join(r.choice(["Thing", "it's", "é", "x²", "the", "don't..", "漢字", "<|endoftext|>", "a\u0301b", "A" * 30]) for _ in range(r.choice([0, 3, 40, 900]))) for _ in range(90)]
    texts += [None, "", "\x1c \x85 \xa0", "word " * 9000]
    d = make(texts, [(1, texts[1], None, None, None, None, None, None)]).repartition(2)
    ids = brute_ids(texts)
    got = packing.pack(spark, d, tokenizer_path(), capacity=256).collect()
    by_doc, by_sequence = {}, {}
    for g in got:
        assert g.doc_tokens == len(ids[g.doc_id]) and g.length > 0
        x = np.frombuffer(g.ids, "<u4")
        assert x.tolist() == ids[g.doc_id][g.start : g.start + g.length]
        by_doc.setdefault(g.doc_id, []).append((g.start, g.length))
        by_sequence.setdefault(g.sequence_id, []).append((g.offset, g.length))
    for k, x in enumerate(ids):
        assert sum(n for _, n in by_doc[k]) == len(x) * (2 if k == 1 else 1)
    full = []
    for parts in by_sequence.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        full.append(at)
    assert max(full) <= 256 and sum(256 - x for x in full) < 0.1 * 256 * len(full)
    # only documents longer than a window are cut, into whole windows and what is left
    for k, x in by_doc.items():
        assert k == 1 or sorted(n for _, n in x)[1:] == [256] * (len(ids[k]) // 256 - (len(ids[k]) % 256 == 0)) or len(x) == 1
    crc = {(g.doc_id, g.start, g.sequence_id): g.ids_crc32 for g in packing.with_crc(packing.pack(spark, d, tokenizer_path(), capacity=256)).collect()}
    assert all(crc[g.doc_id, g.start, g.sequence_id] == zlib.crc32(bytes(g.ids)) for g in got)
    assert packing.pack(spark, make([]), tokenizer_path()).count() == 0


def test_differencing():
    r = np.random.default_rng(0)
    for m in (1, 2, 5, 16):
        x = r.integers(1, 400, 200)
        window, sums = packing.difference(x, m)
        assert (np.bincount(window, weights=x, minlength=m) == sums).all() and sums.max() - sums.min() <= 4
    assert packing.difference(np.zeros(0, int), 3)[1].tolist() == [0, 0, 0]


def test_window_count_rises_beyond_the_capacity():
    # five items of 60 fit no two windows of 150
    window, m = packing.fitting(np.array([60] * 5), 150)
    assert m == 3 and np.bincount(window).max() == 2
    # no two of these share a window
    assert packing.fitting(np.array([90, 90, 90]), 150)[1] == 3
    r = np.random.default_rng(1)
    for _ in range(20):
        x = r.integers(1, 100, r.integers(1, 80))
        window, m = packing.fitting(x, 128)
        sums = np.bincount(window, weights=x, minlength=m)
        assert sums.max() <= 128 and m >= -(-x.sum() // 128)
