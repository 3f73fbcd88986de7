"""The learnt operators against slow versions: plain loops over what was learnt, one text, character and feature at a time."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.test_models import toxic_corpus
from tickforge.llm import language_id, toxicity, url_filter

M = 2**64


def slow_features(text):
    """Counts of hashed 1- to 3-grams."""
    c = [ord(x) for x in (text or "").lower()]
    out = Counter()
    for n in (1, 2, 3):
        for i in range(len(c) - n + 1):
            h = sum((c[i + k] + 1) * int(language_id._PLACE[k]) for k in range(n)) % M
            out[((h ^ (h >> 31)) * int(language_id._LENGTH[n - 1]) % M) >> (64 - language_id.BITS)] += 1
    return out


def slow_language(model, text):
    if text is None or not re.search(r"[^\W\d_]", text):
        return "und", 0.0
    x = {f: (1 + math.log(n)) * float(model.idf[f]) for f, n in slow_features(text).items()}
    size = math.sqrt(sum(v * v for v in x.values()))
    logits = [sum(v / size * float(model.weights[f, k]) for f, v in x.items()) / model.temperature for k in range(len(model.languages))]
    most = max(logits)
    share = [math.exp(v - most) for v in logits]
    best = logits.index(most)
    return model.languages[best], share[best] / sum(share)


def test_language_against_a_slow_version(spark, make):
    r = random.Random(1)
    words = {"aa": ["the", "and", "Thing", "ing"], "bb": ["été", "les", "DES", "où"], "cc": ["und", "für", "straße"]}
    rows = [(k, " ".join(r.choices(words[lang], k=r.randint(1, 12))), lang, None, None, None, None, None) for k, lang in enumerate(r.choices(list(words), k=120))]
    rows += [(500, "the été und", None, None, None, None, None, None), (501, None, "aa", None, None, None, None, None), (502, "12 .", "bb", None, None, None, None, None), (503, "ﬀ İ the", None, None, None, None, None, None)]
    docs = make([], rows)
    known = docs.where(~language_id.held_out("doc_id", 5, 0)).select("doc_id", "text", "lang")
    model = language_id.train(spark, known)
    got = {g.doc_id: (g.lang_pred, g.score) for g in language_id.identify(spark, docs).collect()}
    for k, text, *_ in rows:
        lang, score = slow_language(model, text)
        assert got[k][0] == lang and got[k][1] == pytest.approx(score, abs=1e-4)


def test_ftrl_against_loops():
    """Follow the regularised leader, one weight at a time."""
    r = np.random.default_rng(0)
    rows = [(np.sort(r.choice(6, 3, replace=False)), r.random(3), int(r.integers(3))) for _ in range(25)]
    alpha, beta, l1, l2 = 2.0, 1.0, 0.02, 0.002
    z, n = [[0.0] * 3 for _ in range(6)], [[0.0] * 3 for _ in range(6)]

    def weight(f, k):
        return 0.0 if abs(z[f][k]) <= l1 else -(z[f][k] - math.copysign(l1, z[f][k])) / ((beta + math.sqrt(n[f][k])) / alpha + l2)

    order = np.random.default_rng(0)
    for _ in range(4):
        for at in order.permutation(len(rows)):
            features, values, y = rows[at]
            w = {(f, k): weight(f, k) for f in features for k in range(3)}
            scores = [sum(v * w[f, k] for f, v in zip(features, values, strict=True)) for k in range(3)]
            total = sum(math.exp(s) for s in scores)
            for f, v in zip(features, values, strict=True):
                for k in range(3):
                    g = v * (math.exp(scores[k]) / total - (k == y))
                    z[f][k] += g - (math.sqrt(n[f][k] + g * g) - math.sqrt(n[f][k])) / alpha * w[f, k]
                    n[f][k] += g * g
    want = [[weight(f, k) for k in range(3)] for f in range(6)]
    assert language_id.ftrl(rows, 6, 3) == pytest.approx(np.array(want), abs=1e-5)


def test_urls_against_a_slow_version(spark):
    urls = ["https://www.Casino-Win.example.com/en/12/x?y", "http://library.example.org", "ftp://a/b#c", "x", None, "http://museum.example.com/de/7", "https://free-money.biz/fr/99.html"]
    hashed, model = url_filter.train(spark)
    got = url_filter.judge(spark, spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")).orderBy("page_id").collect()
    for g, url in zip(got, urls, strict=True):
        host = path = ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            host = re.split("[/?#]", rest, maxsplit=1)[0]
            path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
            host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        grams = set()
        for mark, text in (("h", f"^{host}$"), ("p", re.sub("[0-9]+", "0", path + "$"))):
            grams |= {mark + text[i : i + n] for n in (3, 4, 5) for i in range(len(text) - n + 1)}
        margin = model.intercept + sum(model.coefficients[f] for f in {hashed.indexOf(x) for x in grams})
        assert (g.host, g.path) == (host, path) and g.probability == pytest.approx(1 / (1 + math.exp(-margin)))
        assert g.rule or g.verdict == ("block" if margin > 0 else "allow")


def slow_subsequences(s):
    """Subsequences of three characters with their best weight: DECAY for each character that one spans, at most SPAN."""
    out = {}
    for i in range(len(s)):
        for k in range(i + 2, min(len(s), i + toxicity.SPAN)):
            for j in range(i + 1, k):
                key = s[i] + s[j] + s[k]
                out[key] = max(out.get(key, 0), toxicity.DECAY ** (k - i + 1))
    return out


def slow_kernel(word, landmark):
    a, b = slow_subsequences(word), slow_subsequences(landmark)
    return min(1, sum(w * b.get(key, 0) for key, w in a.items()) / max(1e-9, sum(w * w for w in b.values())))


def test_kernel_against_a_slow_version():
    r = random.Random(2)
    words = ["".join(r.choices("abcdé", k=r.randint(0, 14))) for _ in range(80)]
    marks = ["abcd", "ddé", "badcab"]
    got = toxicity.Kernel(marks)(words)
    assert got == pytest.approx(np.array([[slow_kernel(w, m) for m in marks] for w in words]), abs=1e-5)


def test_landmarks_kernel_matrix_is_positive_semidefinite():
    r = random.Random(4)
    marks = sorted({"".join(r.choices("abcdé", k=r.randint(4, 8))) for _ in range(40)})
    features = [slow_subsequences(m) for m in marks]
    dot = lambda a, b: sum(w * b.get(key, 0) for key, w in a.items())
    want = np.array([[dot(a, b) / math.sqrt(dot(a, a) * dot(b, b)) for b in features] for a in features])
    gram = toxicity.Kernel(marks).gram()
    assert gram == pytest.approx(want, abs=1e-5)
    assert np.linalg.eigvalsh(gram**toxicity.DEGREE).min() > -1e-5


def test_toxicity_against_a_slow_version(spark, make):
    texts, y = toxic_corpus(300)
    texts += ["an i.d.i.o.t on", "mor on the", None, ""]
    labels = spark.createDataFrame(list(enumerate(y)), "doc_id long, toxic int")
    docs = make(texts)
    model = toxicity.train(*toxicity.sample(spark, docs, labels, 2000))
    got = {g.doc_id: g.score for g in toxicity.score(spark, docs, labels).collect()}
    for k in [*range(0, 300, 12), *range(300, 304)]:
        best = [0.0] * len(model.landmarks)
        for w in toxicity.words(texts[k]):
            for m, mark in enumerate(model.landmarks):
                value = slow_kernel(w, mark)
                best[m] = max(best[m], value**toxicity.DEGREE if value >= toxicity.FLOOR else 0)
        margin = sum(b * row for b, row in zip(best, model.whiten @ model.weights, strict=True)) + model.bias
        assert got[k] == pytest.approx(1 / (1 + math.exp(-(model.slope * margin + model.shift))), abs=1e-3)


def test_held_out_is_crc32(spark):
    import zlib

    rows = spark.range(200).select("id", language_id.held_out("id", 7, 2).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 7 == 2) for r in rows)
