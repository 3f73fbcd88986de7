"""Language identification: sparse multinomial logistic regression on TF-IDF
character n-grams, trained by follow-the-regularised-leader with elastic-net
penalties and calibrated by a temperature."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from tickforge.llm import scratch as S
from tickforge.llm.textcore import U64

#: Hashed features of 1-, 2- and 3-grams.
BITS = 14
#: Odd multipliers, one for each place of an n-gram and one for each length.
_PLACE = [U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F), U64(0x165667B19E3779F9)]
_LENGTH = [U64(0xD6E8FEB86659FD93), U64(0xA0761D6478BD642F), U64(0xE7037ED1A0B428DB)]
_LETTER = regex.compile(r"\p{L}")
#: Documents and characters in one feature matrix.
_ROWS, _CHARS = 64, 1 << 19


def counts(texts: list[str | None]) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first, end, matrix of n-gram counts) of runs of texts, lower-cased whole."""
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and end - at < _ROWS and (end == at or size + len(texts[end] or "") <= _CHARS):
            size += len(texts[end] or "")
            end += 1
        low = [(t or "").lower() for t in texts[at:end]]
        c = np.frombuffer("".join(low).encode("utf-32-le", "replace"), np.uint32).astype(U64)
        row = np.repeat(np.arange(end - at), [len(t) for t in low])
        m = np.zeros((end - at) << BITS, np.int64)
        h = np.zeros(len(c), U64)
        for n in range(min(3, len(c))):
            h = h[: len(c) - n] + (c[n:] + U64(1)) * _PLACE[n]
            same = row[n:] == row[: len(c) - n]
            x = ((h ^ (h >> U64(31))) * _LENGTH[n]) >> U64(64 - BITS)
            m += np.bincount((row[: len(c) - n][same] << BITS) + x[same].astype(np.int64), minlength=len(m))
        yield at, end, m.reshape(end - at, 1 << BITS)
        at = end


def weighted(m: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of (1 + ln count) * idf of length 1."""
    x = np.zeros(m.shape, np.float32)
    on = m > 0
    x[on] = 1 + np.log(m[on].astype(np.float32))
    x *= idf
    return x / np.maximum(1e-9, np.sqrt((x * x).sum(1, keepdims=True)))


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        labels, scores = [], []
        for a, e, m in counts(texts):
            p = softmax(weighted(m, self.idf) @ self.weights / self.temperature)
            best = p.argmax(1)
            for k, t in enumerate(texts[a:e]):
                known = t is not None and self.languages and _LETTER.search(t)
                labels.append(self.languages[best[k]] if known else "und")
                scores.append(float(p[k, best[k]]) if known else 0.0)
        return labels, np.array(scores)


def softmax(x: np.ndarray) -> np.ndarray:
    if not x.shape[1]:
        return np.zeros((len(x), 1))
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], n_features: int, n_classes: int, epochs: int = 4, alpha: float = 2.0, beta: float = 1.0, l1: float = 0.02, l2: float = 0.002) -> np.ndarray:
    """Weights after so many passes over rows of (features, values, class)."""
    z, n = np.zeros((n_features, n_classes)), np.zeros((n_features, n_classes))

    def weights(i):
        shrunk = np.sign(z[i]) * np.maximum(0, np.abs(z[i]) - l1)
        return -shrunk / ((beta + np.sqrt(n[i])) / alpha + l2)

    order = np.random.default_rng(0)
    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            i, v, y = rows[k]
            w = weights(i)
            p = softmax((v @ w)[None])[0]
            p[y] -= 1
            g = v[:, None] * p
            step = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
            z[i] += g - step * w
            n[i] += g * g
    return weights(np.arange(n_features)).astype(np.float32)


def temperature(logits: np.ndarray, y: np.ndarray, smooth: float = 0.01) -> float:
    """The one of a fine grid under which held-back rows are likeliest, were a share ``smooth`` of their labels spread over all classes."""
    grid = np.exp(np.linspace(np.log(0.02), np.log(20), 200))
    if not len(y):
        return 1.0
    target = np.full(logits.shape, smooth / max(1, logits.shape[1]))
    target[np.arange(len(y)), y] += 1 - smooth
    loss = [-(target * np.log(np.maximum(1e-12, softmax(logits / t)))).sum(1).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def train(spark: SparkSession, rows: DataFrame, per_language: int = 500) -> Model:
    """rows (doc_id, text, lang).  Document frequencies are over all rows; the weights are fitted on about per_language rows of each language (whole texts, chosen by a hash of doc_id)."""
    S.ship(spark)
    rows = rows.where("text is not null and lang is not null")
    by_lang = rows.groupBy("lang").count().collect()
    languages = sorted(r["lang"] for r in by_lang)
    number = {lang: k for k, lang in enumerate(languages)}
    if not languages:
        return Model([], np.ones(1 << BITS, np.float32), np.zeros((1 << BITS, 0), np.float32), 1.0)
    total = sum(r["count"] for r in by_lang)
    share = F.create_map(*[F.lit(x) for r in by_lang for x in (r["lang"], min(1.0, per_language / r["count"]))])

    def frequencies(batches):
        df = np.zeros(1 << BITS, np.int64)
        for b in batches:
            for _, _, m in counts(b["text"].to_pylist()):
                df += (m > 0).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(df)), pa.array(df[df > 0])], names=["f", "n"])

    df = np.zeros(1 << BITS)
    for r in rows.select("text").mapInArrow(frequencies, "f long, n long").groupBy("f").agg(F.sum("n").alias("n")).collect():
        df[r["f"]] = r["n"]
    idf = (np.log((1 + total) / (1 + df)) + 1).astype(np.float32)

    def features(batches):
        for b in batches:
            langs = b["lang"].to_pylist()
            for a, e, m in counts(b["text"].to_pylist()):
                on = [np.flatnonzero(x) for x in m]
                yield pa.RecordBatch.from_arrays([pa.array(langs[a:e]), pa.array([i.astype(np.int16).tobytes() for i in on]), pa.array([x[i].astype(np.uint32).tobytes() for x, i in zip(m, on, strict=True)])], names=["lang", "i", "c"])

    sample = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.element_at(share, F.col("lang")) * 1_000_000)
    data = []
    for r in sample.select("lang", "text").mapInArrow(features, "lang string, i binary, c binary").orderBy("lang", "i", "c").toLocalIterator():
        i, c = np.frombuffer(r["i"], np.int16).astype(np.int64), np.frombuffer(r["c"], np.uint32)
        v = (1 + np.log(c)) * idf[i]
        data.append((i, v / max(1e-9, np.sqrt((v * v).sum())), number[r["lang"]]))
    held = data[::5] if len(data) > 50 else []
    weights = ftrl([d for k, d in enumerate(data) if not held or k % 5], 1 << BITS, len(languages))
    logits = np.array([v @ weights[i] for i, v, _ in held]).reshape(len(held), len(languages))
    return Model(languages, idf, weights, temperature(logits, np.array([y for *_, y in held])))


def held_out(doc_id, modulus: int, remainder: int):
    """Whether crc32 of the doc_id's text leaves the remainder; false without doc_id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def identify(spark: SparkSession, docs: DataFrame, per_language: int = 500) -> DataFrame:
    """Per input row: doc_id, rest (a struct of the other columns), text, held_out, lang_pred, score.

    Learns from text and lang of the rows that are not held out (crc32 of the
    doc_id's text modulo 5 is 0); predictions use the whole text alone.  Null
    texts and texts without a letter are ``und`` with score 0, as are all texts
    where no row has a lang to learn from.  Ties go to the first language in
    order.  Rows without doc_id are predicted but not learnt from.  Repeated
    rows are rows of their own; an empty table gives an empty result.  Very long
    texts count whole.  Columns beside doc_id and text come back inside rest,
    whatever their names; lang is read from there.
    """
    S.ship(spark)
    docs = S.with_rest(docs).withColumn("held_out", held_out("doc_id", 5, 0))
    known = docs.where("not held_out and doc_id is not null").select("doc_id", "text", F.col("rest.lang").cast("string").alias("lang")) if "lang" in docs.schema["rest"].dataType.names else docs.select("doc_id", "text", F.lit(None).cast("string").alias("lang")).limit(0)
    model = train(spark, known, per_language)

    def f(batches):
        for b in batches:
            labels, scores = model.predict(b["text"].to_pylist())
            yield b.append_column("lang_pred", pa.array(labels, pa.string())).append_column("score", pa.array(scores, pa.float64()))

    return docs.mapInArrow(f, S.more_fields(docs.schema, lang_pred=StringType(), score=DoubleType()))
