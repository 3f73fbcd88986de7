"""Toxicity by a subsequence string kernel and a Nyström support vector machine.

Kernel: two strings are alike by the subsequences of three characters they
share, gaps allowed, each weighted by DECAY per character that it spans (at
most SPAN).  An inserted character (``id-iot``) lowers the value but does not
remove it; words with more of them are seen a second time without separators
and short neighbours also as one word.  Landmarks are strings typical of toxic labelled documents.  A
document's value for a landmark is the largest kernel value among its words,
taken to the power DEGREE; values for all landmarks are whitened by the
landmarks' own kernel matrix (Nyström; a matrix of cosines to a power, so it is
positive semidefinite), and a linear machine on top is trained
with the squared hinge loss and calibrated by a logistic curve.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter, defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType

from tickforge.llm import scratch as S
from tickforge.llm.language_id import held_out
from tickforge.llm.textcore import U64

SPAN, DECAY, DEGREE = 6, 0.9, 4
#: Kernel values below this count as none.
FLOOR = 0.35
BITS = 18
#: Added to the eigenvalues of the landmarks' kernel matrix.
JITTER = 0.05
#: Distinct words that a worker remembers.
CACHE = 600_000
_GAPS = [(a, b) for b in range(2, SPAN) for a in range(1, b)]
_SEPARATORS = re.compile(r"[\W_]+")
#: Longest word that is joined with its neighbours.
_SHORT = 3


def bare(word: str) -> str:
    """A word without separators, nor a letter that comes after each of the others."""
    if not word.isalnum():
        word = _SEPARATORS.sub("", word)
    return word[::2] if len(word) > 6 and len(set(word[1::2])) == 1 else word


def words(text: str | None) -> set[str]:
    """Distinct lower-cased words of a whole text, also without separators; runs of short words, however set apart, are also one word."""
    out: set[str] = set()
    run: list[str] = []
    for w in [*(text or "").lower().split(), " " * (_SHORT + 1)]:
        b = bare(w) if w[0] != " " else w
        if len(b) <= _SHORT:
            run.append(b)
        else:
            if len(run) > 1:
                out.add("".join(run))
            run.clear()
            out.add(b)
        out.add(w)
    return out - {"", " " * (_SHORT + 1)}


def subsequences(strings: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, hashed subsequence, weight) of all strings."""
    size = np.array([len(s) for s in strings])
    c = np.frombuffer("".join(strings).encode("utf-32-le", "replace"), np.uint32).astype(U64)
    row = np.repeat(np.arange(len(strings)), size)
    out = []
    for a, b in _GAPS:
        n = len(c) - b
        if n > 0:
            ok = np.flatnonzero(row[:n] == row[b:])
            h = c[ok] * U64(0x9E3779B97F4A7C15) + c[ok + a] * U64(0xC2B2AE3D27D4EB4F) + c[ok + b] * U64(0x165667B19E3779F9)
            out.append((row[ok], ((h ^ (h >> U64(29))) * U64(0xD6E8FEB86659FD93)) >> U64(64 - BITS), np.full(len(ok), DECAY ** (b + 1), np.float32)))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32)
    r, x, w = (np.concatenate(p) for p in zip(*out, strict=True))
    return r, x.astype(np.int64), w


@dataclass
class Kernel:
    """Kernel values of any string with each landmark, as a share of the landmark's own."""

    landmarks: list[str]
    slot: np.ndarray = field(init=False)
    table: np.ndarray = field(init=False)
    own: np.ndarray = field(init=False)

    def __post_init__(self):
        r, x, w = best_of_each(*subsequences(self.landmarks), 1 << BITS)
        used, at = np.unique(x, return_inverse=True)
        self.slot = np.zeros(1 << BITS, np.int32)
        self.slot[used] = np.arange(1, len(used) + 1)
        table = np.zeros((len(used) + 1, len(self.landmarks)), np.float32)
        table[at + 1, r] = w
        #: Each landmark's own kernel value.
        self.own = np.maximum(1e-9, (table * table).sum(0))
        self.table = table / self.own

    def gram(self) -> np.ndarray:
        """Kernel values of the landmarks with each other, as cosines: positive semidefinite, as are its elementwise powers."""
        k = self.shares(self.landmarks) * np.sqrt(self.own[None, :] / self.own[:, None])
        return (k + k.T) / 2

    def __call__(self, strings: list[str]) -> np.ndarray:
        return np.minimum(self.shares(strings), 1)

    def shares(self, strings: list[str]) -> np.ndarray:
        out = np.zeros((len(strings), len(self.landmarks)), np.float32)
        for lo in range(0, len(strings), 8192):
            r, x, w = subsequences(strings[lo : lo + 8192])
            at = self.slot[x]
            on = at > 0
            r, at, w = best_of_each(r[on], at[on], w[on], len(self.table))
            if len(r):
                starts = np.flatnonzero(np.append(True, r[1:] != r[:-1]))
                out[lo + r[starts]] = np.add.reduceat(self.table[at] * w[:, None], starts, axis=0)
        return out


def best_of_each(r: np.ndarray, x: np.ndarray, w: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One entry for each string and subsequence (0 to n - 1), the one of the largest weight, by string."""
    key = r.astype(np.int64) * n + x
    order = np.lexsort((-w, key))
    key = key[order]
    first = np.ones(len(key), bool)
    first[1:] = key[1:] != key[:-1]
    order = order[first]
    return r[order], x[order], w[order]


@dataclass
class Model:
    landmarks: list[str]
    whiten: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    shift: float
    key: str = field(default_factory=lambda: uuid.uuid4().hex)

    def scores(self, values: np.ndarray) -> np.ndarray:
        margin = values @ self.whiten @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -500, 500)))


class Features:
    """Values of documents for each landmark; remembers words."""

    def __init__(self, landmarks: list[str]):
        self.kernel = Kernel(landmarks)
        self.seen: set[str] = set()
        self.alike: dict[str, np.ndarray] = {}
        self.names: set[str] = set()

    def __call__(self, docs: list[set[str]]) -> np.ndarray:
        new = list(set().union(*docs).difference(self.seen))
        if len(self.seen) + len(new) > CACHE:
            self.seen, self.alike, self.names = set(), {}, set()
            new = list(set().union(*docs))
        if new:
            k = self.kernel(new)
            for i in np.flatnonzero(k.max(1, initial=0) >= FLOOR):
                self.alike[new[i]] = np.where(k[i] >= FLOOR, k[i], 0) ** DEGREE
            self.names = set(self.alike)
            self.seen.update(new)
        out = np.zeros((len(docs), len(self.kernel.landmarks)), np.float32)
        for k, d in enumerate(docs):
            if found := self.names & d:
                out[k] = np.max([self.alike[w] for w in found], axis=0)
        return out


_features: dict[str, Features] = {}


def choose_landmarks(docs: list[set[str]], y: np.ndarray, most: int) -> list[str]:
    """Strings of 4 to 8 characters inside words that toxic documents favour: each next one covers most toxic documents beyond those before it, and is rare in the others."""
    good, bad = Counter(), Counter()
    for d, t in zip(docs, y, strict=True):
        (bad if t else good).update(d)
    n_bad, n_good = max(1, y.sum()), max(1, (1 - y).sum())
    strong = {w for w, n in bad.items() if n >= 3 and n / n_bad > 6 * (good[w] + 0.5) / n_good}
    if not strong:
        strong = {w for w, n in bad.items() if n >= 2} or set(bad)
    inside = defaultdict(set)
    for w in strong:
        for size in range(4, 9):
            for i in range(len(w) - size + 1):
                inside[w[i : i + size]].add(w)
    for w in strong:
        if len(w) < 4:
            inside[w].add(w)
    by_word = defaultdict(set)
    for k, (d, t) in enumerate(zip(docs, y, strict=True)):
        if t:
            for w in d & strong:
                by_word[w].add(k)
    cover = {s: set().union(*(by_word[w] for w in ws)) for s, ws in inside.items()}
    # of many strings some are in three or four toxic documents and no other by chance
    least = 3 if n_bad < 150 else 5
    cover = {s: k for s, k in cover.items() if len(k) >= least} or cover
    other = "\n".join(good)
    share = n_bad / n_good
    chosen: list[str] = []
    left = {k for k in range(len(docs)) if y[k]}
    ranked = sorted(cover, key=lambda s: (-len(cover[s]), -len(s), s))
    clean: dict[str, int] = {}

    def clean_count(s: str) -> int:
        if s not in clean:
            clean[s], at = 0, other.find(s)
            while at >= 0:
                end = other.find("\n", at) % (len(other) + 1)
                clean[s] += good[other[other.rfind("\n", 0, at) + 1 : end]]
                at = other.find(s, end)
        return clean[s]

    while ranked and len(chosen) < most:
        gains = [g for s in ranked if (g := (len(cover[s] & left), len(s), s))[0] >= 2]
        if not gains:
            # strings that many toxic documents have beside those chosen, if they are not like them
            new = [s for s in ranked if len(cover[s]) >= max(3, n_bad // 25) and (len(s) > 5 or s in strong)]
            near = Kernel(chosen)(new).max(1) if new and chosen else np.zeros(len(new))
            gains = [(len(cover[s]), len(s), s) for s, k in zip(new, near, strict=True) if k < 0.4]
            if not gains:
                break
        s = max(gains)[2]
        ranked = [r for r in ranked if r != s and not (r in s or s in r)] if clean_count(s) * share <= 0.02 * len(cover[s]) else [r for r in ranked if r != s]
        if clean_count(s) * share <= 0.02 * len(cover[s]):
            chosen.append(s)
            left -= cover[s]
    return chosen or ["\0"]


def hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-3, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weights and bias under the squared hinge loss, by accelerated gradient steps."""
    z = np.hstack([x, np.ones((len(x), 1))])
    sign = 2.0 * y - 1
    step = 1 / (2 * np.linalg.norm(z * np.sqrt(weight)[:, None], 2) ** 2 + penalty)
    w = last = np.zeros(z.shape[1])
    for k in range(steps):
        v = w + k / (k + 3) * (w - last)
        slack = np.maximum(0, 1 - sign * (z @ v))
        grad = -2 * z.T @ (weight * sign * slack) + penalty * np.append(v[:-1], 0)
        last, w = w, v - step * grad
    return w[:-1], float(w[-1])


def platt(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve, by Newton steps with a small ridge."""
    z, b = np.column_stack([margin, np.ones(len(margin))]), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        h = (z * (weight * p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(2)
        b = b - np.linalg.solve(h, z.T @ (weight * (p - y)) + 1e-3 * (b - [1, 0]))
    return float(max(1e-3, b[0])), float(b[1])


def varied(docs: list[set[str]], marks: list[str], seed: int = 0) -> list[set[str]]:
    """For each toxic document, three with a single one of its words like a landmark: as it is, with a character put in, and with one after each letter."""
    rng, kernel = np.random.default_rng(seed), Kernel(marks)
    every = sorted(set().union(*docs))
    alike = {w for w, k in zip(every, kernel(every).max(1, initial=0), strict=True) if k >= 0.75}
    out = []
    for d in docs:
        if hit := sorted(d & alike):
            w = hit[rng.integers(len(hit))]
            at = int(rng.integers(1, max(2, len(w))))
            rest = d - alike
            put = "-.*_x1"[rng.integers(6)]
            out += [rest | {w}, rest | words(w[:at] + put + w[at:]), rest | words(put.join(w))]
    return out


def train(docs: list[set[str]], y: np.ndarray, prior: float, landmarks: int = 64) -> Model:
    """prior: share of toxic rows among all that were labelled."""
    if len(set(y.tolist())) < 2:
        return Model(["\0"], np.zeros((1, 1)), np.zeros(1), 0.0, 1.0, 500.0 if len(y) and y[0] else -500.0)
    held = np.arange(len(y)) % 4 == 0 if len(y) >= 80 else np.zeros(len(y), bool)
    marks = choose_landmarks([d for d, h in zip(docs, held, strict=True) if not h], y[~held], landmarks)
    n = len(docs)
    for kept_back in (False, True):
        more = varied([d for d, h, t in zip(docs, held, y, strict=True) if h == kept_back and t], marks) if kept_back in held[: len(docs)] else []
        docs, y, held = docs + more, np.append(y, np.ones(len(more), int)), np.append(held, np.full(len(more), kept_back))
    made = np.arange(len(docs)) >= n
    value, vector = np.linalg.eigh(Kernel(marks).gram() ** DEGREE)
    whiten = vector @ np.diag(1 / np.sqrt(np.maximum(value, 0) + JITTER)) @ vector.T
    x = Features(marks)(docs) @ whiten
    weight = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    w, b = hinge(x[~held], y[~held], weight[~held])
    # documents as they come; the varied ones weigh a tenth
    rate = np.where(made, 0.1, 1) * np.where(y == 1, prior / max(1, y[:n].sum()), (1 - prior) / max(1, (1 - y).sum())) * n
    fit = held if held.any() and len(set(y[held].tolist())) == 2 else ~held
    slope, shift = platt(x[fit] @ w + b, y[fit], rate[fit])
    return Model(marks, whiten, w, b, slope, shift)


def sample(spark: SparkSession, docs: DataFrame, labels: DataFrame, per_class: int) -> tuple[list[set[str]], np.ndarray, float]:
    """Word sets and labels of about per_class documents of each class, chosen by a hash of doc_id; and the share of toxic ones."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic in (0, 1)")
    known = known.where(~held_out("doc_id", 5, 0)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    share = F.when(F.col("toxic") == 1, min(1.0, per_class / max(1, n.get(1, 0)))).otherwise(min(1.0, per_class / max(1, n.get(0, 0))))
    few = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share * 1_000_000)
    # few has about 2 * per_class rows, whatever the input's size
    rows = docs.select("doc_id", "text").join(F.broadcast(few), "doc_id").dropDuplicates(["doc_id"]).orderBy("doc_id")
    got = [(words(r["text"]), r["toxic"]) for r in rows.toLocalIterator()]
    return [g[0] for g in got], np.array([g[1] for g in got], int), n.get(1, 0) / max(1, sum(n.values()))


def score(spark: SparkSession, docs: DataFrame, labels: DataFrame, per_class: int = 2000) -> DataFrame:
    """Per input row: doc_id, rest (a struct of the other columns), text, held_out, score, predicted.

    labels (doc_id, toxic 0/1): those held out (crc32 of the doc_id's text
    modulo 5 is 0), null ones and other values are not learnt from; a doc_id
    labelled twice counts as toxic if any label says so.  The machine is fitted
    on about per_class documents of each class.  Scores come from the whole
    text alone.  Null and empty texts have no words and get the score of a
    text without any likeness.  With labels of one class alone (or none) every
    score is that class's (or 0).  An empty table gives an empty result.  Very
    long texts are read whole.  Repeated rows, and rows without doc_id, are
    scored each by its own text; a score of 0.5 counts as toxic.  Columns beside
    doc_id and text come back inside rest, whatever their names.
    """
    S.ship(spark)
    docs = S.with_rest(docs).withColumn("held_out", held_out("doc_id", 5, 0))
    model = train(*sample(spark, docs, labels, per_class))

    def f(batches):
        if model.key not in _features:
            _features.clear()
            _features[model.key] = Features(model.landmarks)
        features = _features[model.key]
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                b = batch.slice(lo, 256)
                p = model.scores(features([words(t) for t in b["text"].to_pylist()]))
                yield b.append_column("score", pa.array(p.astype(np.float64))).append_column("predicted", pa.array((p >= 0.5).astype(np.int32)))

    return docs.mapInArrow(f, S.more_fields(docs.schema, score=DoubleType(), predicted=IntegerType()))
