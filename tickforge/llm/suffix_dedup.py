"""Suffix-array dedup on bytes by a difference cover.

The distributed algorithm sorts, of all suffixes, only those that start at
positions of a difference cover (here 18 of each 307 positions), by
the names of their leading strings; equal names bring the remaining suffixes
near them into the second sort, which orders them by the name of their first
``length`` bytes; neighbours in that order with equal names share a prefix of
``length`` bytes.  Names are 64-bit hashes: the order among different strings
is that of their names, not the alphabet, which does not matter to equality,
and prefixes longer than ``length`` are never compared, so one level of
recursion is enough.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import BinaryType, LongType

from tickforge.llm import repeats


def difference_set(q: int) -> tuple[int, tuple[int, ...]]:
    """Modulus q*q+q+1 and q+1 residues in which each non-zero difference occurs once, for a prime q (Singer's construction)."""
    for a in range(q):
        for b in range(q):
            for c in range(1, q):
                # x**3 = a*x*x + b*x + c; powers of x in GF(q**3)
                seen, v, n = [], (0, 0, 1), q * q + q + 1
                for i in range(n):
                    if v[0] == 0:
                        seen.append(i)
                    top = v[0]
                    v = ((v[1] + a * top) % q, (v[2] + b * top) % q, c * top % q)
                if len(seen) == q + 1 and len({(x - y) % n for x in seen for y in seen}) == n:
                    return n, tuple(seen)
    raise ValueError(f"no difference set for {q}")


#: 307 positions, 18 of them in the cover.
PERIOD, COVER = difference_set(17)


def remove_repeats(spark: SparkSession, docs: DataFrame, length: int = 400, rounds: int = 4) -> DataFrame:
    """Removes every byte that a ``length``-byte string covers which also starts anywhere else.

    Texts are UTF-8 bytes; matches do not cross documents; strings are judged
    on the input.  All occurrences go, the first too.  ``rounds``: the second
    sort is done in so many ranges of names, one after the other, so that its
    shuffle takes that share of the disk.  Returns, per input row: doc_id, rest
    (a struct of the other columns), kept (binary; cuts may fall inside a
    character), n_bytes, n_removed, n_spans (maximal removed runs) and n_shared:
    the bytes inside anchors (of length - 306) that start elsewhere too, by
    which passages shorter than ``length`` show, which stay.  An anchor is found
    where both copies of a passage have it at a position of the cover, so a
    repeated string of ``length`` always shows and a shorter one mostly.

    Null text: no bytes.  Rows without doc_id count as one document; rows that
    repeat a doc_id are the same document, not another occurrence.  An empty
    table gives an empty result.  Very long texts are taken whole, in one task
    each.  All equal strings go, so there are no ties.  Other columns may have
    any names.
    """
    spec = repeats.Windows("byte", length, PERIOD, COVER, later_only=False, rounds=rounds)
    texts, starts, anchors = repeats.find(spark, docs, spec)
    return repeats.apply(texts, starts, spec, _kept, anchors, kept=BinaryType(), n_bytes=LongType(), n_removed=LongType(), n_spans=LongType(), n_shared=LongType())


def _kept(s: repeats.Symbols, data: np.ndarray, off: np.ndarray, covered: np.ndarray, shared: np.ndarray) -> dict:
    total = np.zeros(len(data) + 1, np.int64)
    np.cumsum(covered, out=total[1:])
    also = np.zeros(len(data) + 1, np.int64)
    np.cumsum(shared, out=also[1:])
    begin = covered.copy()
    begin[1:] &= ~covered[:-1]
    first = off[:-1][off[:-1] < off[1:]]
    begin[first] = covered[first]
    spans = np.zeros(len(data) + 1, np.int64)
    np.cumsum(begin, out=spans[1:])
    return {"kept": repeats.binary_column(data, ~covered, off, pa.binary()), "n_bytes": pa.array(np.diff(off), pa.int64()), "n_removed": pa.array(np.diff(total[off]), pa.int64()), "n_spans": pa.array(np.diff(spans[off]), pa.int64()), "n_shared": pa.array(np.diff(also[off]), pa.int64())}
