"""Substring dedup by difference-cover anchors (words)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StringType

from tickforge.llm import repeats

#: The perfect difference set modulo 13: any two positions share a shift.
PERIOD, COVER = 13, (0, 1, 3, 9)


def remove_repeats(spark: SparkSession, docs: DataFrame, window: int = 20) -> DataFrame:
    """Removes the words of every window of ``window`` words that also starts earlier.

    Earlier: in a document of a smaller doc_id, or before in the same one; the
    windows are judged on the input.  Returns, per input row: doc_id, rest (a
    struct of the other columns), text (kept words joined by one space),
    n_words and n_removed.

    Null text: no words, empty result.  Rows without doc_id count as one
    document before all others.  Rows that repeat a doc_id are taken as the
    same document: both lose the same words.  Texts of fewer than ``window``
    words lose nothing.  An empty table gives an empty result.  Very long texts
    are taken whole, in one task each.  Of equal windows the one of the smallest
    (doc_id, start) stays, so there are no ties.  Other columns may have any
    names.
    """
    spec = repeats.Windows("word", window, PERIOD, COVER, later_only=True)
    texts, starts, _ = repeats.find(spark, docs, spec)
    return repeats.apply(texts, starts, spec, _kept, text=StringType(), n_words=LongType(), n_removed=LongType())


def _kept(s: repeats.Symbols, data: np.ndarray, off: np.ndarray, covered: np.ndarray) -> dict:
    w = s.words
    row = w.row_of()
    kept = np.flatnonzero(~covered)
    edge = np.bincount(w.starts[kept], minlength=len(data) + 1) - np.bincount(w.ends[kept], minlength=len(data) + 1)
    keep = np.cumsum(edge[: len(data)]) > 0
    # one space after each kept word but a document's last
    between = w.ends[kept[:-1][row[kept[1:]] == row[kept[:-1]]]]
    data = data.copy()
    data[between] = 0x20
    keep[between] = True
    removed = np.bincount(row[covered], minlength=len(w.counts))
    return {"text": repeats.binary_column(data, keep, off, pa.string()), "n_words": pa.array(w.counts, pa.int64()), "n_removed": pa.array(removed, pa.int64())}
