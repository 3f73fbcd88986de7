"""The pipeline: stages on made documents, and that it is not needed elsewhere."""

import random
import subprocess
import sys
import zlib
from pathlib import Path

import corpus_pipeline as P
import numpy as np
import pytest
from tests.conftest import ROOT, SF
from tests.llm.test_links import groups
from tests.llm.test_models import brute_ids
from tests.llm.test_windows import words_brute


def test_stages(spark, tmp_path):
    assert [n for n, _ in P.STAGES] == ["language_id", "ngram_jaccard_join", "substring_dedup", "benchmark_decontamination", "packing"]
    words = lambda a, n: " ".join(f"{'the' if k % 3 else 'and'} thing{a}{k}" for k in range(n))
    base = [words(a, 40) for a in "abcdef"]
    texts = [*base, base[0], base[1] + " more", "12 34", None, words("z", 30) + " " + words("a", 25), words("p", 5) + " " + words("q", 12)]
    spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, words("q", 9))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = docs
    for name, f in P.STAGES[:4]:
        kept = f(spark, kept, str(tmp_path))
        kept.write.parquet(str(tmp_path / name))
        kept = spark.read.parquet(str(tmp_path / name))
        assert kept.columns == docs.columns
    lang = {r.doc_id for r in spark.read.parquet(str(tmp_path / "language_id")).collect()}
    assert lang == set(range(len(texts))) - {8, 9}
    near = {r.doc_id for r in spark.read.parquet(str(tmp_path / "ngram_jaccard_join")).collect()}
    assert near == {d for d in lang if groups(texts)[d][1] == d}
    got = {r.doc_id: (r.text, r.n_chars) for r in spark.read.parquet(str(tmp_path / "substring_dedup")).collect()}
    brute = dict(zip(sorted(near), words_brute([texts[d] for d in sorted(near)], 20), strict=True))
    assert got == {d: (t, len(t)) for d, (t, n, gone) in brute.items() if gone < n or not n}
    assert {r.doc_id for r in kept.collect()} == set(got) - {11}


def test_run_against_brute_force(spark, tmp_path):
    """run() over near copies, shared passages, benchmark windows, texts without words and rows without doc_id, against plain loops over what the language stage keeps."""
    r = random.Random(12)
    words = [f"{a}{b}" for a in ("the", "and", "thing", "water", "house") for b in range(60)]
    some = lambda n: " ".join(r.choice(words) for _ in range(n))
    passage, item = some(30), some(14)
    texts = [some(r.randint(5, 90)) for _ in range(30)]
    for k in range(0, 12, 3):
        w = texts[k].split() * 2
        texts.append(" ".join([*w, "water1"]))
        texts.append(" ".join(w))
    texts += [some(10) + " " + passage + " " + some(20), passage + " " + some(15), passage, some(20) + " " + item, item[: len(item) // 2] + " " + some(9), "12 3", None, "", " ", "word " * 3000]
    rows = [(k, t, "en", None, len(t or "")) for k, t in enumerate(texts)] + [(None, some(12), None, "s", None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, item), (1, None), (2, "...")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = {g.doc_id: g.text for g in P.language_stage(spark, docs, "").collect()}
    assert set(kept) < {d for d, *_ in rows} and None in kept
    ids = sorted((d for d in kept if d is not None))
    group = [g for _, g in groups([kept[d] for d in ids])]
    ids = [d for k, d in enumerate(ids) if group[k] == k]
    order = [None, *ids]
    left = {d: t for d, (t, n, gone) in zip(order, words_brute([kept[d] for d in order], 20), strict=True) if gone < n or not n}
    known = item.split()
    left = {d: t for d, t in left.items() if not any(t.split()[i : i + 10] == known[k : k + 10] for i in range(len(t.split()) - 9) for k in range(len(known) - 9))}
    assert 20 < len(left) < len(order) < len(kept)
    want = dict(zip(left, brute_ids(left.values()), strict=True))
    got = {}
    for g in P.run(spark, str(tmp_path)).collect():
        assert g.doc_tokens == len(want[g.doc_id])
        assert g.ids_crc32 == zlib.crc32(np.array(want[g.doc_id][g.start : g.start + g.length], "<u4").tobytes())
        got.setdefault(g.doc_id, []).append((g.start, g.length))
    assert set(got) == set(want)
    for d, parts in got.items():
        assert [s for s, _ in sorted(parts)] == list(np.cumsum([0, *(n for _, n in sorted(parts))])[:-1]) and sum(n for _, n in parts) == len(want[d])


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert P.run(spark, str(tmp_path)).count() == 0


def test_run(spark):
    out = P.run(spark, SF)
    assert out.where("length > 2048 or offset < 0").count() == 0 and out.select("doc_id").distinct().count() > 50


@pytest.mark.parametrize("code", ["import tickforge.queries, tickforge.cli, bench; assert not [m for m in sys.modules if m.startswith('tickforge.llm')]", "import __spark_entry__ as e; assert 'pipeline' in e.queries()"])
def test_library_stands_alone(code):
    subprocess.run([sys.executable, "-c", f"import sys; {code}"], cwd=ROOT, check=True, timeout=120)


def test_nothing_else_imports_the_subpackage():
    for p in Path(ROOT, "tickforge").rglob("*.py"):
        assert "llm" in p.parts or "tickforge.llm" not in p.read_text()
