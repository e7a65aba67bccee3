"""The pipeline against its stages by hand, and the entry without the subpackage."""

import hashlib
import os
import re
import shutil
import subprocess
import sys
import tempfile

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline
from conftest import SF001
from test_jaccard import by_hand as groups_by_hand
from test_models import size, targets_by_hand
from test_native import measures_by_hand

REPO = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def good(text):
    """The quality rules, all of them, in plain Python."""
    text = text or ""
    n, chars, symbols, dup, _, failed = measures_by_hand(text)
    ws = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    letters, upper = sum(c.isalpha() for c in text), sum(c.isupper() for c in text)
    ellipses = sum(bool(re.search(r"(\.\.\.|…)\s*$", x)) for x in lines)
    bullets = sum(bool(re.search(r"^\s*[-*•]", x)) for x in lines)
    return not (
        failed or 5 * symbols > n or 10 * upper > 6 * letters or 2 * chars < 5 * n or chars > 14 * n
        or 10 * sum(a == b for a, b in zip(ws, ws[1:])) > 3 * n or 10 * dup > 3 * len(lines)
        or 10 * sum(any(c.isalpha() for c in w) for w in ws) < 6 * n
        or bullets > 0.9 * max(len(lines), 1) or ellipses > 0.3 * max(len(lines), 1)
    )


def by_hand(rows):
    """(doc_id, how often) after the filtering stages and the mix; the mix's cut copy is the only one that may differ."""
    rows = [r for r in rows if good(r[1])]
    last = {}
    for i, t, s in rows:
        last[t or ""] = max(i, last.get(t or "", i))
    rows = [r for r in rows if last[r[1] or ""] == r[0]]
    group = {i: g for i, _, g in groups_by_hand([(i, t) for i, t, _ in rows])}
    return [r for r in rows if group[r[0]] == r[0]]


@pytest.fixture(scope="module")
def documents(spark):
    return [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]


def test_pipeline_matches_its_stages_by_hand(spark, documents):
    kept = by_hand(documents)
    assert 50 < len(kept) < len(documents)
    got = corpus_pipeline.run(spark, SF001).collect()
    times = {}
    for r in got:
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    assert set(times) <= {i for i, _, _ in kept} and max(times.values()) <= 2
    sizes, took, largest = {}, {}, {}
    for i, t, s in kept:
        sizes[s] = sizes.get(s, 0) + size(t)
        took[s] = took.get(s, 0) + size(t) * times.get(i, 0)
        largest[s] = max(largest.get(s, 0), size(t))
    for s, target in targets_by_hand(sizes).items():
        assert abs(took[s] - target) <= largest[s] / 2 + 1, s
    library, texts = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), {i: t for i, t, _ in kept}
    for r in got:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.n_tokens == len(ids)
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "exact dedup", "n-gram Jaccard join", "mixing sources", "BPE"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF001).schema == docs.schema


ODD = T.StructType([T.StructField(n, t) for n, t in zip(COLUMNS + ["id", "row_key", "kept", "text_hash"], (T.LongType(), T.StringType(), T.StringType(), T.StringType(), T.LongType()) + (T.StringType(),) * 4)])


@pytest.mark.parametrize("empty", [False, True])
def test_stages_take_odd_rows(spark, empty):
    """Nulls in every column, empty and very long texts, repeated rows, columns of clashing names; no rows at all."""
    words = " ".join(f"word{k}" for k in range(60))
    rows = [(1, words, "en", "a", 3), (1, words, "en", "a", 3), (None, words, None, None, None), (2, None, "en", "a", 0), (3, "", None, "b", None)]
    rows += [(4, " ".join(f"text{k}" for k in range(40_000)), "de", None, 1), (5, words + " more", "en", "a", 3), (None, None, None, None, None)]
    docs = spark.createDataFrame([r + ("x",) * 4 for r in ([] if empty else rows)], ODD)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF001)
        if name != "BPE":
            assert out.columns == docs.columns
        got = out.collect()
        assert not (empty and got)
    if not empty:
        assert {r.doc_id for r in corpus_pipeline.quality_rules(spark, docs, SF001).collect()} == {1, None, 4, 5}
        assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, SF001).collect()} == {1, 2, 3, 4, None}


def test_every_operator_and_the_pipeline_are_registered():
    names = list(E.queries())
    assert "pipeline" in names
    for k in range(1, 11):
        assert sum(n.startswith(f"op{k}_") for n in names) == 1


def test_entry_without_the_subpackage():
    """Left over caches of the folder do not count as the subpackage; other faults still show."""
    copy = os.path.join(tempfile.mkdtemp(prefix="tidemark-copy-"), "repo")
    shutil.copytree(REPO, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    os.makedirs(os.path.join(copy, "tidemark", "llm", "__pycache__"))
    code = "import __spark_entry__ as E; q = E.queries(); assert len(q) >= 42 and 'pipeline' not in q and set(E.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, timeout=120, env=os.environ | {"PYTHONPATH": copy})
    os.makedirs(os.path.join(copy, "tidemark", "llm", "queries"))
    with open(os.path.join(copy, "tidemark", "llm", "queries.py"), "w") as f:
        f.write("import nowhere_to_be_found\n")
    os.rmdir(os.path.join(copy, "tidemark", "llm", "queries"))
    failed = subprocess.run([sys.executable, "-c", code], cwd=copy, timeout=120, env=os.environ | {"PYTHONPATH": copy}, capture_output=True, text=True)
    assert failed.returncode and "nowhere_to_be_found" in failed.stderr


def test_nothing_else_imports_the_subpackage():
    for folder, _, files in os.walk(os.path.join(REPO, "tidemark")):
        for name in files:
            if name.endswith(".py") and "llm" not in folder.split(os.sep):
                with open(os.path.join(folder, name), encoding="utf-8") as f:
                    assert "llm" not in f.read(), name


def test_native_operators_have_no_python_in_their_plans(spark):
    for name in ("op5_exact_dedup", "op6_secret_scan", "op7_quality_rules"):
        plan = E.queries()[name](spark, SF001)._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow", plan), name


def test_scan_operators_do_not_shuffle_texts(spark):
    for name in ("op1_license_scan", "op4_bpe"):
        assert "Exchange" not in E.queries()[name](spark, SF001)._jdf.queryExecution().executedPlan().toString(), name


def test_counts_of_pipeline_rows_repeat(spark):
    first, second = (corpus_pipeline.run(spark, SF001).select("doc_id", F.sha2("ids", 256).alias("x")).collect() for _ in range(2))
    assert sorted(map(tuple, first)) == sorted(map(tuple, second))
