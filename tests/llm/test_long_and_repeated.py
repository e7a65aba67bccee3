"""Very long texts, ids that are text, and rows that repeat."""

import time

import numpy as np

from pyspark.sql import functions as F

from tidemark.llm import exact_dedup, jaccard, secrets
from tidemark.llm.count_tree import folded, likely_pairs
from tidemark.llm.licenses import Scanner, license_rules
from tidemark.llm.license_rules import NAMES


def test_license_rules_are_hundreds_and_gated():
    rules = license_rules()
    assert len(NAMES.strip().splitlines()) >= 200
    assert len(rules) > 300


def test_licenses_of_ten_megabytes():
    piece = "words of a text, Apache License Version 2.0 and so on; all rights reserved. " * 20 + "nothing here at all " * 400
    text = piece * (10_000_000 // len(piece))
    t = time.perf_counter()
    got = Scanner(tuple(license_rules())).scan(text)
    assert time.perf_counter() - t < 30
    per = len(text) // len(piece)
    assert len(got["base"]) == 20 * per and sum(f[0] == "apache-2.0" for f in got["found"]) == 20 * per
    n = got["n_words"] // per
    assert {first % n for _, first, _, _ in got["found"]} == {first % n for _, first, _, _ in got["found"][:20]}


def test_secrets_of_long_texts_and_text_ids(spark):
    line = "password = hunter2secret and more words here\n"
    long = line * 40_000 + "x" * 5_000_000
    rows = [("a", long), ("b", "token: abcdefgh"), ("b", "nothing"), (None, "api_key=zyxwvuts"), (None, None), ("12", "")]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    t = time.perf_counter()
    got = secrets.find_secrets(df).select("doc_id", F.size("spans").alias("n"), F.get("spans", F.lit(0)).alias("first"), F.get("spans", F.size("spans") - 1).alias("last")).collect()
    assert time.perf_counter() - t < 60
    by = sorted(((r.doc_id or "-"), r.n) for r in got)
    assert by == [("-", 0), ("-", 1), ("12", 0), ("a", 40_000), ("b", 0), ("b", 1)]
    whole = next(r for r in got if r.doc_id == "a")
    assert whole.first["start"] == 0 and whole.last["start"] == 39_999 * len(line) and whole.last["end"] == whole.last["start"] + len("password = hunter2secret")


def test_repeated_rows_leave_one(spark):
    rows = [(1, "a b c", "x"), (1, "a b c", "x"), (1, "a b c", "y"), (2, "a b c", "z"), (None, "n", "p"), (None, "n", "q"), (None, "n", "q"), (3, "n", None), (None, "m", "1"), (None, "m", "2"), (5, None, "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept_row string")
    for keep, first in (("min", 1), ("max", 2)):
        got = exact_dedup.drop_duplicates(df, keep=keep)
        assert got.columns == df.columns
        assert sorted((r.doc_id or -1, r.text or "") for r in got.collect()) == sorted([(first, "a b c"), (3, "n"), (-1, "m"), (5, "")])


def test_one_document_of_each_group_though_ids_repeat(spark):
    base = [f"w{k}" for k in range(40)]
    texts = [" ".join(base), " ".join(base[:-1] + ["end"]), " ".join(base[:-1] + ["other"])]
    alone = "quite another text with some words of its own"
    rows = [(7, texts[0]), (7, texts[1]), (9, texts[2]), (7, alone)]
    got = jaccard.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.text == alone for r in got) == [False, True] and all(r.doc_id == 7 for r in got)
    none = [(None, texts[0]), (None, texts[1]), (None, alone), (None, ""), (4, "")]
    got = jaccard.one_of_each(spark.createDataFrame(none, "doc_id long, text string")).collect()
    assert sorted((r.text == alone, r.text == "") for r in got) == [(False, False), (False, True), (False, True), (True, False)]


def test_folds_do_not_wrap():
    assert folded(np.array([[40_000, 40_000, 3, 4]], np.uint16)).tolist() == [[80_000, 7]]
    big = np.array([65_535, 30, 0, 0], np.uint32)
    assert list(likely_pairs([(big[:2], 65_565)], [(big, 65_565)], 75)) == [(0, 0)]
