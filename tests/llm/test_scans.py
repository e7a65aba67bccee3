"""Licence scan, byte-pair encoding and personal data against brute force."""

import hashlib
import re
import unicodedata

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given as given_any
from hypothesis import settings
from hypothesis import strategies as st
from pyspark.sql import types as T
from tokenizers import Tokenizer

from conftest import SF001
from tidemark.llm import bpe, licenses, pii, queries

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = T.StructType([T.StructField(n, t) for n, t in (
    ("doc_id", T.LongType()), ("text", T.StringType()), ("ids", T.StringType()), ("row", T.LongType()), ("spans", T.StringType()), ("n_words", T.StringType()))])


def frame(spark, pairs):
    return spark.createDataFrame([(i, t, "x", 1, "y", "z") for i, t in pairs], SCHEMA)


def documents(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()}


def test_scans_of_an_empty_table(spark):
    none = frame(spark, [])
    assert licenses.scan_licenses(none).count() == 0
    assert bpe.encode_documents(none, bpe.Vocabulary(PATH)).count() == 0
    assert pii.find_personal_data(none).count() == 0
    assert pii.sanitise(none).count() == 0


# licences

def base_by_hand(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    out = []
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        out += [(k, label) for k in range(len(words)) if words[k : k + len(p)] == p]
    return len(words), sorted(out)


LICENSE_TEXTS = [
    "Licensed under CC BY-NC 4.0.", "GNU General Public License, version 3 cc-by CC/BY", "ALL rights\nreserved all Rights reserved", None, "", "É CC by",
    "SPDX-License-Identifier: GPL-3.0-or-later", "the MIT License", "mit Lizenz", "apache 2.0 " * 3000, "cc by " * 20_000,
]


def test_license_scan(spark):
    pairs = list(enumerate(LICENSE_TEXTS)) + [(i + 100, t) for i, t in documents(spark).items()] + [(None, "cc by"), (1, "cc by")]
    got = licenses.scan_licenses(frame(spark, pairs)).collect()
    assert sorted(((r.doc_id, r.n_words, sorted((b.first, b.label) for b in r.base)) for r in got), key=repr) == sorted(((i, *base_by_hand(t)) for i, t in pairs), key=repr)


def test_license_labels():
    scan = licenses.Scanner(licenses.license_rules()).scan
    want = {
        "Licensed under CC BY-NC 4.0.": {"cc-by-nc-4.0"}, "the GNU General Public License, version 3 ": {"gpl-3.0"},
        "Apache License, Version 2.0, or MIT License": {"apache-2.0", "mit"}, "SPDX-License-Identifier: GPL-3.0-or-later": {"gpl-3.0-or-later"},
        "GNU Lesser General Public License v2.1": {"lgpl-2.1"}, "nothing at all": set(), "admit licenseless": set(),
    }
    assert {t: {f[0] for f in scan(t)["found"]} for t in want} == want


def test_license_suppression_matches_brute_force():
    """Every match of every rule, none skipped for its keyword; containment checked pair by pair."""
    rules = licenses.license_rules()
    scanner = licenses.Scanner(rules)
    assert len(rules) > 250
    for text in [t for t in LICENSE_TEXTS[:9] if t] + [r.pattern.replace("(?: ", " ").replace(")?", "") for r in rules]:
        line = f" {b' '.join(licenses.words_of(text)).decode()} "
        stands = []
        for rule, pattern in zip(rules, scanner.patterns):
            new = []
            for m in pattern.finditer(line):
                assert rule.keyword in line
                first = line[: m.start()].count(" ") - 1
                end = first + m.group().count(" ") + 1
                if not any(a <= first and end <= e for _, a, e, _ in stands):
                    new.append((rule.label, first, end, rule.weight))
            stands += new
        assert scanner.scan(text)["found"] == stands


def test_license_query(spark):
    texts = documents(spark)
    rows = queries.op1_license_scan(spark, SF001).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, base = base_by_hand(texts[r.doc_id])
        at = [k for k, _ in base]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (n, len(base), min(at, default=None), max(at, default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in base}))
        labels = r.labels.split(",") if r.labels else []
        assert labels == sorted(set(labels)) and {x for _, x in base} <= set(labels)
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(labels)


# byte-pair encoding

@pytest.fixture(scope="module")
def coders():
    return bpe.Encoder(bpe.Vocabulary(PATH)), Tokenizer.from_file(PATH)


def same(coders, text):
    own, library = coders
    packed = own.encode(text)
    ids = library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(packed, "<u4").tolist() == ids
    assert own.decode(packed).decode() == library.decode(ids, skip_special_tokens=False)


BPE_TEXTS = [
    "", " \n\t", "Hello, World's BEST'LL don't", "<|endoftext|> a<|startoftext|>b <|endoftext |>", "ΑΣ ΣΑΣ", "İı ſ K Ǆ é é ẛ̣ 한국어 日本語 𝒳 🎉🎉", "a\x1cb\x1fc\x85d e　f",
    "ab" * 3000, "!" * 3000, "1234567890", "tokenization " * 3000, "xqzjk" * 30, "aaaaaaaaaaaaaaaaaaaaaaaaa", "<|", "</w>", "a</w>b",
]


def test_bpe_equals_the_library(spark, coders):
    for text in [*BPE_TEXTS, *documents(spark).values()]:
        same(coders, text or "")


@settings(max_examples=400, deadline=None)
@given_any(st.text(st.sampled_from("aehinorstlwdÉéüß'Σ1,.!<|> "), max_size=60))
def test_bpe_equals_the_library_on_random_texts(coders, text):
    same(coders, text)


@settings(max_examples=200, deadline=None)
@given_any(st.text(max_size=30).filter(lambda t: all(unicodedata.category(c) != "Cn" for c in t)))
def test_bpe_equals_the_library_on_any_assigned_characters(coders, text):
    same(coders, text)


def test_bpe_compatibility_table_against_merging(coders):
    """Two tokens fit if and only if merging their joined symbols in rank order gives them back."""
    v = coders[0].vocabulary
    rng = np.random.default_rng(5)

    def symbols(k):
        return [k] if v.left[k] < 0 else symbols(v.left[k]) + symbols(v.right[k])

    def merge(ids):
        while True:
            ranked = [(v.merged[p], k) for k, p in enumerate(zip(ids, ids[1:])) if p in v.merged]
            if not ranked:
                return ids
            token, k = min(ranked)
            ids = ids[:k] + [token] + ids[k + 2 :]

    pairs = [tuple(map(int, p)) for p in rng.integers(0, 49_406, (1500, 2))] + [(v.left[k], v.right[k]) for k in range(600, 3000, 7)]
    pairs += [(int(a), int(b)) for a, b in rng.integers(512, 2000, (3000, 2))]
    for a, b in pairs:
        assert v.fits(a, b) == (merge(symbols(a) + symbols(b)) == [a, b]), (a, b)


def test_bpe_documents(spark, coders):
    pairs = list(enumerate(BPE_TEXTS)) + [(None, "null id"), (3, "again"), (99, None), (100, "long " * 30_000)]
    got = bpe.encode_documents(frame(spark, pairs), bpe.Vocabulary(PATH)).collect()
    want = [(i, coders[1].encode(t or "", add_special_tokens=False).ids) for i, t in pairs]
    assert sorted(((r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in got), key=repr) == sorted(want, key=repr)
    assert all(r.decoded == coders[1].decode(np.frombuffer(r.ids, "<u4").tolist(), skip_special_tokens=False) for r in got)


def test_bpe_query(spark, coders):
    texts = documents(spark)
    for r in queries.op4_bpe(spark, SF001).collect():
        ids = coders[1].encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(coders[1].decode(ids, skip_special_tokens=False).encode()).hexdigest()


# personal data

def base_pii_by_hand(text):
    """The patterns as they stand in the contract."""
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((0, *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((1, *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m.group() if c.isdigit()]
        if 16 <= len(digits) <= 19 and sum(d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(reversed(digits))) % 10 == 0:
            out.append((2, *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((3, *m.span()))
    return out


PII_TEXTS = [
    "é𝒳 mail a.b@c.d.e, x@y a@b@c.de .@-.- a@b..c _%+-@x.yy", "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 001.02.3.4 1.2.3", "4111 1111 1111 1111 4111-1111-1111-1112 4111111111111111",
    "+1 (803) 555-5351 +1 555 +123456789012345678 ++12345678 + 12345678", None, "", "9" * 3000 + ".1.2.3", "a" * 200_000, "a@b.c" * 2000, "+1 2345678" * 500, "1-" * 5000,
]


@settings(max_examples=500, deadline=None)
@given_any(st.text(st.sampled_from("ab.@-+%_ 0123456789()"), max_size=60))
def test_personal_patterns_on_random_texts(text):
    assert pii.personal_spans(text) == base_pii_by_hand(text)


def test_personal_data(spark):
    pairs = list(enumerate(PII_TEXTS)) + [(i + 100, t) for i, t in documents(spark).items()] + [(None, PII_TEXTS[0]), (3, PII_TEXTS[0])]
    got = pii.find_personal_data(frame(spark, pairs)).collect()
    base = sorted(((r.doc_id, [tuple(s) for s in r.spans if s.kind < 4]) for r in got), key=repr)
    assert base == sorted(((i, base_pii_by_hand(t) if t != "a" * 200_000 else []) for i, t in pairs), key=repr)


def test_disclosing_terms_against_counting(spark):
    """Terms that meet a value in three contexts and nowhere else disclose it; frequent ones and copies do not."""
    texts = [f"{x} the headmaster Quimby wrote jo@ex.org about number {k}" for k, x in enumerate(("Alpha", "Gamma", "Delta", "Kappa"))]
    texts += ["the number about nothing wrote"] * 40 + ["copy beside other@ex.org Smithers"] * 5
    pairs = list(enumerate(texts))
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in pii.find_personal_data(frame(spark, pairs)).collect()}

    def word(k, span):
        return texts[k][span[1] : span[2]].lower()

    assert {word(k, s) for k in range(4) for s in got[k] if s[0] == 4} == {"headmaster", "quimby"}
    assert all(s[0] == 0 for k in range(44, 49) for s in got[k])
    assert all(not got[k] for k in range(4, 44))
    clean = {r.doc_id: r.text for r in pii.sanitise(frame(spark, pairs), {"headmaster": "employee"}).collect()}
    assert clean[0] == "Alpha the employee  wrote [email] about number 0"
    assert clean[10] == texts[10]


def test_a_signature_that_never_changes_discloses(spark):
    """The same line beside the value in different documents; copies of one document count once."""
    line = "Jane Example, Acme Corporation, jane@acme.com"
    fill = "nothing of note stands in this long paragraph about plain weather and roads " * 2
    texts = [f"letter {w} {fill}{line} {fill}" for w in ("first", "second", "third")] + [f"{fill} copy of Smithers joe@ex.org {fill}"] * 4 + [fill] * 40
    got = {r.doc_id: [texts[r.doc_id][s.start : s.end] for s in r.spans if s.kind == 4] for r in pii.find_personal_data(frame(spark, list(enumerate(texts)))).collect()}
    assert all({"Jane", "Example", "Acme", "Corporation"} <= set(got[k]) for k in range(3))
    assert all(not got[k] for k in range(3, 47))


def test_terms_far_from_the_value_and_in_other_documents(spark):
    """Short terms and terms with digits count, at any distance; every occurrence is marked, beside the value or not."""
    gap = " plain weather and roads" * 20
    texts = [f"Zed X9 {w}{gap} jane@acme.com{gap} zed" for w in ("first", "second", "third")] + ["Zed and roads", "roads zed_x9 weather"] + [f"plain{gap} roads {k}" for k in range(2000)]
    got = {r.doc_id: [texts[r.doc_id][s.start : s.end] for s in r.spans if s.kind == 4] for r in pii.find_personal_data(frame(spark, list(enumerate(texts)))).collect()}
    assert got[0] == got[1] == got[2] == ["Zed", "X9", "zed"]
    assert got[3] == ["Zed"] and got[4] == ["zed", "x9"]
    assert all(not got[k] for k in range(5, len(texts)))
    clean = {r.doc_id: r.text for r in pii.sanitise(frame(spark, list(enumerate(texts))), {"zed": "someone"}).collect()}
    assert clean[0] == f"someone  first{gap} [email]{gap} someone" and clean[3] == "someone and roads"


def test_personal_query(spark):
    texts = documents(spark)
    for r in queries.op8_personal_data(spark, SF001).collect():
        base = base_pii_by_hand(texts[r.doc_id])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[0] == k for s in base) for k in range(4))
        assert r.base_sha256 == hashlib.sha256(",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
