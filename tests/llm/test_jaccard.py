"""N-gram Jaccard join against all pairs by hand."""

import random

import numpy as np
import pytest
from pyspark.sql import types as T

from conftest import SF001
from tidemark.llm import jaccard, queries
from tidemark.llm.count_tree import CountTree, counts, folded, groups_for, likely_pairs, needed, overlap_bound, packed, unpacked
from tidemark.llm.graph import components

SCHEMA = T.StructType([T.StructField(n, t) for n, t in (
    ("doc_id", T.LongType()), ("text", T.StringType()), ("node", T.StringType()), ("n", T.LongType()), ("component_id", T.StringType()), ("h", T.StringType()))])


def frame(spark, pairs):
    return spark.createDataFrame([(i, t, "x", 1, "y", "z") for i, t in pairs], SCHEMA)


def shingles(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text).split(" ") if w]
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def by_hand(pairs):
    sets = [shingles(t) for _, t in pairs]
    group = list(range(len(pairs)))

    def top(k):
        while group[k] != k:
            k = group[k]
        return k

    for i in range(len(pairs)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                group[top(i)] = top(j)
    ids = {}
    for k, (i, _) in enumerate(pairs):
        if i is not None:
            ids[top(k)] = min(i, ids.get(top(k), i))
    return sorted(((i, len(sets[k]), ids.get(top(k)) if sets[k] else i) for k, (i, _) in enumerate(pairs)), key=repr)


def close(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return " ".join(words)


def hard_cases():
    """Near copies around the threshold, chains, one passage in many texts, long and short texts, copies."""
    rng, texts = random.Random(4), []
    passage = " ".join(f"p{k}" for k in range(60))
    for n in (30, 80, 200, 700):
        base = [f"w{n}x{k}" for k in range(n)]
        texts += [close(rng, base, e) for e in range(0, max(3, n // 14)) for _ in range(2)]
    base = [f"chain{k}" for k in range(300)]
    for _ in range(40):
        for _ in range(3):
            base[rng.randrange(300)] = f"c{rng.randrange(10**6)}"
        texts.append(" ".join(base))
    texts += [" ".join(f"u{k}x{j}" for j in range(rng.randrange(20, 90))) + " " + passage for k in range(60)]
    texts += [passage, passage.upper(), passage + " more", "a b c d", "a b c d", "A\tB c\nd", "a b c", "one", "", None, "  \n", "a b c d e", "x " * 3000, "x x x x x", "é É", "É é"]
    texts += [" ".join(f"long{k}" for k in range(20_000)), " ".join(f"long{k}" for k in range(18_000))]
    pairs = [(1000 - k, t) for k, t in enumerate(texts)]
    return pairs + [(None, passage), (None, "a lonely null id"), (5, passage), (5, passage), (None, "")]


@pytest.mark.parametrize("sample", [1, 16])
def test_groups_of_hard_cases(spark, sample):
    pairs = hard_cases()
    got = jaccard.similar_groups(frame(spark, pairs).repartition(5), sample=sample)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect()), key=repr) == by_hand(pairs)


def test_tiles_and_parts_do_not_change_the_groups(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE", 7)
    monkeypatch.setattr(jaccard, "PART", 3)
    pairs = hard_cases()
    assert sorted(map(tuple, jaccard.similar_groups(frame(spark, pairs)).collect()), key=repr) == by_hand(pairs)


def test_query_and_one_of_each(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    pairs = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = by_hand(pairs)
    assert sorted(map(tuple, queries.op10_jaccard_join(spark, SF001).collect()), key=repr) == want
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _, c in want if i == c}


def test_empty_table(spark):
    none = frame(spark, [])
    assert jaccard.similar_groups(none).count() == 0
    assert jaccard.one_of_each(none).count() == 0


def test_bounds_never_lose_a_similar_pair():
    rng = np.random.default_rng(2)
    sets = []
    for n in (1, 3, 10, 40, 40, 100, 300, 1000):
        base = rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2)
        for edit in (0, 1, n // 12, n // 7, n // 5):
            other = base.copy()
            other[:edit] = rng.integers(0, 2**63, edit, dtype=np.uint64)
            sets.append(np.unique(np.concatenate([other, rng.integers(0, 2**63, edit // 2, dtype=np.uint64)])))
    points = [(unpacked(packed(s)), len(s)) for s in sets]
    assert all(np.array_equal(p, counts(s, groups_for(len(s)))) for (p, _), s in zip(points, sets))
    want = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if jaccard.similar(sets[i], sets[j])}
    found = {p for p in likely_pairs(points, points, 75) if p[0] < p[1]}
    assert want <= found and len(found) < len(sets) * (len(sets) - 1) / 8
    half = len(sets) // 2
    across = {(i, j + half) for i, j in likely_pairs(points[:half], points[half:], 75)}
    assert {(i, j) for i, j in want if i < half <= j} <= across
    for i, j in want:
        a, b = sets[i], sets[j]
        assert overlap_bound(points[i][0], points[j][0]) >= len(np.intersect1d(a, b)) >= needed(len(a), len(b), 75)
        assert np.intersect1d(a[: jaccard.prefix(len(a))], b[: jaccard.prefix(len(b))]).size


def test_tree_finds_what_a_scan_finds():
    rng = np.random.default_rng(9)
    points = (rng.poisson(3, (500, 32)) + (rng.integers(0, 9, (500, 1)) == 0) * rng.poisson(2, (500, 32))).astype(np.uint8)
    sizes = points.sum(1, dtype=np.int64)
    tree = CountTree(points, sizes)
    for k in range(0, 500, 11):
        scan = {r for r in range(500) if 100 * min(sizes[r], sizes[k]) >= 75 * max(sizes[r], sizes[k])
                and np.minimum(points[r], points[k]).sum(dtype=np.int64) >= needed(sizes[k], sizes[r], 75)}
        assert set(map(int, tree.search(points[k], sizes[k], 75))) == scan
    assert (folded(points).sum(1) == sizes).all()


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(0, 200)] + [(1000, 2000 + k) for k in range(300)] + [(-5, 7000), (7000, -9), (3, 3)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert all(got[k] == 0 for k in range(201)) and all(got[2000 + k] == 1000 for k in range(300))
    assert got[7000] == got[-5] == got[-9] == -9


@pytest.mark.parametrize("often", [0.0, 0.3, 1.0])
def test_similar_pairs_pass_in_the_cell_of_their_first_common_hash(often):
    rng = np.random.default_rng(6)
    for n in (1, 4, 20, 150, 900):
        for _ in range(20):
            a = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
            b = a.copy()
            b[: n // 9] = rng.integers(0, 2**64, n // 9, dtype=np.uint64)
            b = np.unique(b)
            if not jaccard.similar(a, b):
                continue
            frequent = np.sort(rng.choice(np.union1d(a, b), int(often * n), replace=False))
            order = {int(h): (bool(jaccard._is_in(np.array([h]), frequent)[0]), int(h)) for h in np.union1d(a, b)}
            h = min(np.intersect1d(a, b).tolist(), key=order.get)
            assert all(h in np.concatenate(jaccard._first(s, frequent, 75)) for s in (a, b))
            p, q = (jaccard._after(unpacked(packed(s)), h, int(jaccard._is_in(s, frequent).sum()), order[h][0]) for s in (a, b))
            assert overlap_bound(p, q) >= len(np.intersect1d(a, b))
            assert (0, 0) in set(likely_pairs([(p, len(a))], [(q, len(b))], 75))


def test_short_texts_beside_a_star_centre_that_holds_their_common_part(spark):
    """The cells that both and the centre share lie on both sides of 2^63; the pair passes in the first of them only."""
    rng, pairs = random.Random(11), []
    for k in range(3000):
        n = rng.choice((12, 12, 13, 16, 20))
        common = [f"t{k}w{j}" for j in range(n - 1)]
        other = [f"o{k}w{j}" for j in range(rng.randrange(4, 10))]
        texts = [[*common, "a"], [*common, "b"], [*common, *other], [*other, *(f"d{k}w{j}" for j in range(3))]]
        pairs += [(10 * k + j, " ".join(t)) for j, t in enumerate(texts)]
    got = {r.doc_id: r.component_id for r in jaccard.similar_groups(frame(spark, pairs)).collect()}
    want = {i: c for at in range(0, len(pairs), 4) for i, _, c in by_hand(pairs[at : at + 4])}
    assert {i: (got[i], c) for i, c in want.items() if got[i] != c} == {}
