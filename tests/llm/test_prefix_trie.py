import hashlib
import random
from zlib import crc32

import numpy as np
import pytest

from pyspark.sql import functions as F

from tidemark.llm import prefix_trie
from tidemark.llm.prefix_trie import RangeMinimum

S = "conv_id long, turn long, role string, text string, pos string, length string"


def brute(rows, h):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    digest = lambda t: hashlib.md5(f"{len(t[2].encode())}:{t[2]}{t[3]}".encode()).hexdigest()
    for c in convs:
        convs[c] = [t[2:] for t in sorted(convs[c], key=lambda t: (t[0], t[1], digest(t)))]
    built = {c: tuple(convs.get(c - c % 5, [])[: h(c)] + own[h(c) :]) for c, own in convs.items()}
    nodes = {}
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(seq[:d], []).append(c)
    inner = {p[:-1] for p in nodes if p}
    out = []
    for p, members in nodes.items():
        under = [q for q in nodes if q[: len(p)] == p]
        ends = ",".join(str(c) for c in sorted(members) if built[c] == p)
        out.append((
            min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), sum(1 for q in nodes if len(q) == len(p) + 1 and q[:-1] == p),
            sum(1 for q in under if q not in inner), sum((len(nodes[q]) - 1) * len(q[-1][1].encode()) for q in under if q), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def built(spark, rows, h, **sizes):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], S)
    found = prefix_trie.prefix_trie(df, lambda c: c - c % 5, h, 8, **sizes)
    assert found.columns == prefix_trie.OUT
    return sorted((tuple(r) for r in found.collect()), key=str)


def crc(c):
    return F.crc32(c.cast("string").cast("binary")) % 9


@pytest.mark.parametrize("sizes", [{}, {"segment": 2, "block": 3}, {"segment": 3, "block": 1}])
def test_equals_brute_force(spark, sizes):
    rng = random.Random(5)
    rows = []
    for c in range(40):
        for t in range(rng.choice([0, 1, 2, 3, 5, 9])):
            rows.append((c, None if rng.random() < 0.1 else t, rng.choice(["user", None]), rng.choice(["a", "bé", "", None, "ccc"])))
    for c in range(100, 130):  # copies, and what goes on from them
        rows += [(c, t, "user", "same") for t in range(7)] + ([(c, 9, "user", str(c % 3))] if c % 4 == 0 else [])
    rows += [(200, t, "user", f"long {t // 2}") for t in range(13)] + [(None, 1, "user", "nobody"), (201, 1, "r", "x"), (201, 1, "r", "x"), (201, 1, "r", "y")]
    rng.shuffle(rows)
    assert built(spark, rows, crc, **sizes) == brute(rows, lambda c: crc32(str(c).encode()) % 9)


def test_turnless_conversations_and_empty_table(spark):
    rows = [(c, 0, "u", "x") for c in (1, 2, 3, 11)]  # the first of each five is absent, one turn is given up
    eight = lambda c: F.lit(8).cast("long")
    assert built(spark, rows, eight) == brute(rows, lambda c: 8)
    assert built(spark, [], eight) == []


def test_sparse_table_against_scans():
    rng = np.random.default_rng(3)
    values = rng.integers(0, 6, 50)
    values[0] = 0
    table = RangeMinimum(values)
    rows = np.repeat(np.arange(50), 6)
    depths = np.tile(np.arange(6), 50)
    right, left = table.reach_right(rows, depths), table.reach_left(rows, depths)
    for i, d, r, low in zip(rows, depths, right, left):
        assert r == max(j for j in range(i, 50) if all(values[i + 1 : j + 1] >= d))
        assert low == min(j for j in range(i + 1) if all(values[j + 1 : i + 1] >= d))
    first, last = np.sort(rng.integers(0, 50, (2, 200)), axis=0)
    assert table.between(first, last).tolist() == [values[a : b + 1].min() for a, b in zip(first, last)]
