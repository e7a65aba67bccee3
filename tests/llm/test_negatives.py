import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import negatives

S = "vec_id long, embedding array<float>, label int, id string, score string"


def brute(rows, anchors, positives=5, negatives=10):
    items = {}
    for i, vec, label in rows:
        if i is None or label is None or vec is None or any(x is None or not np.isfinite(x) for x in vec):
            continue
        item = (label, [int(np.floor(256 * float(np.float32(x)))) for x in vec])
        items[i] = min(items.get(i, item), item)
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for a in items:
        if a % anchors:
            continue
        scored = sorted((-dot(items[a][1], v), i) for i, (_, v) in items.items() if i != a)
        for s, p in [(s, i) for s, i in scored if items[i][0] == items[a][0]][:positives]:
            found = [(n, i) for n, i in scored if items[i][0] != items[a][0] and 30 * -s <= 100 * -n <= 90 * -s][:negatives]
            out += [(a, p, k + 1, i, -s, -n) for k, (n, i) in enumerate(found)]
    return sorted(out)


def mined(spark, rows, anchors):
    df = spark.createDataFrame([(i, v, y, "x", "y") for i, v, y in rows], S)
    found = negatives.mine(df, is_anchor=F.col("id") % anchors == 0, label=F.col("label"))
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in found.collect())


def test_equals_brute_force_over_several_blocks(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(0, 0.1, 8).round(2).tolist(), int(rng.integers(0, 4))) for i in range(400)]
    rows += [(1000 + i, rows[i % 7][1], int(i % 4)) for i in range(150)]  # many ties
    monkeypatch.setattr(negatives, "BLOCK_CELLS", 8 * 60)
    got = mined(spark, rows, 20)
    assert got == brute(rows, 20) and len(got) > 500


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], 1), (2, [1.0, 0.4], 1), (4, [0.6, 0.3], 2), (6, [0.5, None], 2), (8, [nan, 1.0], 2), (10, [inf, 1.0], 1), (12, None, 1),
            (14, [0.5, 0.5], None), (None, [0.5, 0.5], 2), (4, [0.6, 0.3], 2), (4, [0.7, 0.3], 3), (16, [], 2), (18, [0.9], 2), (20, [0.0, 0.0], 1)]
    got = mined(spark, rows, 10)
    assert got == brute(rows, 10)
    assert {r[3] for r in got} <= {4, 18, 16}


def test_empty_table_and_no_anchor(spark):
    assert mined(spark, [], 10) == []
    assert mined(spark, [(1, [1.0], 1), (3, [1.0], 2)], 10) == []


def test_block_stops_early_and_keeps_ties():
    rng = np.random.default_rng(2)
    vectors = np.concatenate([rng.integers(-50, 50, (2000, 4)), np.tile([[90, 90, 90, 90]], (30, 1))])
    block = negatives.Block(np.arange(2030)[::-1].copy(), np.r_[np.zeros(2000, int), np.ones(30, int)], vectors)
    anchor = np.array([10, 10, 10, 10])
    ids, scores = block.positives(-1, 1, anchor, 5)
    assert ids.tolist() == [0, 1, 2, 3, 4] and set(scores) == {3600}
    rounds = 0
    for _, _, threshold in block.sorted_access(anchor, None):
        rounds += 1
        if threshold is not None and threshold < 3600:
            break
    assert rounds < 3
    # Scores beyond what doubles hold exactly.
    big = negatives.Block(np.arange(2), np.array([0, 0]), np.array([[2**30, 1], [2**30, 2]]))
    assert big.scores(np.arange(2), np.array([2**31, 1])).tolist() == [2**61 + 1, 2**61 + 2]
