import numpy as np
import pytest

from larder.llm import hard_negatives

ROWS = "vec_id long, embedding array<float>, label int, place string, block string"


def brute_force(rows):
    """All scores of all rows, in Python integers."""
    part = []
    for vec_id, v, label, *_ in rows:
        if vec_id is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        part.append((vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label, [int(np.floor(256 * float(np.float32(x)))) for x in v]))
    out = []
    for a, label, v in part:
        if a % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), b, other) for b, other, w in part)
        for ps, p, _ in [s for s in scored if s[2] == label and s[1] != a][:5]:
            window = [s for s in scored if s[2] != label and 80 * -ps <= 100 * -s[0] <= 100 * -ps][:5]
            out += [(a, p, n, b, -ps, -s) for n, (s, b, _) in enumerate(window, 1)]
    return sorted(out)


def mined(spark, rows, **how):
    frame = spark.createDataFrame(rows, ROWS).repartition(3)
    return sorted(tuple(r) for r in hard_negatives.mine(frame, **how).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def vectors(n, centres, width=12, labels=4, noise=0.1, seed=3):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(centres, width))
    picked = rng.integers(0, centres, size=n)
    x = centre[picked] + noise * rng.normal(size=(n, width))
    x /= np.linalg.norm(x, axis=1)[:, None]
    return [(i, x[i].tolist(), int(rng.integers(0, labels)), "mine", "mine") for i in range(n)]


def test_equals_brute_force_in_many_blocks_pages_and_groups(spark):
    rows = vectors(1500, 12)
    assert len(want := brute_force(rows)) > 200
    assert mined(spark, rows, block_rows=16, page_blocks=20, group_anchors=4) == want


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(320, 5, labels=2)
    rows += [(None, [0.5] * 12, 1, None, None), (400, None, 1, None, None), (401, [0.5] * 12, None, None, None), (402, [nan] * 12, 1, None, None), (403, [inf] * 12, 1, None, None), (404, [None] * 12, 1, None, None)]
    rows += [(500, [], 1, None, None), (600, [0.5, 0.5], 1, None, None), (601, [-0.25] * 13, 0, None, None), (700, [0.0] * 12, 1, None, None)]
    rows += [rows[100], rows[100], rows[7]] + [(800 + i, [0.125] * 12, i % 2, None, None) for i in range(60)]  # repeated rows and equal vectors
    assert mined(spark, rows, block_rows=16, page_blocks=4, group_anchors=3) == brute_force(rows)


def test_empty_tables_and_no_anchors(spark):
    assert mined(spark, []) == [] and mined(spark, vectors(50, 2)[1:]) == []


def test_clustered_blocks_are_skipped(spark):
    rows = vectors(4000, 40, width=8, noise=0.01)
    frame = spark.createDataFrame(rows, ROWS)
    blocks, width = hard_negatives.build_blocks(hard_negatives.usable(frame, 256, (7, 10)), 32)
    pages = hard_negatives.zone_pages(blocks, 1000)
    anchors = hard_negatives.stored(blocks.select("block", "vec_ids", "labels", "flat").mapInArrow(hard_negatives._anchors(100, width, 5), "block long, spot long, anchor_id long, label long, v array<long>, floor long"), "t")
    one_each = anchors.selectExpr("anchor_id AS place", "anchor_id AS `group`", "anchor_id", "label", "v", "array(floor) AS floors", f"array({1 << 62}) AS ceilings")
    read = hard_negatives.chosen_blocks(one_each, blocks, pages, width, 5, True).where("group % 100 = 0").count()
    assert read < 0.4 * 40 * blocks.count()


def test_curve_visits_every_cell_by_single_steps():
    for dimensions, bits in ((2, 3), (3, 2), (4, 1)):
        side = 1 << bits
        cells = np.stack(np.meshgrid(*[np.arange(side)] * dimensions, indexing="ij"), axis=-1).reshape(-1, dimensions)
        keys = [bytes(k) for k in hard_negatives.hilbert_keys(cells, bits)]
        walk = cells[np.argsort(keys, kind="stable")]
        assert len(set(keys)) == len(cells) and (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_and_large_values_stay_exact():
    rng = np.random.default_rng(0)
    x, a = rng.integers(-300, 300, size=(40, 6)), rng.integers(-300, 300, size=(5, 6))
    least, most = hard_negatives.interval(a, x.min(axis=0)[None], x.max(axis=0)[None])
    scores = a @ x.T
    assert (least[:, 0] <= scores.min(axis=1)).all() and (scores.max(axis=1) <= most[:, 0]).all()
    large = np.array([[(1 << 30) + 1, 3]])
    assert hard_negatives._inner(large, large)[0, 0] == ((1 << 30) + 1) ** 2 + 9
