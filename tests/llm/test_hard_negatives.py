import itertools
import math

import numpy as np
import pytest

from tidemark.llm import hard_negatives as hn

VECTORS = "vec_id bigint, embedding array<float>, label int"


def whole(x):
    return [math.floor(256 * float(np.float32(v))) for v in x]


def brute(rows, positives=5, negatives=10):
    part = []
    for n, (vec_id, x, label) in enumerate(rows):
        if vec_id is None or label is None or x is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        part.append((n, vec_id, whole(x), (label + 1) % 10 if vec_id % 7 == 0 else label))
    out = []
    for a in part:
        if a[1] % 100:
            continue
        scored = sorted(((-sum(map(int.__mul__, a[2], b[2])), b[1], b[0], b[3] == a[3]) for b in part if b[0] != a[0]))
        for p in [s for s in scored if s[3]][:positives]:
            fit = [s for s in scored if not s[3] and 30 * -p[0] <= 100 * -s[0] <= 90 * -p[0]][:negatives]
            out += [(a[1], p[1], i, s[1], -p[0], -s[0]) for i, s in enumerate(fit, 1)]
    return sorted(out)


def found(df):
    return sorted(map(tuple, df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()))


def vectors(n, width, labels, seed, spread=0.3, step=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (labels, width))
    marks = rng.integers(0, labels, n)
    return [(int(i) * step, (0.3 * centres[m] + rng.normal(0, spread, width)).astype(np.float32).tolist(), int(m)) for i, m in enumerate(marks)]


@pytest.fixture
def table(spark):
    return lambda rows: spark.createDataFrame(rows, VECTORS)


@pytest.mark.parametrize(("dims", "bits"), [(1, 3), (2, 4), (3, 2), (4, 2)])
def test_neighbours_on_the_curve_are_neighbours_on_the_grid(dims, bits):
    grid = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    keys = [bytes(k) for k in hn.hilbert_keys(grid, bits)]
    assert len(set(keys)) == len(grid)
    along = grid[sorted(range(len(grid)), key=keys.__getitem__)]
    assert (np.abs(np.diff(along, axis=0)).sum(1) == 1).all()


def test_bounds_hold_for_every_vector_of_a_box():
    rng = np.random.default_rng(1)
    rows = rng.integers(-90, 90, (40, 6))
    anchors = rng.integers(-90, 90, (15, 6))
    least, most = hn.bounds(anchors, rows.min(0)[None], rows.max(0)[None])
    scores = hn.products(anchors, rows)
    assert (scores >= least).all() and (scores <= most).all()
    assert (hn.products(anchors * 10**9, rows * 10**9) == np.clip(scores.astype(object) * 10**18, -hn._MOST, hn._MOST)).all()


@pytest.mark.parametrize("size", [(300, 8, 3), (900, 3, 10)])
def test_random_vectors_equal_brute_force(table, monkeypatch, size):
    rows = vectors(*size, seed=size[0], step=10)
    assert found(hn.mined(table(rows))) == brute(rows)
    # The same with tiny blocks, groups, cells and parts.
    for name, value in (("BLOCK", 7), ("GROUP", 4), ("ZONES", 5), ("GROUPS", 2), ("PART", 3)):
        monkeypatch.setattr(hn, name, value)
    assert found(hn.mined(table(rows))) == brute(rows)


def test_boxes_leave_blocks_out(spark, table, monkeypatch):
    """Few dimensions: of the blocks of an anchor's own label, most are not read, and nothing is lost."""
    monkeypatch.setattr(hn, "BLOCK", 16)
    monkeypatch.setattr(hn, "GROUP", 1)
    rows = vectors(2000, 2, 6, seed=3, step=10)
    assert found(hn.mined(table(rows))) == brute(rows)
    stored = hn.quantised(table(rows), "vec_id", "embedding", "label")
    low, high = hn.ranges(stored)
    blocks = hn.blocks_of(stored, low, high, 100, 5)
    groups = hn.anchor_groups(blocks, 100, "<i2", 2)
    near = hn.chosen_blocks(groups, blocks, "<i2", 2, False)
    same = groups.count() * blocks.count() / 6
    assert near.count() < 0.7 * same


def test_edge_rows(spark, table):
    nan, inf = float("nan"), float("inf")
    rows = vectors(260, 4, 4, seed=8, step=5)
    rows += [(None, [1.0, 1.0, 0.0, 0.0], 1), (1300, None, 1), (1400, [1.0, nan, 0.0, 0.0], 1), (1401, [1.0, None, 0.0, 0.0], 1), (1402, [inf] * 4, 1)]
    rows += [(100, rows[20][1], 2)] * 3 + [(1500, [0.0] * 4, 0), (1507, [0.5] * 4, None), (1600, [0.1] * 4, 77), (-700, [0.3] * 4, 2)]
    rows += [(3000 + i, [0.25, 0.25, 0.0, 0.0], i % 3) for i in range(60)]
    df = table(rows).selectExpr("*", "'clash' AS row", "1 AS rank", "2 AS score", "3 AS block", "4 AS g")
    assert found(hn.mined(df)) == brute(rows)
    assert hn.mined(table([])).count() == 0
    assert hn.mined(table([(0, [], 1), (1, [], 1), (2, [], 2)])).count() == 1  # scores are 0, and 0 lies in the window of 0
    huge = [(i, [3e38 * (-1) ** i, 1.0], i % 2) for i in range(0, 500, 50)]
    hn.mined(table(huge)).count()
    assert hn.mined(table([(0, [1.0], 0), (1, [0.9, 5.0], 1), (2, [0.5, 0.0, 9.0], 2)])).count() == 1


def test_query_on_whole_table(spark):
    from tests.llm.conftest import FOLDER
    from tidemark.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert found(QUERIES["op12_zone_map_negatives"](spark, FOLDER)) == brute(rows)
