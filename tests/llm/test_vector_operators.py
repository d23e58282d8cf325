"""Near vectors by binary codes and top-k on bit slices."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fieldtally.llm import binary_codes, sliced_topk

NAN, INF = float("nan"), float("inf")


def vectors(spark, rows):
    return spark.createDataFrame(
        [(i, v, label, "x", 3) for i, v, label in rows],
        "vec_id long, embedding array<float>, label int, component_id string, score int")


# ---- operator 1

def plain_links(rows, threshold=binary_codes.THRESHOLD):
    """n_links and component of each row, over every pair."""
    def fit(v, label):
        return label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    unit = [np.array(v, np.float32).astype(float) / np.linalg.norm(np.array(v, np.float32).astype(float))
            if i is not None and fit(v, label) else None for i, v, label in rows]
    near = np.zeros((len(rows), len(rows)), bool)
    for a, u in enumerate(unit):
        for b, w in enumerate(unit[:a]):
            if u is not None and w is not None and rows[a][2] == rows[b][2] and len(u) == len(w):
                near[a, b] = near[b, a] = u @ w >= threshold
    ids = [i for i, _, _ in rows]
    component = list(ids)
    changed = True
    while changed:
        changed = False
        for a in range(len(rows)):
            for b in np.flatnonzero(near[a]):
                if component[b] < component[a]:
                    component[a], changed = component[b], True
    return sorted(((i, int(near[a].sum()), component[a], i is not None and component[a] == i)
                   for a, i in enumerate(ids)), key=str)


def found_links(frame):
    return sorted((tuple(r) for r in binary_codes.near_vectors(frame).collect()), key=str)


def test_links_like_every_pair(spark):
    rng = np.random.default_rng(4)
    rows, centres = [], rng.normal(size=(12, 32))
    for i in range(600):
        spread = rng.choice([0.005, 0.02, 0.03])
        base = centres[i % 12] if i % 3 else rng.normal(size=32)
        rows.append((1000 - i, (base + spread * rng.normal(size=32)).tolist(), int(i % 12 % 3)))
    rows += [(2000 + k, rows[7][1], rows[7][2]) for k in range(40)]
    assert found_links(vectors(spark, rows)) == plain_links(rows)


def test_hot_buckets_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(binary_codes, "BLOCK", 16)
    monkeypatch.setattr(binary_codes, "PAIRS", 100)
    rng = np.random.default_rng(5)
    centre = rng.normal(size=24)
    rows = [(i, (centre + 0.03 * rng.normal(size=24)).tolist(), 1) for i in range(150)]
    assert found_links(vectors(spark, rows)) == plain_links(rows)


def test_near_vector_edges(spark):
    one = [1.0, 2.0, 3.0]
    rows = [(1, one, 0), (2, one, 0), (2, one, 0), (3, [2.0, 4.0, 6.0], 0), (4, one, 1), (5, one, None),
            (6, None, 0), (7, [], 0), (8, [0.0, 0.0, 0.0], 0), (9, [1.0, None, 3.0], 0), (10, [NAN, 2.0, 3.0], 0),
            (11, [INF, 2.0, 3.0], 0), (None, one, 0), (12, [1.0, 2.0], 0), (13, [-1.0, -2.0, -3.0], 0),
            (14, [1e30, 2e30, 3e30], 0), (15, [1e-30, 2e-30, 3e-30], 0), (16, [5.0], 0), (17, [0.1], 0)]
    frame = vectors(spark, rows)
    assert found_links(frame) == plain_links(rows)
    assert binary_codes.near_vectors(frame.where("false")).count() == 0
    assert binary_codes.near_vectors(frame.where("vec_id = 6")).count() == 1


def test_codes_are_balanced_and_near():
    rng = np.random.default_rng(6)
    unit = binary_codes.unit_rows(rng.normal(size=(4000, 32)) * np.linspace(2, 0.3, 32))
    codes = binary_codes.Codes(unit, 12, 0.98)
    bits = (unit - codes.mean) @ codes.turn >= codes.cut
    assert np.abs(bits.mean(axis=0) - 0.5).max() < 0.01
    near = unit + rng.normal(size=unit.shape) * 0.02
    near = binary_codes.unit_rows(near)
    linked = (unit * near).sum(axis=1) >= 0.98
    met = (codes.keys(unit) == codes.keys(near)).any(axis=1)
    assert linked.mean() > 0.9 and met[linked].mean() >= 0.999


@pytest.mark.parametrize("dims", [256, 384])
def test_small_groups_off_the_main_axes_are_found(spark, dims):
    rng, rows = np.random.default_rng(12), []
    scale = np.where(np.arange(dims) < 64, 1.0, 0.002)
    for i in range(1000):
        rows.append((i, (scale * rng.normal(size=dims)).tolist(), 1))
    for group in range(8):
        centre = scale[::-1] * rng.normal(size=dims)
        for k in range(6):
            shift = 0.12 * np.linalg.norm(centre) / np.sqrt(dims)
            rows.append((2000 + 10 * group + k, (centre + shift * rng.normal(size=dims)).tolist(), 1))
    expected = plain_links(rows)
    assert sum(links for _, links, _, _ in expected) > 100
    assert found_links(vectors(spark, rows)) == expected


# ---- operator 5

def plain_topk(rows, queries, k=10):
    def fit(v):
        return v and all(x is not None and np.isfinite(x) for x in v)

    whole = [(i, np.floor(np.array(v, np.float32).astype(float) * 1024).astype(int))
             for i, v, _ in rows if i is not None and fit(v)]
    found = set()
    for q, u in {i: v for i, v in whole if i in queries}.items():
        scored = sorted((-int(u @ v), i) for i, v in whole if i != q and len(u) == len(v))
        found |= {(q, rank + 1, i, -score) for rank, (score, i) in enumerate(scored[:k])}
    return found


@settings(max_examples=150, deadline=None)
@given(st.data())
def test_slices_give_exact_scores(data):
    dims, rows = data.draw(st.integers(1, 5)), data.draw(st.integers(1, 90))
    top = data.draw(st.sampled_from([1, 3, 40, 1 << 30]))
    random = np.random.default_rng(data.draw(st.integers(0, 99)))
    values = random.integers(-top, top + 1, (rows, dims))
    query = random.integers(-min(top, 50), min(top, 50) + 1, dims)
    offset, bits, slices = sliced_topk.pack_slices(values)
    valid = np.zeros(slices.shape[2] * 64, np.uint8)
    valid[:rows] = random.random(rows) < 0.9
    ids = random.permutation(rows)
    k = data.draw(st.integers(1, 12))
    found, scores = sliced_topk.block_topk(query, offset, slices, ids, np.packbits(
        valid, bitorder="little").view(np.uint64), k, low=data.draw(st.integers(0, 6)))
    kept = np.flatnonzero(valid)
    wanted = sorted((-int(values[at] @ query), int(ids[at])) for at in kept)[:k]
    assert [(-s, i) for s, i in zip(scores.tolist(), found.tolist())] == wanted


@pytest.mark.parametrize("block_rows", [50, 1 << 14])
def test_topk_like_every_pair(spark, monkeypatch, block_rows):
    monkeypatch.setattr(sliced_topk.build_index, "__defaults__", (block_rows,))
    rng = np.random.default_rng(7)
    rows = [(int(i), rng.normal(size=16).round(1).tolist(), 0) for i in rng.permutation(400)]
    rows += [(1000 + i, rows[0][1], 0) for i in range(30)]
    frame = vectors(spark, rows)
    found = {tuple(r) for r in sliced_topk.top_k(frame.repartition(3), frame.where("vec_id % 20 = 0")).collect()}
    assert found == plain_topk(rows, {i for i, _, _ in rows if i % 20 == 0})


def test_topk_edges(spark):
    rows = [(0, [1.0, -0.5], 1), (0, [1.0, -0.5], 1), (1, [1.0, -0.5], 1), (2, [0.0, 0.0], None),
            (3, None, 1), (4, [], 1), (5, [NAN, 1.0], 1), (6, [1.0, None], 1), (7, [INF, 1.0], 1),
            (None, [1.0, 1.0], 1), (20, [0.5], 1), (40, [0.0, 0.0], 1), (8, [-1.0, 0.5], 1)]
    frame = vectors(spark, rows)
    found = [tuple(r) for r in sliced_topk.top_k(frame, frame.where("vec_id % 20 = 0")).collect()]
    expected = plain_topk([r for r in rows if r[0] != 0], set()) | plain_topk(rows, {0, 20, 40})
    assert set(found) == expected and len(found) == len(expected)
    assert sliced_topk.top_k(frame.where("false"), frame.where("false")).count() == 0
    big = vectors(spark, [(0, [1e30, 1.0], 1), (1, [1.0, 1.0], 1)])
    with pytest.raises(Exception, match="too large"):
        sliced_topk.top_k(big, big).count()


def test_topk_scores_never_wrap(spark):
    vectors = spark.createDataFrame([(0, [2.0 ** 26] * 4), (1, [2.0 ** 26] * 4), (2, [100.0] * 4)],
                                    "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="pass a long"):
        sliced_topk.top_k(vectors, vectors).collect()
    fits = spark.createDataFrame([(0, [2.0 ** 19] * 4), (1, [2.0 ** 19] * 4), (2, [100.0] * 4)],
                                 "vec_id long, embedding array<double>")
    best = sliced_topk.top_k(fits, fits.where("vec_id = 0")).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in best] == [(1, 4 << 58), (2, 4 * 100 * 1024 << 29)]


def test_topk_of_an_id_with_usable_and_unusable_rows(spark):
    vectors = spark.createDataFrame(
        [(100, None), (100, [1.0, 0.0]), (100, [float("nan"), 1.0]), (1, [2.0, 1.0])],
        "vec_id long, embedding array<double>")
    found = sliced_topk.top_k(vectors, vectors.where("vec_id = 100")).collect()
    assert [tuple(r) for r in found] == [(100, 1, 1, 2 * 1024 * 1024)]


def test_query_blocks_are_not_broadcast(spark):
    rng = np.random.default_rng(21)
    rows = [(i, rng.normal(size=4).tolist(), 0) for i in range(60)]
    frame = vectors(spark, rows)
    found = sliced_topk.top_k(frame, frame.where("vec_id % 2 = 0"))
    assert {tuple(r) for r in found.collect()} == plain_topk(rows, set(range(0, 60, 2)))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Broadcast" not in plan
