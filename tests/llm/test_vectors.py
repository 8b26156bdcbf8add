"""The subspace join against all pairs."""

import numpy as np
import pytest

from tripmart.llm import subspaces
from tripmart.llm.subspaces import Subspaces

SCHEMA = "vec_id long, embedding array<double>, label int, key string, copies int"


def brute(rows, cosine=0.95):
    """{place: (links, component)} by all pairs."""
    good = [i for i, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    scaled = {i: np.array(rows[i][1]) / max(map(abs, rows[i][1])) for i in good}
    unit = {i: v / np.linalg.norm(v) for i, v in scaled.items()}
    near = {i: [j for j in good if j != i and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine] for i in good}
    out = {}
    for i, (own, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near.get(todo.pop(), []):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out[i] = (own, len(near.get(i, [])), min(ids, default=None))
    return out


def scattered(seed, size, groups):
    draw = np.random.default_rng(seed)
    vectors = []
    for n, spread in groups:
        middle = draw.standard_normal(size)
        vectors += [(middle + spread * draw.standard_normal(size)) * draw.uniform(0.1, 9) for _ in range(n)]
    return [v.tolist() for v in vectors]


def compared(spark, vectors, space, ids=None):
    rows = list(zip(range(len(vectors)) if ids is None else ids, vectors, strict=True))
    frame = spark.createDataFrame([(*r, 1, "k", 7) for r in rows], SCHEMA)
    found = subspaces.near_duplicates(frame, space).collect()
    expected = brute(rows, space.cosine)
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in found), key=str) == sorted(expected.values(), key=str)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found)


@pytest.mark.parametrize("space", [Subspaces(), Subspaces(blocks=7, part=16, most_bits=2), Subspaces(cosine=0.9, blocks=1, part=50)])
def test_links_equal_all_pairs(spark, space):
    # Groups around the threshold, a dense one of several parts, and lone vectors.
    groups = [(40, 0.12), (30, 0.22), (60, 0.01), *[(1, 0)] * 80, (20, 0.3)]
    vectors = scattered(3, 24, groups)
    vectors += vectors[:3] * 4 + [[2 * x for x in vectors[0]]]
    compared(spark, vectors, space)


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [None, [], [0.0, 0.0], [1.0, None], [nan, 1.0], [inf, 1.0], [1.0, 0.0], [1.0, 0.0], [2.0, 0.0], [1.0, 0.1], [-0.0, 1.0], [0.0, 1.0]]
    vectors += [[1.0], [3.0], [-1.0], [1.0, 0.0, 0.0], [1e300, 1e300], [1.0, 1.0], [1e-300, 0.0], [1.0, 0.0]]
    compared(spark, vectors, Subspaces(), [0, 1, 2, 3, 4, 5, 6, 6, 8, 9, 10, 11, 12, 13, 14, 15, 16, 17, None, None])
    empty = spark.createDataFrame([], SCHEMA)
    assert subspaces.near_duplicates(empty).collect() == []


def test_a_chain_is_one_class(spark):
    angles = np.arange(0, 3, 0.25)
    compared(spark, [[float(np.cos(a)), float(np.sin(a)), 0.0, 0.0] for a in angles], Subspaces())


def test_pairs_in_reach_meet_in_a_cell():
    """Any two vectors within a block's budget share a cell in which one is at home."""
    space, bits = Subspaces(), 4
    vectors = np.array(scattered(8, 64, [(30, 0.2)] * 6))
    middle = subspaces.units(vectors).mean(axis=0)
    found = [set(p.tolist()) for p in subspaces.places(vectors, middle, space, bits)]
    turned = subspaces.units(vectors) @ subspaces.rotation(64).T
    met = 0
    for i in range(len(vectors)):
        for j in range(i):
            for block, (low, high) in enumerate(space.ranges(64)):
                if ((turned[i, low:high] - turned[j, low:high]) ** 2).sum() <= space.budget * (high - low) / 64:
                    cells = {p >> 1 for p in found[i] if p >> (bits + 1) == block} & {p >> 1 for p in found[j]}
                    assert any(2 * c + 1 in found[i] or 2 * c + 1 in found[j] for c in cells)
                    met += 1
    assert met > 1000


def test_a_hot_cell_is_dealt_out(spark):
    vectors = scattered(4, 16, [(300, 0.001)])
    rows = spark.createDataFrame([(str(i).encode(), 1, v) for i, v in enumerate(vectors)], "key binary, copies long, vector array<double>")
    space = Subspaces(part=32)
    assert sum(r["links"] for r in subspaces.linked(rows, space).collect()) == 300 * 299
