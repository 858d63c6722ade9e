"""Embedding near-duplicates against all cosines."""

import math

import numpy as np
import pytest

from llm_helpers import llm  # noqa: F401
from tillroll.llm import vector_dedup


def plain(rows, threshold=0.93):
    def cosine(a, b):
        if a[2] is None or a[2] != b[2] or len(a[1]) != len(b[1]):
            return -1
        x, y = np.array(a[1], float), np.array(b[1], float)
        return x @ y / math.sqrt(x @ x) / math.sqrt(y @ y)

    good = [r[1] is not None and len(r[1]) > 0 and all(v is not None and math.isfinite(v) for v in r[1])
            and any(r[1]) and r[2] is not None for r in rows]
    links = [[j for j in range(len(rows)) if j != i and good[i] and good[j]
              and cosine(rows[i], rows[j]) >= threshold] for i in range(len(rows))]
    out = []
    for i, row in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            new = [k for k in links[todo.pop()] if k not in seen]
            seen.update(new)
            todo += new
        out.append((row[0], len(links[i]), min((rows[k][0] for k in seen if rows[k][0] is not None), default=None)))
    return sorted(out, key=repr)


def make(seed, dim=24):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(6, dim))
    rows = []
    for i in range(160):
        v = centres[r.integers(6)] + r.normal(size=dim) * r.choice([0.05, 0.2, 0.3])
        rows.append((i + 10, [float(x) for x in v.astype(np.float32)], int(r.integers(3))))
    rows += [(1000 + i, [float(x) for x in (centres[0] + r.normal(size=dim) * 0.02).astype(np.float32)], 1)
             for i in range(40)]
    rows += [(2000 + i, rows[0][1], rows[0][2]) for i in range(5)]
    rows += [(rows[1][0], rows[1][1], rows[1][2]), (None, rows[2][1], rows[2][2])]
    rows += [(3000, None, 1), (3001, [], 1), (3002, [0.0] * dim, 1), (3003, [1.0, None] * (dim // 2), 1),
             (3004, [math.inf] + [1.0] * (dim - 1), 1), (3005, [math.nan] * dim, 1), (3006, rows[3][1], None),
             (3007, [1.0, 2.0], 1), (3008, [2.0, 4.0], 1), (3009, [1e-30] * dim, 2), (3010, [3e30] * dim, 2),
             (None, None, None)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, v, g, 7, "x") for i, v, g in rows],
        "vec_id long, embedding array<float>, label int, node long, vec string").repartition(4)


@pytest.mark.parametrize("tile", [512, 12])
def test_links_against_all_pairs(llm, monkeypatch, tile):  # noqa: F811
    monkeypatch.setattr(vector_dedup, "TILE", tile)
    rows = make(3)
    got = vector_dedup.vector_links(frame(llm, rows), recall=0.99999).collect()
    assert sorted(map(tuple, got), key=repr) == plain(rows)


def test_empty_table(llm):  # noqa: F811
    assert vector_dedup.vector_links(frame(llm, make(1)).limit(0)).collect() == []


def test_plan_reaches_the_recall():
    for rows in (1, 100, 10_000, 10_000_000):
        size, tables = vector_dedup.plan_tables(rows, 0.93, 0.995)
        near = vector_dedup.meeting(math.sqrt(2 - 2 * 0.93))
        assert 1 - (1 - near ** size) ** tables >= 0.995
        assert rows * vector_dedup.meeting(math.sqrt(2)) ** size <= vector_dedup.CHANCE
    near = vector_dedup.meeting(0.4)
    r = np.random.default_rng(0)
    gap, shift = 0.4 * r.normal(size=200_000), r.uniform(0, 2, 200_000)
    assert abs((np.floor((gap + shift) / 2) == 0).mean() - near) < 0.005


def test_big_groups_are_products(llm, monkeypatch):  # noqa: F811
    """A bucket of more than 64 rows takes the other path to the same links."""
    r = np.random.default_rng(4)
    base = r.normal(size=16)
    rows = [(i, [float(x) for x in (base + r.normal(size=16) * 0.18).astype(np.float32)], 0) for i in range(150)]
    got = vector_dedup.vector_links(frame(llm, rows), recall=0.99999).collect()
    assert sorted(map(tuple, got), key=repr) == plain(rows)
