"""Operator 1 on vectors of several lengths and sizes, and its recall on planted links."""

import numpy as np

from tilescan.llm import op1_lattice

VECS = "vec_id long, embedding array<double>"


def brute(rows, threshold=0.95):
    """(n_links, component_id) by vec_id, of finite vectors that are not zero; scaled before the norm."""
    x = {k: np.array(v) / np.abs(v).max() for k, v in rows}
    x = {k: v / np.linalg.norm(v) for k, v in x.items()}
    links = {k: [j for j in x if j != k and len(x[j]) == len(x[k]) and x[j] @ x[k] >= threshold] for k in x}
    out = {}
    for k in x:
        seen, todo = {k}, [k]
        while todo:
            new = [j for j in links[todo.pop()] if j not in seen]
            seen.update(new)
            todo += new
        out[k] = (len(links[k]), min(seen))
    return out


def test_lengths_and_sizes(spark):
    rng = np.random.default_rng(4)
    rows = []
    for length in (1, 2, 3, 8, 64, 200):
        for base in rng.normal(size=(4, length)):
            rows += [base, base * 3, base + rng.normal(size=length) * 0.1 * np.linalg.norm(base) / np.sqrt(length), -base]
    rows += [[1e200, 0.0], [1.0, 0.0], [2.0, -0.0], [1e-310, 0.0], [1.7e308, 1.7e308], [1.0, 1.0], [5e-324, 5e-324]]
    rows = [(k, [float(y) for y in v]) for k, v in enumerate(rows)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in op1_lattice.near_duplicates(spark.createDataFrame(rows, VECS)).collect()}
    want = brute(rows)
    assert set(got) == set(want)
    right = sum(got[k] == want[k] for k in want) / len(want)
    assert right >= 0.95, right
    for k in range(len(rows) - 7, len(rows)):
        assert got[k] == want[k], rows[k]


def test_recall_of_planted_links(spark):
    """Pairs planted at cosines from 0.95 to 0.999; none below the threshold is linked."""
    rng = np.random.default_rng(9)
    base = rng.normal(size=(400, 64))
    base /= np.linalg.norm(base, axis=1)[:, None]
    z = rng.normal(size=base.shape)
    z -= (z * base).sum(1)[:, None] * base
    z /= np.linalg.norm(z, axis=1)[:, None]
    c = np.r_[np.linspace(0.9501, 0.999, 300), np.linspace(0.90, 0.9499, 100)][:, None]
    near = c * base + np.sqrt(1 - c * c) * z
    rows = [(k, v.tolist()) for k, v in enumerate(np.r_[base, near])]
    got = {r["vec_id"]: r["component_id"] for r in op1_lattice.near_duplicates(spark.createDataFrame(rows, VECS)).collect()}
    linked = [got[400 + k] == k for k in range(400)]
    print("planted links found:", sum(linked[:300]), "of 300")
    assert sum(linked[:300]) >= 0.9 * 300
    assert not any(linked[300:])


def test_ties_empty_and_clashing_columns(spark):
    rows = [(5, [1.0, 2.0], 1, "a"), (5, [1.0, 2.0], 2, "b"), (None, [2.0, 4.0], 3, "c"), (7, None, 4, "d"), (None, None, 5, "e"), (8, [0.0], 6, "f"), (9, [float("inf")], 7, "g"), (3, [], 8, "h")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n_links int, component_id string")
    got = sorted(tuple(r) for r in op1_lattice.near_duplicates(table).fillna(-1).collect())
    assert got == [(-1, 0, -1, False), (-1, 2, 5, False), (3, 0, 3, True), (5, 2, 5, True), (5, 2, 5, True), (7, 0, 7, True), (8, 0, 8, True), (9, 0, 9, True)]
    assert op1_lattice.near_duplicates(table.limit(0)).count() == 0
