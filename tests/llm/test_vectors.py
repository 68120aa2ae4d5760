"""Vector codes and whitening against brute force."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import vector_code, whitening

VECTORS = "vec_id long, embedding array<float>, label int"


def rows_of(n, width, seed, scale=0.3):
    rng = np.random.default_rng(seed)
    return [(int(i), [float(np.float32(v)) for v in rng.normal(0, scale, width)], None if i % 7 == 0 else int(i % 3)) for i in range(n)]


def odd_rows(width=16):
    """Nulls, bad entries, repeated rows and ids, a short and an empty vector, a null id, huge entries."""
    rows = rows_of(60, width, 5)
    bad = [(100, None, 1), (101, [float("nan")] * width, 1), (102, [float("inf")] + [0.0] * (width - 1), 1), (103, [None] + [0.5] * (width - 1), None)]
    return [*rows, *bad, rows[3], (4, rows[9][1], 2), (104, rows[1][1][:5], 0), (105, [], None), (None, rows[2][1], 1), (None, rows[2][1], None)]


def frame(spark, rows):
    extra = {"code": "c", "error": 1, "n": 2, "total": "t", "component": 3, "__salt": 0, "row": 1, "entries": 2}
    return spark.createDataFrame(rows, VECTORS).repartition(5).withColumns({k: F.lit(v) for k, v in extra.items()})


def cleaned(rows, width):
    out = [(i, [float(v) for v in e] + [0.0] * (width - len(e)), la) for i, e, la in rows if e is not None and all(v is not None and math.isfinite(v) for v in e)]
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def codes_by_force(rows, width, parts=8, entries=16, rounds=6):
    kept = cleaned(rows, width)
    size = width // parts
    cut = [[[math.floor(4096 * v) for v in e[p * size : (p + 1) * size]] for p in range(parts)] for _, e, _ in kept]
    books = [[list(cut[i][p]) for i in range(min(entries, len(cut)))] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            of = [nearest(p, v[p])[1] for v in cut]
            for e in {*of}:
                own = [v[p] for v, i in zip(cut, of) if i == e]
                books[p][e] = [sum(c) // len(own) for c in zip(*own)]
    digest = hashlib.sha256(",".join(str(c) for p in books for e in p for c in e).encode()).hexdigest()
    found = [(i, [nearest(p, v[p]) for p in range(parts)], la) for (i, _, la), v in zip(kept, cut)]
    errors = {}
    for _, near, la in found:
        errors[la] = errors.get(la, 0) + sum(d for d, _ in near)
    return [(i, "".join(f"{e:02x}" for _, e in near), sum(d for d, _ in near), errors[la], digest) for i, near, la in found]


def key(row):
    return tuple((x is None, x or 0) if not isinstance(x, str) else x for x in row)


@pytest.mark.parametrize("rows, width", [(rows_of(200, 64, 1), 64), (odd_rows(), 16), (rows_of(5, 16, 2), 16), ([(i, [0.25] * 8, 1) for i in range(40)], 8)])
def test_codes_equal_brute_force(spark, rows, width):
    got = vector_code.encode(frame(spark, rows)).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()
    assert sorted((tuple(r) for r in got), key=key) == sorted(codes_by_force(rows, width), key=key)


def test_codes_of_nothing_and_of_many_labels(spark, monkeypatch):
    assert vector_code.encode(frame(spark, [])).collect() == []
    assert vector_code.encode(frame(spark, [(1, None, 1), (2, [float("nan")], 1)])).collect() == []
    monkeypatch.setattr(vector_code, "MOST_KEYS", 0)  # label sums that are not broadcast
    rows = odd_rows()
    got = vector_code.encode(frame(spark, rows)).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()
    assert sorted((tuple(r) for r in got), key=key) == sorted(codes_by_force(rows, 16), key=key)


@pytest.mark.parametrize("width", [1, 2, 8])
def test_cell_bounds_leave_the_nearest_entry_in(width):
    rng = np.random.default_rng(width)
    for case in range(30):
        entries = rng.integers(-50, 50, (16, width)) * (case % 3 > 0) * (1000 if case % 5 == 0 else 1)
        cells = vector_code.CellFile(entries)
        parts = rng.integers(-3000, 3000, (300, width))
        index, distance, refined = cells.nearest(parts)
        exact = ((parts[:, None] - entries) ** 2).sum(axis=2)
        assert (index == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()
        assert 300 <= refined <= 300 * 16


def test_cells_spare_distances():
    """The filter does its work: most entries are ruled out without their distance."""
    rng = np.random.default_rng(1)
    parts = np.floor(4096 * rng.normal(0, 0.3, (2000, 8))).astype(np.int64)
    _, _, refined = vector_code.CellFile(parts[:16]).nearest(parts)
    assert refined < 2000 * 16 * 0.4


def whitened_by_force(rows, width):
    kept = cleaned(rows, width)
    x = [[math.floor(64 * v) + 1000000 for v in e] for _, e, _ in kept]
    n, total = len(x), [sum(c) for c in zip(*x)]
    apart = np.array([[(n * v - s) / n for v, s in zip(r, total)] for r in x])
    covariance = apart.T @ apart / n
    values, axes = np.linalg.eigh(covariance)
    return [i for i, _, _ in kept], n, [sum((n * v - s) ** 2 for v, s in zip(r, total)) for r in x], apart, covariance, values[::-1], axes[:, ::-1]


@pytest.mark.parametrize("rows, width, sound", [(rows_of(300, 64, 3), 64, 32), (odd_rows(), 16, 16), ([(i, [0.1 * i, -0.2 * i, 0.5], 0) for i in range(20)], 3, 2)])
def test_whitening_equals_eigenvectors(spark, rows, width, sound):
    ids, n, deviations, apart, covariance, values, axes = whitened_by_force(rows, width)
    got = whitening.whiten(frame(spark, rows)).collect()
    used = min(32, width)
    assert len(got) == len(ids) * used and {r["n"] for r in got} == {n} and len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9
    assert sorted(((r["vec_id"] is None, r["vec_id"] or 0, r["deviation"]) for r in got if r["component"] == 1)) == sorted((i is None, i or 0, d) for i, d in zip(ids, deviations))
    for c in range(1, used + 1):
        of = [r for r in got if r["component"] == c]
        assert abs(of[0]["explained"] - values[c - 1] / np.trace(covariance)) < 1e-9
        if c > sound:
            assert all(r["whitened"] is None for r in of)
            continue
        want = sorted(apart @ axes[:, c - 1] / math.sqrt(values[c - 1]))
        z = sorted(r["whitened"] for r in of)
        assert max(np.abs(np.array(z) - want).max() if s > 0 else 9 for s in [1]) < 1e-6 or np.abs(np.sort(-np.array(z)) - want).max() < 1e-6


def test_whitening_of_little(spark):
    assert whitening.whiten(frame(spark, [])).collect() == []
    one = whitening.whiten(frame(spark, [(1, [0.5, 0.25], 0)])).collect()
    assert [(r["component"], r["deviation"], r["whitened"], r["explained"]) for r in one] == [(1, 0, None, None), (2, 0, None, None)]
    huge = whitening.whiten(frame(spark, [(i, [3e38 * (-1) ** i, 0.5 * i, 1.0 * (i % 3)], 0) for i in range(9)])).collect()
    assert len(huge) == 27 and all(r["deviation"] is None for r in huge)


def test_jacobi_keeps_small_eigenvalues():
    """A graded matrix: rotations find its smallest eigenvalue to full relative accuracy."""
    scale = np.diag(10.0 ** -np.arange(0, 12, 2))
    rng = np.random.default_rng(4)
    core = np.eye(6) + 0.1 * (m := rng.normal(size=(6, 6))) @ m.T
    graded = scale @ core @ scale
    values, axes = whitening.jacobi(graded)
    from fractions import Fraction

    def determinant(a):  # exact
        a, out = [[Fraction(v) for v in r] for r in a.tolist()], Fraction(1)
        for i in range(len(a)):
            out *= a[i][i]
            for j in range(i + 1, len(a)):
                f = a[j][i] / a[i][i]
                a[j] = [x - f * y for x, y in zip(a[j], a[i])]
        return out

    assert abs(float(determinant(graded)) / np.prod(values) - 1) < 1e-12
    assert np.abs(axes.T @ axes - np.eye(6)).max() < 1e-13 and (np.diff(values) <= 0).all()


def test_scatter_does_not_hang_on_the_partitions(spark):
    rows = rows_of(400, 8, 6)
    pair = [whitening._fit(whitening.with_doubles(spark.createDataFrame(rows, VECTORS).repartition(k), "embedding", "vec_id")) for k in (1, 13)]
    assert pair[0][:2] == pair[1][:2] and np.allclose(pair[0][2], pair[1][2], rtol=1e-12, atol=1e-12)
