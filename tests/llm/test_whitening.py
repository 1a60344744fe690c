"""Whitening against numpy's eigenvectors and exact integers."""

import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from reachmap.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, label int"


def matrices():
    rng = np.random.default_rng(4)
    for n in (1, 2, 3, 7, 16, 40):
        a = rng.standard_normal((n, n))
        yield f"full {n}", a @ a.T
        yield f"multiple of one {n}", np.eye(n) * 3
        yield f"zero {n}", np.zeros((n, n))
        u = rng.standard_normal((n, 2))
        yield f"rank two {n}", u @ u.T
        q, _ = np.linalg.qr(a)
        v = q @ np.diag(np.repeat(np.arange(1, n // 3 + 2), 3)[:n]) @ q.T
        yield f"threefold {n}", (v + v.T) / 2
        yield f"tiny {n}", (a @ a.T) * 1e-200
        close = np.diag(1 + 1e-13 * np.arange(n))
        yield f"clustered {n}", (q @ close @ q.T + (q @ close @ q.T).T) / 2


@pytest.mark.parametrize(("name", "v"), [pytest.param(n, v, id=n) for n, v in matrices()])
def test_eigenvectors(name, v):
    values, vectors = whitening.leading_components(v, 16)
    want = np.linalg.eigvalsh(v)[::-1][: len(values)]
    scale = np.abs(want).max() or 1.0
    assert np.abs(values - want).max() <= 1e-13 * scale
    assert np.abs(vectors @ vectors.T - np.eye(len(values))).max() < 1e-12
    assert np.abs(v @ vectors.T - vectors.T * values).max() <= 1e-12 * scale


def test_sturm_counts():
    rng = np.random.default_rng(2)
    d, s = rng.standard_normal(12), rng.standard_normal(11)
    t = np.diag(d) + np.diag(s, 1) + np.diag(s, -1)
    at = np.linspace(-4, 4, 41)
    assert whitening.below(d, s**2, at, 1e-300).tolist() == [(np.linalg.eigvalsh(t) < x).sum() for x in at]


def brute(rows):
    """(id, component) to the exact and the floating columns, with numpy's eigenvectors."""
    x = [(i, [min(max(math.floor(64 * float(c)), -(10**19)), 10**19) + 1_000_000 for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    by = defaultdict(list)
    for i, v in x:
        by[len(v)].append((i, v))
    out = {}
    for d, own in by.items():
        fit = sorted({tuple(v) for _, v in own})
        n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
        mean = np.array([s / n for s in sums])
        c = np.array(fit, float) - mean
        cov = c.T @ c / n
        e, q = np.linalg.eigh(cov)
        for i, v in own:
            dev = sum((n * a - s) ** 2 for a, s in zip(v, sums, strict=True))
            for k in range(min(16, d)):
                w = (np.array(v, float) - mean) @ q[:, d - 1 - k]
                out.setdefault((i, k + 1), []).append((n, dev, w, e[d - 1 - k], np.trace(cov)))
    return out


def check(got, rows, tolerance=1e-6):
    want = brute(rows)
    found = defaultdict(list)
    for r in got:
        found[r.vec_id, r.component].append(r)
    assert set(found) == set(want)
    signs = {}
    for key, rs in found.items():
        assert len(rs) == len(want[key])
        for r, (n, dev, w, e, trace) in zip(sorted(rs, key=lambda r: r.deviation), sorted(want[key], key=lambda x: x[1]), strict=True):
            assert (r.n, r.deviation) == (n, dev)
            assert r.explained == pytest.approx(e / trace if trace else 0, rel=1e-6, abs=1e-12)
            assert r.identity_error <= 1e-8
            if e > 1e-9 * trace:
                z = w / math.sqrt(e)
                if abs(z) > 1e-3:
                    signs.setdefault((key[1], n), set()).add(bool(z * r.whitened > 0))
                assert abs(r.whitened) == pytest.approx(abs(z), abs=tolerance)
            else:
                assert r.whitened is None
    assert all(len(s) == 1 for s in signs.values())


def test_against_numpy(spark):
    rng = np.random.default_rng(8)
    base = rng.standard_normal((300, 20)) * np.linspace(0.2, 2, 20)
    rows = [(i, v.tolist()) for i, v in enumerate(base)] + [(1000 + i, base[0].tolist()) for i in range(200)] + [(7, base[3].tolist())]
    rows += [(2000 + i, v.tolist()) for i, v in enumerate(rng.standard_normal((30, 3)))]
    rows += [(3000, None), (3001, []), (3002, [1.0, None, 2.0]), (3003, [1.0, math.nan, 2.0]), (3004, [math.inf] * 3), (3005, [1.0, -math.inf, 0.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA).withColumns({n: F.lit(n) for n in ("x", "d", "n", "id", "component")})
    got = whitening.whiten(df.repartition(7)).collect()
    assert {r.vec_id for r in got} == {i for i, _ in rows if i < 3000}
    check(got, rows)


def test_defined_cases(spark):
    one = spark.createDataFrame([(1, [0.5, 1.0], 1), (2, [0.5, 1.0], 1)], SCHEMA)
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in whitening.whiten(one).collect()] == [(1, 0, None, 0.0, 0.0)] * 4
    assert whitening.whiten(one.limit(0)).count() == 0
    large = [(1, [1e300, 1.0]), (2, [-1e300, 2.0]), (3, [0.0, 5.0])]
    got = whitening.whiten(spark.createDataFrame([(i, v, 1) for i, v in large], SCHEMA)).collect()
    assert len(got) == 6 and all(r.deviation is None for r in got if r.vec_id < 3) and max(r.identity_error for r in got) < 1e-6
    line = [(i, [float(i), 2.0 * i, 0.0]) for i in range(9)]  # one component has variance
    got = whitening.whiten(spark.createDataFrame([(i, v, 1) for i, v in line], SCHEMA)).collect()
    assert all((r.whitened is None) == (r.component > 1) for r in got)
    check(got, line)


def test_query_on_the_table(spark):
    path = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    got = whitening.op13_whitening(spark, path).collect()
    check(got, rows)
    w = defaultdict(dict)
    for r in got:
        w[r.vec_id][r.component] = r.whitened
    assert len(got) == 16 * len(rows)
