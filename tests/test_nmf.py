"""Non-negative factors: start, fall of the error, and the form with joined tables."""

import numpy as np
import pytest
from conftest import master
from test_recommend import purchases, random_baskets

from cartwise.operators import factors, nmf
from cartwise.operators.interactions import customer_baskets, interactions
from cartwise.operators.krylov import Cells
from cartwise.session import stage


@pytest.fixture(scope="module")
def data(spark):
    table = stage(master(spark, purchases(random_baskets(9, users=90, cats=9))))
    baskets = stage(customer_baskets(table))
    rows = interactions(table).collect()
    users, cats = sorted({r["user"] for r in rows}), sorted({r["category"] for r in rows})
    x = np.zeros((len(users), len(cats)))
    for r in rows:
        x[users.index(r["user"]), cats.index(r["category"])] = r["interactions"]
    return baskets, x


def plain_start(x, k):
    """From the singular vectors: the heavier of both sides' positive and negative parts, zeros filled with the mean."""
    u, s, vt = np.linalg.svd(x, full_matrices=False)
    h = np.zeros((k, x.shape[1]))
    h[0] = np.sqrt(s[0]) * np.abs(vt[0])
    for j in range(1, k):
        parts = [(np.maximum(g * u[:, j], 0), np.maximum(g * vt[j], 0)) for g in (1, -1)]
        weights = [np.linalg.norm(a) * np.linalg.norm(b) for a, b in parts]
        best = int(np.argmax(weights))
        h[j] = np.sqrt(s[j] * weights[best]) * parts[best][1] / np.linalg.norm(parts[best][1])
    return np.where(h < 1e-6, x.mean(), h)


def test_the_start_equals_a_plain_one(data):
    baskets, x = data
    found = stage(factors.basket_factors(baskets, 4))
    sigma, positive, negative, mean, norm = nmf._totals(Cells.of_baskets(baskets), found, 4)
    vectors = np.vstack(found.orderBy("category_en").toPandas()["factors"])
    assert mean == pytest.approx(x.mean()) and norm == pytest.approx((x**2).sum())
    assert nmf.start_factors(vectors, sigma, positive, negative, mean).T == pytest.approx(plain_start(x, 4))


def test_coordinate_steps_reach_the_smallest_error():
    rng = np.random.default_rng(0)
    f, x = rng.random((3, 8)), rng.random((20, 8))
    y = nmf.solve(x @ f.T, f @ f.T, np.zeros((20, 3)), 1e-11)
    slope = y @ (f @ f.T) - x @ f.T
    assert (y >= 0).all() and (slope >= -1e-6).all() and np.abs(slope[y > 0]).max() < 1e-6


def test_error_falls_and_joined_tables_give_the_same(data, monkeypatch):
    baskets, x = data
    found, errors = factors.nmf_factors(baskets, 3, rounds=6, tolerance=1e-3)
    h = np.vstack(found.orderBy("category_en").toPandas()["factors"])
    assert (h >= 0).all() and all(b <= a * (1 + 1e-9) for a, b in zip(errors, errors[1:]))
    w = nmf.solve(x @ h, h.T @ h, np.zeros((len(x), 3)))
    assert ((x - w @ h.T) ** 2).sum() == pytest.approx(errors[-1], rel=1e-2)
    s = np.linalg.svd(x, compute_uv=False)
    assert (s[3:] ** 2).sum() <= errors[-1] < (s[1:] ** 2).sum()
    monkeypatch.setattr(nmf, "FACTOR_ROWS", 0)
    joined, other = factors.nmf_factors(baskets, 3, rounds=6, tolerance=1e-3)
    assert other == pytest.approx(errors)
    assert np.vstack(joined.orderBy("category_en").toPandas()["factors"]) == pytest.approx(h, abs=1e-4)


def test_factors_come_back_without_arrow(spark, data):
    """Sessions need not have Arrow on; then a frame takes plain numbers only."""
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "false")
    try:
        found, errors = factors.nmf_factors(data[0], 3, rounds=6, tolerance=1e-3)
        assert found.count() == 9 and min(min(r["factors"]) for r in found.collect()) >= 0 and errors[-1] < errors[0]
    finally:
        spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "true")
