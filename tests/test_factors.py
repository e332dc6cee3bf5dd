import numpy as np
import pytest
from conftest import master
from test_recommend import purchases, random_baskets

from cartwise.operators import factors
from cartwise.operators.cooccurrence import gram
from cartwise.operators.interactions import customer_baskets, interactions
from cartwise.operators.model import fit
from cartwise.operators.tune import compare_families, search_table
from cartwise.operators.interactions import popularity
from cartwise.session import stage


@pytest.fixture(scope="module")
def data(spark):
    table = stage(master(spark, purchases(random_baskets(5, users=80, cats=8))))
    baskets = stage(customer_baskets(table))
    matrix = stage(interactions(table))
    rows = matrix.collect()
    users = sorted({r["user"] for r in rows})
    cats = sorted({r["category"] for r in rows})
    x = np.zeros((len(users), len(cats)))
    for r in rows:
        x[users.index(r["user"]), cats.index(r["category"])] = r["interactions"]
    return table, baskets, matrix, users, cats, x


def test_factors_similarity_and_user_factors(spark, data):
    _, baskets, matrix, users, cats, x = data
    products = stage(gram(baskets))
    found = stage(factors.category_factors(products, 3))
    rows = {r["category_en"]: r for r in found.collect()}
    v = np.array([rows[c]["factors"] for c in cats])
    _, s, vt = np.linalg.svd(x, full_matrices=False)
    assert rows[cats[0]]["sigma"] == pytest.approx(list(s[:3]))
    assert np.abs(v.T @ vt[:3].T).round(6) == pytest.approx(np.eye(3), abs=1e-6)
    unit = vt[:3].T / np.linalg.norm(vt[:3].T, axis=1, keepdims=True)
    want = unit @ unit.T
    for r in factors.cosine_similarity(found).collect():
        assert r["sim"] == pytest.approx(want[cats.index(r["cat_a"]), cats.index(r["cat_b"])], abs=1e-8)
    several = factors.svd_similarities(products, [2, 3], [])
    for r in several.collect():
        assert r["svd3"] == pytest.approx(want[cats.index(r["cat_a"]), cats.index(r["cat_b"])], abs=1e-8)
    for r in factors.user_factors(matrix, found).collect():
        assert r["factors"] == pytest.approx(list(x[users.index(r["user"])] @ v))


def test_distributed_solver_agrees_with_the_local_one(data):
    _, baskets, *_ = data
    products = stage(gram(baskets))
    local = {r["category_en"]: r for r in factors.category_factors(products, 2).collect()}
    for r in factors._distributed_factors(products, 2).collect():
        assert r["sigma"] == pytest.approx(local[r["category_en"]]["sigma"])
        assert list(r["factors"]) == pytest.approx(list(local[r["category_en"]]["factors"]), abs=1e-6)


def test_explained_variance(data):
    table, baskets, matrix, users, cats, x = data
    model = fit(table, {"method": "svd", "n_components": 3}, baskets)
    got = model.factor_importance(table).collect()
    _, _, vt = np.linalg.svd(x, full_matrices=False)
    want = (x @ vt[:3].T).var(axis=0) / x.var(axis=0).sum()
    assert [r["explained_variance"] for r in got] == pytest.approx(list(want))
    assert got[-1]["cumulative_variance"] == pytest.approx(want.sum())
    assert [r["factor"] for r in got] == ["F1", "F2", "F3"]
    assert model.influence(2).count() == 2


def test_factor_number_is_clipped(data):
    _, baskets, *_ = data
    assert len(factors.category_factors(stage(gram(baskets)), 50).first()["factors"]) == 7


def test_nmf_error_falls_and_factors_are_not_negative(data):
    _, baskets, _, users, cats, x = data
    found, errors = factors.nmf_factors(baskets, 3, rounds=15)
    assert all(b <= a * (1 + 1e-9) for a, b in zip(errors, errors[1:]))
    h = np.array([r["factors"] for r in found.orderBy("category_en").collect()]).T
    assert (h >= 0).all()
    # No worse than 15 % above the best rank-3 approximation of any sign.
    s = np.linalg.svd(x, compute_uv=False)
    assert errors[-1] < (s[3:] ** 2).sum() * 1.5


def test_families_and_searches_over_all_backbones(spark, data):
    table, baskets, *_ = data
    popular = stage(popularity(table))
    families = {
        "pop": {"method": "popularity"},
        "cop": {"method": "copurchase", "min_support": 2},
        "svd": {"method": "svd", "n_components": 2},
        "nmf": {"method": "nmf", "n_components": 2},
        "hyb": {"method": "hybrid", "alpha": 0.5, "min_support": 2},
    }
    rows = {r["variant"]: r for r in compare_families(baskets, popular, families, k=3).collect()}
    assert set(rows) == set(families) and all(0 <= r["recall"] <= 1 for r in rows.values())
    table = search_table(baskets, popular, list(families.values()), k=3, n_splits=2).collect()
    assert len(table) == 5 and [round(r["recall_mean"], 4) for r in table] == sorted(
        (round(r["recall_mean"], 4) for r in table), reverse=True
    )
