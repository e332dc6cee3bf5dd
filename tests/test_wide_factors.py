"""Factors without a Gram matrix, and rankings without a table of category pairs."""

import random

import numpy as np
import pytest
from conftest import master
from test_recommend import purchases, random_baskets

from cartwise.operators import evolution, factors, krylov, latent, tune
from cartwise.operators.cooccurrence import gram
from cartwise.operators.interactions import customer_baskets, popularity
from cartwise.operators.latent import Latent
from cartwise.operators.recommend import Variant, rank_units, recommend_all
from cartwise.session import stage


@pytest.fixture(scope="module")
def baskets(spark):
    rng, rows = random.Random(1), []
    for u in range(300):
        cats = rng.sample(range(45), rng.randint(1, 8))
        rows.append((f"u{u}", [f"c{c:02d}" for c in cats], [rng.randint(1, 3) for _ in cats], u % 2))
    schema = "customer_unique_id string, cats array<string>, counts array<bigint>, fold int"
    return stage(spark.createDataFrame(rows, schema))


@pytest.mark.parametrize(("by", "from_products"), [([], False), (["fold"], False), (["fold"], True)])
def test_block_steps_find_the_same_vectors(baskets, by, from_products):
    products = stage(gram(baskets, by))
    wide = krylov.Products(products, tuple(by)) if from_products else krylov.Cells.of_baskets(baskets, by)
    keys = [*by, "category_en"]
    want = factors.group_factors(products, 12, by).toPandas().sort_values(keys)
    got = krylov.leading_factors(wide, 12).toPandas().sort_values(keys)
    assert got[keys].values.tolist() == want[keys].values.tolist()
    assert np.vstack(got["sigma"]) == pytest.approx(np.vstack(want["sigma"]))
    assert np.vstack(got["factors"]) == pytest.approx(np.vstack(want["factors"]), abs=1e-9)


def test_block_steps_that_begin_again(baskets, monkeypatch):
    """Fewer basis vectors than categories: the steps begin again until the residuals are negligible."""
    monkeypatch.setattr(krylov, "MOST_COLUMNS", 30)
    monkeypatch.setattr(krylov, "EXTRA", 6)
    products = stage(gram(baskets))
    want = factors.category_factors(products, 1).toPandas().sort_values("category_en")
    got = krylov.leading_factors(krylov.Products(products), 1, 1e-8).toPandas().sort_values("category_en")
    assert np.vstack(got["factors"]) == pytest.approx(np.vstack(want["factors"]), abs=1e-6)


def test_one_category_and_equal_columns(spark):
    rows = [("u1", ["a"], [2], 0), ("u2", ["a", "b", "c"], [1, 1, 1], 1), ("u3", ["b", "c"], [3, 3], 1)]
    df = stage(spark.createDataFrame(rows, "customer_unique_id string, cats array<string>, counts array<bigint>, fold int"))
    got = {(r["fold"], r["category_en"]): r for r in krylov.leading_factors(krylov.Cells.of_baskets(df, ["fold"]), 5).collect()}
    assert got[0, "a"]["factors"] == pytest.approx([1.0]) and got[0, "a"]["sigma"] == pytest.approx([2.0])
    x = np.array([[1, 1, 1], [0, 3, 3]])
    assert got[1, "b"]["sigma"] == pytest.approx(np.linalg.svd(x, compute_uv=False)[:2].tolist())
    assert got[1, "b"]["factors"] == pytest.approx(got[1, "c"]["factors"])


def test_searches_and_refits_do_not_depend_on_the_limit(spark, monkeypatch):
    table = stage(master(spark, purchases(random_baskets(4, users=70, cats=8))))
    users, popular = stage(customer_baskets(table)), stage(popularity(table))
    params = [
        {"method": "svd", "n_components": 3},
        {"method": "hybrid", "cf_method": "svd", "alpha": 0.4, "n_components": 2},
        {"method": "copurchase", "min_support": 2},
    ]

    def everything():
        found = [tuple(r) for r in tune.search_table(users, popular, params, k=3, n_splits=2).collect()]
        families = {"svd": {"method": "svd", "n_components": 3}, "pop": {"method": "popularity"}}
        found += [tuple(r) for r in tune.compare_families(users, popular, families, k=3).collect()]
        return found + [tuple(r) for r in evolution.expanding_refits(table, 3, k=3, warm_up=0, min_users=1).collect()]

    small = everything()
    monkeypatch.setattr(factors, "DENSE_CATEGORIES", 0)
    assert factors.is_wide(users)
    for a, b in zip(everything(), small, strict=True):
        assert [x if isinstance(x, str | None) else pytest.approx(x) for x in b] == list(a)


def _plain(units, found, pop, variants, widths, k):
    """Every category scored for every unit."""
    out = set()
    for uid, cats in units:
        for v in variants:
            zero, unit = np.zeros(widths[v.weight]), {}
            for c, f in found.items():
                x = np.array(f[: len(zero)])
                unit[c] = x / np.linalg.norm(x) if x.any() else x
            wanted = sum((unit[c] for c in cats if c in unit), zero)
            affinity = {c: float(unit.get(c, zero) @ wanted) for c in pop}
            most, rows = max(affinity.values()), []
            for c in set(pop) - set(cats):
                share = affinity[c] / most if most > 0 else affinity[c]
                score = affinity[c] if v.keep_all else v.alpha * share + (1 - v.alpha) * pop[c][1]
                listed = v.keep_all or score > 0
                rows.append((not listed, -np.floor(score * 1e10 + 0.5) if listed else pop[c][0], c, score))
            for place, (_, _, c, score) in enumerate(sorted(rows)[:k], 1):
                out.add((uid, v.name, c, place, round(affinity[c], 7), round(score, 7)))
    return out


@pytest.mark.parametrize(("block", "chunk"), [(512, 1 << 26), (7, 1 << 26), (5, 3000)])
def test_factor_rankings_equal_scoring_everything(spark, monkeypatch, block, chunk):
    monkeypatch.setattr(latent, "BLOCK", block)
    monkeypatch.setattr(latent, "CHUNK_BYTES", chunk)
    rng, draw = random.Random(block), np.random.default_rng(block)
    names = [f"c{i:02d}" for i in range(40)]
    found = {c: (draw.normal(size=6) if rng.random() > 0.2 else np.zeros(6)).tolist() for c in names if rng.random() > 0.1}
    found["outside the popularity list"] = draw.normal(size=6).tolist()
    pop = {c: (i + 1, (40 - i) / 40) for i, c in enumerate(names)}
    units = [(i, sorted(rng.sample([*names, *list(found)[-1:], "unknown"], rng.randint(0, 6)))) for i in range(40)]
    variants = [Variant("a", "s6", keep_all=True), Variant("b", "s6", 0.5), Variant("c", "s3", 1.0), Variant("d", "s3", 0.2)]
    frame = stage(spark.createDataFrame(list(found.items()), "category_en string, factors array<double>"))
    popular = spark.createDataFrame([(c, *v) for c, v in pop.items()], "category_en string, rank int, pop_score double")
    got = rank_units(
        stage(spark.createDataFrame(units, "unit_id long, cats array<string>")), Latent(frame, {"s6": 6, "s3": 3}), popular, variants, 7
    ).collect()
    rows = {(r["unit_id"], r["variant"], r["category"], r["rank"], round(r["affinity"], 7), round(r["score"], 7)) for r in got}
    assert rows == _plain(units, found, pop, variants, {"s6": 6, "s3": 3}, 7)


def test_blocks_out_of_reach_are_not_multiplied(monkeypatch):
    monkeypatch.setattr(latent, "BLOCK", 16)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 8))
    vectors = np.repeat(centres, 20, 0) + 0.02 * rng.normal(size=(400, 8))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    blocks = list(latent._near_blocks(vectors, np.arange(400)))
    chunk = latent._Chunk(np.array([f"c{i:03d}" for i in range(400)], object), np.arange(1, 401), np.zeros(400), vectors, blocks)
    best = [latent.Best.empty(50, 5)]
    seen = latent._rank(
        chunk, vectors[:50], {}, [np.array([i]) for i in range(50)], [Variant("a", "s", keep_all=True)], {"s": slice(0, 8)}, best
    )
    assert seen < 50 * 400 / 2
    scores = vectors[:50] @ vectors.T
    scores[np.arange(50), np.arange(50)] = -2
    assert best[0].score == pytest.approx(-np.sort(-scores, axis=1)[:, :5])


def test_recommending_needs_no_pair_table(spark, baskets):
    """The same lists from factors and from the table of their cosines."""
    users = stage(baskets.drop("fold"))
    found = stage(factors.basket_factors(users, 4))
    popular = stage(
        spark.createDataFrame([(f"c{i:02d}", i + 1, 1 / (i + 1)) for i in range(45)], "category_en string, rank int, pop_score double")
    )
    for variant in (Variant("v", "sim", keep_all=True), Variant("v", "sim", 0.6)):
        lists = [
            {(r["customer_unique_id"], r["rank"], r["category"], round(r["score"], 8)) for r in recommend_all(users, s, popular, variant, 6).collect()}
            for s in (Latent(found, {"sim": 4}), stage(factors.cosine_similarity(found)))
        ]
        assert lists[0] == lists[1]
