import datetime
import itertools
import random
from collections import Counter

import pytest
from conftest import master

from cartwise.operators import evaluate, tune
from cartwise.operators.cooccurrence import copurchase, copurchase_similarity, gram, pair_counts
from cartwise.operators.interactions import customer_baskets, popularity
from cartwise.operators.model import fit
from cartwise.operators.recommend import Variant, recommend_all
from cartwise.session import stage


def purchases(baskets: dict[str, list[str]]) -> list[dict]:
    start = datetime.datetime(2018, 1, 1)
    return [
        {"customer_unique_id": u, "category_en": c, "order_id": f"{u}-{i}",
         "order_purchase_timestamp": start + datetime.timedelta(days=i)}
        for u, cats in baskets.items() for i, c in enumerate(cats)
    ]


def random_baskets(seed: int, users: int = 60, cats: int = 9) -> dict[str, list[str]]:
    rng = random.Random(seed)
    names = [f"k{i}" for i in range(cats)]
    weights = [1 / (i + 1) for i in range(cats)]
    return {
        f"u{n:03d}": [rng.choices(names, weights)[0] for _ in range(rng.choice([1, 1, 2, 3, 4, 6]))]
        for n in range(users)
    }


# --- a plain per-user model, written from the operator definition -----------------


def naive_fit(baskets, min_support):
    orders = Counter(c for cats in baskets.values() for c in cats)  # one order per purchase here
    popular = sorted(orders, key=lambda c: (-orders[c], c))
    single, pair = Counter(), Counter()
    for cats in baskets.values():
        single.update(set(cats))
        pair.update(itertools.combinations(sorted(set(cats)), 2))
    sim = {(c, c): 1.0 for c in single}
    for (a, b), n in pair.items():
        if n >= min_support:
            sim[a, b] = sim[b, a] = n / (single[a] + single[b] - n)
    return popular, {c: orders[c] / max(orders.values()) for c in orders}, sim


def naive_recommend(model, owned, k, alpha):
    popular, score, sim = model
    if alpha is None:
        return [c for c in popular if c not in owned][:k]
    cf = {c: sum(sim.get((o, c), 0.0) for o in owned) for c in popular}
    top = max(cf.values(), default=0)
    mixed = {c: alpha * (v / top if top > 0 else v) + (1 - alpha) * score[c] for c, v in cf.items()}
    ranked = sorted((c for c in mixed if c not in owned and mixed[c] > 0), key=lambda c: (-round(mixed[c], 10), c))
    return (ranked + [c for c in popular if c not in owned and c not in ranked])[:k]


def naive_loo(model, baskets, k, alpha):
    hits, users, covered = 0, 0, set()
    for cats in baskets.values():
        unique = list(dict.fromkeys(cats))
        if len(unique) < 2:
            continue
        recs = naive_recommend(model, set(unique[:-1]), k, alpha)
        covered.update(recs)
        users += 1
        hits += unique[-1] in recs
    return hits / users, hits / users / k, len(covered) / len(model[0]), users


def test_jaccard_by_hand(spark):
    table = master(spark, purchases({"u": ["A", "B"], "v": ["B", "A"], "w": ["A", "C"]}))
    got = {(r["cat_a"], r["cat_b"]): r["sim"] for r in copurchase_similarity(customer_baskets(table), 2).collect()}
    assert got[("A", "B")] == got[("B", "A")] == pytest.approx(2 / 3)
    assert ("A", "C") not in got and got[("C", "C")] == 1.0


def test_no_pair_above_support_gives_empty_frame(spark):
    table = master(spark, purchases({"u": ["A", "B"]}))
    found = copurchase(customer_baskets(table), 20)
    assert found.columns == ["cat_a", "cat_b", "support"] and found.count() == 0


def test_pairs_of_very_wide_and_repeated_baskets(spark):
    """One basket of 150 categories spans several blocks; a third of all customers share one basket."""
    wide = [f"k{i:03d}" for i in range(150)]
    baskets = {"wide": wide, **{f"h{i}": ["k001", "k140"] for i in range(30)}, **{f"s{i}": [f"k{i:03d}", "k070"] for i in range(60)}}
    rows = spark.createDataFrame(
        [(u, list(dict.fromkeys(c)), [c.count(x) for x in dict.fromkeys(c)]) for u, c in baskets.items()],
        "customer_unique_id string, cats array<string>, counts array<bigint>",
    )
    want, dots = Counter(), Counter()
    for cats in baskets.values():
        unique = sorted(set(cats))
        want.update(itertools.combinations(unique, 2))
        for a, b in itertools.combinations_with_replacement(unique, 2):
            dots[a, b] += cats.count(a) * cats.count(b)
    assert {(r["cat_a"], r["cat_b"]): r["support"] for r in pair_counts(rows).collect()} == dict(want)
    assert {(r["cat_a"], r["cat_b"]): r["dot"] for r in gram(rows).collect()} == dict(dots)


@pytest.mark.parametrize("seed, alpha, k", [(1, None, 3), (2, 0.0, 3), (3, 0.3, 4), (4, 1.0, 3), (5, 0.7, 20)])
def test_recommendations_match_the_per_user_model(spark, seed, alpha, k):
    baskets = random_baskets(seed)
    table = master(spark, purchases(baskets))
    users = stage(customer_baskets(table.repartition(3)))
    variant = Variant("v") if alpha is None else Variant("v", "sim", alpha)
    similarity = None if alpha is None else stage(copurchase_similarity(users, 2))
    got = {}
    for r in recommend_all(users, similarity, stage(popularity(table)), variant, k).orderBy("rank").collect():
        got.setdefault(r["customer_unique_id"], []).append(r["category"])
    model = naive_fit(baskets, 2)
    want = {u: naive_recommend(model, set(c), k, alpha) for u, c in baskets.items()}
    assert got == {u: recs for u, recs in want.items() if recs}
    for u, recs in got.items():
        assert not set(recs) & set(baskets[u]) and len(set(recs)) == len(recs)
        assert len(recs) == min(k, len(model[0]) - len(set(baskets[u])))


def test_short_lists_are_prefixes_of_long_ones(spark):
    table = master(spark, purchases(random_baskets(9)))
    users = stage(customer_baskets(table))
    similarity, popular = stage(copurchase_similarity(users, 2)), stage(popularity(table))
    lists = {}
    for k in (2, 5):
        rows = recommend_all(users, similarity, popular, Variant("v", "sim", 0.4), k).collect()
        lists[k] = {(r["customer_unique_id"], r["rank"]): r["category"] for r in rows}
    assert lists[2] == {key: c for key, c in lists[5].items() if key[1] <= 2}


def test_unknown_history_gets_the_popularity_list(spark):
    table = master(spark, purchases({"u": ["A", "B"], "v": ["A"]}))
    model_users = stage(customer_baskets(table))
    stranger = spark.createDataFrame([("x", ["unseen"], [1])], "customer_unique_id string, cats array<string>, counts array<bigint>")
    got = recommend_all(stranger, stage(copurchase_similarity(model_users, 1)), stage(popularity(table)), Variant("v", "sim"), 3)
    assert [r["category"] for r in got.orderBy("rank").collect()] == ["A", "B"]


@pytest.mark.parametrize("alpha", [None, 0.5, 1.0])
def test_leave_one_out_matches_the_per_user_model(spark, alpha):
    baskets = random_baskets(11, users=80)
    table = master(spark, purchases(baskets))
    users = stage(customer_baskets(table))
    variant = Variant("v") if alpha is None else Variant("v", "sim", alpha)
    similarity = None if alpha is None else stage(copurchase_similarity(users, 2))
    popular = stage(popularity(table))
    row = evaluate.loo_metrics(evaluate.loo_units(users), similarity, popular, [variant], 3).first()
    recall, precision, coverage, n = naive_loo(naive_fit(baskets, 2), baskets, 3, alpha)
    assert (row["recall"], row["precision"], row["coverage"]) == pytest.approx((recall, precision, coverage))
    assert row["n_users"] == n and row["hit_rate"] == pytest.approx(recall)
    if alpha is None:
        curve = evaluate.popularity_at_k(evaluate.loo_units(users), popular, [1, 3]).orderBy("k").collect()
        assert curve[1]["recall"] == pytest.approx(recall)
    other = stage(customer_baskets(table.repartition(7).sample(1.0)))
    again = evaluate.loo_metrics(evaluate.loo_units(other), similarity, popular, [variant], 3).first()
    assert again == row


def test_no_evaluable_customer_gives_zeros(spark):
    table = master(spark, purchases({"u": ["A", "A"], "v": ["B"]}))
    users, popular = stage(customer_baskets(table)), stage(popularity(table))
    row = evaluate.loo_metrics(evaluate.loo_units(users), None, popular, [Variant("v")], 3).first()
    assert (row["precision"], row["recall"], row["f1"], row["n_users"]) == (0.0, 0.0, 0.0, 0)


def test_cross_validation_equals_refitting_without_the_fold(spark):
    baskets = random_baskets(21, users=90)
    table = master(spark, purchases(baskets))
    users, popular = stage(customer_baskets(table)), stage(popularity(table))
    params = [{"method": "hybrid", "alpha": 0.4, "min_support": 2}, {"method": "copurchase", "min_support": 1}]
    rows = tune.cross_validate(users, popular, params, k=3, n_splits=3).collect()
    fold = {r[0]: r[1] for r in tune.assign_folds(users, 3).select("customer_unique_id", "fold").collect()}
    assert all((fold[u] == -1) == (len(set(c)) < 2) for u, c in baskets.items())
    for r in rows:
        alpha, floor = (0.4, 2) if r["variant"] == "0" else (1.0, 1)
        inside = {u: c for u, c in baskets.items() if fold[u] == r["fold"] - 1}
        rest = {u: c for u, c in baskets.items() if fold[u] != r["fold"] - 1}
        recall, precision, coverage, n = naive_loo(naive_fit(rest, floor), inside, 3, alpha)
        assert (r["recall"], r["precision"], r["coverage"]) == pytest.approx((recall, precision, coverage))
        assert r["n_users"] == n
    assert len(rows) == 6


def test_backtest_skips_customers_without_new_categories(spark):
    baskets = random_baskets(31, users=70)
    later = random_baskets(32, users=70)
    later["u001"] = list(baskets["u001"])  # nothing new
    table = master(spark, purchases(baskets))
    users = stage(customer_baskets(table))
    similarity, popular = stage(copurchase_similarity(users, 2)), stage(popularity(table))
    got = evaluate.backtest(users, master(spark, purchases(later)), similarity, popular, Variant("v", "sim", 0.6), 3).first()
    model = naive_fit(baskets, 2)
    parts = []
    for u, cats in later.items():
        new = set(cats) - set(baskets[u])
        if new:
            parts.append((len(new & set(naive_recommend(model, set(baskets[u]), 3, 0.6))), len(new)))
    assert got["n_users"] == len(parts)
    assert got["recall"] == pytest.approx(sum(h / n for h, n in parts) / len(parts))
    assert got["precision"] == pytest.approx(sum(h / 3 for h, _ in parts) / len(parts))


def test_searches_are_seeded_and_distinct():
    assert len(tune.grid_params(tune.GRID)) == 15
    drawn = tune.random_params(tune.RANDOM_SPACE, 8)
    assert drawn == tune.random_params(tune.RANDOM_SPACE, 8) and len({str(p) for p in drawn}) == 8
    assert all(("n_components" in p) == (p["cf_method"] == "svd") for p in drawn)
    assert all(("n_components" in p) == (p["cf_method"] == "svd") for p in tune.conditional_params(20))


def test_unknown_method_is_refused(spark):
    with pytest.raises(ValueError, match="unknown method"):
        fit(master(spark, [{}]), {"method": "magic"})


@pytest.mark.parametrize("variant", [Variant("svd", "sim", keep_all=True), Variant("hybrid", "sim", 0.9)])
def test_a_category_without_similarity_outranks_a_negative_one(spark, variant):
    baskets = spark.createDataFrame([("u", ["a1"])], "customer_unique_id string, cats array<string>")
    similarity = spark.createDataFrame(
        [("a1", "a1", 1.0), ("a1", "a2", -0.5), ("a2", "a1", -0.5), ("a1", "z", 0.0)], "cat_a string, cat_b string, sim double"
    )
    popular = spark.createDataFrame([("a1", 1, 1.0), ("a2", 2, 0.5), ("z", 3, 0.1)], "category_en string, rank int, pop_score double")
    (row,) = recommend_all(baskets, similarity, popular, variant, k=1).collect()
    assert row["category"] == "z"
