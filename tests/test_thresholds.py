"""Rankings from pairs: the square product and the threshold algorithm equal the joined table."""

import random

import pytest

from cartwise.operators import recommend, threshold
from cartwise.operators.recommend import Variant
from cartwise.session import stage

NAMES = [f"c{i:03d}" for i in range(120)]


def _tables(spark, by, seed):
    rng = random.Random(seed)
    popular, links, units = [], [], []
    for g in [0, 1] if by else [0]:
        orders = {c: rng.randint(1, 80) for c in rng.sample(NAMES, 110)}
        ranked = sorted(orders, key=lambda c: (-orders[c], c))
        popular += [(g, c, i + 1, orders[c] / max(orders.values())) for i, c in enumerate(ranked)]
        for a in NAMES:
            links.append((g, a, a, 1.0, 1.0))
            for b in rng.sample(NAMES, rng.randint(0, 30)):
                if a != b:
                    w = rng.choice([0.1, 0.2, rng.random()])  # many equal weights
                    links.append((g, a, b, w, w if w > 0.3 else 0.0))
        units += [(g, g * 1000 + i, sorted(rng.sample([*NAMES, "unknown"], rng.randint(0, 5)))) for i in range(60)]
    frames = [
        spark.createDataFrame(popular, "g int, category_en string, rank int, pop_score double"),
        spark.createDataFrame(links, "g int, cat_a string, cat_b string, w1 double, w2 double"),
        spark.createDataFrame(units, "g int, unit_id long, cats array<string>"),
    ]
    return [stage(f if by else f.drop("g")) for f in frames]


def _ranked(units, links, popular, variants, by):
    rows = recommend.rank_units(units, links, popular, variants, 7, by).collect()
    return {(r["unit_id"], r["variant"], r["category"], r["rank"], round(r["affinity"], 9), round(r["score"], 9)) for r in rows}


@pytest.mark.parametrize("by", [[], ["g"]])
def test_all_ways_rank_alike(spark, monkeypatch, by):
    popular, links, units = _tables(spark, by, 5)
    mixed = [Variant("p"), Variant("a", "w1", 1.0), Variant("b", "w1", 0.5), Variant("c", "w2", 0.3), Variant("d", "w2", 1.0)]
    plain = [Variant("k", "w1", keep_all=True)]
    with monkeypatch.context() as m:
        m.setattr(threshold, "fits", lambda *_: False)
        want = _ranked(units, links, popular, mixed, by), _ranked(units, links, popular, plain, by)
    assert (_ranked(units, links, popular, mixed, by), _ranked(units, links, popular, plain, by)) == want
    monkeypatch.setattr(threshold, "SQUARE", 10)
    assert not threshold.fits(links, popular, plain, ["w1"], by)  # every category counts there
    monkeypatch.setattr(threshold, "_CELLS", 50)
    for depth in (1, 16):
        monkeypatch.setattr(threshold, "FIRST_DEPTH", depth)
        assert _ranked(units, links, popular, mixed, by) == want[0]


def test_lists_are_not_read_to_their_end(spark, monkeypatch):
    popular, links, units = _tables(spark, [], 6)
    monkeypatch.setattr(threshold, "SQUARE", 10)
    monkeypatch.setattr(threshold, "FIRST_DEPTH", 2)
    scored = spark.sparkContext.accumulator(0)
    threshold.rank_by_pairs(units, links, popular, [Variant("a", "w1", 0.4)], 3, scored=scored).count()
    assert 0 < scored.value < 0.6 * 60 * 110  # a pair that is scored again counts again


def test_pairs_over_the_limit_or_below_zero_are_joined(spark, monkeypatch):
    popular, links, _ = _tables(spark, [], 7)
    hybrid = [Variant("a", "w1", 0.4)]
    assert threshold.fits(links, popular, hybrid, ["w1"], [])
    monkeypatch.setattr(threshold, "SQUARE", 10)
    assert threshold.fits(links, popular, hybrid, ["w1"], [])
    assert not threshold.fits(links.selectExpr("cat_a", "cat_b", "w1 - 0.5 AS w1"), popular, hybrid, ["w1"], [])
    monkeypatch.setattr(threshold, "SENT_BYTES", 1000)
    assert not threshold.fits(links, popular, hybrid, ["w1"], [])
