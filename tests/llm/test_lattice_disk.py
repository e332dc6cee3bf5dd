"""Vectors move to their blocks in slices and without their cell keys; the links stay the same."""

import numpy as np

from cartwise.llm import lattice


def near_copies(spark, kind: str):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((30, 16))
    x = np.concatenate([base, base + 0.01 * rng.standard_normal(base.shape), base[:5]]).astype(np.float32)
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], f"vec_id bigint, embedding array<{kind}>")


def test_slices_of_blocks_give_the_same_links(spark, monkeypatch):
    df = near_copies(spark, "float")
    whole = sorted(map(tuple, lattice.near_vectors(df, "vec_id", "embedding").collect()))
    calls = []
    real = lattice.in_slice
    monkeypatch.setattr(lattice, "in_slice", lambda *a: calls.append(a) or real(*a))
    monkeypatch.setattr(lattice, "MOVED_ROWS", 60)
    monkeypatch.setattr(lattice, "MOVED_SHARE", 0)
    monkeypatch.setattr(lattice, "MEMBERS", 3)
    assert sorted(map(tuple, lattice.near_vectors(df, "vec_id", "embedding").collect())) == whole
    assert len(calls) > 1 and sum(r[1] for r in whole) >= 60
    double = near_copies(spark, "double")
    assert sorted(map(tuple, lattice.near_vectors(double, "vec_id", "embedding").collect())) == whole


def test_keys_do_not_depend_on_the_rows_beside():
    x = np.random.default_rng(5).standard_normal((40, 37))
    x /= np.sqrt((x * x).sum(1))[:, None]
    for table in range(lattice.TABLES):
        whole = lattice.cells(x, table)
        assert (np.concatenate([lattice.cells(x[i : i + 1], table) for i in range(40)]) == whole).all()


def test_only_the_vector_moves_to_a_block(spark, monkeypatch):
    """Before, each row took its 150 keys along, four times the vector."""
    seen = []
    real = lattice.stage
    monkeypatch.setattr(lattice, "stage", lambda df, then=(): (seen.append(df.columns), real(df, then))[1])
    lattice.near_vectors(near_copies(spark, "float"), "vec_id", "embedding").collect()
    assert ["cid", "links", "other"] in seen and not any("keys" in c for c in seen)
