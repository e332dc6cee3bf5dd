"""One fitted recommender: similarity and popularity tables plus its parameters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.operators.cooccurrence import (
    centrality,
    copurchase_similarity,
    gram,
)
from cartwise.operators.factors import (
    basket_factors,
    explained_variance,
    loading_influence,
    nmf_factors,
)
from cartwise.operators.interactions import customer_baskets, interactions, popularity
from cartwise.operators.latent import Latent
from cartwise.operators.recommend import Similarity, Variant
from cartwise.session import stage, stage_in_slices

METHODS = ("popularity", "copurchase", "svd", "nmf", "hybrid")

# Parameters that apply when none is given.
DEFAULTS = {
    "method": "hybrid",
    "cf_method": "copurchase",
    "n_components": 15,
    "alpha": 0.5,
    "min_support": 10,
}


def backbone(params: dict) -> str | None:
    """The similarity a parameter set uses: copurchase, svd, nmf or none."""
    method = params["method"]
    if method not in METHODS:
        raise ValueError(f"unknown method: {method}")
    if method == "popularity":
        return None
    if method != "hybrid":
        return method
    return "svd" if params["cf_method"] == "svd" else "copurchase"


def full_params(params: dict) -> dict:
    merged = {**DEFAULTS, **{k: v for k, v in params.items() if v is not None}}
    backbone(merged)
    return merged


def weight_name(params: dict) -> str | None:
    """Name of the similarity column that belongs to a parameter set."""
    base = backbone(params)
    if base is None:
        return None
    return f"w{params['min_support']}" if base == "copurchase" else f"{base}{params['n_components']}"


def variant_of(params: dict, name: str, weight: str | None = None) -> Variant:
    params = full_params(params)
    alpha = float(params["alpha"]) if params["method"] == "hybrid" else 1.0
    return Variant(name, weight or weight_name(params), alpha)


@dataclass(frozen=True)
class Model:
    params: dict
    popular: DataFrame
    similarity: DataFrame | None = None
    factors: DataFrame | None = None
    products: DataFrame | None = None
    n_users: int = 0
    n_cats: int = 0

    @property
    def variant(self) -> Variant:
        weight = None if self.scoring is None else "sim"
        return variant_of(self.params, self.params["method"], weight)

    @property
    def scoring(self) -> Similarity:
        """What recommendations are scored with: the pair table or the category factors."""
        if self.factors is None:
            return self.similarity
        return Latent(self.factors, {"sim": self.params["n_components"]})

    def influence(self, top: int = 15) -> DataFrame:
        """Categories that shape the recommendations most."""
        if self.factors is not None:
            return loading_influence(self.factors, top)
        if self.similarity is not None:
            return centrality(self.similarity, top)
        raise ValueError("a popularity model has no similarity")

    def factor_importance(self, master: DataFrame) -> DataFrame:
        if self.products is None or self.factors is None:
            raise ValueError("only a model with an SVD backbone has explained variance")
        return explained_variance(interactions(master), self.products, self.factors, self.n_users)


def fit(master: DataFrame, params: dict, baskets: DataFrame | None = None) -> Model:
    """Fit one of the five methods; all tables of the model are staged."""
    params = full_params(params)
    base = backbone(params)
    baskets = stage_in_slices(master, ["customer_unique_id"], customer_baskets) if baskets is None else baskets
    popular = stage(popularity(master))
    n_users = baskets.count()
    cats = baskets.select(F.explode("cats").alias("c")).agg(F.count_distinct("c")).first()[0]
    parts: dict = {}
    if base == "copurchase":
        parts["similarity"] = stage(copurchase_similarity(baskets, params["min_support"]))
    elif base == "svd":
        parts["products"] = stage(gram(baskets))
        parts["factors"] = stage(basket_factors(baskets, params["n_components"]))
    elif base == "nmf":
        parts["factors"], _ = nmf_factors(baskets, params["n_components"])
    return Model(params, popular, n_users=n_users, n_cats=cats, **parts)
