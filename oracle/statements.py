"""The statement of each registered query (see ``sql`` for the shared parts)."""

from __future__ import annotations

from oracle.sql import (
    CLEAN,
    CLEANED,
    HIST,
    LOO,
    LOO_METRICS,
    RAW,
    SOURCES,
    category_features,
    cleaned_then_cut,
    cleaned_until,
    fold_search,
    folds,
    histogram,
    history,
    jaccard,
    metrics_row,
    pairs,
    ranking,
    rfm,
    stable,
    svd,
    SVD_HIST,
    with_,
    _master,
)

TRAIN_END, VALIDATION_END = "1998-12", "2000-06"

# Column, type and order of the master table.
MASTER_TYPES = [
    ("order_id", "string"), ("customer_id", "string"), ("order_status", "string"),
    ("order_purchase_timestamp", "timestamp"), ("order_approved_at", "timestamp"),
    ("order_delivered_carrier_date", "timestamp"), ("order_delivered_customer_date", "timestamp"),
    ("order_estimated_delivery_date", "timestamp"), ("customer_unique_id", "string"),
    ("customer_zip_code_prefix", "string"), ("customer_city", "string"), ("customer_state", "string"),
    ("review_score", "double"), ("review_count", "bigint"), ("total_payment", "double"),
    ("num_installments", "int"), ("payment_type", "string"), ("order_item_id", "int"),
    ("product_id", "string"), ("seller_id", "string"), ("price", "double"), ("freight_value", "double"),
    ("product_category_name", "string"), ("category_en", "string"), ("product_weight_g", "double"),
    ("product_photos_qty", "int"), ("seller_state", "string"), ("delivery_days", "double"),
    ("estimated_days", "double"), ("delivery_delay", "double"), ("is_late", "int"), ("order_year", "int"),
    ("order_month", "int"), ("order_ym", "string"), ("item_total", "double"), ("freight_ratio", "double"),
]

QUALITY = ",\nprofile AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{t}' AS dtype, count(*) - count({c}) AS null_count, "
    f"round((count(*) - count({c})) * 100.0 / count(*), 2) AS null_pct, count(DISTINCT {c}) AS \"unique\" FROM master"
    for c, t in MASTER_TYPES
) + ")"

CAT_COLUMNS = (
    "category_en, total_orders, total_customers, "
    + ", ".join(
        f"{stable(c, d)} AS {c}"
        for c, d in [("avg_price", 6), ("avg_review", 6), ("avg_delivery", 6), ("late_rate", 8),
                     ("total_revenue", 4), ("avg_freight_ratio", 8), ("repeat_rate", 8)]
    )
    + ", popularity_rank"
)

SIM10 = pairs() + "," + jaccard(10)


def report_side(table: str, side: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{m}' AS metric, {i} AS position, CAST({e} AS DOUBLE) AS {side} FROM {table}"
        for i, (m, e) in enumerate(
            [
                ("rows", "count(*)"),
                ("orders", "count(DISTINCT order_id)"),
                ("customers", "count(DISTINCT customer_unique_id)"),
                ("null_pct_delivery_days", "(count(*) - count(delivery_days)) * 100.0 / count(*)"),
                ("null_pct_review_score", "(count(*) - count(review_score)) * 100.0 / count(*)"),
                ("null_pct_category_en", "(count(*) - count(category_en)) * 100.0 / count(*)"),
                ("max_price", "max(price)"),
                ("median_price", "median(price)"),
            ],
            1,
        )
    )


def null_side(table: str, side: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {stable(f'(count(*) - count({c})) * 100.0 / count(*)', 6)} AS {side} FROM {table}"
        for c in ["delivery_days", "review_score", "delivery_delay", "estimated_days", "freight_ratio"]
    )


def recommended(hist: str, alpha: str, sim: str | None = "sim") -> str:
    """Top ten of all customers with affinity, score and mean similarity."""
    parts = ["bask AS MATERIALIZED (SELECT u, cat FROM firsts)"]
    parts.append(SIM10 if sim else "sim AS (SELECT 'x' AS cat_a, 'x' AS cat_b, 0.0 AS sim WHERE false)")
    parts.append(ranking("bask", alpha if sim else "1"))
    return (
        hist + "," + ",".join(parts) + f"""
SELECT r.u AS customer_unique_id, cat AS category, rank, {stable("cf", 8)} AS affinity,
  {stable("score" if sim else "0.0", 8)} AS score, {stable("cf / size", 8)} AS explain
FROM recs r JOIN (SELECT u, count(*) AS size FROM firsts GROUP BY 1) s ON s.u = r.u
WHERE rank <= 10"""
    )


def loo(name: str, alpha: str, sim: bool = True) -> str:
    parts = [LOO, SIM10 if sim else "sim AS (SELECT 'x' AS cat_a, 'x' AS cat_b, 0.0 AS sim WHERE false)"]
    parts.append(ranking("train", alpha))
    inner = LOO_METRICS.format(name=name)
    return HIST + "," + ",".join(parts) + rounded_measures(inner)


def rounded_measures(inner: str, keep: str = "variant, n_users") -> str:
    cols = ", ".join(f"{stable(c, 8)} AS {c}" for c in ["precision", "recall", "hit_rate", "coverage", "f1"])
    return f"\nSELECT {keep}, {cols} FROM ({inner})"


GRID = [
    (str(i), a, m)
    for i, (a, m) in enumerate((a, m) for a in [0.3, 0.5, 0.7, 0.9, 1.0] for m in [3, 5, 10])
]
SEARCH = folds(3) + "," + fold_search(GRID)
ONE_CV = folds(3) + "," + fold_search([("0", 0.9, 10)])
GRID_MEANS = """
grid AS MATERIALIZED (SELECT CAST(variant AS INTEGER) AS trial, 'hybrid' AS method, 'copurchase' AS cf_method,
  p.alpha AS alpha, p.floor_ AS min_support, avg(precision) AS precision_mean, avg(recall) AS recall_mean,
  stddev_samp(recall) AS recall_std, avg(f1) AS f1_mean, avg(coverage) AS coverage_mean
  FROM fold_rows JOIN par p USING (variant) GROUP BY ALL)"""

SPLIT = f"""
split AS (SELECT *, CASE WHEN order_ym <= '{TRAIN_END}' THEN 'train' WHEN order_ym <= '{VALIDATION_END}' THEN 'val'
  ELSE 'backtest' END AS split FROM clean WHERE order_ym IS NOT NULL)"""

CURVE = """
ranked_test AS (
  SELECT t.u, p.rank - (SELECT count(*) FROM train r JOIN pop q ON q.cat = r.cat WHERE r.u = t.u AND q.rank < p.rank) AS place
  FROM test t JOIN pop p ON p.cat = t.cat)"""

RAW_SUM = ("* (CASE WHEN mx > 0 THEN cf / mx ELSE cf END)", "* cf")

# Popularity against plain similarity sums, with relative differences.
COMPARED = f"""
SELECT k, {stable("b / (n * k)", 8)} AS precision_baseline, {stable("b / n", 8)} AS recall_baseline,
  {stable("m / (n * k)", 8)} AS precision_model, {stable("m / n", 8)} AS recall_model,
  printf('%+.1f%%', coalesce((m / (n * k)) / nullif(b / (n * k), 0) * 100 - 100, 0.0)) AS delta_precision,
  printf('%+.1f%%', coalesce((m / n) / nullif(b / n, 0) * 100 - 100, 0.0)) AS delta_recall
FROM (SELECT k, (SELECT count(*) FROM test) AS n, (SELECT count(*) FROM ranked_test WHERE place <= k) AS b,
  (SELECT count(*) FROM recs r JOIN test t ON t.u = r.u AND t.cat = r.cat WHERE r.rank <= k) AS m
  FROM (VALUES (5), (10), (20)) ks(k))"""

# Share of the categories of later periods that the lists of training customers hold.
HIST0 = "hist0 AS (SELECT DISTINCT customer_unique_id AS u, category_en AS cat FROM split WHERE split = 'train')"
PERIODS = f""",
truth AS (SELECT DISTINCT split, customer_unique_id AS u, category_en AS cat FROM split
  WHERE split <> 'train' AND customer_unique_id IN (SELECT u FROM hist0))
SELECT split, n_users, {stable("hits / relevant", 8)} AS recall FROM (
  SELECT t.split, count(DISTINCT t.u) AS n_users, count(*) AS relevant, count(r.cat) AS hits
  FROM truth t LEFT JOIN recs r ON r.u = t.u AND r.cat = t.cat AND r.rank <= 10 GROUP BY 1)"""

TOP = """
SELECT k, {p} AS precision, {r} AS recall, n_users FROM (
  SELECT k, (SELECT count(*) FROM test) AS n_users, (SELECT count(*) FROM ranked_test WHERE place <= k) AS hits FROM {ks})"""


STATEMENTS: dict[str, str] = {
    "master_table": RAW + f"""
SELECT order_id, customer_unique_id, order_status, order_item_id, product_id, category_en, seller_state,
  customer_state, payment_type, num_installments, {stable("review_score", 6)} AS review_score, review_count,
  delivery_days, estimated_days, delivery_delay, is_late, order_year, order_month, order_ym,
  {stable("item_total", 4)} AS item_total, {stable("freight_ratio", 6)} AS freight_ratio,
  {stable("total_payment", 4)} AS total_payment FROM master""",
    "payments_per_order": with_(SOURCES) + f"""
SELECT order_id, {stable("total_payment", 4)} AS total_payment, num_installments, payment_type FROM pay""",
    "reviews_per_order": with_(SOURCES) + f"""
SELECT order_id, {stable("review_score", 6)} AS review_score, review_count FROM rev""",
    "labelled_products": with_(SOURCES) + """
SELECT product_id, product_category_name, category_en, product_weight_g, product_photos_qty FROM t_products""",
    "csv_round_trip": with_(SOURCES, _master(), history("master")) + """
SELECT cat AS category_en, num_orders, rank FROM pop""",
    "data_quality": RAW + QUALITY + "\nSELECT * FROM profile",
    "data_quality_by_sketch": RAW + QUALITY + """
SELECT "column", (SELECT count(*) FROM master) AS rows, null_count, true AS near FROM profile""",
    "columns_with_nulls": RAW + QUALITY + "\nSELECT * FROM profile WHERE null_pct > 0",
    "business_metrics": RAW + metrics_row("master"),
    "metrics_raw_and_clean": CLEANED
    + f"\nSELECT *, 'raw' AS dataset FROM ({metrics_row('master')}) UNION ALL SELECT *, 'clean' FROM ({metrics_row('clean')})",
    "clean_table": CLEANED + f"""
SELECT order_id, order_item_id, product_id, category_en, order_status, delivery_days,
  {stable("review_score", 6)} AS review_score, {stable("price", 4)} AS price, delivery_delay, is_late FROM clean""",
    "cleaning_log": CLEANED + """
SELECT a AS dropped_no_category, b AS dropped_price,
  'Dropped no-category: ' || a || ' | price outliers: ' || b AS cleaning_log
FROM (SELECT (SELECT count(*) FROM master WHERE category_en IS NULL OR customer_unique_id IS NULL) AS a,
  (SELECT count(*) FROM base) - (SELECT count(*) FROM clean) AS b)""",
    "cleaning_report": CLEANED + f"""
SELECT position, metric, {stable("before", 4)} AS before, {stable("after", 4)} AS after
FROM ({report_side("master", "before")}) JOIN ({report_side("clean", "after")}) USING (metric, position)""",
    "null_share_before_after": CLEANED + f"""
SELECT * FROM ({null_side("master", "before")}) JOIN ({null_side("clean", "after")}) USING ("column")""",
    "rfm_features": CLEANED + "," + rfm() + f"""
SELECT u AS customer_unique_id, recency, frequency, {stable("monetary", 4)} AS monetary,
  {stable("avg_ticket", 6)} AS avg_ticket, {stable("avg_review", 6)} AS avg_review, category_diversity, total_items,
  {stable("avg_delivery_days", 6)} AS avg_delivery_days, {stable("late_rate", 8)} AS late_rate, preferred_state,
  preferred_category, last_category, n_distinct_payments, R_score, F_score, M_score, RFM_score, segment FROM rfm_seg""",
    "category_features": CLEANED + "," + category_features() + f"\nSELECT {CAT_COLUMNS} FROM cat_full",
    "user_item": CLEANED + f"""
SELECT customer_unique_id, category_en, count(DISTINCT order_id) AS purchase_count,
  {stable("coalesce(sum(item_total), 0)", 4)} AS total_spent, {stable("avg(review_score)", 6)} AS avg_review,
  {stable("avg(delivery_days)", 6)} AS avg_delivery_days
FROM clean WHERE customer_unique_id IS NOT NULL AND category_en IS NOT NULL GROUP BY 1, 2""",
    "interaction_matrix": HIST + "\nSELECT u AS user, cat AS category, x AS interactions FROM inter",
    "matrix_stats": HIST + """
SELECT n_users, n_categories, n_interactions,
  round(100 - n_interactions * 100.0 / (n_users * n_categories), 3) AS sparsity_pct,
  round(n_interactions * 100.0 / (n_users * n_categories), 4) AS density_pct,
  round(n_interactions / n_users, 3) AS avg_cats_per_user, max_cats_per_user,
  round(n_interactions / n_categories, 1) AS avg_users_per_cat
FROM (SELECT count(DISTINCT u) AS n_users, count(DISTINCT cat) AS n_categories, count(*) AS n_interactions,
  (SELECT max(n) FROM (SELECT count(*) AS n FROM inter GROUP BY u)) AS max_cats_per_user FROM inter)""",
    "customer_history": HIST + """
SELECT f.u AS customer_unique_id, string_agg(cat, '|' ORDER BY place) AS category_history, count(*) AS n_categories,
  max(c.n_orders) AS n_orders
FROM firsts f JOIN (SELECT customer_unique_id AS u, count(*) AS n_orders FROM purchases GROUP BY 1) c ON c.u = f.u GROUP BY 1""",
    "history_rows": HIST + """
SELECT customer_unique_id, row_number() OVER (PARTITION BY customer_unique_id ORDER BY order_purchase_timestamp NULLS LAST,
  order_id, order_item_id, product_id, category_en) AS position, category_en FROM purchases""",
    "popularity": with_(SOURCES, _master(), history("master")) + f"""
SELECT cat AS category_en, num_orders, rank, {stable("pct", 8)} AS pct_of_total, {stable("score", 8)} AS pop_score FROM pop""",
    "leave_one_out_split": HIST + "," + LOO + """
SELECT test, train, count(*) AS customers FROM (
  SELECT t.u, t.cat AS test, string_agg(r.cat, '|' ORDER BY r.cat) AS train FROM test t JOIN train r ON r.u = t.u
  GROUP BY 1, 2) GROUP BY 1, 2""",
    "copurchase_pairs": HIST + "," + pairs() + "\nSELECT * FROM pair WHERE support >= 20",
    "jaccard_similarity": HIST + "," + SIM10 + f"\nSELECT cat_a, cat_b, {stable('sim', 10)} AS sim FROM sim",
    "copurchase_influence": HIST + "," + SIM10 + f"""
SELECT category_en, {stable("i", 8)} AS influence FROM (
  SELECT cat_a AS category_en, sum(CASE WHEN cat_a <> cat_b THEN sim ELSE 0 END) AS i FROM sim GROUP BY 1)
ORDER BY i DESC, category_en LIMIT 15""",
    "top_category_similarity": HIST + "," + SIM10 + "," + category_features() + f""",
best AS (SELECT category_en FROM cat_full ORDER BY total_orders DESC, category_en LIMIT 20)
SELECT cat_a, cat_b, {stable("sim", 10)} AS sim FROM sim
WHERE cat_a IN (SELECT category_en FROM best) AND cat_b IN (SELECT category_en FROM best)""",
    "gram_matrix": HIST + """
SELECT a.cat AS cat_a, b.cat AS cat_b, CAST(sum(a.x * b.x) AS BIGINT) AS dot FROM inter a
JOIN inter b ON a.u = b.u AND a.cat <= b.cat GROUP BY 1, 2""",
    "recommend_popularity": recommended(HIST, "1", None),
    "recommend_copurchase": recommended(HIST, "1.0"),
    "recommend_hybrid": recommended(HIST, "0.5"),
    "recommend_final_model": recommended(HIST, "1.0").replace("r.u AS customer_unique_id,", "r.u AS customer_unique_id, history,").replace(
        "SELECT u, count(*) AS size FROM firsts GROUP BY 1",
        "SELECT u, count(*) AS size, string_agg(cat, '|' ORDER BY place) AS history FROM firsts GROUP BY 1 HAVING count(*) >= 2",
    ),
    "popularity_curve": HIST + "," + LOO + "," + CURVE
    + TOP.format(p=stable("hits / (n_users * k)", 8), r=stable("hits / n_users", 8), ks="(SELECT CAST(range AS INTEGER) AS k FROM range(1, 21))"),
    "loo_popularity": loo("popularity", "1.0", sim=False),
    "loo_copurchase": loo("copurchase", "1.0"),
    "loo_hybrid": loo("hybrid", "0.5"),
    "compare_popularity_and_copurchase": HIST + "," + LOO + "," + CURVE + "," + SIM10 + ","
    + ranking("train", "1.0", positives=False).replace(*RAW_SUM) + COMPARED,
    "compare_popularity_and_svd": SVD_HIST + "," + LOO + "," + CURVE + "," + svd(15) + ","
    + ranking("train", "1.0", positives=False).replace(*RAW_SUM) + COMPARED,
    "svd_category_factors": SVD_HIST + "," + svd(15) + f"""
SELECT cat AS category_en, f AS factor, {stable("v", 6)} AS loading FROM fac""",
    "svd_similarity": SVD_HIST + "," + svd(15) + f"""
SELECT cat_a, cat_b, {stable("sim", 6)} AS sim FROM sim""",
    "svd_user_factors": SVD_HIST + "," + svd(15) + f"""
SELECT u AS user, f AS factor, {stable("sum(x * v)", 6)} AS value FROM inter JOIN fac USING (cat) GROUP BY u, f""",
    "svd_explained_variance": SVD_HIST + "," + svd(15) + f""",
n AS (SELECT count(DISTINCT u) AS n FROM inter),
total AS (SELECT sum(q / n - (m / n) * (m / n)) AS total FROM (SELECT cat, sum(x) AS m, sum(x * x) AS q FROM inter GROUP BY 1), n),
coord AS (SELECT u, f, sum(x * v) AS c FROM inter JOIN fac USING (cat) GROUP BY 1, 2),
share AS (SELECT f, (sum(c * c) / any_value(n) - (sum(c) / any_value(n)) * (sum(c) / any_value(n))) / any_value(total) AS r FROM coord, n, total GROUP BY 1)
SELECT 'F' || (f + 1) AS factor, {stable("r", 8)} AS explained_variance, {stable("sum(r) OVER (ORDER BY f)", 8)} AS cumulative_variance FROM share""",
    "svd_influence": SVD_HIST + "," + svd(15) + f"""
SELECT category_en, {stable("i", 6)} AS influence FROM (SELECT cat AS category_en, sum(abs(v)) AS i FROM fac GROUP BY 1 ORDER BY i DESC, cat LIMIT 15)""",
    "nmf_quality": SVD_HIST + "," + svd(15) + f""",
norm AS (SELECT CAST(sum(x * x) AS BIGINT) AS q FROM inter),
kept AS (SELECT sum(l) AS l, count(*) AS n FROM (SELECT DISTINCT f, l FROM fac))
SELECT (SELECT count(*) FROM every_cat) AS n_categories, n AS n_factors, true AS non_negative, q AS squared_norm,
  {stable("q - l", 4)} AS svd_error, true AS error_falls, true AS between_svd_and_rank_one FROM norm, kept""",
    "recommend_svd": SVD_HIST + ", bask AS MATERIALIZED (SELECT u, cat FROM firsts)," + svd(15) + ","
    + ranking("bask", "1.0", positives=False).replace(*RAW_SUM) + f"""
SELECT r.u AS customer_unique_id, cat AS category, rank, {stable("cf", 8)} AS affinity, {stable("cf", 8)} AS score,
  {stable("cf / size", 8)} AS explain
FROM recs r JOIN (SELECT u, count(*) AS size FROM firsts GROUP BY 1) s ON s.u = r.u WHERE rank <= 10""",
    "split_summary": CLEANED + "," + SPLIT + f"""
SELECT split, CASE split WHEN 'val' THEN '1999-01' WHEN 'backtest' THEN '2000-07' ELSE min(order_ym) END AS from_month,
  CASE split WHEN 'train' THEN '{TRAIN_END}' WHEN 'val' THEN '{VALIDATION_END}' ELSE max(order_ym) END AS to_month,
  count(DISTINCT order_ym) AS months, count(DISTINCT order_id) AS orders, count(DISTINCT customer_unique_id) AS customers
FROM split GROUP BY split""",
    "split_orders_per_month": CLEANED + "," + SPLIT + """
SELECT split, order_ym, count(DISTINCT order_id) AS orders FROM split GROUP BY 1, 2""",
    "period_recall_copurchase": HIST + "," + SIM10 + "," + SPLIT + "," + HIST0 + ","
    + ranking("hist0", "1.0", positives=False).replace(*RAW_SUM) + PERIODS,
    "period_recall_svd": SVD_HIST + "," + svd(15) + "," + SPLIT + "," + HIST0 + ","
    + ranking("hist0", "1.0", positives=False).replace(*RAW_SUM) + PERIODS,
    "temporal_backtest": with_(SOURCES, _master()) + "," + ",".join([
        CLEAN, SPLIT,
        "past AS (SELECT * FROM split WHERE split <> 'backtest')", history("past"), SIM10,
        "hist0 AS (SELECT u, cat FROM firsts)", ranking("hist0", "0.7")]) + f""",
fresh AS (SELECT DISTINCT customer_unique_id AS u, category_en AS cat FROM split s WHERE split = 'backtest'
  AND customer_unique_id IN (SELECT u FROM hist0)
  AND NOT EXISTS (SELECT 1 FROM hist0 h WHERE h.u = s.customer_unique_id AND h.cat = s.category_en)),
per_user AS (SELECT f.u, count(*) AS m, count(r.cat) AS hits FROM fresh f
  LEFT JOIN recs r ON r.u = f.u AND r.cat = f.cat AND r.rank <= 10 GROUP BY 1)
SELECT {stable("avg(hits / 10.0)", 8)} AS precision, {stable("avg(hits / m)", 8)} AS recall, count(*) AS n_users FROM per_user""",
    "cross_validation": HIST + "," + ONE_CV
    + rounded_measures("SELECT * FROM fold_rows", "variant, fold, n_users"),
    "cross_validation_summary": HIST + "," + ONE_CV + f"""
SELECT metric, {stable("avg(v)", 8)} AS mean, {stable("stddev_samp(v)", 8)} AS std, {stable("min(v)", 8)} AS min, {stable("max(v)", 8)} AS max
FROM (SELECT 'precision' AS metric, precision AS v FROM fold_rows UNION ALL SELECT 'recall', recall FROM fold_rows
  UNION ALL SELECT 'f1', f1 FROM fold_rows UNION ALL SELECT 'coverage', coverage FROM fold_rows) GROUP BY 1""",
    "grid_search": HIST + "," + SEARCH + "," + GRID_MEANS + "\nSELECT trial, method, cf_method, alpha, min_support, "
    + ", ".join(f"{stable(c, 8)} AS {c}" for c in ["precision_mean", "recall_mean", "recall_std", "f1_mean", "coverage_mean"])
    + " FROM grid",
    "grid_pivot": HIST + "," + SEARCH + "," + GRID_MEANS + "\nSELECT min_support, "
    + ", ".join(
        f"{stable(f'max(CASE WHEN alpha = {a} THEN recall_mean END)', 8)} AS alpha_{str(a).replace('.', '_')}"
        for a in [0.3, 0.5, 0.7, 0.9, 1.0]
    )
    + " FROM grid GROUP BY 1",
    "grid_running_best": HIST + "," + SEARCH + "," + GRID_MEANS + f"""
SELECT trial, {stable("recall_mean", 8)} AS recall_mean, {stable("max(recall_mean) OVER (ORDER BY trial)", 8)} AS best_so_far FROM grid""",
    "expanding_popularity": with_(SOURCES, _master(), history("master")) + f""",
months AS (SELECT order_ym, row_number() OVER (ORDER BY order_ym) AS i FROM (SELECT DISTINCT order_ym FROM master)),
cut AS (SELECT order_ym AS cutoff FROM months WHERE i > 12),
known AS (SELECT c.cutoff, f.u, f.cat, row_number() OVER (PARTITION BY c.cutoff, f.u ORDER BY f.place DESC) AS back,
    count(*) OVER (PARTITION BY c.cutoff, f.u) AS n
  FROM firsts f JOIN seen s ON s.u = f.u AND s.cat = f.cat AND s.nth = 1 JOIN cut c ON strftime(s.ts, '%Y-%m') <= c.cutoff),
cpop AS (SELECT cutoff, cat, row_number() OVER (PARTITION BY cutoff ORDER BY n DESC, cat) AS rank FROM (
  SELECT c.cutoff, category_en AS cat, count(DISTINCT order_id) AS n FROM master m JOIN cut c ON m.order_ym <= c.cutoff
  WHERE category_en IS NOT NULL GROUP BY 1, 2)),
placed AS (SELECT k.cutoff, k.u, k.back, p.rank FROM known k JOIN cpop p ON p.cutoff = k.cutoff AND p.cat = k.cat WHERE k.n >= 2),
found AS (SELECT t.cutoff, t.u, t.rank - count(r.rank) AS place FROM placed t
  LEFT JOIN placed r ON r.cutoff = t.cutoff AND r.u = t.u AND r.back > 1 AND r.rank < t.rank
  WHERE t.back = 1 GROUP BY t.cutoff, t.u, t.rank)
SELECT cutoff, count(*) AS eval_users, {stable("avg(CASE WHEN place <= 10 THEN 1.0 ELSE 0.0 END)", 8)} AS recall_baseline,
  {stable("avg(CASE WHEN place <= 10 THEN 0.1 ELSE 0.0 END)", 8)} AS precision_baseline FROM found GROUP BY 1""",
    "monthly_retrain_log": cleaned_until(VALIDATION_END, LOO, SIM10, ranking("train", "1.0")) + f"""
SELECT '20000630_0000' AS version, '{VALIDATION_END}' AS cutoff_ym, (SELECT count(DISTINCT u) FROM firsts) AS n_users_train,
  n_users AS n_users_eval, (SELECT count(*) FROM pop) AS n_cats, {stable("precision", 8)} AS precision, {stable("recall", 8)} AS recall,
  {stable("f1", 8)} AS f1, {stable("hit_rate", 8)} AS hit_rate, {stable("coverage", 8)} AS coverage,
  'version=20000630_0000' AS artefact FROM ({LOO_METRICS.format(name="hybrid")})""",
    "retrain_log": cleaned_then_cut(VALIDATION_END, LOO, SIM10, ranking("train", "0.7")) + f"""
SELECT '20000630_0001' AS version, '{VALIDATION_END}' AS cutoff_ym, (SELECT count(DISTINCT u) FROM firsts) AS n_users_train,
  n_users AS n_users_eval, (SELECT count(*) FROM pop) AS n_cats, {stable("precision", 8)} AS precision, {stable("recall", 8)} AS recall,
  {stable("f1", 8)} AS f1, {stable("hit_rate", 8)} AS hit_rate, {stable("coverage", 8)} AS coverage,
  'version=20000630_0001' AS artefact FROM ({LOO_METRICS.format(name="hybrid")})""",
    "model_metadata": cleaned_then_cut(VALIDATION_END, LOO, SIM10, ranking("train", "0.7")) + f"""
SELECT '20000630_0001' AS model_version, 'category_en' AS target, 'hybrid' AS algorithm, 0.7::DOUBLE AS alpha, 10 AS min_support,
  (SELECT count(*) FROM pop) AS n_categories, (SELECT count(DISTINCT u) FROM firsts) AS n_users_train, n_users AS n_users_eval,
  {stable("precision", 8)} AS precision, {stable("recall", 8)} AS recall, 'popular,similarity' AS tables
FROM ({LOO_METRICS.format(name="hybrid")})""",
    "recommend_reloaded_model": recommended(cleaned_then_cut(VALIDATION_END), "0.7"),
    "report_orders_by_month": RAW + """
SELECT order_ym, count(DISTINCT order_id) AS orders FROM master WHERE order_ym IS NOT NULL GROUP BY 1""",
    "report_orders_by_review_score": RAW + f"""
SELECT {stable("review_score", 6)} AS review_score, count(DISTINCT order_id) AS orders FROM master
WHERE review_score IS NOT NULL GROUP BY review_score""",
    "report_delivery_histogram": RAW + histogram("master", "delivery_days", "AND delivery_days > 0 AND delivery_days < 100"),
    "report_delivery_median": RAW + """
SELECT median(delivery_days) AS median_days FROM master WHERE delivery_days > 0 AND delivery_days < 100""",
    "report_orders_by_category": with_(SOURCES, _master(), history("master")) + f"""
SELECT cat AS category_en, num_orders, {stable("pct", 8)} AS pct FROM pop WHERE rank <= 20""",
    "report_ticket_by_category": RAW + """
SELECT category_en, round(m, 2) AS avg_ticket FROM (SELECT category_en, avg(item_total) AS m FROM master
  WHERE category_en IS NOT NULL GROUP BY 1 ORDER BY m DESC, category_en LIMIT 20)""",
    "report_demand_by_month": RAW + """,
best AS (SELECT category_en FROM master WHERE category_en IS NOT NULL GROUP BY 1
  ORDER BY count(DISTINCT order_id) DESC, category_en LIMIT 15)
SELECT category_en, """ + ", ".join(
        f"count(DISTINCT CASE WHEN order_month = {i} THEN order_id END) AS \"{m}\""
        for i, m in enumerate(["Ene", "Feb", "Mar", "Abr", "May", "Jun", "Jul", "Ago", "Sep", "Oct", "Nov", "Dic"], 1)
    ) + " FROM master WHERE category_en IN (SELECT category_en FROM best) GROUP BY 1",
    "report_top_pairs": HIST + "," + pairs() + """
SELECT cat_a, cat_b, support, cat_a || ' ↔ ' || cat_b AS pair FROM pair WHERE support >= 30
ORDER BY support DESC, cat_a, cat_b LIMIT 25""",
    "report_customers_by_orders": RAW + """
SELECT n_orders, count(*) AS n_customers FROM (SELECT count(DISTINCT order_id) AS n_orders FROM master
  WHERE customer_unique_id IS NOT NULL GROUP BY customer_unique_id) WHERE n_orders <= 10 GROUP BY 1""",
    "report_customers_by_categories": RAW + """
SELECT n_cats, count(*) AS n_customers FROM (SELECT count(DISTINCT category_en) AS n_cats FROM master
  WHERE customer_unique_id IS NOT NULL GROUP BY customer_unique_id) WHERE n_cats <= 10 GROUP BY 1""",
    "report_customers_by_state": RAW + """
SELECT customer_state, count(DISTINCT customer_unique_id) AS customers FROM master
WHERE customer_state IS NOT NULL GROUP BY 1""",
    "report_spend_by_state": RAW + """
SELECT customer_state, round(coalesce(sum(item_total), 0), 0) AS total_brl FROM master
WHERE customer_state IS NOT NULL GROUP BY 1""",
    "report_diversity_segments": HIST + """
SELECT CASE WHEN n = 1 THEN '1 categoría' WHEN n = 2 THEN '2 categorías' WHEN n <= 5 THEN '3-5 categorías'
  ELSE '6+ categorías' END AS segment, count(*) AS customers
FROM (SELECT count(*) AS n FROM firsts GROUP BY u) WHERE n <= 100 GROUP BY 1""",
    "report_revenue_by_month": RAW + f""",
best AS (SELECT category_en FROM master WHERE category_en IS NOT NULL GROUP BY 1
  ORDER BY coalesce(sum(item_total), 0) DESC, category_en LIMIT 10)
SELECT order_ym, category_en, {stable("coalesce(sum(item_total), 0)", 4)} AS revenue FROM master
WHERE category_en IN (SELECT category_en FROM best) AND order_ym IS NOT NULL GROUP BY 1, 2""",
    "report_rfm_histograms": CLEANED + "," + rfm() + f"""
SELECT 'recency' AS metric, * FROM ({histogram("rfm_seg", "recency", "")})
UNION ALL SELECT 'frequency', frequency, CAST(frequency AS DOUBLE), CAST(frequency AS DOUBLE), count(*) FROM rfm_seg
  WHERE frequency <= 5 GROUP BY frequency
UNION ALL SELECT 'monetary', * FROM ({histogram("rfm_seg", "monetary", "AND monetary <= (SELECT quantile_cont(monetary, 0.95) FROM rfm_seg)")})""",
    "report_rfm_medians": CLEANED + "," + rfm() + f"""
SELECT median(CAST(recency AS DOUBLE)) AS median_recency, {stable("median(monetary)", 4)} AS median_monetary FROM rfm_seg""",
    "report_rfm_segments": CLEANED + "," + rfm() + """
SELECT segment, n AS customers, round(n * 100.0 / sum(n) OVER (), 1) AS pct,
  list_position(['Campeones', 'Leales', 'Regulares', 'En riesgo', 'Perdidos'], segment) AS position
FROM (SELECT segment, count(*) AS n FROM rfm_seg WHERE segment IS NOT NULL GROUP BY 1)""",
    "report_top_category_features": CLEANED + "," + category_features() + f"""
SELECT {CAT_COLUMNS} FROM cat_full ORDER BY cat_full.total_orders DESC, category_en LIMIT 20""",
}


STATEMENTS["master_from_buckets"] = STATEMENTS["master_table"]
STATEMENTS["scenario_measures"] = f"""
WITH a AS (SELECT 'leave_one_out' AS scenario, precision, recall FROM ({loo("hybrid", "0.7")})),
b AS (SELECT 'cross_validation' AS scenario, {stable("avg(precision)", 8)} AS precision, {stable("avg(recall)", 8)} AS recall
  FROM ({HIST + "," + folds(3) + "," + fold_search([("0", 0.7, 10)])} SELECT precision, recall FROM fold_rows)),
c AS (SELECT 'backtest' AS scenario, precision, recall FROM ({STATEMENTS["temporal_backtest"]})),
d AS (SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c)
SELECT scenario, 'precision' AS metric, precision AS value FROM d UNION ALL SELECT scenario, 'recall', recall FROM d"""
