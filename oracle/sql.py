"""ANSI-style SQL over the driver's tables, one statement per registered query.

The statements are written from the operator definitions: naive forms (all
customers x all categories, one model per fold, full sorts), not the forms the
Spark code uses.
"""

from __future__ import annotations

DAY = "86400000000.0"


def stable(x: str, digits: int) -> str:
    """Rounding whose tie point lies off the decimal grid (summation order cannot flip it)."""
    return f"(floor(({x}) * 1e{digits} + 0.5001) / 1e{digits})"


def title(x: str) -> str:
    return (
        f"array_to_string(list_transform(string_split({x}, ' '), "
        "lambda w: upper(w[1]) || lower(w[2:])), ' ')"
    )


SOURCES = f"""
t_orders AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
    CASE WHEN o_orderkey % 50 = 0 THEN 'canceled' WHEN o_orderkey % 50 = 1 THEN 'unavailable'
         WHEN o_orderstatus = 'F' THEN 'delivered' ELSE 'shipped' END AS order_status,
    o_orderdate AS order_purchase_timestamp,
    o_orderdate + to_hours(o_orderkey % 48) AS order_approved_at,
    CASE WHEN o_orderkey % 20 <> 0 THEN o_orderdate + to_days(CAST(1 + o_orderkey % 3 AS INTEGER)) END
      AS order_delivered_carrier_date,
    CASE WHEN o_orderkey % 20 <> 0 THEN o_orderdate + to_days(CAST(3 + o_orderkey % 37 AS INTEGER))
         + to_hours(o_orderkey % 24) END AS order_delivered_customer_date,
    o_orderdate + to_days(20) AS order_estimated_delivery_date
  FROM orders),
t_customers AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id, CAST(c_custkey AS VARCHAR) AS customer_unique_id,
    lpad(CAST(c_custkey % 99999 AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
    c_mktsegment AS customer_city, n_name AS customer_state
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
t_items AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS order_item_id,
    CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
    CASE WHEN l_orderkey % 211 = 0 THEN l_extendedprice * 10 ELSE l_extendedprice END AS price,
    l_extendedprice * l_tax AS freight_value
  FROM lineitem),
t_map AS (
  SELECT DISTINCT replace(p_name, ' ', '_') AS product_category_name, upper(p_name) AS english
  FROM part WHERE length(p_name) % 2 = 0),
t_products AS (
  SELECT product_id, p.product_category_name,
    coalesce(english, {title("replace(p.product_category_name, '_', ' ')")}) AS category_en,
    product_weight_g, product_photos_qty
  FROM (SELECT CAST(p_partkey AS VARCHAR) AS product_id,
          CASE WHEN p_partkey % 97 <> 0 THEN replace(p_name, ' ', '_') END AS product_category_name,
          CAST(p_size * 100.0 AS DOUBLE) AS product_weight_g, p_partkey % 5 + 1 AS product_photos_qty
        FROM part) p
  LEFT JOIN t_map m ON m.product_category_name = p.product_category_name),
t_reviews AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_orderkey % 5 + 1 AS review_score
  FROM orders WHERE o_orderkey % 10 <> 0
  UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 5 FROM orders WHERE o_orderkey % 100 = 1),
t_payments AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_orderpriority AS payment_type,
    o_orderkey % 10 + 1 AS payment_installments, o_totalprice AS payment_value FROM orders
  UNION ALL
  SELECT CAST(o_orderkey AS VARCHAR), 'voucher', o_orderkey % 10 + 1, o_totalprice
  FROM orders WHERE o_orderkey % 7 = 0),
t_sellers AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, n_name AS seller_state
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey),
pay AS (
  SELECT s.order_id, total_payment, num_installments, payment_type
  FROM (SELECT order_id, sum(payment_value) AS total_payment, max(payment_installments) AS num_installments
        FROM t_payments GROUP BY 1) s
  LEFT JOIN (SELECT order_id, payment_type FROM (
      SELECT order_id, payment_type, row_number() OVER (PARTITION BY order_id
        ORDER BY count(*) DESC, payment_type) AS r FROM t_payments GROUP BY 1, 2) WHERE r = 1) m
    ON m.order_id = s.order_id),
rev AS (
  SELECT order_id, avg(review_score) AS review_score, count(*) AS review_count FROM t_reviews GROUP BY 1)"""


def _master(where: str = "") -> str:
    return f"""
joined AS (
  SELECT o.*, c.* EXCLUDE (customer_id), r.review_score, r.review_count, p.total_payment,
    p.num_installments, p.payment_type, i.order_item_id, i.product_id, i.seller_id, i.price,
    i.freight_value, pr.product_category_name, pr.category_en, pr.product_weight_g,
    pr.product_photos_qty, s.seller_state,
    CAST(floor((epoch_us(order_delivered_customer_date) - epoch_us(order_purchase_timestamp)) / {DAY}) AS DOUBLE) AS delivery_days,
    CAST(floor((epoch_us(order_estimated_delivery_date) - epoch_us(order_purchase_timestamp)) / {DAY}) AS DOUBLE) AS estimated_days,
    year(order_purchase_timestamp) AS order_year, month(order_purchase_timestamp) AS order_month,
    strftime(order_purchase_timestamp, '%Y-%m') AS order_ym,
    price + freight_value AS item_total,
    CASE WHEN price > 0 THEN freight_value / price END AS freight_ratio
  FROM t_orders o
  LEFT JOIN t_customers c ON c.customer_id = o.customer_id
  LEFT JOIN t_items i ON i.order_id = o.order_id
  LEFT JOIN t_products pr ON pr.product_id = i.product_id
  LEFT JOIN rev r ON r.order_id = o.order_id
  LEFT JOIN pay p ON p.order_id = o.order_id
  LEFT JOIN t_sellers s ON s.seller_id = i.seller_id),
master AS MATERIALIZED (
  SELECT *, delivery_days - estimated_days AS delivery_delay,
    CASE WHEN delivery_days - estimated_days > 0 THEN 1 ELSE 0 END AS is_late FROM joined {where})"""


CLEAN = """
base AS MATERIALIZED (
  SELECT * FROM master WHERE category_en IS NOT NULL AND customer_unique_id IS NOT NULL
    AND (order_status IS NULL OR order_status NOT IN ('canceled', 'unavailable', 'created'))),
state_days AS (
  SELECT seller_state, median(delivery_days) AS md FROM base WHERE seller_state IS NOT NULL GROUP BY 1),
filled AS (
  SELECT b.* REPLACE (coalesce(b.delivery_days, md) AS delivery_days)
  FROM base b LEFT JOIN state_days s ON s.seller_state = b.seller_state),
cap AS (
  SELECT q3 + 3 * (q3 - q1) AS price_cap
  FROM (SELECT quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.75) AS q3 FROM base)),
clean AS MATERIALIZED (
  SELECT * REPLACE (
    coalesce(delivery_days, (SELECT median(delivery_days) FROM filled)) AS delivery_days,
    coalesce(review_score, (SELECT median(review_score) FROM base)) AS review_score)
  FROM filled WHERE price <= (SELECT price_cap FROM cap))"""


def history(table: str) -> str:
    """First-purchase order per customer, interactions and popularity of a table."""
    return f"""
purchases AS MATERIALIZED (
  SELECT * FROM {table} WHERE customer_unique_id IS NOT NULL AND category_en IS NOT NULL),
seen AS MATERIALIZED (
  SELECT customer_unique_id AS u, category_en AS cat, row_number() OVER (
    PARTITION BY customer_unique_id, category_en ORDER BY order_purchase_timestamp NULLS LAST,
      order_id, order_item_id, product_id) AS nth,
    order_purchase_timestamp AS ts, order_id, order_item_id, product_id FROM purchases),
firsts AS MATERIALIZED (
  SELECT u, cat, row_number() OVER (PARTITION BY u ORDER BY ts NULLS LAST, order_id, order_item_id,
    product_id, cat) AS place, count(*) OVER (PARTITION BY u) AS n FROM seen WHERE nth = 1),
inter AS MATERIALIZED (
  SELECT customer_unique_id AS u, category_en AS cat, count(DISTINCT order_id) AS x FROM purchases GROUP BY 1, 2),
pop AS MATERIALIZED (
  SELECT category_en AS cat, num_orders, row_number() OVER (ORDER BY num_orders DESC, category_en) AS rank,
    num_orders * 100.0 / sum(num_orders) OVER () AS pct, num_orders / max(num_orders) OVER () AS score
  FROM (SELECT category_en, count(DISTINCT order_id) AS num_orders FROM {table}
        WHERE category_en IS NOT NULL GROUP BY 1))"""


def pairs(users: str = "firsts") -> str:
    return f"""
pair AS MATERIALIZED (
  SELECT a.cat AS cat_a, b.cat AS cat_b, count(*) AS support FROM {users} a
  JOIN {users} b ON a.u = b.u AND a.cat < b.cat GROUP BY 1, 2),
single AS (SELECT cat, count(*) AS n FROM {users} GROUP BY 1)"""


def jaccard(min_support: int) -> str:
    return f"""
half AS (
  SELECT cat_a, cat_b, support / (a.n + b.n - support) AS sim FROM pair
  JOIN single a ON a.cat = cat_a JOIN single b ON b.cat = cat_b WHERE support >= {min_support}),
sim AS MATERIALIZED (
  SELECT * FROM half UNION ALL SELECT cat_b, cat_a, sim FROM half
  UNION ALL SELECT cat, cat, 1.0 FROM single)"""


def ranking(hist: str, alpha: str, positives: bool = True, sim: str = "sim", pop: str = "pop", g: str = "") -> str:
    """Rank every category for every customer in ``hist`` (u, cat); optional group columns ``g``."""
    gs = [c for c in g.split(",") if c]
    sel = "".join(f"h.{c}, " for c in gs)
    on = lambda a, b: "".join(f" AND {a}.{c} = {b}.{c}" for c in gs)
    part = "".join(f"{c}, " for c in gs)
    listed = "score > 0" if positives else "true"
    return f"""
cf AS MATERIALIZED (
  SELECT {sel}h.u, s.cat_b AS cat, sum(s.sim) AS cf FROM {hist} h
  JOIN {sim} s ON s.cat_a = h.cat{on("s", "h")} GROUP BY ALL),
who AS (SELECT DISTINCT {sel}h.u FROM {hist} h),
cand AS MATERIALIZED (
  SELECT {"".join(f"w.{c}, " for c in gs)}w.u, p.cat, p.rank AS pop_rank, p.score AS pop_score,
    coalesce(c.cf, 0) AS cf, m.mx
  FROM who w JOIN {pop} p ON true{on("p", "w")}
  LEFT JOIN cf c ON c.u = w.u AND c.cat = p.cat{on("c", "w")}
  LEFT JOIN (SELECT {part}u, max(cf) AS mx FROM cf GROUP BY ALL) m ON m.u = w.u{on("m", "w")}
  WHERE NOT EXISTS (SELECT 1 FROM {hist} o WHERE o.u = w.u AND o.cat = p.cat{on("o", "w")})),
scored AS (
  SELECT *, {alpha} * (CASE WHEN mx > 0 THEN cf / mx ELSE cf END) + (1 - {alpha}) * pop_score AS score FROM cand),
recs AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY {part}u ORDER BY CASE WHEN {listed} THEN 0 ELSE 1 END,
    CASE WHEN {listed} THEN floor(score * 1e10 + 0.5) END DESC NULLS LAST,
    CASE WHEN NOT ({listed}) THEN pop_rank END, cat) AS rank FROM scored)"""


LOO = """
train AS MATERIALIZED (SELECT u, cat FROM firsts WHERE n >= 2 AND place < n),
test AS MATERIALIZED (SELECT u, cat FROM firsts WHERE n >= 2 AND place = n)"""

LOO_METRICS = """
SELECT '{name}' AS variant, hits / (n * 10.0) AS precision, hits / n AS recall, hits / n AS hit_rate,
  covered / (SELECT count(*) FROM pop) AS coverage, n AS n_users,
  CASE WHEN hits > 0 THEN 2 * (hits / (n * 10.0)) * (hits / n) / (hits / (n * 10.0) + hits / n) ELSE 0.0 END AS f1
FROM (SELECT (SELECT count(*) FROM test) AS n,
  (SELECT count(*) FROM recs r JOIN test t ON t.u = r.u AND t.cat = r.cat WHERE r.rank <= 10) AS hits,
  (SELECT count(DISTINCT cat) FROM recs WHERE rank <= 10) AS covered)"""


def with_(*parts: str) -> str:
    return "WITH " + ",".join(parts)


RAW = with_(SOURCES, _master())
CLEANED = with_(SOURCES, _master(), CLEAN)
HIST = with_(SOURCES, _master(), CLEAN, history("clean"))
SVD_HIST = HIST.replace("WITH", "WITH RECURSIVE", 1)


def cleaned_until(month: str, *parts: str) -> str:
    return with_(SOURCES, _master(f"WHERE order_ym <= '{month}'"), CLEAN, history("clean"), *parts)


def cleaned_then_cut(month: str, *parts: str) -> str:
    cut = f"upto AS MATERIALIZED (SELECT * FROM clean WHERE order_ym <= '{month}')"
    return with_(SOURCES, _master(), CLEAN, cut, history("upto"), *parts)


def metrics_row(table: str) -> str:
    return f"""
SELECT (SELECT count(DISTINCT order_id) FROM {table}) AS total_orders,
  (SELECT count(DISTINCT customer_unique_id) FROM {table}) AS total_customers,
  (SELECT count(DISTINCT product_id) FROM {table}) AS total_products,
  (SELECT count(DISTINCT category_en) FROM {table}) AS total_categories,
  {stable("avg(review_score)", 6)} AS avg_review_score,
  {stable(f"(SELECT avg(n) FROM (SELECT count(order_item_id) AS n FROM {table} GROUP BY order_id))", 6)} AS avg_items_per_order,
  {stable(f"(SELECT avg(s) FROM (SELECT coalesce(sum(item_total), 0) AS s FROM {table} GROUP BY order_id))", 4)} AS avg_order_value_brl,
  {stable("avg(delivery_days)", 6)} AS avg_delivery_days,
  {stable("avg(is_late) * 100", 6)} AS late_delivery_rate_pct,
  {stable(f"(SELECT avg(CASE WHEN n > 1 THEN 1.0 ELSE 0.0 END) * 100 FROM (SELECT count(DISTINCT order_id) AS n FROM {table} WHERE customer_unique_id IS NOT NULL GROUP BY customer_unique_id))", 6)} AS repeat_customer_rate,
  {stable(f"(SELECT avg(n) FROM (SELECT count(DISTINCT category_en) AS n FROM {table} WHERE customer_unique_id IS NOT NULL GROUP BY customer_unique_id))", 6)} AS avg_categories_per_customer,
  (SELECT customer_state FROM (SELECT customer_state, count(DISTINCT customer_unique_id) AS n FROM {table}
     WHERE customer_state IS NOT NULL GROUP BY 1) ORDER BY n DESC, customer_state LIMIT 1) AS top_state_customers
FROM {table} WHERE order_status = 'delivered'"""


def rfm(table: str = "clean") -> str:
    def mode(col: str, name: str) -> str:
        return f"""{name} AS (SELECT u, {col} FROM (SELECT customer_unique_id AS u, {col}, row_number() OVER (
    PARTITION BY customer_unique_id ORDER BY count(*) DESC, {col}) AS r FROM {table}
    WHERE {col} IS NOT NULL GROUP BY 1, 2) WHERE r = 1)"""

    def scored(metric: str, name: str, reverse: bool) -> str:
        score = "5 - b" if reverse else "1 + b"
        return f"""
e_{metric} AS (SELECT [quantile_cont(v, 0.0), quantile_cont(v, 0.2), quantile_cont(v, 0.4), quantile_cont(v, 0.6),
    quantile_cont(v, 0.8), quantile_cont(v, 1.0)] AS e FROM (SELECT CAST({metric} AS DOUBLE) AS v FROM rfm0)),
p_{metric} AS (SELECT u, CAST({metric} AS DOUBLE) AS v, (rank() OVER (ORDER BY {metric}) + (count(*) OVER (PARTITION BY {metric}) - 1) / 2.0)
    / count(*) OVER () AS pct FROM rfm0),
s_{metric} AS (
  SELECT u, CAST({score} AS DOUBLE) AS {name} FROM (
    SELECT u, CASE WHEN len(list_distinct(e)) = 6
      THEN (CASE WHEN v > e[2] THEN 1 ELSE 0 END) + (CASE WHEN v > e[3] THEN 1 ELSE 0 END)
         + (CASE WHEN v > e[4] THEN 1 ELSE 0 END) + (CASE WHEN v > e[5] THEN 1 ELSE 0 END)
      ELSE (CASE WHEN pct > lo + (hi - lo) * 0.2 THEN 1 ELSE 0 END) + (CASE WHEN pct > lo + (hi - lo) * 0.4 THEN 1 ELSE 0 END)
         + (CASE WHEN pct > lo + (hi - lo) * 0.6 THEN 1 ELSE 0 END) + (CASE WHEN pct > lo + (hi - lo) * 0.8 THEN 1 ELSE 0 END) END AS b
    FROM p_{metric}, e_{metric},
      (SELECT CASE WHEN min(pct) = max(pct) THEN min(pct) * 0.999 ELSE min(pct) END AS lo,
              CASE WHEN min(pct) = max(pct) THEN max(pct) * 1.001 ELSE max(pct) END AS hi FROM p_{metric})))"""

    return f"""
{mode("customer_state", "mode_state")},
{mode("category_en", "mode_cat")},
last_cat AS (SELECT u, category_en AS last_category FROM (SELECT customer_unique_id AS u, category_en, row_number() OVER (
    PARTITION BY customer_unique_id ORDER BY order_purchase_timestamp DESC, order_id DESC, order_item_id DESC,
    product_id DESC, category_en DESC) AS r FROM {table} WHERE category_en IS NOT NULL) WHERE r = 1),
rfm0 AS MATERIALIZED (
  SELECT customer_unique_id AS u,
    CAST(floor((epoch_us((SELECT max(order_purchase_timestamp) FROM {table})) - epoch_us(max(order_purchase_timestamp))) / {DAY}) AS BIGINT) AS recency,
    count(DISTINCT order_id) AS frequency, coalesce(sum(item_total), 0) AS monetary, avg(item_total) AS avg_ticket,
    avg(review_score) AS avg_review, count(DISTINCT category_en) AS category_diversity,
    count(order_item_id) AS total_items, avg(delivery_days) AS avg_delivery_days, avg(is_late) AS late_rate,
    count(DISTINCT payment_type) AS n_distinct_payments
  FROM {table} WHERE customer_unique_id IS NOT NULL GROUP BY 1),
{scored("recency", "R_score", True)},{scored("frequency", "F_score", False)},{scored("monetary", "M_score", False)},
rfm AS MATERIALIZED (
  SELECT r.*, customer_state AS preferred_state, category_en AS preferred_category, last_category, R_score, F_score,
    M_score, floor((R_score + F_score + M_score) / 3 * 10 + 0.5) / 10 AS RFM_score
  FROM rfm0 r LEFT JOIN mode_state USING (u) LEFT JOIN mode_cat USING (u) LEFT JOIN last_cat USING (u)
  JOIN s_recency USING (u) JOIN s_frequency USING (u) JOIN s_monetary USING (u)),
rfm_seg AS MATERIALIZED (
  SELECT *, CASE WHEN RFM_score <= 0 THEN NULL WHEN RFM_score <= 1.5 THEN 'Perdidos' WHEN RFM_score <= 2.5 THEN 'En riesgo'
    WHEN RFM_score <= 3.5 THEN 'Regulares' WHEN RFM_score <= 4.5 THEN 'Leales' WHEN RFM_score <= 5.1 THEN 'Campeones' END AS segment
  FROM rfm)"""


def category_features(table: str = "clean") -> str:
    return f"""
cat_feat AS MATERIALIZED (
  SELECT category_en, count(DISTINCT order_id) AS total_orders, count(DISTINCT customer_unique_id) AS total_customers,
    avg(price) AS avg_price, avg(review_score) AS avg_review, avg(delivery_days) AS avg_delivery,
    avg(is_late) AS late_rate, coalesce(sum(item_total), 0) AS total_revenue, avg(freight_ratio) AS avg_freight_ratio
  FROM {table} WHERE category_en IS NOT NULL GROUP BY 1),
repeaters AS (SELECT category_en, count(*) AS n FROM (SELECT category_en, customer_unique_id FROM {table}
    WHERE category_en IS NOT NULL AND customer_unique_id IS NOT NULL GROUP BY 1, 2
    HAVING count(DISTINCT order_id) > 1) GROUP BY 1),
cat_full AS MATERIALIZED (
  SELECT c.*, coalesce(r.n / c.total_customers, 0) AS repeat_rate,
    CAST(floor(rank() OVER (ORDER BY total_orders DESC) + (count(*) OVER (PARTITION BY total_orders) - 1) / 2.0) AS INTEGER) AS popularity_rank
  FROM cat_feat c LEFT JOIN repeaters r USING (category_en))"""


def histogram(table: str, value: str, where: str, bins: int = 50) -> str:
    return f"""
SELECT bin, {stable(f"lo + (hi - lo) / {bins} * (bin - 1)", 4)} AS low, {stable(f"lo + (hi - lo) / {bins} * bin", 4)} AS high, n
FROM (SELECT least(CAST(floor((v - lo) / ((hi - lo) / {bins})) AS BIGINT) + 1, {bins}) AS bin, lo, hi, count(*) AS n
  FROM (SELECT CAST({value} AS DOUBLE) AS v, min(CAST({value} AS DOUBLE)) OVER () AS lo,
      max(CAST({value} AS DOUBLE)) OVER () AS hi FROM {table} WHERE {value} IS NOT NULL {where}) GROUP BY ALL)"""


def folds(n: int, seed: int = 42) -> str:
    """One model per fold, fitted from the customers outside it."""
    return f"""
fold_of AS MATERIALIZED (
  SELECT DISTINCT u, CASE WHEN n >= 2 THEN CAST(CAST('0x' || substr(md5('{seed}' || u), 1, 7) AS BIGINT) % {n} AS INTEGER) + 1 END AS fold
  FROM firsts),
fold AS (SELECT CAST(range AS INTEGER) AS fold FROM range(1, {n} + 1)),
fit AS MATERIALIZED (
  SELECT f.fold, h.u, h.cat, i.x FROM fold f JOIN firsts h ON true JOIN fold_of o ON o.u = h.u
  JOIN inter i ON i.u = h.u AND i.cat = h.cat WHERE o.fold IS NULL OR o.fold <> f.fold),
fpop AS MATERIALIZED (
  SELECT fold, cat, row_number() OVER (PARTITION BY fold ORDER BY s DESC, cat) AS rank,
    s / max(s) OVER (PARTITION BY fold) AS score
  FROM (SELECT fold, cat, CAST(sum(x) AS BIGINT) AS s FROM fit GROUP BY 1, 2)),
fsingle AS (SELECT fold, cat, count(*) AS n FROM fit GROUP BY 1, 2),
fpair AS MATERIALIZED (
  SELECT a.fold, a.cat AS cat_a, b.cat AS cat_b, count(*) AS support FROM fit a
  JOIN fit b ON a.fold = b.fold AND a.u = b.u AND a.cat < b.cat GROUP BY 1, 2, 3),
train AS MATERIALIZED (SELECT o.fold, f.u, f.cat FROM firsts f JOIN fold_of o USING (u) WHERE f.n >= 2 AND place < n),
test AS MATERIALIZED (SELECT o.fold, f.u, f.cat FROM firsts f JOIN fold_of o USING (u) WHERE f.n >= 2 AND place = n)"""


def fold_search(params: list[tuple[str, float, int]]) -> str:
    """All (variant, alpha, floor) of a search: similarity and ranking per fold and variant."""
    rows = ", ".join(f"('{v}', CAST({a} AS DOUBLE), {m})" for v, a, m in params)
    return f"""
par AS (SELECT * FROM (VALUES {rows}) t(variant, alpha, floor_)),
fhalf AS (
  SELECT v.variant, p.fold, cat_a, cat_b, support / (a.n + b.n - support) AS sim
  FROM par v JOIN fpair p ON p.support >= v.floor_
  JOIN fsingle a ON a.fold = p.fold AND a.cat = cat_a JOIN fsingle b ON b.fold = p.fold AND b.cat = cat_b),
fsim AS MATERIALIZED (
  SELECT * FROM fhalf UNION ALL SELECT variant, fold, cat_b, cat_a, sim FROM fhalf
  UNION ALL SELECT variant, fold, cat, cat, 1.0 FROM fsingle JOIN par ON true),
vtrain AS MATERIALIZED (SELECT p.variant, p.alpha, t.* FROM train t JOIN par p ON true),
vpop AS (SELECT p.variant, p.alpha, f.* FROM fpop f JOIN par p ON true),
vsim AS (SELECT s.*, p.alpha FROM fsim s JOIN par p USING (variant)),
{ranking("vtrain", "alpha", sim="vsim", pop="vpop", g="variant,alpha,fold")},
fold_rows AS (
  SELECT variant, fold, hits / (n * 10.0) AS precision, hits / n AS recall, hits / n AS hit_rate,
    covered / cats AS coverage, n AS n_users,
    CASE WHEN hits > 0 THEN 2 * (hits / (n * 10.0)) * (hits / n) / (hits / (n * 10.0) + hits / n) ELSE 0.0 END AS f1
  FROM (SELECT r.variant, r.fold, CAST(sum(CASE WHEN t.u IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS hits, count(DISTINCT r.cat) AS covered
        FROM recs r LEFT JOIN test t ON t.u = r.u AND t.cat = r.cat WHERE r.rank <= 10 GROUP BY 1, 2)
  JOIN (SELECT fold, count(*) AS n FROM test GROUP BY 1) USING (fold)
  JOIN (SELECT fold, count(*) AS cats FROM fpop GROUP BY 1) USING (fold))"""


SQUARINGS = 22


def eigen(name: str, source: str, k: int) -> str:
    """``name`` (f, cat, l, v): leading eigenvectors of the full symmetric matrix ``source`` (a, b, v), recursively.

    The matrix is squared again and again (scaled to trace 1) until its first
    eigenvector alone is left; that part is subtracted, and so on, for ``k``
    vectors or one less than there are rows. The largest entry of a vector is
    positive, the first one if several are.
    """
    return f"""
{name}_steps(f, step, a, b, g, p) AS (
  SELECT 0, 0, a, b, v, v / (SELECT sum(v) FROM {source} WHERE a = b) FROM {source}
  UNION ALL
  SELECT * FROM (
    WITH s AS (SELECT * FROM {name}_steps WHERE f >= 0),
    squared AS (SELECT x.a, y.b, sum(x.p * y.p) AS p FROM s x JOIN s y ON x.b = y.a WHERE x.step < {SQUARINGS} GROUP BY 1, 2),
    trace AS (SELECT sum(p) AS t FROM squared WHERE a = b),
    peak AS (SELECT a FROM s WHERE a = b AND step = {SQUARINGS} ORDER BY p DESC, a LIMIT 1),
    vec AS (SELECT s.a, s.p AS v FROM s JOIN peak ON s.b = peak.a),
    unit AS (SELECT a, v / sqrt(sum(v * v) OVER ()) AS v FROM vec),
    val AS (SELECT sum(s.g * x.v * y.v) AS l FROM s JOIN unit x ON x.a = s.a JOIN unit y ON y.a = s.b),
    less AS (SELECT s.f, s.a, s.b, s.g - l * x.v * y.v AS g FROM s JOIN unit x ON x.a = s.a JOIN unit y ON y.a = s.b, val),
    rest AS (SELECT sum(g) AS t, count(*) AS n FROM less WHERE a = b)
    SELECT s.f, s.step + 1 AS step, s.a, s.b, s.g, q.p / t AS p FROM s JOIN squared q ON q.a = s.a AND q.b = s.b, trace
    UNION ALL SELECT f + 1, 0, a, b, g, g / t FROM less, rest WHERE f + 1 < least({k}, n - 1)
    UNION ALL SELECT -1 - less.f, 0, unit.a, unit.a, l, unit.v FROM unit JOIN less ON less.a = unit.a AND less.b = unit.a, val)),
{name} AS MATERIALIZED (
  SELECT -1 - f AS f, a AS cat, greatest(g, 0) AS l, p * CASE WHEN first_value(p) OVER (PARTITION BY f ORDER BY abs(p) DESC, a) < 0 THEN -1 ELSE 1 END AS v
  FROM {name}_steps WHERE f < 0)"""


def svd(k: int) -> str:
    """``fac`` and the cosines ``sim`` of its rows; a negligible row has none."""
    return f"""
every_cat AS (SELECT DISTINCT cat FROM inter),
half_gram AS (SELECT a.cat AS a, b.cat AS b, CAST(sum(a.x * b.x) AS DOUBLE) AS v FROM inter a JOIN inter b ON a.u = b.u GROUP BY 1, 2),
gram AS MATERIALIZED (
  SELECT x.cat AS a, y.cat AS b, coalesce(g.v, 0.0) AS v FROM every_cat x JOIN every_cat y ON true
  LEFT JOIN half_gram g ON g.a = x.cat AND g.b = y.cat),
{eigen("fac", "gram", k)},
unit_fac AS (SELECT f, cat, CASE WHEN sqrt(sum(v * v) OVER (PARTITION BY cat)) > 1e-9 THEN v / sqrt(sum(v * v) OVER (PARTITION BY cat)) ELSE 0.0 END AS v FROM fac),
sim AS MATERIALIZED (SELECT a.cat AS cat_a, b.cat AS cat_b, sum(a.v * b.v) AS sim FROM unit_fac a JOIN unit_fac b ON a.f = b.f GROUP BY 1, 2)"""
