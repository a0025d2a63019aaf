"""Each registered query as SQL over the same tables, written independently of Spark ML.

Linear, isotonic and Poisson fits are closed forms or Newton steps. Trees are grown
level by level in ``oracle_trees``.
"""

from __future__ import annotations

from monthtide.registry.oracle_trees import tree_queries

# category role -> table, date column, category as text, output name
ROLES = {
    "priority": ("orders", "o_orderdate", "o_orderpriority", "o_orderpriority"),
    "status": ("orders", "o_orderdate", "o_orderstatus", "o_orderstatus"),
    "returnflag": ("lineitem", "l_shipdate", "l_returnflag", "l_returnflag"),
    "supplier": ("lineitem", "l_shipdate", "CAST(l_suppkey AS VARCHAR)", "l_suppkey"),
    "customer": ("orders", "o_orderdate", "CAST(o_custkey AS VARCHAR)", "o_custkey"),
}

TEST_AFTER = "DATE '2000-04-02'"
TRAIN_BEFORE = "DATE '2000-06-02'"


def overall_ctes() -> str:
    """counts, series(month, n, id)"""
    return """
counts AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n
  FROM orders GROUP BY 1),
series AS (
  SELECT month, n, CAST(row_number() OVER (ORDER BY month) AS INTEGER) AS id FROM counts)"""


def category_ctes(role: str) -> str:
    """counts, numbered, series(month, category, n, id, category_idx)"""
    table, day, category, _ = ROLES[role]
    return f"""
counts AS (
  SELECT CAST(date_trunc('month', {day}) AS DATE) AS month, {category} AS category,
         count({category}) AS n
  FROM {table} GROUP BY 1, 2),
numbered AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY category ORDER BY month) AS INTEGER) AS id
  FROM counts),
ranked AS (
  SELECT category,
         CAST(row_number() OVER (ORDER BY count(*) DESC, category) - 1 AS DOUBLE) AS category_idx
  FROM counts GROUP BY category),
series AS (SELECT * FROM numbered JOIN ranked USING (category))"""


def select_from(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


def counts_sql(role: str) -> str:
    return select_from(category_ctes(role), "SELECT month, category, n FROM counts")


# --- closed forms ------------------------------------------------------------------

OLS = """
fit AS (
  SELECT regr_slope(n, id) AS coef_id, regr_intercept(n, id) AS intercept FROM train)"""


def elastic_one_feature(slope: str) -> str:
    """Penalised least squares on the month number; ``slope`` uses r, sx, sy."""
    return f"""
moments AS (
  SELECT corr(id, n) AS r, stddev_pop(id) AS sx, stddev_pop(n) AS sy,
         avg(id) AS mx, avg(n) AS my FROM train),
fit AS (
  SELECT {slope} AS coef_id, my - ({slope}) * mx AS intercept FROM moments)"""


RIDGE = elastic_one_feature("r * sy / sx / (1 + 0.01 / sy)")
LASSO = elastic_one_feature("sign(r) * greatest(abs(r) - 0.01 / sy, 0) * sy / sx")


def ridge_two_features(penalty: str) -> str:
    """Ridge (plain least squares at 0) on the month number and the category index."""
    return f"""
moments AS (
  SELECT corr(id, n) AS r1, corr(category_idx, n) AS r2, corr(id, category_idx) AS r12,
         stddev_pop(id) AS s1, stddev_pop(category_idx) AS s2, stddev_pop(n) AS sy,
         avg(id) AS m1, avg(category_idx) AS m2, avg(n) AS my,
         1 + {penalty} / stddev_pop(n) AS a
  FROM train),
slopes AS (
  SELECT *, (a * r1 - r12 * r2) / (a * a - r12 * r12) * sy / s1 AS coef_id,
         (a * r2 - r12 * r1) / (a * a - r12 * r12) * sy / s2 AS coef_category
  FROM moments),
fit AS (
  SELECT coef_id, coef_category, my - coef_id * m1 - coef_category * m2 AS intercept
  FROM slopes)"""


ALL_ROWS = "train AS (SELECT * FROM series)"
ONE_COEFFICIENT = """
SELECT round(intercept, 6) AS intercept, round(coef_id, 6) AS coef_id FROM fit"""
TWO_COEFFICIENTS = """
SELECT round(intercept, 6) AS intercept, round(coef_id, 6) AS coef_id,
       round(coef_category, 6) AS coef_category FROM fit"""


def fit_sql(series: str, fit: str, body: str) -> str:
    return select_from(f"{series},\n{ALL_ROWS},{fit}", body)


ISOTONIC = """
merged AS (SELECT id, avg(n) AS y, count(*) AS w FROM series GROUP BY id),
running AS (
  SELECT id, y, w, sum(w) OVER (ORDER BY id) AS cw, sum(w * y) OVER (ORDER BY id) AS cwy
  FROM merged),
spans AS (
  SELECT a.id AS j, b.id AS k, (b.cwy - a.cwy + a.w * a.y) / (b.cw - a.cw + a.w) AS mean
  FROM running a JOIN running b ON a.id <= b.id),
lows AS (
  SELECT m.id, s.j, min(s.mean) AS low
  FROM merged m JOIN spans s ON s.j <= m.id AND s.k >= m.id GROUP BY m.id, s.j),
fitted AS (SELECT id, max(low) AS prediction FROM lows GROUP BY id)"""


def isotonic_sql(series: str, columns: str) -> str:
    return select_from(
        f"{series},{ISOTONIC}",
        f"SELECT {columns}, round(prediction, 6) AS prediction FROM series JOIN fitted USING (id)",
    )


def forecast_ctes(horizon: int, value: str) -> str:
    """future(month, id), forecast("Date", prediction) of an overall fit."""
    return f"""
future AS (
  SELECT CAST(last_month + to_months(CAST(step AS INTEGER)) AS DATE) AS month,
         last_id + step AS id
  FROM (SELECT max(month) AS last_month, max(id) AS last_id FROM series),
       generate_series(1, {horizon}) AS g(step)),
forecast AS (
  SELECT month AS "Date", greatest(0.0, round({value}, 0)) AS prediction FROM future, fit)"""


def ols_forecast_sql(horizon: int, body: str) -> str:
    return fit_sql(
        overall_ctes(), f"{OLS},{forecast_ctes(horizon, 'intercept + coef_id * id')}", body
    )


# --- Poisson regression: Newton steps on the log link ------------------------------


def poisson_ctes(two_features: bool, name: str = "poisson") -> str:
    """Recursive CTE over ``folded(k, month..., x1, [x2], n)``: one fit per training set k.

    Newton's method on centred features, started from the log of the mean.
    """
    x2 = "x2" if two_features else "0.0"
    ridge = "" if two_features else " + 1.0"
    return f"""
{name}_centres AS (
  SELECT k, avg(x1) AS c1, avg({x2}) AS c2, avg(n) AS my FROM folded GROUP BY k),
{name}_rows AS (
  SELECT f.k, f.x1 - c1 AS u, {x2} - c2 AS v, n FROM folded f JOIN {name}_centres USING (k)),
{name}_steps AS (
  SELECT k, 0 AS step, ln(my) AS b0, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2
  FROM {name}_centres
  UNION ALL
  SELECT k, step + 1,
         b0 + (g0*(h11*h22 - h12*h12) - h01*(g1*h22 - h12*g2) + h02*(g1*h12 - h11*g2)) / det,
         b1 + (h00*(g1*h22 - g2*h12) - g0*(h01*h22 - h12*h02) + h02*(h01*g2 - g1*h02)) / det,
         b2 + (h00*(h11*g2 - h12*g1) - h01*(h01*g2 - g1*h02) + g0*(h01*h12 - h11*h02)) / det
  FROM (
    SELECT *, h00*(h11*h22 - h12*h12) - h01*(h01*h22 - h12*h02) + h02*(h01*h12 - h11*h02) AS det
    FROM (
      SELECT k, step, b0, b1, b2, sum(n - mu) AS g0, sum((n - mu) * u) AS g1,
             sum((n - mu) * v) AS g2, sum(mu) AS h00, sum(mu * u) AS h01, sum(mu * v) AS h02,
             sum(mu * u * u) AS h11, sum(mu * u * v) AS h12, sum(mu * v * v){ridge} AS h22
      FROM (
        SELECT s.k, s.step, s.b0, s.b1, s.b2, r.u, r.v, r.n, exp(b0 + b1 * u + b2 * v) AS mu
        FROM {name}_steps s JOIN {name}_rows r ON s.k = r.k
        WHERE s.step < 12)
      GROUP BY k, step, b0, b1, b2))),
{name} AS (
  SELECT k, b0 - b1 * c1 - b2 * c2 AS intercept, b1 AS coef_id, b2 AS coef_category
  FROM {name}_steps JOIN {name}_centres USING (k) WHERE step = 12)"""


def gaussian_ctes(two_features: bool) -> str:
    """Least squares per training set k of ``folded``."""
    if not two_features:
        return """
gaussian AS (
  SELECT k, regr_intercept(n, x1) AS intercept, regr_slope(n, x1) AS coef_id,
         0.0 AS coef_category FROM folded GROUP BY k)"""
    return """
gaussian AS (
  SELECT k, my - b1 * m1 - b2 * m2 AS intercept, b1 AS coef_id, b2 AS coef_category
  FROM (
    SELECT k, m1, m2, my, (r1 - r12 * r2) / (1 - r12 * r12) * sy / s1 AS b1,
           (r2 - r12 * r1) / (1 - r12 * r12) * sy / s2 AS b2
    FROM (
      SELECT k, corr(x1, n) AS r1, corr(x2, n) AS r2, corr(x1, x2) AS r12,
             stddev_pop(x1) AS s1, stddev_pop(x2) AS s2, stddev_pop(n) AS sy,
             avg(x1) AS m1, avg(x2) AS m2, avg(n) AS my
      FROM folded GROUP BY k)))"""


def glr_choice_ctes(two_features: bool) -> str:
    """folded, gaussian, poisson, scores(family, rmse), best: training set 3 is all rows."""
    x2 = "category_idx" if two_features else "0.0"
    return f"""
keyed AS (
  SELECT n, CAST(id AS DOUBLE) AS x1, {x2} AS x2, CAST(id + {x2} AS BIGINT) % 3 AS fold
  FROM series),
folded AS (
  SELECT k, n, x1, x2 FROM keyed, generate_series(0, 3) AS g(k) WHERE fold <> k),
{gaussian_ctes(two_features)},
{poisson_ctes(two_features)},
fits AS (
  SELECT 'gaussian' AS family, * FROM gaussian UNION ALL SELECT 'poisson', * FROM poisson),
errors AS (
  SELECT family, fold, n - CASE family
           WHEN 'poisson' THEN exp(intercept + coef_id * x1 + coef_category * x2)
           ELSE intercept + coef_id * x1 + coef_category * x2 END AS e
  FROM keyed JOIN fits ON fits.k = keyed.fold),
scores AS (
  SELECT family, avg(rmse) AS rmse FROM (
    SELECT family, fold, sqrt(avg(e * e)) AS rmse FROM errors GROUP BY family, fold)
  GROUP BY family),
best AS (SELECT family FROM scores ORDER BY rmse, family LIMIT 1)"""


def glr_forecast_sql(role: str | None, horizon: int, by: str | None = None) -> str:
    series = overall_ctes() if role is None else category_ctes(role)
    if role is None:
        starts, category = "(SELECT 0.0 AS category_idx)", ""
    else:
        starts = "(SELECT DISTINCT category, category_idx FROM series)"
        category = f"category AS {by or ROLES[role][3]}, "
    score = "intercept + coef_id * (last_id + step) + coef_category * category_idx"
    return f"""WITH RECURSIVE {series},
{glr_choice_ctes(role is not None)},
chosen AS (SELECT fits.* FROM fits JOIN best USING (family) WHERE k = 3)
SELECT CAST(last_month + to_months(CAST(step AS INTEGER)) AS DATE) AS "Date", {category}
       greatest(0.0, round(CASE family WHEN 'poisson' THEN exp({score}) ELSE {score} END, 0))
         AS prediction
FROM (SELECT max(month) AS last_month, max(id) AS last_id FROM series),
     generate_series(1, {horizon}) AS g(step), {starts}, chosen"""


PENALTIES = ("0.0", "0.01", "1.0", "100.0")


def linear_recursive_sql(series: str, by: str, horizon: int, penalty: str) -> str:
    """Step k fits a plane to the history and to what step k - 1 predicted."""
    steps = []
    for k in range(1, horizon + 1):
        fed = "" if k == 1 else f" UNION ALL SELECT id, category_idx, p FROM p{k - 1}"
        steps.append(f"""
p{k} AS MATERIALIZED (
  WITH train AS (
    SELECT CAST(id AS DOUBLE) AS id, category_idx, CAST(n AS DOUBLE) AS n FROM series{fed}),
  {ridge_two_features(penalty)}
  SELECT CAST(last_month + to_months({k}) AS DATE) AS month, category, category_idx,
         CAST(last_id + {k} AS DOUBLE) AS id,
         intercept + coef_id * (last_id + {k}) + coef_category * category_idx AS p
  FROM (SELECT max(month) AS last_month, max(id) AS last_id FROM series),
       (SELECT DISTINCT category, category_idx FROM series), fit)""")
    parts = "\nUNION ALL\n".join(
        f'SELECT month AS "Date", category AS {by}, round(p, 0) AS prediction FROM p{k}'
        for k in range(1, horizon + 1)
    )
    return f"WITH {series},{','.join(steps)}\n{parts}"


def penalty_choice_sql(series: str, two_features: bool) -> str:
    """Each penalty's error over the folds; the lasso for one feature only."""
    kinds = ("0.0",) if two_features else ("0.0", "1.0")
    grid = ", ".join(
        f"({i}, {p}::DOUBLE, {kind}::DOUBLE)"
        for i, (p, kind) in enumerate((p, kind) for p in PENALTIES for kind in kinds)
    )
    x2 = "category_idx" if two_features else "0.0"
    if two_features:
        slopes = """
         (a * r1 - r12 * r2) / (a * a - r12 * r12) * sy / s1 AS b1,
         (a * r2 - r12 * r1) / (a * a - r12 * r12) * sy / s2 AS b2"""
    else:
        slopes = """
         CASE elastic_net WHEN 0 THEN r1 * sy / s1 / a
           ELSE sign(r1) * greatest(abs(r1) - (a - 1), 0) * sy / s1 END AS b1, 0.0 AS b2"""
    return f"""WITH {series},
grid(place, reg_param, elastic_net) AS (VALUES {grid}),
keyed AS (
  SELECT n, CAST(id AS DOUBLE) AS x1, {x2} AS x2, CAST(id + {x2} AS BIGINT) % 3 AS fold
  FROM series),
moments AS (
  SELECT k, corr(x1, n) AS r1, corr(x2, n) AS r2, corr(x1, x2) AS r12,
         stddev_pop(x1) AS s1, stddev_pop(x2) AS s2, stddev_pop(n) AS sy,
         avg(x1) AS m1, avg(x2) AS m2, avg(n) AS my
  FROM keyed, generate_series(0, 2) AS g(k) WHERE fold <> k GROUP BY k),
fits AS (
  SELECT k, place, m1, m2, my,{slopes}
  FROM (SELECT *, 1 + reg_param / sy AS a FROM moments, grid)),
errors AS (
  SELECT place, fold, n - (my + b1 * (x1 - m1) + b2 * (x2 - m2)) AS e
  FROM keyed JOIN fits ON k = fold),
scores AS (
  SELECT place, avg(rmse) AS rmse
  FROM (SELECT place, fold, sqrt(avg(e * e)) AS rmse FROM errors GROUP BY place, fold)
  GROUP BY place)
SELECT reg_param, elastic_net, round(rmse, 6) AS rmse,
       row_number() OVER (ORDER BY round(rmse, 9), place) = 1 AS chosen
FROM scores JOIN grid USING (place)"""


def poisson_sql(role: str | None) -> str:
    series = overall_ctes() if role is None else category_ctes(role)
    x2 = "0.0" if role is None else "category_idx"
    category = "" if role is None else ", round(coef_category, 6) AS coef_category"
    return f"""WITH RECURSIVE {series},
folded AS (SELECT 3 AS k, n, CAST(id AS DOUBLE) AS x1, {x2} AS x2 FROM series),
{poisson_ctes(role is not None)}
SELECT round(intercept, 6) AS intercept, round(coef_id, 6) AS coef_id{category} FROM poisson"""


# --- the registered keys -----------------------------------------------------------

METRICS = {
    "mae": "avg(abs(n - p))",
    "rmse": "sqrt(avg(power(n - p, 2)))",
    "r2": "1 - sum(power(n - p, 2)) / (count(*) * var_pop(n))",
}


def ols_metric_sql(metric: str) -> str:
    return select_from(
        f"{overall_ctes()},\ntrain AS (SELECT * FROM series WHERE month < {TEST_AFTER}),{OLS},\n"
        f"tested AS (SELECT n, intercept + coef_id * id AS p FROM series, fit "
        f"WHERE month > {TEST_AFTER})",
        f"SELECT round({METRICS[metric]}, 6) AS {metric} FROM tested",
    )


def ridge_metrics_sql() -> str:
    values = ", ".join(f"round({sql}, 6) AS {name}" for name, sql in METRICS.items())
    return select_from(
        f"{category_ctes('supplier')},\n{ALL_ROWS},{ridge_two_features('0.01')},\n"
        f"tested AS (SELECT n, intercept + coef_id * id + coef_category * category_idx AS p "
        f"FROM series, fit WHERE month > {TEST_AFTER})",
        f"SELECT {values} FROM tested",
    )


def isotonic_metrics_sql() -> str:
    values = ", ".join(f"round({sql}, 6) AS {name}" for name, sql in METRICS.items())
    return select_from(
        f"{category_ctes('status')},{ISOTONIC},\n"
        f"tested AS (SELECT n, prediction AS p FROM series JOIN fitted USING (id) "
        f"WHERE month > {TEST_AFTER})",
        f"SELECT {values} FROM tested",
    )


BIN_RULE = """CAST(CASE WHEN greatest(max(id), {n}) <= 32 THEN 32
  ELSE greatest(max(id), {n} - 1) + 1 END AS INTEGER)"""


def bins_sql() -> str:
    overall = BIN_RULE.format(n="1")
    by_category = BIN_RULE.format(n="count(DISTINCT category)")
    bins = f"(WITH {overall_ctes()} SELECT {overall} FROM series)"
    parts = [f"SELECT 'overall' AS series, {bins} AS bins"]
    parts += [
        f"SELECT '{role}', (WITH {category_ctes(role)} SELECT {by_category} FROM series)"
        for role in ("priority", "status", "returnflag", "supplier")
    ]
    return "\nUNION ALL\n".join(parts)


BOUNDS = """
SELECT max(month) AS last_month, max(id) AS last_id, count(*) AS rows,
       {categories} AS categories, CAST({nulls} AS BIGINT) AS null_categories FROM {frame}"""

ORDER_TEXTS = """
SELECT strftime(o_orderdate, '%d/%m/%Y') AS removal_date,
       CAST(o_orderkey AS VARCHAR) AS order_key, o_orderstatus AS specialty,
       o_orderpriority AS priority
FROM orders"""


def sql() -> dict[str, str]:
    overall = overall_ctes()
    forecast = ols_forecast_sql(3, "SELECT * FROM forecast")
    return {
        "csv_scan": ORDER_TEXTS,
        "csv_reordered_header": ORDER_TEXTS,
        "csv_quarantine": """
SELECT CASE o_orderkey % 50 WHEN 0 THEN 'not a date' WHEN 1 THEN 'no date'
            WHEN 2 THEN 'malformed row' ELSE 'good' END AS kind, count(*) AS n
FROM orders GROUP BY 1""",
        "csv_monthly_counts_by_priority": counts_sql("priority"),
        "csv_sink_roundtrip": forecast,
        "generic_sink_roundtrip": counts_sql("supplier"),
        "parse_month_key": """
SELECT CAST(o_orderkey AS VARCHAR) AS order_key,
       CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS month_key FROM orders""",
        "month_key_to_date": """
SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders""",
        "truncate_to_month": """
SELECT l_orderkey, l_linenumber, CAST(date_trunc('month', l_shipdate) AS DATE) AS month
FROM lineitem""",
        "round_half_up": """
SELECT c_custkey, round(c_acctbal, 0) AS whole,
       floor(c_acctbal) + CASE WHEN floor(c_acctbal) >= 0 THEN 1 ELSE 0 END AS whole_of_half
FROM customer""",
        "clamp_negative": """
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS clamped,
       CASE WHEN c_acctbal > 5000 THEN c_acctbal ELSE 0.0 END AS clamped_or_zero FROM customer""",
        "monthly_counts": select_from(overall, "SELECT month, n FROM counts"),
        "monthly_counts_by_priority": counts_sql("priority"),
        "monthly_counts_by_status": counts_sql("status"),
        "monthly_counts_by_returnflag": counts_sql("returnflag"),
        "monthly_counts_by_supplier": counts_sql("supplier"),
        "monthly_counts_null_category": """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
       nullif(o_orderstatus, 'P') AS category, count(nullif(o_orderstatus, 'P')) AS n
FROM orders GROUP BY 1, 2""",
        "month_index_overall": select_from(overall, "SELECT month, n, id FROM series"),
        "month_index_by_category": select_from(
            category_ctes("supplier"), "SELECT month, category, n, id FROM numbered"
        ),
        "sparse_month_index_by_customer": select_from(
            category_ctes("customer"), "SELECT month, category, n, id FROM numbered"
        ),
        "series_bounds": select_from(
            overall, BOUNDS.format(categories="CAST(1 AS BIGINT)", nulls="0", frame="series")
        ),
        "series_bounds_by_category": select_from(
            category_ctes("supplier"),
            BOUNDS.format(
                categories="count(DISTINCT category)",
                nulls="count(*) - count(category)",
                frame="numbered",
            ),
        ),
        "distinct_categories": select_from(
            category_ctes("supplier"), "SELECT DISTINCT category, category_idx FROM series"
        ),
        "bin_count": bins_sql(),
        "holdout_split": select_from(
            overall,
            f"""SELECT month, n, id, 'train' AS part FROM series WHERE month < {TRAIN_BEFORE}
UNION ALL
SELECT month, n, id, 'test' FROM series WHERE month > {TEST_AFTER}""",
        ),
        "index_range_filter": select_from(
            category_ctes("supplier"),
            "SELECT month, category, n, id, category_idx FROM series WHERE category_idx IN (0, 1)",
        ),
        "category_index": select_from(
            category_ctes("supplier"), "SELECT month, category, n, id, category_idx FROM series"
        ),
        "category_index_by_customer": select_from(
            category_ctes("customer"), "SELECT month, category, id, category_idx FROM series"
        ),
        "feature_vector": select_from(
            category_ctes("priority"),
            """SELECT month, category, CAST(id AS DOUBLE) AS f_id, category_idx AS f_category
FROM series""",
        ),
        "future_frame_overall": select_from(
            overall,
            """SELECT CAST(last_id + step AS DOUBLE) AS id,
  CAST(last_month + to_months(CAST(step AS INTEGER)) AS DATE) AS month
FROM (SELECT max(month) AS last_month, max(id) AS last_id FROM series),
     generate_series(1, 36) AS g(step)""",
        ),
        "future_frame_by_category": select_from(
            category_ctes("supplier"),
            """SELECT category, category_idx, CAST(last_id + step AS DOUBLE) AS id,
  CAST(last_month + to_months(CAST(step AS INTEGER)) AS DATE) AS month
FROM (SELECT max(month) AS last_month, max(id) AS last_id FROM series),
     (SELECT DISTINCT category, category_idx FROM series),
     generate_series(1, 12) AS g(step)""",
        ),
        "feedback_union": select_from(
            category_ctes("priority"),
            """SELECT month, category, category_idx, CAST(id AS DOUBLE) AS id,
  CAST(n AS DOUBLE) AS n FROM series
UNION ALL
SELECT CAST(last_month + INTERVAL 1 MONTH AS DATE), category, category_idx,
  CAST(last_id + 1 AS DOUBLE), last_id + 1.25
FROM (SELECT max(month) AS last_month, max(id) AS last_id FROM series),
     (SELECT DISTINCT category, category_idx FROM series)""",
        ),
        "ols_fit": fit_sql(overall, OLS, ONE_COEFFICIENT),
        "ridge_fit": fit_sql(overall, RIDGE, ONE_COEFFICIENT),
        "lasso_fit": fit_sql(overall, LASSO, ONE_COEFFICIENT),
        "glr_gaussian": fit_sql(overall, OLS, ONE_COEFFICIENT),
        "glr_poisson": poisson_sql(None),
        "ols_fit_by_supplier": fit_sql(
            category_ctes("supplier"), ridge_two_features("0.0"), TWO_COEFFICIENTS
        ),
        "ridge_fit_by_supplier": fit_sql(
            category_ctes("supplier"), ridge_two_features("0.01"), TWO_COEFFICIENTS
        ),
        "ridge_fit_by_status": fit_sql(
            category_ctes("status"), ridge_two_features("0.01"), TWO_COEFFICIENTS
        ),
        "glr_poisson_by_priority": poisson_sql("priority"),
        "isotonic_fit": isotonic_sql(overall, "month, id, n"),
        "isotonic_by_supplier": isotonic_sql(category_ctes("supplier"), "month, category, id, n"),
        "isotonic_by_status": isotonic_sql(category_ctes("status"), "month, category, id, n"),
        "lasso_holdout": select_from(
            f"{overall},\ntrain AS (SELECT * FROM series WHERE month < {TRAIN_BEFORE}),{LASSO}",
            f"""SELECT month, id, n, round(intercept + coef_id * id, 6) AS prediction
FROM series, fit WHERE month > {TEST_AFTER}""",
        ),
        "metric_mae": ols_metric_sql("mae"),
        "metric_rmse": ols_metric_sql("rmse"),
        "metric_r2": ols_metric_sql("r2"),
        "ridge_metrics_by_supplier": ridge_metrics_sql(),
        "isotonic_metrics_by_status": isotonic_metrics_sql(),
        "cv_model_choice": f"""WITH RECURSIVE {overall},
{glr_choice_ctes(False)}
SELECT family, round(rmse, 6) AS rmse, family = (SELECT family FROM best) AS chosen FROM scores""",
        "ols_recursive_by_supplier": linear_recursive_sql(
            category_ctes("supplier"), "l_suppkey", 6, "0.0"
        ),
        "ridge_recursive_by_priority": linear_recursive_sql(
            category_ctes("priority"), "o_orderpriority", 12, "100.0"
        ),
        "cv_penalty_choice": penalty_choice_sql(overall, False),
        "cv_penalty_choice_by_supplier": penalty_choice_sql(category_ctes("supplier"), True),
        "ols_forecast_overall": forecast,
        "glr_forecast_overall": glr_forecast_sql(None, 3),
        "glr_forecast_by_category": glr_forecast_sql("priority", 3),
        "glr_forecast_by_supplier": glr_forecast_sql("supplier", 12),
        "forecast_job_direct": glr_forecast_sql("priority", 3, "priority"),
        "forecast_job_allowed_dimension": glr_forecast_sql("priority", 3, "priority"),
        "forecast_job_without_nulls": glr_forecast_sql("status", 3, "specialty").replace(
            "FROM orders", "FROM (SELECT * FROM orders WHERE o_orderstatus <> 'P')"
        ),
        "forecast_preview": ols_forecast_sql(
            12, 'SELECT * FROM forecast ORDER BY "Date" LIMIT 5'
        ),
        "forecast_lines": ols_forecast_sql(
            3,
            """SELECT format('Prediction for {}-{} is {}', month("Date"), year("Date"),
  CAST(prediction AS BIGINT)) AS line FROM forecast""",
        ),
        **tree_queries(overall, category_ctes, (TEST_AFTER, TRAIN_BEFORE), METRICS),
    }
