"""Decision trees in SQL: variance-reducing splits, grown one level per CTE.

``<prefix>_input(run, x1, x2, y, w, trained, month, category)`` holds the training rows, with
their weight, and the rows to predict of each run (a fold, a tree of a forest, or all rows). A split on the month number lies
halfway between two neighbouring month numbers of the run; a split on the category takes
a prefix of the categories ordered by their mean in the node. The best gain wins, on a
tie the month number before the category and the earlier split before the later. Node 1
is the root, the children of node k are 2k and 2k + 1.
"""

from __future__ import annotations

import math
from collections.abc import Callable


def chance(*parts: str) -> str:
    """From 0 up to 1, by the first eight hex digits of an MD5."""
    text = " || ':' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"(CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT) / 4294967296.0)"


def level_ctes(prefix: str, level: int, month: str = "true", category: str = "true") -> str:
    """Nodes of one level and, from them, the rows of the next.

    ``month`` and ``category`` tell which nodes may be split by these.
    """
    rows = f"{prefix}_rows{level}"
    return f"""
{prefix}_nodes{level} AS MATERIALIZED (
  SELECT run, node, sum(w * y) AS ty, sum(w * y * y) AS tyy, sum(w)::DOUBLE AS tc
  FROM {rows} WHERE trained AND w > 0 GROUP BY run, node),
{prefix}_values{level} AS (
  SELECT run, node, 1 AS feature, x1 AS value, x1 AS place, 0.0 AS tie,
         sum(w * y) AS vy, sum(w * y * y) AS vyy, sum(w)::DOUBLE AS vc
  FROM {rows} WHERE trained AND w > 0 AND {month} GROUP BY run, node, x1
  UNION ALL
  SELECT run, node, 2, x2, sum(w * y) / sum(w), x2, sum(w * y), sum(w * y * y), sum(w)::DOUBLE
  FROM {rows} WHERE trained AND w > 0 AND {category} GROUP BY run, node, x2),
{prefix}_lefts{level} AS (
  SELECT *, sum(vy) OVER w AS ly, sum(vyy) OVER w AS lyy, sum(vc) OVER w AS lc
  FROM {prefix}_values{level}
  WINDOW w AS (PARTITION BY run, node, feature ORDER BY place, tie)),
{prefix}_gains{level} AS (
  SELECT l.run, l.node, feature, value, place, tie,
         (tyy - ty * ty / tc) / tc
           - lc / tc * ((lyy - ly * ly / lc) / lc)
           - (tc - lc) / tc * (((tyy - lyy) - (ty - ly) * (ty - ly) / (tc - lc)) / (tc - lc))
           AS gain
  FROM {prefix}_lefts{level} l JOIN {prefix}_nodes{level} n ON l.run = n.run AND l.node = n.node
  WHERE lc < tc),
{prefix}_best{level} AS MATERIALIZED (
  SELECT * FROM {prefix}_gains{level} WHERE gain > 0
  QUALIFY row_number() OVER (PARTITION BY run, node ORDER BY gain DESC, feature, place, tie) = 1),
{prefix}_rows{level + 1} AS MATERIALIZED (
  SELECT r.run, r.x1, r.x2, r.y, r.w, r.trained, r.month, r.category,
         2 * r.node + CASE
           WHEN b.feature = 1 THEN CASE WHEN r.x1 <= t.threshold THEN 0 ELSE 1 END
           WHEN v.place < b.place OR (v.place = b.place AND v.tie <= b.tie) THEN 0
           ELSE 1 END AS node
  FROM {rows} r
  JOIN {prefix}_best{level} b ON r.run = b.run AND r.node = b.node
  LEFT JOIN {prefix}_thresholds t ON b.feature = 1 AND t.run = b.run AND t.x1 = b.value
  LEFT JOIN {prefix}_values{level} v
    ON v.feature = 2 AND v.run = r.run AND v.node = r.node AND v.value = r.x2)"""


def tree_ctes(prefix: str, depth: int, month: str = "true", category: str = "true") -> str:
    """From ``<prefix>_input`` to ``<prefix>_levels(run, ..., level, prediction)``.

    ``levels`` has each row once per level it reaches; its prediction by a tree of
    depth d is the one of its last level up to d.
    """
    levels = ",".join(level_ctes(prefix, level, month, category) for level in range(depth + 1))
    reached = "\n  UNION ALL\n".join(
        f"""  SELECT r.run, x1, x2, y, trained, month, category, {level} AS level,
         ty / tc AS prediction
  FROM {prefix}_rows{level} r
  JOIN {prefix}_nodes{level} n ON r.run = n.run AND r.node = n.node"""
        for level in range(depth + 1)
    )
    return f"""
{prefix}_thresholds AS MATERIALIZED (
  SELECT run, x1, (x1 + lead(x1) OVER (PARTITION BY run ORDER BY x1)) / 2 AS threshold
  FROM (SELECT DISTINCT run, x1 FROM {prefix}_input WHERE trained)),
{prefix}_rows0 AS (SELECT *, 1::BIGINT AS node FROM {prefix}_input),{levels},
{prefix}_levels AS MATERIALIZED (
{reached})"""


def at_depth(prefix: str, depth: int, where: str = "true") -> str:
    """Each row to predict with the prediction of a tree of that depth."""
    return f"""
  SELECT * FROM {prefix}_levels WHERE level <= {depth} AND NOT trained AND {where}
  QUALIFY row_number() OVER (PARTITION BY run, month, category ORDER BY level DESC) = 1"""


def input_rows(
    source: str, overall: bool, run: str, trained: str, where: str, weight: str = "1.0::DOUBLE"
) -> str:
    x2, category = ("0.0", "''") if overall else ("category_idx", "category")
    return f"""
  SELECT {run} AS run, CAST(id AS DOUBLE) AS x1, CAST({x2} AS DOUBLE) AS x2,
         CAST(n AS DOUBLE) AS y, {weight} AS w, {trained} AS trained, month,
         {category} AS category
  FROM {source} WHERE {where}"""


def fitted_ctes(overall: bool, depth: int, train: str, test: str) -> str:
    """``fitted``: the test rows' predictions by one tree on the training rows."""
    return f"""
t_input AS (
{input_rows('series', overall, '0', 'true', train)}
  UNION ALL
{input_rows('series', overall, '0', 'false', test)}),
{tree_ctes('t', depth)},
fitted AS ({at_depth('t', depth)})"""


def fitted_sql(series: str, overall: bool, depth: int, train: str = "true", test: str = "true"):
    category = "" if overall else "category, "
    return f"""WITH {series},
{fitted_ctes(overall, depth, train, test)}
SELECT month, {category}CAST(x1 AS INTEGER) AS id, CAST(y AS BIGINT) AS n,
       round(prediction, 6) AS prediction FROM fitted"""


def metrics_sql(series: str, depth: int, test: str, metrics: dict[str, str]) -> str:
    values = ", ".join(f"round({sql}, 6) AS {name}" for name, sql in metrics.items())
    return f"""WITH {series},
{fitted_ctes(False, depth, 'true', test)}
SELECT {values} FROM (SELECT y AS n, prediction AS p FROM fitted)"""


DEPTHS = (3, 5, 7)


def choice_ctes(prefix: str, overall: bool, source: str) -> str:
    """Cross-validate the depths over ``source``; run 3 trains on all rows.

    Gives ``<prefix>_levels``, ``<prefix>_scores(depth, rmse)`` and ``<prefix>_best(depth)``.
    The rows to predict of run 3 come from ``<prefix>_future``.
    """
    x2 = "0" if overall else "category_idx"
    fold = f"CAST(id + {x2} AS BIGINT) % 3"
    folds = "\n  UNION ALL\n".join(
        input_rows(source, overall, str(k), trained, f"{fold} {sign} {k}")
        for k in range(3)
        for trained, sign in (("true", "<>"), ("false", "="))
    )
    errors = "\n  UNION ALL\n".join(
        f"  SELECT {d} AS depth, run, y - prediction AS e FROM ({at_depth(prefix, d, 'run < 3')})"
        for d in DEPTHS
    )
    return f"""
{prefix}_input AS MATERIALIZED (
{folds}
  UNION ALL
{input_rows(source, overall, '3', 'true', 'true')}
  UNION ALL
{input_rows(prefix + '_future', overall, '3', 'false', 'true')}),
{tree_ctes(prefix, max(DEPTHS))},
{prefix}_errors AS (
{errors}),
{prefix}_scores AS MATERIALIZED (
  SELECT depth, avg(rmse) AS rmse FROM (
    SELECT depth, run, sqrt(avg(e * e)) AS rmse FROM {prefix}_errors GROUP BY depth, run)
  GROUP BY depth),
{prefix}_best AS (SELECT depth FROM {prefix}_scores ORDER BY rmse, depth LIMIT 1),
{prefix}_predicted AS MATERIALIZED (
  SELECT * FROM {prefix}_levels WHERE run = 3 AND NOT trained
    AND level <= (SELECT depth FROM {prefix}_best)
  QUALIFY row_number() OVER (PARTITION BY month, category ORDER BY level DESC) = 1)"""


def tuned_holdout_sql(series: str, train: str, test: str) -> str:
    return f"""WITH {series},
h_training AS (SELECT * FROM series WHERE {train}),
h_future AS (SELECT * FROM series WHERE {test}),
{choice_ctes('h', True, 'h_training')}
SELECT month, CAST(x1 AS INTEGER) AS id, CAST(y AS BIGINT) AS n,
       round(prediction, 6) AS prediction FROM h_predicted"""


def future_cte(name: str, overall: bool, step: int) -> str:
    """The month of one step for each category; its n is not known."""
    category = "" if overall else "category, category_idx, "
    starts = "" if overall else ", (SELECT DISTINCT category, category_idx FROM series)"
    return f"""
{name} AS (
  SELECT {category}CAST(last_id + {step} AS DOUBLE) AS id, NULL::DOUBLE AS n,
         CAST(last_month + to_months({step}) AS DATE) AS month
  FROM (SELECT max(month) AS last_month, max(id) AS last_id FROM series){starts})"""


def depth_choice_sql(series: str) -> str:
    return f"""WITH {series},{future_cte('c_future', False, 1)},
{choice_ctes('c', False, 'series')}
SELECT CAST(depth AS INTEGER) AS max_depth, round(rmse, 6) AS rmse,
       depth = (SELECT depth FROM c_best) AS chosen FROM c_scores"""


def recursive_forecast_sql(series: str, by: str | None, horizon: int) -> str:
    """Step k trains on the history and on what step k - 1 predicted."""
    overall = by is None
    ctes = [series]
    for step in range(1, horizon + 1):
        prefix = f"s{step}"
        ctes.append(future_cte(f"{prefix}_future", overall, step))
        if step == 1:
            source = "series"
        else:
            source = f"{prefix}_training"
            category = "" if overall else "category, "
            index = ("", "") if overall else ("category_idx, ", "x2, ")
            ctes.append(f"""
{source} AS MATERIALIZED (
  SELECT month, {category}{index[0]}CAST(id AS DOUBLE) AS id, CAST(n AS DOUBLE) AS n FROM series
  UNION ALL
  SELECT month, {category}{index[1]}x1, prediction FROM s{step - 1}_predicted)""")
        ctes.append(choice_ctes(prefix, overall, source))
    category = "" if overall else f"category AS {by}, "
    parts = "\nUNION ALL\n".join(
        f'SELECT month AS "Date", {category}round(prediction, 0) AS prediction FROM s{k}_predicted'
        for k in range(1, horizon + 1)
    )
    return f"WITH {','.join(ctes)}\n{parts}"


def recursive_tree_sql(series: str, by: str, depth: int, horizon: int) -> str:
    """As ``recursive_forecast_sql``, with trees of one depth."""
    ctes = [series]
    for step in range(1, horizon + 1):
        prefix, source = f"s{step}", "series" if step == 1 else f"s{step}_training"
        ctes.append(future_cte(f"{prefix}_future", False, step))
        if step > 1:
            ctes.append(f"""
{source} AS MATERIALIZED (
  SELECT month, category, category_idx, CAST(id AS DOUBLE) AS id, CAST(n AS DOUBLE) AS n FROM series
  UNION ALL
  SELECT month, category, x2, x1, prediction FROM s{step - 1}_predicted)""")
        ctes.append(f"""
{prefix}_input AS MATERIALIZED (
{input_rows(source, False, '0', 'true', 'true')}
  UNION ALL
{input_rows(prefix + '_future', False, '0', 'false', 'true')}),
{tree_ctes(prefix, depth)},
{prefix}_predicted AS MATERIALIZED ({at_depth(prefix, depth)})""")
    parts = "\nUNION ALL\n".join(
        f'SELECT month AS "Date", category AS {by}, round(prediction, 0) AS prediction FROM s{k}_predicted'
        for k in range(1, horizon + 1)
    )
    return f"WITH {','.join(ctes)}\n{parts}"


def ols_recursive_sql(series: str, horizon: int) -> str:
    """Step k fits a line to the history and to what step k - 1 predicted."""
    steps = []
    for k in range(1, horizon + 1):
        fed = "" if k == 1 else f" UNION ALL SELECT id, p FROM p{k - 1}"
        steps.append(f"""
p{k} AS MATERIALIZED (
  SELECT last_month + to_months({k}) AS month, last_id + {k} AS id,
         (SELECT regr_intercept(n, id) + regr_slope(n, id) * (last_id + {k})
          FROM (SELECT CAST(id AS DOUBLE) AS id, CAST(n AS DOUBLE) AS n FROM series{fed})) AS p
  FROM (SELECT max(month) AS last_month, max(id) AS last_id FROM series))""")
    parts = "\nUNION ALL\n".join(
        f'SELECT CAST(month AS DATE) AS "Date", round(p, 0) AS prediction FROM p{k}'
        for k in range(1, horizon + 1)
    )
    return f"WITH {series},{','.join(steps)}\n{parts}"


def forest_ctes(overall: bool, trees: int, depth: int, train: str, test: str) -> str:
    """``fitted``: the test rows with the mean over trees on rows weighted by hash.

    A weight is a Poisson number: how many values of the distribution function its chance
    reaches. Where there are two features, a node's hash chooses which one may split it.
    """
    of_row = chance("17", "k", "''" if overall else "category", "CAST(id AS BIGINT)")
    reached, total = [], 0.0
    for k in range(13):
        total += math.exp(-1) / math.factorial(k)
        reached.append(f"CASE WHEN u >= {total!r} THEN 1 ELSE 0 END")
    of_node = chance("17", "run", "node", "'feature'")
    month, category = ("true", "false") if overall else (f"{of_node} < 0.5", f"{of_node} >= 0.5")
    grouped = "month" if overall else "month, category"
    return f"""
drawn AS (
  SELECT *, CAST({" + ".join(reached)} AS DOUBLE) AS weight
  FROM (SELECT *, {of_row} AS u FROM series, generate_series(0, {trees - 1}) AS g(k))),
f_input AS MATERIALIZED (
{input_rows('drawn', overall, 'k', 'true', train, 'weight')}
  UNION ALL
{input_rows('drawn', overall, 'k', 'false', test)}),
{tree_ctes('f', depth, month, category)},
fitted AS (
  SELECT {grouped}, x1, y, avg(prediction) AS prediction
  FROM ({at_depth('f', depth)}) GROUP BY {grouped}, x1, y)"""


def forest_sql(series: str, overall: bool, trees: int, depth: int, train: str, test: str) -> str:
    category = "" if overall else "category, "
    return f"""WITH {series},
{forest_ctes(overall, trees, depth, train, test)}
SELECT month, {category}CAST(x1 AS INTEGER) AS id, CAST(y AS BIGINT) AS n,
       round(prediction, 6) AS prediction FROM fitted"""


def forest_metrics_sql(series: str, train: str, test: str, metrics: dict[str, str]) -> str:
    values = ", ".join(f"round({sql}, 6) AS {name}" for name, sql in metrics.items())
    return f"""WITH {series},
{forest_ctes(False, 10, 3, train, test)}
SELECT {values} FROM (SELECT y AS n, prediction AS p FROM fitted)"""


def tree_queries(
    overall: str, by_category: Callable[[str], str], cuts: tuple[str, str], metrics: dict[str, str]
) -> dict[str, str]:
    test_after, train_before = cuts
    test = f"month > {test_after}"
    priority, supplier = by_category("priority"), by_category("supplier")
    first_two = "category_idx < 2"
    return {
        "tree_fit_predict": fitted_sql(overall, True, 3, f"month < {train_before}", test),
        "tuned_tree_holdout": tuned_holdout_sql(overall, f"month < {train_before}", test),
        "tree_by_returnflag": fitted_sql(by_category("returnflag"), False, 5),
        "tree_by_status": fitted_sql(by_category("status"), False, 3),
        "tree_by_supplier": fitted_sql(supplier, False, 3, f"month < {test_after}", test),
        "deep_tree_two_categories": fitted_sql(
            supplier, False, 30, first_two, f"{first_two} AND {test}"
        ),
        "whole_forest_overall": fitted_sql(overall, True, 3, f"month < {test_after}", test),
        "whole_forest_by_supplier": fitted_sql(supplier, False, 3, f"month < {test_after}", test),
        "forest_fit_predict": forest_sql(overall, True, 3, 5, f"month < {test_after}", test),
        "forest_by_supplier": forest_sql(supplier, False, 10, 3, f"month < {test_after}", test),
        "forest_metrics_by_supplier": forest_metrics_sql(
            supplier, f"month < {test_after}", test, metrics
        ),
        "wide_tree_by_supplier": fitted_sql(supplier, False, 3, f"month < {test_after}", test),
        "wide_tree_by_customer": fitted_sql(
            by_category("customer"), False, 3, f"month < {test_after}", test
        ),
        "wide_tree_recursive_by_priority": recursive_tree_sql(priority, "o_orderpriority", 4, 2),
        "tree_metrics_by_priority": metrics_sql(priority, 3, test, metrics),
        "tree_metrics_by_returnflag": metrics_sql(by_category("returnflag"), 5, test, metrics),
        "forecast_job_recursive": recursive_forecast_sql(overall, None, 3),
        "cv_depth_choice": depth_choice_sql(priority),
        "tree_forecast_six_months": recursive_forecast_sql(overall, None, 6),
        "tree_forecast_by_supplier": recursive_forecast_sql(supplier, "l_suppkey", 2),
        "ols_recursive_overall": ols_recursive_sql(overall, 3),
        "forecast_job_named_after_input": ols_recursive_sql(overall, 3),
        "forecast_job_with_quarantine": ols_recursive_sql(overall, 3).replace(
            "FROM orders", "FROM (SELECT * FROM orders WHERE o_orderkey % 50 > 2)"
        ),
        "tree_forecast_overall": recursive_forecast_sql(overall, None, 3),
        "tree_forecast_by_category": recursive_forecast_sql(priority, "o_orderpriority", 3),
    }
