"""SQL for fitted models: logistic regression solved in DuckDB, by another method than the fits it is compared with.

The curvature of the balanced, L2-regularised loss is nowhere larger than at zero weights, where every p(1-p) is 1/4. The inverse
of that matrix therefore gives steps that always go down. It is inverted once by elimination; each step is one aggregate over
the feature combinations.
"""

from __future__ import annotations

from collections.abc import Sequence


def one_hot(feature: str) -> str:
    for column in ("os", "site_category"):
        if feature.startswith(column + "_"):
            return f"CASE WHEN {column} = '{feature[len(column) + 1:]}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"
    return f"{feature}::DOUBLE"


def row_vector(features: Sequence[str]) -> str:
    """The intercept's 1 and the features of a row."""
    return "[1.0::DOUBLE, " + ", ".join(one_hot(f) for f in features) + "]"


def fitted(source: str, train: str, features: Sequence[str], steps: int = 200) -> str:
    """CTEs up to ``fit_weights(w)`` over the labelled rows of ``source``: the intercept first, then the features."""
    d = len(features) + 1
    cell = lambda i, j: f"sum(c * x[{i}] * x[{j}]) / 4" + (" + 1" if i == j and i > 1 else "")
    unit = lambda i, j: "1.0::DOUBLE" if i == j else "0.0::DOUBLE"
    rows = ", ".join("[" + ", ".join([*(cell(i, j) for j in range(1, d + 1)), *(unit(i, j) for j in range(1, d + 1))]) + "]" for i in range(1, d + 1))
    gradient = ", ".join(f"sum(e * x[{i}])" + (f" + any_value(w)[{i}]" if i > 1 else "") for i in range(1, d + 1))
    return f"""
fit_rows AS MATERIALIZED (SELECT {row_vector(features)} AS x, is_clicked AS y, count(*)::DOUBLE AS n FROM {source} WHERE {train} GROUP BY ALL),
fit_data AS MATERIALIZED (SELECT x, y, n * sum(n) OVER () / (2 * sum(n) OVER (PARTITION BY y)) AS c FROM fit_rows),
fit_inverse(k, a) AS (
  SELECT 1, [{rows}] FROM fit_data
  UNION ALL
  SELECT k + 1, list_transform(range(1, {d + 1}), lambda i: CASE WHEN i = k THEN list_transform(a[k], lambda v: v / a[k][k])
    ELSE list_transform(range(1, {2 * d + 1}), lambda j: a[i][j] - a[i][k] * a[k][j] / a[k][k]) END)
  FROM fit_inverse WHERE k <= {d}),
fit_steps AS MATERIALIZED (SELECT list_transform(a, lambda r: r[{d + 1}:]) AS p FROM fit_inverse WHERE k = {d + 1}),
fit_path(t, w) AS (
  SELECT 0, list_transform(range({d}), lambda i: 0.0::DOUBLE)
  UNION ALL
  SELECT t + 1, list_transform(range(1, {d + 1}), lambda i: w[i] - list_dot_product(p[i], g))
  FROM (SELECT t, any_value(w) AS w, [{gradient}] AS g
        FROM (SELECT t, w, x, c * (1 / (1 + exp(-list_dot_product(w, x))) - y) AS e FROM fit_path, fit_data WHERE t < {steps}) GROUP BY t), fit_steps),
fit_weights AS MATERIALIZED (SELECT w FROM fit_path WHERE t = {steps})
"""


def coefficients(features: Sequence[str], digits: int) -> str:
    names = ", ".join(f"'{f}'" for f in features)
    return f" SELECT unnest([{names}]) AS feature, round(unnest(w[2:]), {digits}) AS coefficient FROM fit_weights"


def held_out(source: str, train: str, features: Sequence[str], digits: int = 6) -> str:
    """CTEs scored(label, score) and predicted(label, prediction) over the other rows."""
    return f"""
scored AS (SELECT is_clicked AS label, round(1 / (1 + exp(-list_dot_product(w, {row_vector(features)}))), {digits}) AS score FROM {source}, fit_weights WHERE NOT ({train})),
predicted AS (SELECT label, CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS prediction FROM scored)
"""


def learner(source: str, features: Sequence[str], order: str, per_step: int, eta0: float, alpha: float) -> str:
    """CTEs up to learnt(t, w): the weights after each whole mini-batch of ``per_step`` rows of ``source`` in ``order``."""
    d = len(features) + 1
    mean = ", ".join(f"sum(e * x[{i}]) / count(*)" for i in range(1, d + 1))
    return f"""
learn_rows AS MATERIALIZED (SELECT {row_vector(features)} AS x, is_clicked AS y, (row_number() OVER (ORDER BY {order}) - 1) // {per_step} AS j FROM {source}),
learn_last AS MATERIALIZED (SELECT count(*) // {per_step} AS last FROM learn_rows),
learnt(t, w) AS (
  SELECT 0::BIGINT, list_transform(range({d}), lambda i: 0.0::DOUBLE)
  UNION ALL
  SELECT t + 1, list_transform(range(1, {d + 1}), lambda i: w[i] * CASE WHEN i = 1 THEN 1 ELSE 1 - eta * {alpha} END - eta * g[i])
  FROM (SELECT t, any_value(w) AS w, {eta0}::DOUBLE / (1 + {alpha}::DOUBLE * {eta0} * t) AS eta, [{mean}] AS g
        FROM (SELECT t, w, x, 1 / (1 + exp(-list_dot_product(w, x))) - y AS e FROM learnt JOIN learn_rows ON j = t, learn_last WHERE t < last) GROUP BY t))
"""
