"""SQL for random-intercept logistic models: the marginal likelihood by fixed nodes, climbed in a recursive query.

It shares nothing with the operator: nodes lie at fixed places of the standardised group effect (the operator moves a few nodes per group),
the spread itself is the parameter (the operator's is its logarithm), and the first steps are expected-information steps
from zero (the operator starts at the plain fits).
"""

from __future__ import annotations

#: Places of the group effect in its standard deviations: so far out, and so far apart.
REACH, WIDTH = 6.0, 0.25
#: Steps by the expected information of the rows, which always climb; then by the observed one, which converges at once.
CLIMBING, CLOSING = 25, 9
#: The least spread; a likelihood that falls from there on has none.
LEAST = "exp(-5.0::DOUBLE)"


def _upper(q: int):
    return [(j, k) for j in range(q) for k in range(j, q)]


def _matrix(name, q: int) -> str:
    """[H | identity | gradient] as a list of rows; a column that is empty everywhere gets a one, and a spread that stays at
    its least value leaves the system."""
    rows, last = [], q - 1
    for j in range(q):
        cells = [name(min(j, k), max(j, k)) for k in range(q)]
        cells[j] = f"CASE WHEN {cells[j]} = 0 THEN 1.0 ELSE {cells[j]} END"
        cells = [f"CASE WHEN fixed THEN {'1.0' if j == k else '0.0'} ELSE {c} END" if last in (j, k) else c for k, c in enumerate(cells)]
        gradient = "CASE WHEN fixed THEN 0.0 ELSE g%d END" % j if j == last else f"g{j}"
        rows.append("[" + ", ".join([*cells, *["1.0" if j == k else "0.0" for k in range(q)], gradient]) + "]")
    return "[" + ", ".join(rows) + "]"


def marginal_sql(p: int, width: float = WIDTH, climbing: int = CLIMBING) -> str:
    """CTEs from ``pat`` (cell, grp, n, y, x0 = 1, x1, …, one row per pattern) to ``fit``: cell, th (coefficients, then the spread), cov, ll,
    n, n_groups."""
    q, side, last = p + 1, round(REACH / width), climbing + CLOSING
    s = [f"s{j}" for j in range(p)] + ["z * s0"]
    info = {(j, k): f"i{j}_{k}" for j, k in _upper(p)} | {(j, p): f"z * i0_{j}" for j in range(p)} | {(p, p): "z * z * i0_0"}
    lin = " + ".join(f"x{j} * th[{j + 1}]" for j in range(p)) + f" + z * th[{q}]"
    scores = ", ".join(f"sum((y - n * mu) * x{j}) AS s{j}" for j in range(p))
    infos = ", ".join(f"sum(n * mu * (1 - mu) * x{j} * x{k}) AS i{j}_{k}" for j, k in _upper(p))
    per_group = ", ".join(
        [f"sum(w * ({s[j]})) AS g{j}" for j in range(q)]
        + [f"sum(w * ({info[j, k]})) AS e{j}_{k}" for j, k in _upper(q)]
        + [f"sum(w * ({info[j, k]} - ({s[j]}) * ({s[k]}))) AS o{j}_{k}" for j, k in _upper(q)]
    )
    per_cell = ", ".join(
        [f"sum(g{j}) AS g{j}" for j in range(q)]
        + [f"sum(e{j}_{k}) AS e{j}_{k}" for j, k in _upper(q)]
        + [f"sum(o{j}_{k} + g{j} * g{k}) AS o{j}_{k}" for j, k in _upper(q)]
    )
    expected, observed = _matrix(lambda j, k: f"e{j}_{k}", q), _matrix(lambda j, k: f"o{j}_{k}", q)
    solved = f"SELECT t, cell, th, ll, n, n_groups, CASE WHEN t < {climbing} THEN {expected} ELSE {observed} END AS m FROM (SELECT *, th[{q}] <= {LEAST} AND g{p} < 0 AS fixed FROM c)"
    for k in range(1, q + 1):
        # Gauss-Jordan: row k is divided by its pivot and taken off all others.
        row = f"CASE WHEN i = {k} THEN list_transform(r, lambda v: v / m[{k}][{k}]) ELSE list_transform(r, lambda v, j: v - r[{k}] * m[{k}][j] / m[{k}][{k}]) END"
        solved = f"SELECT * EXCLUDE (m), list_transform(m, lambda r, i: {row}) AS m FROM ({solved})"
    start = "[" + ", ".join(["0.0::DOUBLE"] * p + ["0.5"]) + "]"
    return f"""WITH RECURSIVE k AS (SELECT {width} * (range - {side}) AS z FROM range({2 * side + 1})),
step AS (SELECT 0 AS t, cell, {start} AS th, CAST(NULL AS DOUBLE[][]) AS cov, 0.0::DOUBLE AS ll, 0.0::DOUBLE AS n, 0::BIGINT AS n_groups
  FROM (SELECT DISTINCT cell FROM pat)
UNION ALL (WITH e AS (SELECT t, step.cell, grp, th, z, pat.* EXCLUDE (cell, grp), {lin} AS lin FROM step JOIN pat ON step.cell = pat.cell, k
    WHERE t < {last}),
  u AS (SELECT *, 1 / (1 + exp(-lin)) AS mu, y * lin - n * (greatest(lin, 0) + ln(1 + exp(-abs(lin)))) AS l FROM e),
  d AS (SELECT t, cell, grp, z, any_value(th) AS th, sum(l) - z * z / 2 AS a, sum(n) AS n, {scores}, {infos} FROM u GROUP BY t, cell, grp, z),
  top AS (SELECT cell, grp, max(a) AS most FROM d GROUP BY cell, grp),
  tot AS (SELECT d.cell, d.grp, any_value(most) + ln(sum(exp(a - most))) AS whole FROM d JOIN top ON d.cell = top.cell AND d.grp = top.grp GROUP BY d.cell, d.grp),
  v AS (SELECT d.*, exp(a - whole) AS w, whole FROM d JOIN tot ON d.cell = tot.cell AND d.grp = tot.grp),
  g AS (SELECT t, cell, grp, any_value(th) AS th, any_value(whole) + ln({width} / sqrt(2 * pi())) AS ll, any_value(n) AS n, {per_group} FROM v GROUP BY t, cell, grp),
  c AS (SELECT t, cell, any_value(th) AS th, sum(ll) AS ll, sum(n) AS n, count(*) AS n_groups, {per_cell} FROM g GROUP BY t, cell),
  x AS ({solved})
  SELECT t + 1, cell, list_transform(th, lambda b, i: CASE WHEN i = {q} THEN greatest(abs(b + m[i][{2 * q + 1}]), {LEAST}) ELSE b + m[i][{2 * q + 1}] END), list_transform(m, lambda r: r[{q + 1}:{2 * q}]), ll, n, n_groups FROM x)),
fit AS (SELECT * EXCLUDE (t) FROM step WHERE t = {last})"""


def terms_sql(names: dict[str, int], p: int, two_sided) -> str:
    """``out``: a row per cell and term, as the operator prints them; ``names`` maps a term to its place among the coefficients."""
    q = p + 1
    listed = ", ".join(f"('{n}', {i + 1})" for n, i in names.items())
    return f"""flat AS (SELECT *, th[{q}] <= {LEAST} AS none, pow(th[{q}], 2) / (pow(th[{q}], 2) + pi() * pi() / 3) AS icc0 FROM fit),
one AS (SELECT cell, name AS term, th[place] AS b, n, n_groups, ll, CASE WHEN none THEN 0.0 ELSE icc0 END AS icc, sqrt(cov[place][place]) AS se
  FROM flat, (VALUES {listed}) AS v(name, place)),
out AS (SELECT cell, term, b AS estimate, se AS std_error, n, n_groups, ll AS log_lik, icc, 'converged' AS status, b / se AS z, b - 1.959963984540054 * se AS conf_low,
    b + 1.959963984540054 * se AS conf_high, {two_sided('b / se * b / se', '1')} AS p_value, exp(b) AS odds_ratio FROM one
UNION ALL SELECT cell, 'sd(intercept)', CASE WHEN none THEN 0.0 ELSE th[{q}] END, CASE WHEN NOT none THEN sqrt(cov[{q}][{q}]) END, n, n_groups, ll,
    CASE WHEN none THEN 0.0 ELSE icc0 END, 'converged', NULL,
    CASE WHEN NOT none THEN th[{q}] / exp(1.959963984540054 * sqrt(cov[{q}][{q}]) / th[{q}]) END,
    CASE WHEN NOT none THEN th[{q}] * exp(1.959963984540054 * sqrt(cov[{q}][{q}]) / th[{q}]) END, NULL, NULL FROM flat)"""
