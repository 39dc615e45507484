"""Logistic models with a random intercept per group, fitted for many sub-cohorts at once.

Rows are collapsed to (group, covariate pattern) counts with the cells they belong to, and a group's patterns are laid together
once. A pass then reads them where they lie: tasks find the centre of each group's effect and integrate it for all cells, and only
sums per cell are moved, so a pass shuffles and writes nothing that grows with the groups. A group with more than ``GROUP_CHUNK``
patterns is summed by many tasks: its chunks are joined with its state (centre and spread of the effect), and their sums added up by
an aggregation. There is at most one such group for every ``GROUP_CHUNK`` patterns. All cells share each pass, so a grid of models
costs as many Spark jobs as one model.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortry.models import kernels
from cohortry.models.design import Term, complete, design_columns
from cohortry.models.logit import Z95, wald
from cohortry.session import BROADCAST_ROWS, broadcast_if_small, checkpointed, stored

# Patterns of one group that one task sums at a time.
GROUP_CHUNK = 100_000
# Flags of a row's conditions in one column.
WORD = 62
# A count and a vector of sums per cell.
SUMS = "cell int, n double, v array<double>"

INTERCEPT = "(intercept)"
SD = "sd(intercept)"
# Below this the group effect is reported as 0 (intraclass correlation under 2e-5).
MIN_LOG_SIGMA = -5.0


@dataclass(frozen=True)
class Cell:
    """One model of a grid: a name, the conditions its rows meet and its terms (None = all of the grid)."""

    name: str
    where: tuple[Column, ...] = ()
    terms: tuple[Term, ...] | None = None


@dataclass
class _Fit:
    active: np.ndarray
    beta: np.ndarray
    log_sigma: float = math.log(0.5)
    status: str = "running"
    ll: float = -math.inf
    best: tuple | None = None
    step: np.ndarray | None = None
    scale: float = 1.0
    rows: float = 0.0
    cov: np.ndarray | None = field(default=None, repr=False)


@dataclass(frozen=True)
class _Patterns:
    """``whole``: (grp, n, y, _x0, …, _f0, …), every group in one partition and sorted; ``needs``: the bits of _f0, … that the rows
    of each cell have. ``split``: (cell, grp, n, y, _x0, …) of the groups with more patterns, in chunks; None without such groups."""

    whole: DataFrame
    needs: list[list[int]]
    split: DataFrame | None


def _patterns(
    df: DataFrame, outcome: Column, group: str | None, terms: Sequence[Term], cells: Sequence[Cell]
) -> _Patterns:
    """Patterns counted before rows are copied into the cells they belong to, and laid out by group."""
    names = [f"_x{i}" for i in range(len(design_columns(terms)))]
    x = [F.coalesce(c, F.lit(0.0)).alias(n) for n, (_, c) in zip(names, design_columns(terms))]
    # Every distinct condition is evaluated once per row; cells are combinations of these flags.
    flags: dict[object, Column] = {}
    own_flags = []
    for cell in cells:
        own = tuple(cell.terms if cell.terms is not None else terms)
        flags.setdefault(own, complete(own))
        for c in cell.where:
            flags.setdefault(id(c), c)
        own_flags.append({own, *map(id, cell.where)})
    at = {key: divmod(i, WORD) for i, key in enumerate(flags)}
    words = [f"_f{k}" for k in range(-(-len(flags) // WORD))]
    needs = [[sum(1 << at[key][1] for key in own if at[key][0] == k) for k in range(len(words))] for own in own_flags]
    set_bit = {key: F.when(c, F.lit(1 << at[key][1])).otherwise(F.lit(0)).cast("long") for key, c in flags.items()}
    bits = [reduce(lambda a, b: a.bitwiseOR(b), [c for key, c in set_bit.items() if at[key][0] == k]) for k in range(len(words))]
    rows = df.select(
        (F.col(group).cast("string") if group else F.lit("")).alias("grp"),
        outcome.cast("int").alias("_y"),
        *x,
        *[b.alias(w) for b, w in zip(bits, words)],
    ).filter(F.col("grp").isNotNull() & F.col("_y").isNotNull())
    counted = stored(
        rows.groupBy("grp", *names, *words).agg(
            F.count(F.lit(1)).cast("double").alias("n"), F.sum("_y").cast("double").alias("y")
        ),
        "patterns",
    )
    sizes = counted.groupBy("grp").agg(F.count(F.lit(1)).alias("_size")).filter(F.col("_size") > GROUP_CHUNK)
    large = stored(sizes, "large-groups")
    if not large.count():
        return _Patterns(_laid(counted, names), needs, None)
    # At most one for GROUP_CHUNK patterns.
    large = F.broadcast(large)
    member = [
        F.when(reduce(lambda a, b: a & b, [F.col(w).bitwiseAND(F.lit(m)) == F.lit(m) for w, m in zip(words, need)]), F.lit(i))
        for i, need in enumerate(needs)
    ]
    chunk = F.pmod(F.hash("n", "y", *names), F.ceil(F.col("_size") / GROUP_CHUNK))
    placed = counted.join(large, "grp").select(
        F.explode(F.array_compact(F.array(*member))).alias("cell"), "grp", chunk.alias("_chunk"), "n", "y", *names
    )
    placed = placed.repartition("cell", "grp", "_chunk").sortWithinPartitions("cell", "grp")
    rest = counted.join(large, "grp", "left_anti")
    return _Patterns(_laid(rest, names), needs, checkpointed(placed.select("cell", "grp", "n", "y", *names)))


def _laid(counted: DataFrame, names: Sequence[str]) -> DataFrame:
    """A group's patterns in one partition, equal designs one after another; a checkpoint keeps partitions as they are."""
    return checkpointed(counted.repartition("grp").sortWithinPartitions("grp", *names))


def _sum_by(parts: DataFrame, keys: Sequence[str], col: str, *counts: str) -> DataFrame:
    """Element-wise sum of an array column and exact sums of counts, combined on the map side."""
    return parts.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in counts], vector_to_array(Summarizer.sum(array_to_vector(F.col(col)))).alias(col)
    )


def _solve(info: np.ndarray, score: np.ndarray) -> np.ndarray:
    """Newton direction; a ridge is added only while the information is not positive definite."""
    ridge = 0.0
    for _ in range(30):
        try:
            np.linalg.cholesky(info + ridge * np.eye(len(info)))
            return np.linalg.solve(info + ridge * np.eye(len(info)), score)
        except np.linalg.LinAlgError:
            ridge = max(ridge * 4, 1e-6 * max(1.0, float(np.abs(np.diag(info)).max())))
    raise np.linalg.LinAlgError("information is not positive definite")


def _pooled_pass(pat: _Patterns, fits: list[_Fit], cells: Sequence[int]) -> dict[int, tuple[float, np.ndarray]]:
    """Rows and sums per cell."""
    beta = np.vstack([f.beta for f in fits])
    parts = pat.whole.mapInPandas(kernels.pooled_cells(beta, pat.needs, cells), SUMS)
    if pat.split is not None:
        parts = parts.unionByName(_of_cells(pat.split, cells, fits).mapInPandas(kernels.pooled_sums(beta), SUMS))
    return {r["cell"]: (r["n"], np.array(r["v"])) for r in _sum_by(parts, ["cell"], "v", "n").collect()}


def _fit_pooled(pat: _Patterns, fits: list[_Fit], max_iter: int, tol: float) -> None:
    """Plain logistic fits of all cells."""
    p = len(fits[0].beta)
    for _ in range(max_iter):
        running = [i for i, f in enumerate(fits) if f.status == "running"]
        sums = _pooled_pass(pat, fits, running)
        moving = False
        for i in running:
            f = fits[i]
            if i not in sums:
                f.status = "no rows"
                continue
            f.rows, v = sums[i]
            ll, score, info = v[0], v[1 : 1 + p], v[1 + p :].reshape(p, p)
            a = f.active
            if np.any(np.diag(info)[a] <= 1e-10):
                f.status = "not estimable"
                continue
            if f.best is not None and ll < f.ll - 1e-8 * (1 + abs(f.ll)):
                f.step = f.step / 2
                f.beta = f.best[0] + f.step
                moving = True
                continue
            f.ll, f.best = ll, (f.beta.copy(),)
            try:
                f.cov = np.linalg.inv(info[np.ix_(a, a)])
                direction = _solve(info[np.ix_(a, a)], score[a])
            except np.linalg.LinAlgError:
                f.status = "not estimable"
                continue
            f.step = np.zeros(p)
            f.step[a] = np.clip(direction, -3, 3)
            f.beta = f.beta + f.step
            if abs(score[a] @ direction) < tol:
                f.status = "converged"
                continue
            moving = True
        if not moving:
            break
    for f in fits:
        if f.status == "running":
            f.status = "iteration limit"


def _of_cells(df: DataFrame, cells: Sequence[int], fits: Sequence[_Fit]) -> DataFrame:
    """The rows of some cells; settled ones cost nothing more."""
    return df if len(cells) == len(fits) else df.filter(F.col("cell").isin(*cells))


def _node_pass(pat: DataFrame, state: DataFrame, fits: list[_Fit], nodes: np.ndarray, weights: np.ndarray):
    """One pass over split groups: per-group results (checkpointed, the next state) and sums per cell."""
    p = len(fits[0].beta)
    beta = np.vstack([f.beta for f in fits])
    sigma = np.exp([f.log_sigma for f in fits])
    parts = pat.join(state, ["cell", "grp"]).mapInPandas(
        kernels.node_sums(beta, sigma, nodes), "cell int, grp string, a double, w double, v array<double>"
    )
    groups = checkpointed(
        _sum_by(parts, ["cell", "grp", "a", "w"], "v").mapInPandas(
            kernels.posterior(sigma, p, nodes, weights),
            "cell int, grp string, a double, w double, a_next double, w_next double, ll double, "
            "post array<double>, stats array<double>",
        )
    )
    totals, info = {}, {}
    for r in (
        groups.groupBy("cell", F.col("grp").isNull().alias("whole"))
        .agg(
            F.sum("ll").alias("ll"),
            F.count(F.lit(1)).alias("n"),
            vector_to_array(Summarizer.sum(array_to_vector(F.col("stats")))).alias("stats"),
        )
        .collect()
    ):
        if r["whole"]:
            info[r["cell"]] = np.array(r["stats"]).reshape(p, p)
        else:
            totals[r["cell"]] = (r["ll"], r["n"], np.array(r["stats"]))
    return groups.filter(F.col("grp").isNotNull()), totals, info


def _whole_pass(pat: _Patterns, fits: list[_Fit], cells: Sequence[int], nodes: np.ndarray, weights: np.ndarray):
    """One pass over the groups that lie in one partition each: sums per cell."""
    p = len(fits[0].beta)
    beta, sigma = np.vstack([f.beta for f in fits]), np.exp([f.log_sigma for f in fits])
    parts = pat.whole.mapInPandas(kernels.group_sums(beta, sigma, nodes, weights, pat.needs, cells), SUMS)
    totals, info = {}, {}
    for r in _sum_by(parts, ["cell"], "v", "n").collect():
        v = np.array(r["v"])
        totals[r["cell"]] = (v[0], int(r["n"]), v[1 : -p * p])
        info[r["cell"]] = v[-p * p :].reshape(p, p)
    return totals, info


def _added(a: tuple[dict, dict], b: tuple[dict, dict]) -> tuple[dict, dict]:
    """Totals and information of two sets of groups together."""
    totals = {c: tuple(s + t for s, t in zip(a[0][c], b[0][c])) if c in a[0] and c in b[0] else (a[0] | b[0])[c] for c in a[0] | b[0]}
    return totals, {c: a[1].get(c, 0.0) + b[1].get(c, 0.0) for c in a[1] | b[1]}


def _small(groups: DataFrame, n_groups: int) -> DataFrame:
    """The per-group frame for the join with the patterns: broadcast when its counted size allows."""
    return F.broadcast(groups) if n_groups <= BROADCAST_ROWS else groups


def _unpack(stats: np.ndarray, info: np.ndarray, p: int) -> tuple[np.ndarray, np.ndarray]:
    """Score and observed information of (β, log σ)."""
    score, curve, cov = stats[: p + 1], stats[p + 1], stats[p + 2 :].reshape(p + 1, p + 1)
    full = -cov
    full[:p, :p] += info
    full[p, p] -= curve
    return score, full


def _newton_step(f: _Fit, ll: float, score: np.ndarray, full: np.ndarray, tol: float) -> None:
    """Move one cell, or settle it. A step that lost likelihood is taken back: the old point is evaluated again,
    with better placed nodes, and left by a shorter step."""
    p = len(f.beta)
    if f.best is not None and ll < f.ll - 1e-7 * (1 + abs(f.ll)) and f.scale > 1e-3:
        (f.beta, f.log_sigma), f.best, f.scale = f.best, None, f.scale / 4
        return
    f.ll, f.best = ll, (f.beta.copy(), f.log_sigma)
    a = np.r_[f.active, f.log_sigma > MIN_LOG_SIGMA]
    try:
        direction = _solve(full[np.ix_(a, a)], score[a])
    except np.linalg.LinAlgError:
        f.status = "not estimable"
        return
    step = np.zeros(p + 1)
    step[a] = np.clip(direction, -1.5, 1.5) * f.scale
    step[p] = max(step[p], MIN_LOG_SIGMA - f.log_sigma)
    f.beta, f.log_sigma, f.scale = f.beta + step[:p], f.log_sigma + step[p], min(1.0, f.scale * 2)
    if abs(score[a] @ direction) < tol:
        f.status = "converged"


class _Split:
    """The groups that are cut into chunks, with their state between the passes."""

    def __init__(self, pat: DataFrame, fits: list[_Fit], cells: Sequence[int], nodes: np.ndarray, weights: np.ndarray):
        self.pat, self.fits, self.nodes, self.weights = _of_cells(pat, cells, fits), fits, nodes, weights
        state = self.pat.select("cell", "grp").distinct().select("cell", "grp", F.lit(0.0).alias("a"), F.lit(0.0).alias("w"))
        self.state = broadcast_if_small(checkpointed(state))
        self.sizes: dict[int, int] = {}
        self.settled: list[DataFrame] = []

    def step(self, cells: Sequence[int]) -> tuple[dict, dict]:
        pat = _of_cells(self.pat, cells, self.fits)
        groups, totals, info = _node_pass(pat, self.state, self.fits, self.nodes, self.weights)
        self.sizes |= {c: t[1] for c, t in totals.items()}
        self.state = groups.select("cell", "grp", F.col("a_next").alias("a"), F.col("w_next").alias("w"))
        return totals, info

    def settle(self, running: Sequence[int], left: Sequence[int]) -> None:
        """The state of what has settled waits for the standard errors."""
        if len(left) < len(running):
            self.settled.append(self.state.filter(~F.col("cell").isin(*left)) if left else self.state)
            self.state = self.state.filter(F.col("cell").isin(*left)) if left else self.state.limit(0)
        self.state = _small(self.state, sum(self.sizes.get(i, 0) for i in left))

    def exact(self) -> tuple[dict, dict]:
        """Totals at the estimates, and the information averaged over the nodes."""
        state = reduce(lambda a, b: a.unionByName(b), [*self.settled, self.state])
        n = sum(self.sizes.values())
        groups, totals, _ = _node_pass(self.pat, _small(state, n), self.fits, self.nodes, self.weights)
        beta, sigma = np.vstack([f.beta for f in self.fits]), np.exp([f.log_sigma for f in self.fits])
        post = _small(groups.select("cell", "grp", "a", "w", "post"), n)
        parts = self.pat.join(post, ["cell", "grp"]).mapInPandas(
            kernels.weighted_information(beta, sigma, self.nodes), "cell int, v array<double>"
        )
        p = beta.shape[1]
        return totals, {r["cell"]: np.array(r["v"]).reshape(p, p) for r in _sum_by(parts, ["cell"], "v").collect()}


def _fit_mixed(pat: _Patterns, fits: list[_Fit], q: int, max_iter: int, tol: float) -> dict[int, int]:
    p = len(fits[0].beta)
    nodes, weights = np.polynomial.hermite.hermgauss(q)
    live = [i for i, f in enumerate(fits) if f.status == "converged"]
    for i in live:
        fits[i].status, fits[i].best, fits[i].ll = "running", None, -math.inf
    if not live:
        return {}
    split = _Split(pat.split, fits, live, nodes, weights) if pat.split is not None else None
    # Split groups find their centres from pass to pass.
    running, warm = live, 2 if split else 0
    for it in range(max_iter + warm):
        if it < warm:
            split.step(running)
            continue
        totals, info = _whole_pass(pat, fits, running, nodes, weights)
        if split:
            totals, info = _added((totals, info), split.step(running))
        for i in running:
            _newton_step(fits[i], totals[i][0], *_unpack(totals[i][2], info[i], p), tol)
        left = [i for i in running if fits[i].status == "running"]
        if split:
            split.settle(running, left)
        running = left
        if not running:
            break
    for i in live:
        f = fits[i]
        if f.status == "running":
            f.status = "iteration limit"
            if f.best is not None:
                f.beta, f.log_sigma = f.best

    # Standard errors from the exact information of the quadrature sum at the estimates.
    totals, exact = _whole_pass(pat, fits, live, nodes, weights)
    if split:
        totals, exact = _added((totals, exact), split.exact())
    for i in live:
        f = fits[i]
        f.ll = totals[i][0]
        _, full = _unpack(totals[i][2], exact[i], p)
        a = np.r_[f.active, f.log_sigma > MIN_LOG_SIGMA]
        try:
            f.cov = np.linalg.inv(full[np.ix_(a, a)])
        except np.linalg.LinAlgError:
            f.cov = None
    return {i: totals[i][1] for i in live}


def fit_grid(
    df: DataFrame,
    outcome: Column,
    terms: Sequence[Term],
    cells: Sequence[Cell],
    group: str | None = None,
    points: int = 7,
    max_iter: int = 50,
    tol: float = 1e-7,
) -> DataFrame:
    """Fit every cell; (cell, term, estimate, std_error, z, p_value, conf_low, conf_high, odds_ratio, n, n_groups,
    log_lik, icc, status). A cell that cannot be estimated keeps a row saying so."""
    columns = design_columns(terms)
    names = [INTERCEPT, *[n for n, _ in columns]]
    pat = _patterns(df, outcome, group, terms, cells)
    fits = []
    for cell in cells:
        own = {n for n, _ in design_columns(cell.terms if cell.terms is not None else terms)}
        active = np.array([True, *[n in own for n, _ in columns]])
        fits.append(_Fit(active=active, beta=np.zeros(len(names))))
    # Without a group these are the final fits; with one they only start the mixed ones.
    _fit_pooled(pat, fits, max_iter, tol if group else 1e-12)
    sizes = _fit_mixed(pat, fits, points, max_iter, tol) if group else {}

    rows = []
    for i, (cell, f) in enumerate(zip(cells, fits)):
        done = f.status in ("converged", "iteration limit") and f.cov is not None
        sigma2 = math.exp(2 * f.log_sigma) if group and f.log_sigma > MIN_LOG_SIGMA else 0.0
        icc = sigma2 / (sigma2 + math.pi**2 / 3) if group and done else None
        ses = np.sqrt(np.clip(np.diag(f.cov), 0, None)) if done else None
        common = (f.rows, sizes.get(i), float(f.ll) if done else None, icc, f.status)
        if not done:
            rows.append((cell.name, None, None, None, *common))
            continue
        for k, j in enumerate(np.flatnonzero(f.active)):
            rows.append((cell.name, names[j], float(f.beta[j]), float(ses[k]), *common))
        if group:
            sd = math.exp(f.log_sigma)
            se = sd * float(ses[-1]) if f.log_sigma > MIN_LOG_SIGMA else None
            rows.append((cell.name, SD, sd if sigma2 else 0.0, se, *common))
    schema = (
        "cell string, term string, estimate double, std_error double, n double, n_groups long, log_lik double, "
        "icc double, status string"
    )
    out = wald(df.sparkSession.createDataFrame(rows, schema))
    fixed = F.col("term") != SD
    # A standard deviation has no test against 0 here; its interval is symmetric on the log scale.
    spread = F.exp(F.try_divide(F.lit(Z95) * F.col("std_error"), F.col("estimate")))
    return out.withColumns(
        {
            "z": F.when(fixed, F.col("z")),
            "p_value": F.when(fixed, F.col("p_value")),
            "conf_low": F.when(fixed, F.col("conf_low")).otherwise(F.col("estimate") / spread),
            "conf_high": F.when(fixed, F.col("conf_high")).otherwise(F.col("estimate") * spread),
            "odds_ratio": F.when(fixed, F.exp("estimate")),
        }
    )


def mixed_logit(df: DataFrame, outcome: Column, terms: Sequence[Term], group: str, **options) -> DataFrame:
    """One random-intercept model; a model that cannot be estimated is an error, never a silently smaller one."""
    out = fit_grid(df, outcome, terms, [Cell("model")], group, **options)
    status = out.select("status").first()[0]
    if status not in ("converged", "iteration limit"):
        raise ValueError(f"model is {status}: look at sparse_levels for empty cells")
    return out.drop("cell")


def icc(df: DataFrame, outcome: Column, group: str, cells: Sequence[Cell] = (Cell("all"),), **options) -> DataFrame:
    """Intraclass correlation σ²/(σ²+π²/3) of the model without covariates, per cell."""
    bare = [Cell(c.name, c.where, ()) for c in cells]
    fitted = fit_grid(df, outcome, [], bare, group, **options)
    return fitted.filter((F.col("term") == SD) | F.col("term").isNull()).select(
        "cell", F.col("estimate").alias("sd"), "icc", "n", "n_groups", "status"
    )
