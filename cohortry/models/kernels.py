"""Partial sums over batches of covariate patterns (numpy inside Spark tasks).

All functions take plain arrays in a closure and stream over the batches of one partition. Groups whose patterns lie together
in one partition are summed up there, for all cells at once; one with more patterns than that is summed by many tasks.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def matrix(b: pd.DataFrame, p: int) -> np.ndarray:
    """Design rows: the intercept and the columns ``_x0``, ``_x1``, …"""
    return np.column_stack([np.ones(len(b)), *[b[f"_x{i}"].to_numpy() for i in range(p - 1)]])


def pooled_part(beta: np.ndarray, x: np.ndarray, n: np.ndarray, y: np.ndarray) -> np.ndarray:
    """[log-lik, score, information] of a plain logistic model."""
    lin = x @ beta
    prob = 1 / (1 + np.exp(-lin))
    ll = (y * lin - n * np.logaddexp(0, lin)).sum()
    info = (x * (n * prob * (1 - prob))[:, None]).T @ x
    return np.concatenate([[ll], x.T @ (y - n * prob), info.ravel()])


def summed(acc: dict[int, tuple]) -> pd.DataFrame:
    """Cells with a count and a vector each; counts are kept apart so that their sum is exact."""
    return pd.DataFrame({"cell": list(acc), "n": [n for n, _ in acc.values()], "v": [v.tolist() for _, v in acc.values()]})


def add(acc: dict[int, tuple], cell: int, n: float, v: np.ndarray) -> None:
    held = acc.get(cell, (0.0, 0.0))
    acc[cell] = (held[0] + n, held[1] + v)


def pooled_sums(beta: np.ndarray):
    """Rows and ``pooled_part`` per cell, of rows that are copied into their cells."""
    p = beta.shape[1]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        acc: dict[int, tuple] = {}
        for b in batches:
            if not len(b):
                continue
            cell = b["cell"].to_numpy()
            x, n, y = matrix(b, p), b["n"].to_numpy(), b["y"].to_numpy()
            for c in np.unique(cell):
                m = cell == c
                add(acc, int(c), n[m].sum(), pooled_part(beta[c], x[m], n[m], y[m]))
        if acc:
            yield summed(acc)

    return run


def in_cells(b: pd.DataFrame, p: int, needs: Sequence[Sequence[int]], cells: Sequence[int]) -> Iterator[tuple]:
    """(cell, group numbers, design rows, n, y) of the cells that hold rows of the batch; rows of a group with the same
    design, which come one after another, are added up. ``needs``: bits of ``_f0``, ``_f1``, … that a cell's rows have."""
    x, n, y, grp = matrix(b, p), b["n"].to_numpy(), b["y"].to_numpy(), b["grp"].to_numpy()
    group = np.cumsum(np.r_[False, grp[1:] != grp[:-1]])
    design = np.cumsum(np.r_[False, (grp[1:] != grp[:-1]) | (x[1:] != x[:-1]).any(axis=1)])
    words = [b[f"_f{k}"].to_numpy() for k in range(len(needs[0]))]
    for c in cells:
        held = np.flatnonzero(np.all([(w & bits) == bits for w, bits in zip(words, needs[c])], axis=0))
        if not len(held):
            continue
        start = changes(design[held])
        first = held[start]
        yield c, group[first], x[first], np.add.reduceat(n[held], start), np.add.reduceat(y[held], start)


def changes(key: np.ndarray) -> np.ndarray:
    """Where a run of equal keys starts."""
    return np.flatnonzero(np.r_[True, key[1:] != key[:-1]])


def pooled_cells(beta: np.ndarray, needs: Sequence[Sequence[int]], cells: Sequence[int]):
    """Rows and ``pooled_part`` per cell, of rows with the flags of their cells."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        acc: dict[int, tuple] = {}
        for b in batches:
            for c, _, x, n, y in in_cells(b, beta.shape[1], needs, cells) if len(b) else ():
                add(acc, c, n.sum(), pooled_part(beta[c], x, n, y))
        if acc:
            yield summed(acc)

    return run


def whole_groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batches sorted by group, cut anew so that none ends inside a group."""
    held: list[pd.DataFrame] = []
    for b in batches:
        if not len(b):
            continue
        grp = b["grp"].to_numpy()
        last = int(np.count_nonzero(grp != grp[-1]))
        if last or (held and grp[0] != held[0]["grp"].iat[0]):
            yield pd.concat([*held, b[:last]], ignore_index=True)
            held = [b[last:]]
        else:
            held.append(b)
    if held:
        yield pd.concat(held, ignore_index=True)


def modes(lin: np.ndarray, n: np.ndarray, y: np.ndarray, start: np.ndarray, of: np.ndarray, sigma: float) -> tuple[np.ndarray, np.ndarray]:
    """Where each group's effect is likeliest, and the curvature of its data there: Newton steps, halved intervals where
    these lead out. Like ``centres`` it stays within six standard deviations."""
    u = np.zeros(len(start))
    low, high = np.full(len(start), -6 * sigma), np.full(len(start), 6 * sigma)
    for _ in range(60):
        prob = 1 / (1 + np.exp(-(lin + u[of])))
        slope = np.add.reduceat(y - n * prob, start) - u / sigma**2
        w = np.add.reduceat(n * prob * (1 - prob), start)
        low, high = np.where(slope > 0, u, low), np.where(slope < 0, u, high)
        moved = u + slope / (w + 1 / sigma**2)
        moved = np.where((moved < low) | (moved > high), (low + high) / 2, moved)
        far = np.abs(moved - u).max()
        u = moved
        if far < 1e-10 * sigma:
            break
    return u, w


def group_sums(beta: np.ndarray, sigma: np.ndarray, nodes: np.ndarray, weights: np.ndarray, needs: Sequence[Sequence[int]], cells: Sequence[int]):
    """Per cell, over groups that lie whole in a partition: their number and [log-lik, the vector of ``group_posterior``,
    fixed-effect information averaged over the node probabilities]. Nothing of a single group leaves the task."""
    p = beta.shape[1]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        acc: dict[int, tuple] = {}
        for b in whole_groups(batches):
            for c, group, x, n, y in in_cells(b, p, needs, cells):
                start = changes(group)
                of = np.repeat(np.arange(len(start)), np.diff(np.r_[start, len(group)]))
                s = np.full(len(start), sigma[c])
                lin = x @ beta[c]
                mu, w = modes(lin, n, y, start, of, sigma[c])
                tau = 1 / np.sqrt(w + 1 / s**2)
                lin, prob, ll, score = at_nodes(lin, x, n, y, mu[of], tau[of], nodes)
                node_ll, score = np.add.reduceat(ll, start, axis=0), np.add.reduceat(score, start, axis=0)
                ll, post, stats = group_posterior(node_ll, score.reshape(len(start), len(nodes), p), mu, tau, s, nodes, weights)
                curve = n * (post[of] * prob * (1 - prob)).sum(axis=1)
                info = (x * curve[:, None]).T @ x
                add(acc, c, len(start), np.concatenate([[ll.sum()], stats.sum(axis=0), info.ravel()]))
        if acc:
            yield summed(acc)

    return run


def at_nodes(lin, x, n, y, mu, tau, nodes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Linear predictor, probability, log-likelihood and score (node by node) of each row at the nodes of its group."""
    lin = lin[:, None] + mu[:, None] + np.sqrt(2) * tau[:, None] * nodes
    prob = 1 / (1 + np.exp(-lin))
    ll = y[:, None] * lin - n[:, None] * np.logaddexp(0, lin)
    resid = y[:, None] - n[:, None] * prob
    return lin, prob, ll, (resid[:, :, None] * x[:, None, :]).reshape(len(n), len(nodes) * x.shape[1])


def group_posterior(node_ll, score, mu, tau, s, nodes, weights) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log-likelihood, node probabilities and the vector [score of β, score of log σ, E of the log-σ curvature, covariance of
    the scores] of each group, from its log-likelihood and score at every node."""
    u = mu[:, None] + np.sqrt(2) * tau[:, None] * nodes
    prior = -0.5 * (u / s[:, None]) ** 2 - np.log(s)[:, None] - 0.5 * np.log(2 * np.pi)
    log_a = np.log(weights) + nodes**2 + np.log(np.sqrt(2) * tau)[:, None] + node_ll + prior
    top = log_a.max(axis=1, keepdims=True)
    ll = top[:, 0] + np.log(np.exp(log_a - top).sum(axis=1))
    post = np.exp(log_a - ll[:, None])
    z2 = (u / s[:, None]) ** 2
    scores = np.concatenate([score, (z2 - 1)[:, :, None]], axis=2)
    mean = np.einsum("gq,gqk->gk", post, scores)
    cov = np.einsum("gq,gqk,gql->gkl", post, scores, scores) - mean[:, :, None] * mean[:, None, :]
    return ll, post, np.hstack([mean, (-2 * (post * z2).sum(axis=1))[:, None], cov.reshape(len(mu), -1)])


def centres(a: np.ndarray, w: np.ndarray, sigma: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centre and spread of each group effect: the quadratic data term (pull a, curvature w) times the prior."""
    precision = w + 1 / sigma**2
    return np.clip(a / precision, -6 * sigma, 6 * sigma), 1 / np.sqrt(precision)


def node_sums(beta: np.ndarray, sigma: np.ndarray, nodes: np.ndarray):
    """Per (cell, group): log-likelihood and score at every quadrature node of the group, and the curvature at
    its centre; and per cell (group NULL) the fixed-effect information at the centres."""
    p = beta.shape[1]
    centre = int(np.argmin(np.abs(nodes)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        acc: dict[int, np.ndarray] = {}
        for b in batches:
            if not len(b):
                continue
            cell, grp = b["cell"].to_numpy(), b["grp"].to_numpy()
            a, w = b["a"].to_numpy(), b["w"].to_numpy()
            x, n, y = matrix(b, p), b["n"].to_numpy(), b["y"].to_numpy()
            mu, tau = centres(a, w, sigma[cell])
            _, prob, ll, score = at_nodes(np.einsum("ij,ij->i", x, beta[cell]), x, n, y, mu, tau, nodes)
            curve = n * prob[:, centre] * (1 - prob[:, centre])
            rows = np.hstack([ll, curve[:, None], score])
            # Rows come sorted by cell and group; a group met twice just gives two partial sums.
            start = np.flatnonzero(np.r_[True, (cell[1:] != cell[:-1]) | (grp[1:] != grp[:-1])])
            sums = np.add.reduceat(rows, start, axis=0)
            for c in np.unique(cell):
                m = cell == c
                acc[int(c)] = acc.get(int(c), np.zeros((p, p))) + (x[m] * curve[m, None]).T @ x[m]
            yield pd.DataFrame({"cell": cell[start], "grp": grp[start], "a": a[start], "w": w[start], "v": sums.tolist()})
        if not acc:
            return
        none = [None] * len(acc)
        zero = [0.0] * len(acc)
        yield pd.DataFrame(
            {"cell": list(acc), "grp": none, "a": zero, "w": zero, "v": [m.ravel().tolist() for m in acc.values()]}
        )

    return run


def posterior(sigma: np.ndarray, p: int, nodes: np.ndarray, weights: np.ndarray):
    """Per (cell, group) from its node sums: the results of ``group_posterior``, next pull and curvature. The information rows
    (group NULL) pass through."""
    q = len(nodes)
    centre = int(np.argmin(np.abs(nodes)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            whole = b["grp"].isna()
            if whole.any():
                info = b[whole]
                yield info.assign(a_next=0.0, w_next=0.0, ll=0.0, post=[[]] * len(info), stats=info["v"]).drop(columns="v")
            b = b[~whole]
            if not len(b):
                continue
            v = np.vstack(b["v"].to_numpy())
            s = sigma[b["cell"].to_numpy()]
            mu, tau = centres(b["a"].to_numpy(), b["w"].to_numpy(), s)
            score_b = v[:, q + 1 :].reshape(len(b), q, p)
            ll, post, stats = group_posterior(v[:, :q], score_b, mu, tau, s, nodes, weights)
            yield b.drop(columns="v").assign(
                a_next=v[:, q] * mu + score_b[:, centre, 0],
                w_next=v[:, q],
                ll=ll,
                post=post.tolist(),
                stats=stats.tolist(),
            )

    return run


def weighted_information(beta: np.ndarray, sigma: np.ndarray, nodes: np.ndarray):
    """Per cell: fixed-effect information averaged over the node probabilities of each group."""
    p = beta.shape[1]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        acc: dict[int, np.ndarray] = {}
        for b in batches:
            if not len(b):
                continue
            cell = b["cell"].to_numpy()
            x, n, post = matrix(b, p), b["n"].to_numpy(), np.vstack(b["post"].to_numpy())
            mu, tau = centres(b["a"].to_numpy(), b["w"].to_numpy(), sigma[cell])
            lin = np.einsum("ij,ij->i", x, beta[cell])[:, None] + mu[:, None] + np.sqrt(2) * tau[:, None] * nodes
            prob = 1 / (1 + np.exp(-lin))
            w = n * (post * prob * (1 - prob)).sum(axis=1)
            for c in np.unique(cell):
                m = cell == c
                acc[int(c)] = acc.get(int(c), np.zeros((p, p))) + (x[m] * w[m, None]).T @ x[m]
        if acc:
            yield pd.DataFrame({"cell": list(acc), "v": [a.ravel().tolist() for a in acc.values()]})

    return run
