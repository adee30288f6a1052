"""ARIMA by exact Gaussian likelihood (ML34): a Kalman filter over many series at once.

All arrays have the series as their first axis, so one pass over the periods filters every series of a chunk, whatever
its parameters; series of different lengths are padded, and a padded period leaves the state as it is.  The mean (or,
of differences, the drift) and the variance are those of greatest likelihood given the other parameters, so the search
runs over at most four numbers, each an unbounded stand-in for a partial autocorrelation: every trial is stationary and
invertible.

AIC is comparable over p, d and q: it is the likelihood of the second to the last value given the first, which is what
the likelihood of the differences is, too.
"""

from __future__ import annotations

import numpy as np

ORDERS = tuple((p, q) for p in range(3) for q in range(3))


def from_partial(z: np.ndarray) -> np.ndarray:
    """Coefficients of a stationary autoregression (up to two) from unbounded numbers, one row per series."""
    r = np.tanh(z)
    if z.shape[1] < 2:
        return r
    return np.stack([r[:, 0] * (1 - r[:, 1]), r[:, 1]], 1)


def prepared(y: np.ndarray, seen: np.ndarray) -> tuple:
    """What the filter reads of the rows ``y``, with the series as the last axis: a rough mean, so that large values lose no
    digits; the series without it beside a series of ones; which values are there; and their number."""
    count = seen.sum(axis=1)
    centre = np.where(seen, y, 0).sum(axis=1) / np.maximum(count, 1)
    pair = np.stack([np.where(seen, y - centre[:, None], 0).T, seen.T.astype(float)], 1)
    return centre, pair, np.ascontiguousarray(seen.T), count


def stationary(ar: np.ndarray, ma: np.ndarray) -> np.ndarray:
    """Covariances of the state with the value under the stationary law, from the autocovariances (Yule-Walker), for
    ``ar`` and ``ma`` of two and more rows (zeros beyond p and q)."""
    (a1, a2), (m1, m2) = ar[:2], ma[:2]
    psi = (1, m1 + a1, m2 + a1 * (m1 + a1) + a2)
    c0, c1 = 1 + m1 * psi[1] + m2 * psi[2], m1 + m2 * psi[1]
    g0 = ((c0 + a2 * m2) * (1 - a2) + a1 * (1 + a2) * c1) / ((1 + a2) * (1 - a2 - a1) * (1 - a2 + a1))
    g1 = (c1 + a1 * g0) / (1 - a2)
    g2 = a1 * g1 + a2 * g0 + m2
    return np.stack([g0, a1 * 0 + (a2 * g1 + m1 + m2 * psi[1]), m2 + a1 * 0])


def run_filter(data: tuple, ar: np.ndarray, ma: np.ndarray, owner: np.ndarray | None = None) -> dict:
    """The filter over what :func:`prepared` made; ``ar`` and ``ma`` have a row per coefficient.  A column is a model, of
    the series ``owner`` names (by default each of its own).

    The start is stationary and the model does not change, so the state's covariance moves by one vector's product with
    itself a step (Chandrasekhar recursions): the gain follows from vectors, and no covariance matrix is held.  All
    arrays have the models as the last axis, so every operation runs along whole rows."""
    centre, pair, seen, count = data
    periods, n = len(seen), ar.shape[1]
    if owner is not None:
        count, seen = count[owner], seen[:, owner]
    p, q = len(ar), len(ma)
    r = max(p, q + 1)
    lead, two = np.zeros((r, n)), np.zeros((2, 2, n))
    lead[:p] = ar
    two[0, :p], two[1, :q] = ar, ma

    def advance(x):
        """The next state: rows move up, and the first one is shared out."""
        out = lead * x[0] if x.ndim == 2 else lead[:, None] * x[0]
        out[:-1] += x[1:]
        return out

    start = stationary(two[0], two[1])[:r]
    f, cross = start[0], advance(start)                     # the value's variance, and the next state's covariance with it
    gain, step, scale = cross / f, cross, -1 / f            # the covariance moves by scale * step * step'
    first, log = f, np.log(f)
    state, sums, logs, steady = np.zeros((r, 2, n)), np.zeros((3, n)), np.zeros(n), r == 1 and not p
    some, every = seen.any(axis=1), seen.all(axis=1)
    for t in range(periods):
        if not some[t]:
            break
        miss = (pair[t] if owner is None else pair[t][:, owner]) - state[0]
        over = miss / f
        part = (miss[0] * over[0], miss[0] * over[1], miss[1] * over[1])
        after = advance(state)
        after += gain[:, None] * miss
        if every[t]:
            state = after
            logs += log
            for total, x in zip(sums, part):
                total += x
        else:
            here = seen[t]
            state = np.where(here, after, state)
            logs += np.where(here, log, 0)
            for total, x in zip(sums, part):
                total += np.where(here, x, 0)
        if not steady:
            head = step[0]
            moved = scale * head
            old, f, ahead = f, f + moved * head, advance(step)
            cross = cross + ahead * moved
            gain = cross / f
            scale, step = scale * (f / old), ahead - gain * head
            log = np.log(f)
            steady = t % 4 == 3 and (np.abs(scale) * (step * step).max(axis=0)).max() < 1e-15   # then only the state changes
    with np.errstate(divide="ignore", invalid="ignore"):
        mean = sums[1] / sums[2]
        variance = np.maximum(sums[0] - sums[1] * mean, 0) / count
        loglik = -0.5 * (count * (np.log(2 * np.pi * variance) + 1) + logs)
    return {"mean": mean, "variance": variance, "loglik": loglik, "state": state, "lead": lead, "first": first}


def kalman(y: np.ndarray, seen: np.ndarray, ar: np.ndarray, ma: np.ndarray) -> dict:
    """Exact likelihood of ARMA models (p, q <= 2) with a mean, one per row of ``y``; ``seen`` marks values that are there
    (always the first ones of a row).  Gives ``mean``, ``variance``, ``loglik``, ``first`` (the log density of the first
    value) and the state after the last value, from which forecasts follow."""
    data = prepared(y, seen)
    got = run_filter(data, ar.T, ma.T)
    mean, variance, state, r = got["mean"], got["variance"], got["state"], len(got["lead"])
    with np.errstate(divide="ignore", invalid="ignore"):
        density = -0.5 * (np.log(2 * np.pi * variance * got["first"]) + (data[1][0, 0] - mean) ** 2 / (variance * got["first"])) \
            if y.shape[1] else got["loglik"]
    move = np.zeros((len(y), r, r))
    move[:, :, 0] = got["lead"].T
    move[:, np.arange(r - 1), np.arange(1, r)] = 1
    return {"mean": mean + data[0], "variance": variance, "loglik": got["loglik"], "first": density, "move": move,
            "state": (state[:, 0] - mean * state[:, 1]).T}


def search(y: np.ndarray, seen: np.ndarray, orders, rounds: int = 60, least: float = 1e-3) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each order (p, q) the coefficients of greatest likelihood of every series, by a pattern search that every model
    steps through on its own: each number is moved up or down by the model's step, which is halved when nothing helps; a
    model is done when its step is below ``least``.  All orders are tried at once, as a trial costs mostly one call per
    operation, whatever the number of models: a coefficient that an order lacks stays 0."""
    n, data, (most, last) = len(y), prepared(y, seen), np.max(orders, axis=0)
    owner = np.tile(np.arange(n), len(orders))
    uses = np.repeat([[p > 0, p > 1, q > 0, q > 1] for p, q in orders], n, axis=0)

    def at(z, rows):
        return run_filter(data, from_partial(z[:, :2]).T[:most], -from_partial(z[:, 2:]).T[:last], owner[rows])["loglik"]

    z, step = np.zeros((len(owner), 4)), np.where(uses.any(axis=1), 0.5, 0)
    best = at(z, np.arange(len(owner)))
    best[~np.isfinite(best)] = -np.inf
    for _ in range(rounds):
        alive = np.flatnonzero(step >= least)
        if not len(alive):
            break
        better = np.zeros(len(owner), bool)
        for j in range(4):
            left = alive[uses[alive, j]]
            for sign in (1, -1):                                             # the other way only where this one didn't help
                if not len(left):
                    break
                trial = z[left]
                trial[:, j] = np.clip(trial[:, j] + sign * step[left], -4, 4)
                value = at(trial, left)
                hit = np.isfinite(value) & (value > best[left] + 1e-10)
                z[left[hit]], best[left[hit]] = trial[hit], value[hit]
                better[left[hit]] = True
                left = left[~hit]
        step[alive] = np.where(better[alive], step[alive], step[alive] / 2)
    ar, ma = from_partial(z[:, :2]), -from_partial(z[:, 2:])
    return [(ar[i * n:(i + 1) * n, :p], ma[i * n:(i + 1) * n, :q]) for i, (p, q) in enumerate(orders)]


def fit(y: np.ndarray, seen: np.ndarray, p: int, q: int) -> tuple[np.ndarray, np.ndarray, dict]:
    """Coefficients of greatest likelihood of one order, and the models they make."""
    (ar, ma), = search(y, seen, [(p, q)])
    return ar, ma, kalman(y, seen, ar, ma)


def forecasts(model: dict, horizon: int) -> np.ndarray:
    """The next ``horizon`` values of every series."""
    state, out = model["state"], []
    for _ in range(horizon):
        out.append(model["mean"] + state[:, 0])
        state = (model["move"] @ state[:, :, None])[:, :, 0]
    return np.stack(out, 1)


def select(series: list[np.ndarray], horizon: int) -> list[tuple | None]:
    """For each series the order of least AIC over p, q <= 2 and d <= 1: ((p, d, q), AIC, forecasts); None where no order
    has a finite likelihood (a series without variance).  A series needs three values at least."""
    lengths = np.array([len(s) for s in series])
    y = np.zeros((len(series), lengths.max(initial=0)))
    for row, s in zip(y, series):
        row[:len(s)] = s
    seen = np.arange(y.shape[1]) < lengths[:, None]
    scale = np.array([np.abs(s).max() for s in series])
    found: list[tuple | None] = [None] * len(series)
    for d in (0, 1):
        x, mask = (np.diff(y, axis=1), seen[:, 1:]) if d else (y, seen)
        for (p, q), (ar, ma) in zip(ORDERS, search(x, mask, ORDERS)):
            model = kalman(x, mask, ar, ma)
            loglik = model["loglik"] - (0 if d else model["first"])
            aic = -2 * loglik + 2 * (p + q + 2)
            ahead = forecasts(model, horizon)
            if d:
                ahead = y[np.arange(len(y)), lengths - 1][:, None] + np.cumsum(ahead, axis=1)
            sound = np.isfinite(aic) & (np.sqrt(model["variance"]) > 1e-9 * scale) & np.isfinite(ahead).all(axis=1)
            for i in np.flatnonzero(sound):
                if found[i] is None or aic[i] < found[i][1] - 1e-9:
                    found[i] = ((p, d, q), float(aic[i]), ahead[i].tolist())
    return found
