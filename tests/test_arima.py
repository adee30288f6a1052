"""ARIMA by exact likelihood: closed forms, a dense covariance, recovery of known models."""

import numpy as np
import pytest

from pennant.models import arima as AR
from pennant.models import forecast as FC


def simulated(n, ar=(), ma=(), d=0, seed=0, mean=0.0):
    rng = np.random.default_rng(seed)
    e = rng.normal(size=n + 200)
    y = np.zeros(n + 200)
    for t in range(2, n + 200):
        y[t] = e[t] + sum(a * y[t - i - 1] for i, a in enumerate(ar)) + sum(m * e[t - i - 1] for i, m in enumerate(ma))
    y = y[200:] + mean
    return np.cumsum(y) if d else y


def run(y, ar, ma):
    return {k: v[0] for k, v in AR.kalman(y[None, :], np.ones((1, len(y)), bool), np.array([ar]).reshape(1, -1), np.array([ma]).reshape(1, -1)).items()}


def test_likelihood_of_an_ar1_is_the_closed_form():
    y, phi = simulated(60, (0.6,), seed=1, mean=5), 0.45
    got = run(y, [phi], [])
    n, mu, s2 = len(y), got["mean"], got["variance"]
    ss = (1 - phi ** 2) * (y[0] - mu) ** 2 + np.sum((y[1:] - mu - phi * (y[:-1] - mu)) ** 2)
    assert s2 == pytest.approx(ss / n)
    assert got["loglik"] == pytest.approx(-n / 2 * np.log(2 * np.pi * s2) + 0.5 * np.log(1 - phi ** 2) - ss / (2 * s2))
    assert got["first"] == pytest.approx(-0.5 * (np.log(2 * np.pi * s2 / (1 - phi ** 2)) + (y[0] - mu) ** 2 * (1 - phi ** 2) / s2))
    ahead = AR.forecasts({k: np.array([v]) if np.ndim(v) < 2 else v[None] for k, v in got.items()}, 3)[0]
    assert ahead == pytest.approx([mu + phi ** h * (y[-1] - mu) for h in (1, 2, 3)])


def test_likelihood_is_that_of_the_whole_covariance():
    y, ar, ma = simulated(25, (0.5, -0.3), (0.4, 0.2), seed=2), [0.5, -0.3], [0.4, 0.2]
    weights = [1.0, ma[0] + ar[0]]
    weights.append(ma[1] + ar[0] * weights[1] + ar[1])
    for _ in range(400):
        weights.append(ar[0] * weights[-1] + ar[1] * weights[-2])
    w = np.array(weights)
    cov = np.array([[np.sum(w[:len(w) - abs(i - j)] * w[abs(i - j):]) for j in range(25)] for i in range(25)])
    inv, one = np.linalg.inv(cov), np.ones(25)
    mu = one @ inv @ y / (one @ inv @ one)
    s2 = (y - mu) @ inv @ (y - mu) / 25
    got = run(y, ar, ma)
    assert (got["mean"], got["variance"]) == pytest.approx((mu, s2))
    assert got["loglik"] == pytest.approx(-0.5 * (25 * (np.log(2 * np.pi * s2) + 1) + np.linalg.slogdet(cov)[1]))


def test_padded_series_have_the_likelihood_of_their_own_values():
    y = simulated(40, (0.7,), (0.3,), seed=3)
    both = np.zeros((2, 40))
    both[0], both[1, :23] = y, y[:23]
    seen = np.arange(40) < np.array([[40], [23]])
    got = AR.kalman(both, seen, np.full((2, 1), 0.5), np.full((2, 1), 0.2))
    for i, n in enumerate((40, 23)):
        alone = run(y[:n], [0.5], [0.2])
        assert got["loglik"][i] == pytest.approx(alone["loglik"]) and got["state"][i] == pytest.approx(alone["state"])


def test_known_models_are_recovered():
    y = np.stack([simulated(400, (0.7,), seed=s, mean=3) for s in range(3)])
    ar, _, model = AR.fit(y, np.ones(y.shape, bool), 1, 0)
    assert ar[:, 0] == pytest.approx([0.7] * 3, abs=0.12) and model["mean"] == pytest.approx([3] * 3, abs=0.8)
    x = np.stack([np.diff(simulated(400, (), (-0.6,), d=1, seed=s)) for s in range(3)])
    _, ma, _ = AR.fit(x, np.ones(x.shape, bool), 0, 1)
    assert ma[:, 0] == pytest.approx([-0.6] * 3, abs=0.12)


def test_the_order_of_differences_is_found_by_aic():
    stationary = [simulated(300, (0.5,), seed=s) for s in range(2)]
    walks = [simulated(300, (), (-0.5,), d=1, seed=s, mean=0.1) for s in range(2)]
    got = AR.select(stationary + walks, 2)
    assert [g[0][1] for g in got] == [0] * 2 + [1] * 2


def test_greatest_likelihood_is_not_below_a_grid():
    y = simulated(30, (0.4,), (0.5,), seed=9)[None, :]
    seen = np.ones(y.shape, bool)
    _, _, model = AR.fit(y, seen, 1, 1)
    grid = [AR.kalman(y, seen, np.array([[a]]), np.array([[m]]))["loglik"][0] for a in np.linspace(-0.95, 0.95, 39) for m in np.linspace(-0.95, 0.95, 39)]
    assert model["loglik"][0] >= max(grid) - 1e-3


def test_forecasts_per_entity(spark):
    rows = [("a", t, float(t)) for t in range(20)] + [("flat", t, 5.0) for t in range(20)] + [("short", t, float(t % 3)) for t in range(9)]
    rows += [("gap", t, None if t == 4 else float(t)) for t in range(15)] + [(None, t, float(t % 5)) for t in range(15)]
    rows += [("noise", t, float(v)) for t, v in enumerate(np.random.default_rng(1).normal(10, 1, 28))]
    got = FC.arima_forecasts(spark.createDataFrame(rows, "team_name string, year int, wins double"), "wins", 3).collect()
    by = {}
    for r in got:
        by.setdefault(r.team_name, []).append((r.forecast_period, r.h, r.forecast, r.order, r.aic))
    assert "noise" in by and not {"flat", "short", "gap", None} & set(by)
    assert [x[:2] for x in sorted(by["noise"])] == [(28, 1), (29, 2), (30, 3)] and all(7 < x[2] < 13 for x in by["noise"])
    assert FC.arima_forecasts(spark.createDataFrame([], "team_name string, year int, wins double"), "wins").count() == 0


def test_the_stationary_start_is_the_sum_of_the_shocks():
    """Covariances of the state with the value, for orders below and up to (2, 2) and close to a unit root."""
    for ar, ma in (([0.5, -0.3], [0.4, 0.2]), ([0.6, 0.0], [0.0, 0.0]), ([0.0, 0.0], [-0.7, 0.3]), ([0.99, 0.0], [-0.9, 0.0]), ([0.1, 0.88], [0.5, 0.0])):
        w = [1.0, ma[0] + ar[0]]
        w.append(ma[1] + ar[0] * w[1] + ar[1])
        for _ in range(6000):
            w.append(ar[0] * w[-1] + ar[1] * w[-2])
        w = np.array(w)
        g = [np.sum(w[:len(w) - h] * w[h:]) for h in range(3)]
        want = [g[0], ar[1] * g[1] + ma[0] + ma[1] * w[1], ma[1]]
        assert AR.stationary(np.array([ar]).T, np.array([ma]).T)[:, 0] == pytest.approx(want, rel=1e-8)


def test_the_filter_is_that_of_whole_covariances():
    """Every step's variance and gain by the textbook recursion on the covariance matrix."""
    rng = np.random.default_rng(5)
    for p, q in AR.ORDERS:
        ar, ma, n = AR.from_partial(rng.normal(size=(1, p))), -AR.from_partial(rng.normal(size=(1, q))), 40
        y, r = rng.normal(size=n), max(p, q + 1)
        move, load = np.eye(r, k=1), np.zeros(r)
        move[:p, 0] += ar[0]
        load[0], load[1:q + 1] = 1, ma[0]
        cov = np.linalg.solve(np.eye(r * r) - np.kron(move, move), np.outer(load, load).ravel()).reshape(r, r)
        state, sums, logs = np.zeros((r, 2)), np.zeros(3), 0.0
        for v in y:
            f, miss = cov[0, 0], np.array([v, 1.0]) - state[0]
            gain = move @ cov[:, 0] / f
            sums, logs = sums + np.array([miss[0] ** 2, miss[0] * miss[1], miss[1] ** 2]) / f, logs + np.log(f)
            state = move @ state + np.outer(gain, miss)
            cov = move @ cov @ move.T + np.outer(load, load) - f * np.outer(gain, gain)
        got, mean = run(y, ar[0], ma[0]), sums[1] / sums[2]
        variance = (sums[0] - sums[1] * mean) / n
        assert (got["mean"], got["variance"]) == pytest.approx((mean, variance))
        assert got["loglik"] == pytest.approx(-0.5 * (n * (np.log(2 * np.pi * variance) + 1) + logs))
        assert got["state"] == pytest.approx(state[:, 0] - mean * state[:, 1])


def test_a_search_is_a_few_hundred_passes_for_all_series_and_orders(monkeypatch):
    """A pass costs mostly one call per operation, whatever the number of models: all series and orders share it."""
    widths, whole = [], AR.run_filter
    monkeypatch.setattr(AR, "run_filter", lambda data, ar, *rest: widths.append(ar.shape[1]) or whole(data, ar, *rest))
    series = [simulated(28, (0.4,), (0.2,), seed=s) for s in range(60)]
    together = AR.select(series, 1)
    assert len(widths) < 1200 and max(widths) == 60 * len(AR.ORDERS)
    alone = AR.select(series[7:8], 1)[0]
    assert together[7][0] == alone[0] and together[7][1] == pytest.approx(alone[1]) and together[7][2] == pytest.approx(alone[2], rel=1e-5)
