"""Likelihood of a damped random walk as a fold that can be cut anywhere.

A stretch of a curve is summed up by six numbers for each trial: given the process just
before it, its last value has mean ``carry * x + level`` and variance ``doubt``, and the log of the
probability of what was seen is ``score + pull * x - grip * x^2 / 2``.  One epoch more is a step of
a Kalman filter (Kelly et al. 2009); two stretches are joined by ``joined``, in any order
of joining, so the stretches of a long curve are summed up side by side or in different tasks.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

#: Epochs that are stepped through one after the other.
STRETCH = 256
#: Curves fitted together.
TOGETHER = 64
#: The six numbers, in the order in which they are handed on.
PARTS = ("carry", "level", "doubt", "pull", "grip", "score")
_HALF_LOG = 0.5 * np.log(2.0 * np.pi)


def stretches(gaps, y, variance, there, amplitude, rate, alone=False):
    """The six numbers of each stretch for each trial: stretches by rows, epochs or trials by columns.

    ``there`` is 0 past the end of a stretch.  ``amplitude`` is the variance of the process,
    ``rate`` its decay per day.  A stretch that stands ``alone`` begins with the process at
    rest, and only its score counts.
    """
    carry, level, pull, grip, score = np.ones_like(rate), *np.zeros((4, *rate.shape))
    doubt = amplitude + 0.0 if alone else np.zeros_like(rate)
    for k in range(gaps.shape[1]):
        column = slice(k, k + 1)
        decay = np.exp(-rate * gaps[:, column])
        level *= decay
        doubt = amplitude + (doubt - amplitude) * decay * decay
        expected = doubt + variance[:, column]
        surprise = y[:, column] - level
        share = there[:, column] / expected
        score -= 0.5 * (there[:, column] * np.log(expected) + surprise * surprise * share) + _HALF_LOG * there[:, column]
        gain = doubt * share
        if not alone:
            carry *= decay
            pull += carry * surprise * share
            grip += carry * carry * share
            carry *= 1.0 - gain
        level += gain * surprise
        doubt *= 1.0 - gain
    return carry, level, doubt, pull, grip, score


def joined(parts, amplitude):
    """Log-likelihood of stretches that follow each other: six arrays with curves, stretches and trials as dimensions."""
    mean, spread, total = np.zeros_like(amplitude), amplitude + 0.0, np.zeros_like(amplitude)
    for s in range(parts[0].shape[1]):
        carry, level, doubt, pull, grip, score = (p[:, s] for p in parts)
        known = 1.0 / (1.0 + spread * grip)
        total += score + 0.5 * (np.log(known) + known * (2.0 * pull * mean - grip * mean * mean + pull * pull * spread))
        mean = carry * known * (mean + spread * pull) + level
        spread = carry * carry * known * spread + doubt
    return total


#: ``joined`` as SQL text over ``parts``, the stretches of one curve in order, for one trial.
JOINED_SQL = """aggregate(parts, named_struct('mean', 0D, 'spread', amplitude, 'total', 0D), (z, p) -> named_struct(
  'mean', p.carry*(z.mean + z.spread*p.pull)/(1 + z.spread*p.grip) + p.level,
  'spread', p.carry*p.carry*z.spread/(1 + z.spread*p.grip) + p.doubt,
  'total', z.total + p.score + 0.5D*((2*p.pull*z.mean - p.grip*z.mean*z.mean + p.pull*p.pull*z.spread)/(1 + z.spread*p.grip)
    - ln(1 + z.spread*p.grip))), z -> z.total)"""


def likelihood(data, amplitude, rate):
    """Log-likelihood of many curves for many trials; ``data`` is from ``padded``."""
    curves, count, width = data[0].shape
    lanes = [x.reshape(curves * count, width) for x in data]
    wide = [np.repeat(x, count, axis=0) for x in (amplitude, rate)]
    parts = stretches(*lanes, *wide, alone=count == 1)
    if count == 1:
        return parts[-1]
    return joined([p.reshape(curves, count, -1) for p in parts], amplitude)


def padded(curves):
    """Gaps, centred magnitudes, squared errors and a mark: curves, stretches and epochs as dimensions."""
    longest = max(t.size for t, _, _ in curves)
    width = min(longest, STRETCH)
    count = -(-longest // width)
    gaps, y, variance, there = np.zeros((4, len(curves), count * width))
    variance += 1.0
    for row, (t, m, e) in enumerate(curves):
        # The process is at rest before the first epoch, as it is after an endless gap.
        gaps[row, : t.size] = np.diff(t, prepend=-np.inf)
        y[row, : t.size] = m - m.mean()
        variance[row, : t.size] = e**2.0
        there[row, : t.size] = 1.0
    return tuple(x.reshape(len(curves), count, width) for x in (gaps, y, variance, there))


#: Steps at which a search ends, the logarithms between which numbers have a double, and an end for likelihoods that never turn.
FINE, WIDEST, TURNS = 1e-4, 300.0, 200
#: Relative difference from which one score is better than another.
SAME = 1e-9


class Search:
    """For each of many curves the best point on a grid, refined around it.

    Around the best point so far the next grid has nine values per axis.  Where the best
    lies on its edge the grid grows by half again and moves on, so the first axes bound
    nothing; elsewhere it shrinks to half, until all steps are below ``FINE``.
    ``rounds`` ends the search earlier.
    """

    def __init__(self, axes, count, rounds=None):
        self.axes, self.rounds, self.turn = [np.asarray(a, dtype=float) for a in axes], rounds, 0
        self.best = np.full((count, len(axes) + 1), np.nan)
        self.best[:, -1] = -np.inf
        self.half = np.tile([(a[-1] - a[0]) / 2.0 for a in self.axes], (count, 1))
        self.active = np.ones(count, dtype=bool)

    def trials(self):
        """For each axis the trials of the curves still searched, curves by rows."""
        rows = np.flatnonzero(self.active)
        if self.turn == 0:
            grids = [np.tile(a, (len(rows), 1)) for a in self.axes]
        else:
            steps = np.linspace(-1.0, 1.0, 9)
            grids = [np.clip(self.best[rows, i, None] + self.half[rows, i, None] * steps, -WIDEST, WIDEST) for i in range(len(self.axes))]
        places = np.unravel_index(np.arange(int(np.prod([g.shape[1] for g in grids]))), [g.shape[1] for g in grids])
        return [g[:, p] for g, p in zip(grids, places, strict=True)]

    def advance(self, trials, scores):
        """Take the scores of the trials: where to go on, and which curves are done."""
        rows, size = np.flatnonzero(self.active), [a.size if self.turn == 0 else 9 for a in self.axes]
        places = np.unravel_index(np.arange(int(np.prod(size))), size)
        values = np.nan_to_num(scores, nan=-np.inf, posinf=-np.inf)
        # Scores that rounding alone may tell apart count as equal: the first of them is taken, and a later one is no better.
        top = values.max(axis=1)
        near = top - SAME * (1.0 + np.abs(top))
        at = (values >= near[:, None]).argmax(axis=1)
        top = values[np.arange(len(rows)), at]
        better = np.isfinite(top) & ~(top <= self.best[rows, -1] + SAME * (1.0 + np.abs(top)))
        for i, axis in enumerate(trials):
            self.best[rows[better], i] = axis[np.arange(len(rows)), at][better]
            n = size[i] - 1
            edge = better & ((places[i][at] == 0) | (places[i][at] == n))
            half = self.half[rows, i]
            # The first grid is finer than nine values; what follows starts from its steps.
            inside = 8.0 * half / n if self.turn == 0 else half / 2.0
            self.half[rows, i] = np.where(edge, np.minimum(half * 1.5, WIDEST), inside)
        self.best[rows[better], -1] = top[better]
        if self.turn == self.rounds or self.turn >= TURNS:
            self.active[:] = False
        self.active[rows] &= ~(self.half[rows] < 4.0 * FINE).all(axis=1) & np.isfinite(self.best[rows, -1])
        self.turn += 1


def search(score: Callable, axes, count, rounds=None):
    """The best point of each curve and its score last; ``score`` takes the rows of the curves and a trial array per axis."""
    found = Search(axes, count, rounds)
    while found.active.any():
        trials = found.trials()
        found.advance(trials, score(np.flatnonzero(found.active), *trials))
    return found.best


def in_groups(curves, usable, fit, width):
    """Apply ``fit`` to groups of curves of similar length; NaN where ``usable`` says no."""
    rows = np.full((len(curves), width), np.nan)
    order = sorted((i for i, curve in enumerate(curves) if usable(curve)), key=lambda i: curves[i][0].size)
    for start in range(0, len(order), TOGETHER):
        group = order[start : start + TOGETHER]
        with np.errstate(all="ignore"):
            rows[group] = fit([curves[i] for i in group])
    return rows


def walk_process(a, c):
    """Variance and rate of the process from the two axes of the search."""
    return np.exp(a), np.exp(c)


def autoregression_process(phi):
    """A process of variance one from the correlation after one day; NaN where it is none."""
    inside = (phi > 0.0) & (phi < 1.0)
    rate = -np.log(np.where(inside, phi, 0.5))
    return np.where(inside, 1.0, np.nan), rate


def walk_fits(curves, log_amplitude, log_rate, rounds):
    """Amplitude and time scale of the likeliest damped random walk, and its log-likelihood."""

    def fit(group):
        data = padded(group)
        axes = [np.linspace(*log_amplitude), np.linspace(*log_rate)]
        best = search(lambda rows, *at: likelihood([x[rows] for x in data], *walk_process(*at)), axes, len(group), rounds)
        return np.stack([np.exp(best[:, 0]), np.exp(-best[:, 1]), best[:, 2]], axis=1)

    return in_groups(curves, lambda c: c[0].size > 1, fit, 3)


def autoregression_fits(curves, phis, rounds):
    """Irregular autoregression: likeliest correlation after one day, and its log-likelihood."""

    def fit(group):
        gaps, y, variance, there = padded(group)
        scale = np.array([m.std(ddof=1) for _, m, _ in group])[:, None, None]
        data = gaps, y / scale, variance / scale**2, there
        return search(lambda rows, *at: likelihood([x[rows] for x in data], *autoregression_process(*at)), [np.linspace(*phis)], len(group), rounds)

    return in_groups(curves, lambda c: c[0].size > 1 and np.ptp(c[1]) > 0, fit, 2)
