"""Small numpy scores for one curve, called from Arrow batches inside Spark tasks.

Only what column expressions cannot do at a fair cost is here: sums over a grid
of trial parameters, a correlation by Fourier transform and one least-squares
solve.  Ordering, filtering, quantiles, moments, entropy and assembly stay in
Spark.  Every kernel takes time-ordered arrays and works in blocks of epochs, so
its memory does not follow the product of epochs and trials.
"""

from __future__ import annotations

import numpy as np

BLOCK = 4096


def blocks(size: int, step: int = BLOCK):
    return (slice(i, min(i + step, size)) for i in range(0, size, step))


# ------------------------------------------------------------------ periodogram


def grid_sums(t, weight, target, start, step, count):
    """Sums of w*exp(i*p), w*y*exp(i*p) and w*exp(2i*p), p = 2*pi*f*t, at every frequency of an even grid.

    A frequency is a coarse step plus a fine step, so its phase factor is a
    product of two, and the sum over epochs is one matrix product: trigonometry
    is needed for about 2*sqrt(count) frequencies instead of all of them.  The
    grid is walked in stretches that fit the processor's cache.  Sums over parts of a curve add up.
    """
    wide = int(np.ceil(np.sqrt(count)))
    tall = max(1, 4096 // wide)
    parts = list(blocks(t.size))

    def waves(freqs, part):
        return np.exp(np.multiply.outer(2j * np.pi * freqs, t[part]))

    fine = step * np.arange(wide)
    def fine_waves(part):
        high = waves(fine, part).T
        return high, high * high

    shared = fine_waves(parts[0]) if len(parts) == 1 else None
    out = np.zeros((3, count), dtype=complex)
    for first in range(0, count, tall * wide):
        coarse = start + step * (first + wide * np.arange(tall))
        sums = np.zeros((3, tall, wide), dtype=complex)
        for part in parts:
            low, (high, squared) = waves(coarse, part), shared or fine_waves(part)
            w, y = weight[part], target[part]
            sums[0] += (low * w) @ high
            sums[1] += (low * (w * y)) @ high
            sums[2] += (low * low * w) @ squared
        stretch = out[:, first : first + tall * wide]
        stretch[:] = sums.reshape(3, -1)[:, : stretch.shape[1]]
    return out


def grid_power(t, weight, target, start, step, count):
    """The statistic at every frequency of an even grid."""
    return aov(grid_sums(t, weight, target, start, step, count), weight, target)


def direct_sums(t, weight, target, freqs):
    """Sums of w*exp(i*p), w*y*exp(i*p) and w*exp(2i*p), p = 2*pi*f*t, at listed frequencies."""
    sums = np.zeros((3, freqs.size), dtype=complex)
    for part in blocks(t.size):
        wave = np.exp(2j * np.pi * np.multiply.outer(freqs, t[part]))
        w, y = weight[part], target[part]
        sums += np.stack([wave @ w, wave @ (w * y), (wave * wave) @ w])
    return sums


def aov(sums, weight, target):
    """Analysis of variance for one harmonic plus a constant, from its sums.

    The share p of the weighted variance that a sinusoid explains has a closed
    form (Zechmeister & Kuerster 2009); the statistic is (N-3)/2 * p/(1-p)
    (Schwarzenberg-Czerny 1996).
    """
    mean = weight @ target
    spread = weight @ (target - mean) ** 2
    c, s = sums[0].real, sums[0].imag
    yc, ys = sums[1].real - mean * c, sums[1].imag - mean * s
    cc = (1.0 + sums[2].real) / 2.0 - c * c
    ss = (1.0 - sums[2].real) / 2.0 - s * s
    cs = sums[2].imag / 2.0 - c * s
    det = cc * ss - cs * cs
    with np.errstate(all="ignore"):
        share = (ss * yc**2 + cc * ys**2 - 2.0 * cs * yc * ys) / (spread * det)
    share = np.where(det > 1e-9, np.clip(share, 0.0, 1.0 - 1e-9), 0.0)
    return (target.size - 3) / 2.0 * share / (1.0 - share)


def prepared(t, m, e):
    """Times from the first epoch, normalised weights, centred magnitudes."""
    if t.size < 4 or not (np.all(e > 0) and np.isfinite(t + m).all()) or np.ptp(m) == 0:
        return None
    weight = e**-2.0
    return t - t[0], weight / weight.sum(), m - m.mean()


def spectrum(t, m, e, start, step, count):
    """The power at every grid frequency, or None when it is not defined."""
    curve = prepared(t, m, e)
    return None if curve is None else grid_power(*curve, start, step, count)


def power_at(t, m, e, freqs):
    curve = prepared(t, m, e)
    return None if curve is None else aov(direct_sums(*curve, freqs), curve[1], curve[2])


def largest(power, top):
    """The largest values in falling order."""
    return np.sort(np.partition(power, -min(top, power.size))[-min(top, power.size) :])[::-1]


def picks(power, start, step, top, optima, fine_step):
    """From the powers of a grid: the best frequency and its power, the largest powers, and the frequencies around the best peaks."""
    count = power.size
    best = int(power.argmax())
    near = np.empty(0)
    if optima and count > 2:
        inner = power[1:-1]
        peaks = np.flatnonzero((inner >= power[:-2]) & (inner >= power[2:])) + 1
        if peaks.size > optima:
            floor = np.partition(power[peaks], -optima)[-optima]
            peaks = peaks[power[peaks] >= floor]
        peaks = peaks[np.argsort(-power[peaks], kind="stable")[:optima]]
        reach = int(round(step / fine_step))
        near = start + step * peaks[:, None] + fine_step * np.arange(-reach, reach + 1)
        near = np.unique(near[near > 0])
    return float(start + step * best), float(power[best]), largest(power, top), near


def best_period(t, m, e, start, step, count, top, optima, fine_step):
    """Best frequency and its power after refinement, and the top grid powers."""
    curve = prepared(t, m, e)
    if curve is None:
        return None, None, None
    freq, value, highest, near = picks(grid_power(*curve, start, step, count), start, step, top, optima, fine_step)
    if near.size:
        refined = aov(direct_sums(*curve, near), curve[1], curve[2])
        if refined.max() > value:
            freq, value = float(near[refined.argmax()]), float(refined.max())
    return freq, value, highest


# ------------------------------------------------------------ structure function


def structure_function(t, m, e, per_decade, fewest):
    """Amplitude at one year and slope of the structure function, on a log-log line.

    Lag bins are ``per_decade`` to a decade and cover all lags that the curve has.
    For a lag bin the mean of (m_i - m_j)^2 - e_i^2 - e_j^2 over its pairs follows
    from running sums of m, m^2 and e^2, so the cost is linear in epochs and no
    pair is ever formed.
    """
    gaps = np.diff(t)
    gaps = gaps[gaps > 0]
    if not gaps.size:
        return None, None
    first, last = np.floor(per_decade * np.log10([gaps.min(), t[-1] - t[0]]))
    edges = 10.0 ** (np.arange(first, last + 2) / per_decade)
    y = m - m.mean() if m.size else m
    runs = [np.concatenate(([0.0], np.cumsum(v))) for v in (y, y * y, e * e)]
    reach = [np.searchsorted(t, t + edge, side="left") for edge in edges]
    lags, logs = [], []
    for k in range(len(edges) - 1):
        lo, hi = reach[k], reach[k + 1]
        count = hi - lo
        pairs = int(count.sum())
        if pairs < fewest:
            continue
        s1, s2, noise = (run[hi] - run[lo] for run in runs)
        square = (count * y * y - 2.0 * y * s1 + s2).sum() / pairs
        square -= (count * e * e + noise).sum() / pairs
        if square > 0:
            lags.append(0.5 * (np.log10(edges[k]) + np.log10(edges[k + 1])) - np.log10(365.25))
            logs.append(0.5 * np.log10(square))
    if len(lags) < 2:
        return None, None
    x, z = np.array(lags), np.array(logs)
    slope = float(((x - x.mean()) @ (z - z.mean())) / ((x - x.mean()) @ (x - x.mean())))
    return float(10.0 ** (z.mean() - slope * x.mean())), slope


def correlation_length(m, level):
    """First lag, in epochs, at which the autocorrelation falls below ``level``."""
    if m.size < 2 or not np.isfinite(m).all() or np.ptp(m) == 0:
        return None
    y = m - m.mean()
    size = 1 << int(2 * y.size - 1).bit_length()
    wave = np.fft.rfft(y, size)
    lagged = np.fft.irfft(wave * wave.conj(), size)[: y.size]
    below = np.flatnonzero(lagged / lagged[0] < level)
    return float(below[0]) if below.size else None


# -------------------------------------------------------------------- template


def template_shape(t, peak, plateau, slope, rise, fall):
    """Supernova-like shape of unit amplitude on a grid: one dimension per parameter, epochs last.

    Rise on a logistic curve, a plateau that declines linearly and an exponential
    tail, joined smoothly (Villar et al. 2019; arXiv:2008.03311).  Each
    factor is worked out on the parameters it depends on and no others.
    """
    peak, plateau, slope, rise, fall = (axis[..., None] for axis in np.ix_(peak, plateau, slope, rise, fall))
    return _joined(t - peak, plateau, slope, rise, fall)


def _joined(since, plateau, slope, rise, fall):
    late = since - plateau
    growth = 1.0 / (1.0 + np.exp(-since / rise))
    switch = 1.0 / (1.0 + np.exp(-late / 3.0))
    flat = (1.0 - slope * since / plateau) * (1.0 - switch)
    tail = np.exp(-np.maximum(late, -50.0) / fall) * switch
    return (flat + (1.0 - slope) * tail) * growth


def template_scores(t, flux, weight, axes):
    """For each point of the grid: best amplitude (not negative), offset and chi^2 / N."""
    return tuple(x[0] for x in _scores(*(x[None] for x in (t, flux, weight)), [axis[None] for axis in axes]))


def _times(rows, columns):
    """The product of a matrix and a vector for each curve."""
    return (rows @ columns[:, :, None])[:, :, 0]


def _scores(t, flux, weight, axes):
    """``template_scores`` for many curves of as many epochs: a row for each curve, in the axes too."""
    share = weight.sum(axis=1)[:, None]
    centre = np.vecdot(weight, flux)[:, None] / share
    y = flux - centre
    trials = int(np.prod([axis.shape[1] for axis in axes]))
    peak, plateau, slope, rise, fall = (axis.reshape(-1, *(axis.shape[1] if i == k else 1 for i in range(5)), 1) for k, axis in enumerate(axes))
    s, ss, sy = np.zeros((3, len(t), trials))
    for part in blocks(t.shape[1], max(1, 500_000 // trials)):
        shape = _joined(t[:, None, None, None, None, None, part] - peak, plateau, slope, rise, fall).reshape(len(t), trials, -1)
        w = weight[:, part]
        s += _times(shape, w)
        sy += _times(shape, w * y[:, part])
        ss += _times(shape * shape, w)
    spread = ss - s * s / share
    # A shape that is flat over the curve cannot be told from the offset.
    varied = spread > 1e-6 * ss
    amplitude = np.where(varied, np.maximum(sy / np.where(varied, spread, 1.0), 0.0), 0.0)
    offset = centre - amplitude * s / share
    chi = (np.vecdot(weight, y * y)[:, None] - 2.0 * amplitude * sy + amplitude**2 * spread) / t.shape[1]
    return amplitude, offset, chi


#: Steps at which the search of the template ends: days of the start time, and shares of the other parameters.
FINE = 1e-4
#: Steps at which steps along the axes give way to Gauss-Newton steps.
COARSE = 0.05
#: Values of a grid, and epochs, that are worked on together: as many as the processor's cache holds.
GRID_LOT, EPOCH_LOT = 60_000, 20_000


def template_fit(t, m, e, zero_point, grid, rounds=None):
    """Parameters of the best template: A, t0, gamma, beta, rise, fall, chi, C.

    With ``rounds`` the start times tried are ``grid[0]`` even ones, and each of so many
    rounds halves the spacing around the best point, within the grid.  Without it all
    shapes are tried at start times no farther apart than the shortest rise wherever
    there are epochs, and the search from there may leave the grid on every side.
    """
    return template_fits([(t, m, e)], zero_point, grid, rounds)[0]


def template_fits(curves, zero_point, grid, rounds=None):
    """``template_fit`` of many curves.

    Curves of as many epochs are searched together, each by its own steps: none is padded, so
    that the sums of a curve, and what it ends with, do not depend on the others.
    """
    rows, begun = [(None,) * 8] * len(curves), {}
    shapes = [np.asarray(axis, dtype=float) for axis in grid[1:]]
    with np.errstate(all="ignore"):
        for k, (t, m, e) in enumerate(curves):
            if t.size < 2 or not np.all(e > 0):
                continue
            flux = 10.0 ** (-0.4 * (m - zero_point))
            error = 10.0 ** (-0.4 * (m - e - zero_point)) - flux
            flux = flux - np.percentile(flux, 5)
            t, weight = t - t[0], error**-2.0
            latest = max(t[-1], 1.0)
            axes = [np.linspace(-50.0, latest, grid[0]), *shapes]
            if rounds is None:
                axes[0] = _likely_starts(t, flux, weight, shapes, axes[0], latest)
            best = _least(t, flux, weight, axes)
            if best is None:
                continue
            if rounds is None:
                begun.setdefault(t.size, []).append((k, t, flux, weight, best, _widths(axes)))
            else:
                rows[k] = _within(t, flux, weight, axes, best, rounds)
        for size, group in begun.items():
            for lot in blocks(len(group), max(1, EPOCH_LOT // size)):
                places, *parts = zip(*group[lot], strict=True)
                for k, found in zip(places, _beyond(*(np.array(x) for x in parts)).tolist(), strict=True):
                    rows[k] = tuple(found)
    return rows


def _least(t, flux, weight, axes):
    """The point of a grid with the least chi^2 / N, in the order of ``template_fit``; None if there is none."""
    found, there = _leasts(*(x[None] for x in (t, flux, weight)), [axis[None] for axis in axes])
    return tuple(found[0].tolist()) if there[0] else None


def _leasts(t, flux, weight, axes):
    """``_least`` for many curves, and whether each has such a point."""
    amplitude, offset, chi = _scores(t, flux, weight, axes)
    there, every = np.isfinite(chi).any(axis=1), np.arange(len(t))
    at = np.where(np.isnan(chi), np.inf, chi).argmin(axis=1)
    places = np.unravel_index(at, [axis.shape[1] for axis in axes])
    point = [axis[every, place] for axis, place in zip(axes, places, strict=True)]
    return np.stack([amplitude[every, at], *point, chi[every, at], offset[every, at]], axis=1), there


def _within(t, flux, weight, axes, best, rounds):
    """Rounds of half the spacing, inside the grid's own limits."""
    low, high = np.array([-50.0, 1.0, 0.0, 1.0, 1.0]), np.array([axes[0][-1], 120.0, 1.0, 100.0, 180.0])
    for _ in range(rounds):
        widths = [np.diff(axis).max() / 2.0 if axis.size > 1 else 0.0 for axis in axes]
        if max(widths) < FINE:
            break
        axes = [np.unique(np.clip([b - w, b, b + w], lo, hi)) for b, w, lo, hi in zip(best[1:6], widths, low, high)]
        found = _least(t, flux, weight, axes)
        if found is not None and found[6] <= best[6]:
            best = found
    return best


def _widths(axes):
    """First steps of ``_beyond``: days for the start time, a share for the decline, logarithms of factors for the durations."""
    day = np.diff(axes[0]).max() / 2.0 if axes[0].size > 1 else 1.0
    share = np.diff(axes[2]).max() / 2.0 if axes[2].size > 1 else 0.0
    factor = {k: (np.diff(np.log(axes[k])).max() / 2.0 if axes[k].size > 1 else 0.0) for k in (1, 3, 4)}
    return np.array([day, factor[1], share, factor[3], factor[4]])


def _beyond(t, flux, weight, best, width):
    """A search without limits: a step along each axis and back, kept where it pays and halved where it does not.

    The start time goes by days, the durations by factors, the decline stays a share.
    A gain below a thousandth of chi^2 counts as none (in ``_settled`` 1e-5), so that a shape which no epoch
    can tell from a longer one ends the search.  All arguments have a row for each curve.
    """
    straight = _settled(t, flux, weight, best)
    best, side, stepped = best.copy(), np.array([-1.0, 0.0, 1.0]), np.zeros(len(t), dtype=bool)
    searched = np.flatnonzero(width.max(axis=1) >= COARSE)
    while searched.size:
        point, steps = best[searched, 1:6, None], width[searched, :, None] * side
        axes = np.where(np.isin(np.arange(5), (1, 3, 4))[:, None], point * np.exp(steps), point + steps)
        axes[:, 2] = np.clip(axes[:, 2], 0.0, 1.0)
        # A decline that meets its limit is tried once.
        apart = np.diff(axes[:, 2], axis=1) > 0
        found, there = np.empty((searched.size, 8)), np.empty(searched.size, dtype=bool)
        for pattern in range(4):
            own = np.flatnonzero(apart @ np.array([1, 2]) == pattern)
            declines = [0, *(k + 1 for k in range(2) if pattern >> k & 1)]
            for lot in blocks(own.size, max(1, GRID_LOT // (81 * len(declines) * t.shape[1]))):
                rows = own[lot]
                tried = [axes[rows, k][:, declines] if k == 2 else axes[rows, k] for k in range(5)]
                found[rows], there[rows] = _leasts(*(x[searched[rows]] for x in (t, flux, weight)), tried)
        pays = there & (found[:, 6] < best[searched, 6] * (1.0 - 1e-3))
        moved = pays[:, None] & (point[:, :, 0] != found[:, 1:6])
        width[searched] = np.where(moved, width[searched], width[searched] / 2.0)
        best[searched[pays]], stepped[searched[pays]] = found[pays], True
        searched = searched[width[searched].max(axis=1) >= COARSE]
    # Where no step paid the search would settle as it did before.
    settled, left = straight.copy(), np.flatnonzero(stepped)
    if left.size:
        settled[left] = _settled(*(x[left] for x in (t, flux, weight, best)))
    return np.where((settled[:, 6] < straight[:, 6])[:, None], settled, straight)


def _settled(t, flux, weight, best):
    """Damped Gauss-Newton steps (Marquardt 1963) from a point: durations by their logarithm, amplitude and offset solved for in each.

    It ends when a step that pays is below ``FINE`` or gains less than 1e-5 of chi^2, or none pays however short.
    All arguments have a row for each curve, and each curve goes on until its own search ends.
    """
    root, share = np.sqrt(weight), weight.sum(axis=1)[:, None]
    y = flux - np.vecdot(weight, flux)[:, None] / share

    def misfits(rows, points):
        w, z = weight[rows], y[rows]
        start, plateau, slope, rise, fall = (points[:, :, k, None] for k in range(5))
        shape = _joined(t[rows][:, None] - start, np.exp(plateau), slope, np.exp(rise), np.exp(fall))
        apart = shape - (_times(shape, w) / share[rows])[:, :, None]
        spread = _times(apart * apart, w)
        varied = spread > 1e-6 * _times(shape * shape, w)
        amplitude = np.where(varied, np.maximum(_times(apart, w * z) / np.where(varied, spread, 1.0), 0.0), 0.0)
        return root[rows][:, None] * (amplitude[:, :, None] * apart - z[:, None])

    q = best[:, 1:6].copy()
    q[:, [1, 3, 4]] = np.log(q[:, [1, 3, 4]])
    rows = fresh = np.arange(len(t))
    left, damping = misfits(rows, q[:, None])[:, 0], np.full(len(t), 1e-3)
    square, pull = np.empty((len(t), 5, 5)), np.empty((len(t), 5))
    while rows.size:
        # Slopes stay what they are until a step pays.
        if fresh.size:
            # The decline is a share: at its upper end the difference is taken downwards.
            steps = np.tile([1e-5, 1e-6, 1e-6, 1e-6, 1e-6], (fresh.size, 1))
            steps[q[fresh, 2] > 0.5, 2] = -1e-6
            slopes = (misfits(fresh, q[fresh, None] + steps[:, None] * np.eye(5)) - left[fresh, None]) / steps[:, :, None]
            square[fresh], pull[fresh] = slopes @ slopes.transpose(0, 2, 1), _times(slopes, left[fresh])
            rows = rows[np.isfinite(square[rows]).all(axis=(1, 2))]
        own = np.diagonal(square[rows], axis1=1, axis2=2)
        scale = damping[rows, None] * (own + 1e-12 * np.trace(square[rows], axis1=1, axis2=2)[:, None] + 1e-300)
        damped = square[rows] + scale[:, :, None] * np.eye(5)
        new = q[rows] - np.array([np.linalg.lstsq(a, b, rcond=None)[0] for a, b in zip(damped, pull[rows], strict=True)]).reshape(-1, 5)
        new[:, 2] = np.clip(new[:, 2], 0.0, 1.0)
        found = misfits(rows, new[:, None])[:, 0]
        after, before = np.vecdot(found, found), np.vecdot(left[rows], left[rows])
        pays = after < before
        short = pays & ((np.abs(new - q[rows]).max(axis=1) < FINE) | (after > before * (1.0 - 1e-5)))
        q[rows[pays]], left[rows[pays]] = new[pays], found[pays]
        damping[rows] = np.where(pays, np.maximum(damping[rows] / 3.0, 1e-12), damping[rows] * 4.0)
        fresh = rows[pays & ~short]
        rows = rows[~short & (damping[rows] < 1e6)]
    q[:, [1, 3, 4]] = np.exp(q[:, [1, 3, 4]])
    point, there = _leasts(t, flux, weight, [q[:, k, None] for k in range(5)])
    return np.where((there & (point[:, 6] < best[:, 6]))[:, None], point, best)


def _likely_starts(t, flux, weight, shapes, even, latest):
    """Start times around the one at which the best of all shapes fits, as far apart as the shortest rise.

    A shape is (u - slope v) g: g depends on the rise, u and v on plateau and fall, so
    all sums over epochs are matrix products of few factors.
    """
    plateaus, slopes, rises, falls = shapes
    step = float(rises.min())
    ahead = np.concatenate([np.zeros(1), rises, plateaus])
    near = np.unique(np.round(np.subtract.outer(t, ahead).ravel() / step)) * step
    starts = np.union1d(near[(near >= -50.0) & (near <= latest)], even)
    share = weight.sum()
    y = flux - (weight @ flux) / share
    total = weight @ (y * y)

    def least(starts):
        since = t - starts[:, None]
        late = since[:, None] - plateaus[:, None]
        switch = 1.0 / (1.0 + np.exp(-late / 3.0))
        tail = np.exp(-np.maximum(late, -50.0)[:, :, None] / falls[:, None]) * switch[:, :, None]
        u = (1.0 - switch)[:, :, None] + tail
        v = (since[:, None] / plateaus[:, None] * (1.0 - switch))[:, :, None] + tail
        u, v = (x.reshape(starts.size, -1, t.size) for x in (u, v))
        g = 1.0 / (1.0 + np.exp(-since[:, :, None] / rises))
        w, wy, ww = g * weight[:, None], g * (weight * y)[:, None], g * g * weight[:, None]
        su, sv, yu, yv = u @ w, v @ w, u @ wy, v @ wy
        uu, uv, vv = (u * u) @ ww, (u * v) @ ww, (v * v) @ ww
        chi = np.full(starts.size, np.inf)
        for slope in slopes:
            s, sy, ss = su - slope * sv, yu - slope * yv, uu - 2.0 * slope * uv + slope * slope * vv
            spread = ss - s * s / share
            gain = np.where(spread > 1e-6 * ss, np.maximum(sy, 0.0) ** 2 / spread, 0.0)
            chi = np.fmin(chi, (total - gain).min(axis=(1, 2)))
        return chi

    lot = max(1, 400_000 // (plateaus.size * falls.size * t.size))
    found = np.concatenate([least(starts[part]) for part in blocks(starts.size, lot)])
    best = starts[int(np.argmin(np.nan_to_num(found, nan=np.inf)))]
    return np.unique(np.clip(best + step * np.arange(-5, 6), -50.0, latest))
