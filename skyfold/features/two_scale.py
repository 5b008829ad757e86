"""Power at two time scales in time that grows with the epochs, by a fast Gauss transform.

Epochs are put into bins of half a width.  The moments of a bin say what it adds to the sum of Gaussians
in a bin near it, as a polynomial (Greengard and Strain 1991), so bins meet bins and an
epoch meets its own bin alone.  The curves of a batch lie on one axis, too far apart
to see each other, and are worked out together.
"""

from __future__ import annotations

import numpy as np

#: Bins of a width, widths from which exp(-x^2 / 2) is below 1e-20, and moments for an error below 1e-16 of the charges.
PER_WIDTH, REACH, MOMENTS = 2, 9.75, 16
_NEAR = int(np.ceil(REACH * PER_WIDTH)) + 1
#: A filtered value below this share of the largest magnitude is zero but for rounding.
ZERO = 1e-12


def _passage(distance):
    """What the moments of a bin mean for the polynomial of another: exp(D*(x - y) + x*y - D^2/2) as a table over powers of y and x."""
    facts = np.cumprod([1.0, *range(1, MOMENTS)])
    out = np.zeros((MOMENTS, MOMENTS))
    for b in range(MOMENTS):
        for a in range(MOMENTS):
            l = np.arange(min(a, b) + 1)
            out[b, a] = np.sum(distance ** (a - l) * (-distance) ** (b - l) / (facts[a - l] * facts[b - l] * facts[l]))
    return out * np.exp(-0.5 * distance * distance)


_PASSAGES = {step: _passage(step / PER_WIDTH) for step in range(-_NEAR, _NEAR + 1)}


def gauss_sums(t, curve, charges, sigma):
    """Sums of charge*exp(-gap^2 / (2 sigma^2)) over the epochs of the same curve, at every epoch: a row for each row of ``charges``.

    ``curve`` numbers the curve of each epoch, in order; ``t`` counts from the first epoch of its curve.
    """
    width = sigma / PER_WIDTH
    place = np.floor(t / width)
    # A curve begins far behind the last bin of the one before.
    last = np.zeros(int(curve[-1]) + 1)
    np.maximum.at(last, curve, place)
    first = np.concatenate([[0.0], np.cumsum(last + 2 * _NEAR + 2)[:-1]])
    bins, own = np.unique(first[curve] + place, return_inverse=True)
    away = (t - (place + 0.5) * width) / sigma
    bell = np.exp(-0.5 * away * away)
    moments, term = np.empty((len(charges), bins.size, MOMENTS)), bell
    for k in range(MOMENTS):
        for c, charge in enumerate(charges):
            moments[c, :, k] = np.bincount(own, charge * term, bins.size)
        term = term * away
    powers = np.zeros_like(moments)
    for step, passage in _PASSAGES.items():
        at = np.minimum(np.searchsorted(bins, bins + step), bins.size - 1)
        mine = np.flatnonzero(bins[at] == bins + step)
        powers[:, mine] += moments[:, at[mine]] @ passage
    sums = powers[:, own, -1]
    for k in range(MOMENTS - 2, -1, -1):
        sums = sums * away + powers[:, own, k]
    return sums * bell


def band_pass(t, curve, y, e, scale, epsilon=0.01):
    """Mexican-hat filtered values and their noise at one time scale (Arevalo et al. 2012), for the epochs of many curves.

    The filter is the difference of two Gaussian means whose widths differ by the
    factor 1 + epsilon.  Its square is a sum of three Gaussians, which give the noise.
    """
    sigma = scale / np.sqrt(2.0 * np.pi**2)
    narrow, broad = sigma / np.sqrt(1.0 + epsilon), sigma * np.sqrt(1.0 + epsilon)
    inner, inner_y = gauss_sums(t, curve, [np.ones_like(y), y], narrow)
    outer, outer_y = gauss_sums(t, curve, [np.ones_like(y), y], broad)
    mixed = narrow * broad / np.sqrt(narrow * narrow + broad * broad)
    (n2,), (nb,), (b2,) = (gauss_sums(t, curve, [e * e], w) for w in (narrow / np.sqrt(2.0), mixed, broad / np.sqrt(2.0)))
    return inner_y / inner - outer_y / outer, n2 / inner**2 - 2.0 * nb / (inner * outer) + b2 / outer**2


def two_scale_power(curves, slow, fast):
    """Ratio, low, high, count of non-zero filtered points and the noise flag of each curve; NaN where it has none."""
    rows = np.full((len(curves), 5), np.nan)
    usable = [i for i, (t, m, e) in enumerate(curves) if t.size > 1 and np.isfinite(t + m + e).all()]
    if not usable:
        return rows
    sizes = np.array([curves[i][0].size for i in usable])
    curve = np.repeat(np.arange(len(usable)), sizes)
    t = np.concatenate([curves[i][0] - curves[i][0][0] for i in usable])
    y = np.concatenate([curves[i][1] - curves[i][1].mean() for i in usable])
    e = np.concatenate([curves[i][2] for i in usable])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])

    def mean(values):
        return np.add.reduceat(values, starts) / sizes

    (low, low_noise), (high, high_noise) = (band_pass(t, curve, y, e, scale) for scale in (slow, fast))
    low_power, high_power = mean(low**2) - mean(low_noise), mean(high**2) - mean(high_noise)
    largest = np.maximum.reduceat(np.abs(y), starts)
    filled = np.add.reduceat((np.abs(high) > ZERO * largest[curve]).astype(float), starts)
    with np.errstate(all="ignore"):
        ratio = np.where(high_power != 0, low_power / high_power, np.nan)
    rows[usable] = np.stack([ratio, low_power, high_power, filled, (high_power < 0).astype(float)], axis=1)
    return rows
