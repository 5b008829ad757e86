"""Fourier series at a period, from sums over the epochs.

Products of sines and cosines are sines and cosines of sums of their angles, so the normal equations of
a weighted series with k harmonics hold nothing but sums of 2k angles, with and without the magnitude.
Such sums add up over any parts of a curve; the equations are solved once for each curve, all
curves of a batch together.
"""

from __future__ import annotations

import numpy as np

#: Eigenvalues below this share of the largest are zero but for rounding.
SMALLEST = 64 * np.finfo(float).eps


def series_sums(turns, weight, m, curve, curves, count):
    """For each curve the sums of w*exp(i*k*angle), k to twice ``count``, then of w*m*exp(i*k*angle), k to ``count``."""
    wave = np.exp(2j * np.pi * turns)
    power, sums = np.ones_like(wave), np.empty((curves, 3 * count + 2), dtype=complex)

    def total(values):
        return np.bincount(curve, values.real, curves) + 1j * np.bincount(curve, values.imag, curves)

    for k in range(2 * count + 1):
        sums[:, k] = total(weight * power)
        if k <= count:
            sums[:, 2 * count + 1 + k] = total(weight * m * power)
        power = power * wave
    return sums


def equations(sums, count):
    """The matrix and the right side of each curve; unknowns: constant, cosines, sines."""
    k = np.arange(1, count + 1)
    plus, minus = k[:, None] + k, np.abs(k[:, None] - k)
    sign = np.sign(k[:, None] - k)
    c, s = sums[:, : 2 * count + 1].real, sums[:, : 2 * count + 1].imag
    right = sums[:, 2 * count + 1 :]
    matrix = np.empty((len(sums), 2 * count + 1, 2 * count + 1))
    cosine, sine = slice(1, count + 1), slice(count + 1, None)
    matrix[:, 0, 0] = c[:, 0]
    matrix[:, 0, cosine] = matrix[:, cosine, 0] = c[:, k]
    matrix[:, 0, sine] = matrix[:, sine, 0] = s[:, k]
    matrix[:, cosine, cosine] = (c[:, minus] + c[:, plus]) / 2.0
    matrix[:, sine, sine] = (c[:, minus] - c[:, plus]) / 2.0
    matrix[:, sine, cosine] = (s[:, plus] + sign * s[:, minus]) / 2.0
    matrix[:, cosine, sine] = matrix[:, sine, cosine].transpose(0, 2, 1)
    return matrix, np.concatenate([right[:, :1].real, right[:, 1:].real, right[:, 1:].imag], axis=1)


def series(curves, periods, count, floor):
    """Sizes, phases relative to the first harmonic, and the mean squared residual of each curve; NaN where it has none.

    The weights of the squares are 1/(e + floor)^2; a curve with fewer epochs than terms gets the solution of
    smallest norm.  What rounding of the equations costs is mended by solving for the residual again.
    """
    rows = np.full((len(curves), 2 * count), np.nan)
    periods = np.array([np.nan if p is None else p for p in periods], dtype=float)
    usable = [i for i, (t, m, e) in enumerate(curves) if t.size and np.isfinite(periods[i]) and periods[i] > 0 and np.isfinite(t + m + e).all() and (e + floor != 0).all()]
    if not usable:
        return rows
    sizes = np.array([curves[i][0].size for i in usable])
    curve, number = np.repeat(np.arange(len(usable)), sizes), len(usable)
    t, m, e = (np.concatenate([curves[i][k] for i in usable]) for k in range(3))
    turns = np.mod(t / periods[usable][curve], 1.0)
    weight = (e + floor) ** -2.0
    matrix, right = equations(series_sums(turns, weight, m, curve, number, count), count)
    inverse = np.linalg.pinv(matrix, rcond=SMALLEST * (2 * count + 1), hermitian=True)
    angles = 2.0 * np.pi * np.multiply.outer(turns, np.arange(1, count + 1))
    terms = np.concatenate([np.ones((t.size, 1)), np.cos(angles), np.sin(angles)], axis=1)
    solution, residual = np.zeros((number, 2 * count + 1)), m
    for turn in range(3):
        if turn:
            left = weight * residual
            right = np.stack([np.bincount(curve, left * column, number) for column in terms.T], axis=1)
        solution += (inverse @ right[:, :, None])[:, :, 0]
        residual = m - np.einsum("ij,ij->i", terms, solution[curve])
    cosine, sine = solution[:, 1 : count + 1], solution[:, count + 1 :]
    angle = np.arctan2(sine, cosine)
    relative = np.mod(angle - angle[:, :1] * np.arange(1, count + 1), 2.0 * np.pi)
    error = np.bincount(curve, residual**2, number) / sizes
    rows[usable] = np.concatenate([np.hypot(cosine, sine), relative[:, 1:], error[:, None]], axis=1)
    return rows
