"""Labelers that vote, and how far each can be trusted."""

from __future__ import annotations

import math


#: One vote of each sort in either class.
EVEN = {True: {"+": 1.0, "-": 1.0, "0": 1.0}, False: {"+": 1.0, "-": 1.0, "0": 1.0}}


def posteriors(counts: dict[str, int], start: dict[str, float], rounds: int = 50, prior: dict[bool, dict[str, float]] = EVEN) -> tuple[dict[str, float], float, list[dict]]:
    """By expectation maximisation: the posterior of each vote pattern, the share of the true class, and each labeler's vote rates.

    ``counts`` has how often each pattern occurs: a string with ``+``, ``-`` or ``0`` of each
    labeler.  ``start`` has the posteriors to begin with, ``prior`` the votes that a labeler is taken to
    have cast in either class before any was seen.
    """
    posterior, share, tables = dict(start), 0.5, []
    for _ in range(rounds if counts else 0):
        share = (sum(n * posterior[v] for v, n in counts.items()) + 1) / (sum(counts.values()) + 2)
        tables = []
        for at in range(len(next(iter(counts)))):
            table = {}
            for true in (True, False):
                weight = {c: prior[true][c] + sum(n * (posterior[v] if true else 1 - posterior[v]) for v, n in counts.items() if v[at] == c) for c in "+-0"}
                table[true] = {c: w / sum(weight.values()) for c, w in weight.items()}
            tables.append(table)
        for votes in counts:
            odds = math.log(share / (1 - share)) + sum(math.log(t[True][c] / t[False][c]) for t, c in zip(tables, votes, strict=True))
            posterior[votes] = 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))
    return posterior, share, tables
