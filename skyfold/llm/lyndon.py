"""Suffix arrays by Lyndon grouping (Baier 2016), in linear time and without recursive renaming."""

from __future__ import annotations

from collections import Counter


def suffix_array(text: list[int]) -> list[int]:
    """The suffixes of a list of symbols in lexicographic order, a suffix before those it is a prefix of.

    First the suffixes are grouped by their longest Lyndon prefix.  Groups start as the
    suffixes with one first symbol and are taken from the highest down.  Each member
    points to the nearest suffix before it that is in a lower group: its previous
    smaller one.  A suffix that l members point to has its prefix lengthened by l times
    the members' prefix, so such suffixes leave their group for a new one right above it,
    those with a larger l further above.

    Then the groups are filled from the smallest suffix on: each suffix, as it comes up in
    order, lets the one before it and those up its chain of pointers take the next
    place of their groups.
    """
    n = len(text)
    if not n:
        return []
    # Groups form a list from the highest down; the end of the text is a group below all.
    symbols = sorted(set(text))
    number = {c: k for k, c in enumerate(symbols)}
    group = [number[c] for c in text]
    members: list[list[int]] = [[] for _ in symbols]
    for i, g in enumerate(group):
        members[g].append(i)
    below = list(range(-1, len(symbols) - 1))
    above = [*range(1, len(symbols)), -1]
    done = [False] * len(symbols)
    before = [-1] * n
    order = []
    now = len(symbols) - 1
    while now >= 0:
        own = sorted(i for i in members[now] if group[i] == now)
        members[now] = own
        done[now] = True
        order.append(now)
        for i in own:
            p = i - 1
            while p >= 0 and done[group[p]]:
                p = before[p]
            before[i] = p
        reached = Counter(before[i] for i in own)
        del reached[-1]
        # The most pointed to first: each new group goes right above the old one, below those made before.
        moved: dict[tuple[int, int], list[int]] = {}
        for p, times in reached.items():
            moved.setdefault((times, group[p]), []).append(p)
        for (_, old), leaving in sorted(moved.items(), reverse=True):
            new = len(members)
            members.append(leaving)
            done.append(False)
            below.append(old)
            above.append(above[old])
            if above[old] >= 0:
                below[above[old]] = new
            above[old] = new
            for p in leaving:
                group[p] = new
        now = below[now]
    place, at = [0] * len(members), 0
    for g in reversed(order):
        place[g] = at
        at += len(members[g])
    out = [-1] * n

    def emit(s: int) -> None:
        while s >= 0 and not placed[s]:
            out[place[group[s]]] = s
            place[group[s]] += 1
            placed[s] = True
            s = before[s]

    placed = [False] * n
    emit(n - 1)
    for k in range(n):
        if out[k] > 0:
            emit(out[k] - 1)
    return out
