"""Fits of curves with many epochs, cut into stretches that any task may hold.

An ordinary curve is fitted in the task that has its row.  One with more than ``LONG`` epochs
is laid out as rows, a stretch of epochs each, dealt out by curve and stretch; what a
stretch adds to a fit is small and is merged by Spark: sums by ``sum``, the likelihood of
a random walk by a fold over stretches in order.  So the time of one curve falls with the
number of tasks, and no task holds more of it than a stretch and the merged numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfold.features import kernels, walk
from skyfold.functions.curves import bound, differences, mean, ratio, total, with_curve, with_expressions
from skyfold.workspace import checkpointed

#: Epochs of a stretch, and of the longest curve that stays whole.
LONG = 4096


def keyed(df: DataFrame) -> DataFrame:
    """The curves stored once, with ``_key`` to join by: rows that share it are the same curve in all values."""
    values = F.to_json(F.struct("objectid", "_t", "_m", "_e"))
    return checkpointed(with_curve(df).withColumn("_key", F.sha2(values, 256)), "long-curves")


def stretched(curves: DataFrame, **arrays: str) -> DataFrame:
    """``_key``, ``_part`` and the slices of some arrays (SQL text), dealt out by curve and stretch and stored.

    What is asked of a curve is joined to its stretches: few curves by broadcast, so that tasks keep their
    stretches, many by key, so that tasks have curves.  Spark chooses by size.
    """
    whole = with_expressions(curves.dropDuplicates(["_key"]), **arrays).select("_key", "_n", *arrays)
    rows = whole.withColumn("_part", F.explode(F.expr(f"sequence(0, greatest(int(_n) - 1, 0) div {LONG})")))
    cut = [F.slice(name, F.col("_part") * LONG + 1, LONG).alias(name) for name in arrays]
    # Much work for few bytes, so the number of partitions is kept.
    parts = int(curves.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return checkpointed(rows.select("_key", "_part", *cut).repartition(parts, "_key", "_part"), "stretches")


# ---------------------------------------------------------------- random walk


def _walk_parts(stretches: DataFrame, asked: DataFrame) -> DataFrame:
    """The six numbers of each stretch for each trial: ``_key``, ``_part``, ``trial``, ``amplitude`` and ``walk.PARTS``."""
    names = ("amplitude", *walk.PARTS)

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for key, part, *lists in zip(*(c.to_pylist() for c in frame.columns), strict=True):
                gaps, y, noise, amplitude, rate = (np.array(x, dtype=float) for x in lists)
                width = min(len(y), walk.STRETCH)
                short = -len(y) % width
                lanes = [np.pad(x, (0, short), constant_values=v).reshape(-1, width) for x, v in ((gaps, 0), (y, 0), (noise, 1), (np.ones(len(y)), 0))]
                with np.errstate(all="ignore"):
                    found = walk.stretches(*lanes, *np.broadcast_to(np.stack([amplitude, rate])[:, None], (2, len(lanes[0]), len(rate))))
                # Every lane is a stretch of its own: they are joined where those of other tasks are.
                trials, count = len(rate), len(lanes[0])
                columns = [np.tile(np.arange(trials, dtype=np.int32), count), np.tile(amplitude, count), *(p.ravel() for p in found)]
                place = np.repeat(part * 1_000_000 + np.arange(count), trials)
                yield pa.RecordBatch.from_arrays([pa.array([key] * (trials * count)), pa.array(place), *map(pa.array, columns)], ["_key", "_part", "trial", *names])

    joined = stretches.join(asked, "_key").select("_key", F.col("_part").cast("long"), "_gap", "_y", "_noise", "amplitude", "rate")
    return joined.mapInArrow(run, "_key string, _part long, trial int, " + ", ".join(f"{n} double" for n in names))


def _walk_scores(parts: DataFrame) -> DataFrame:
    """``_key`` and ``scores``: the log-likelihood of every trial, in order."""
    whole = parts.groupBy("_key", "trial", "amplitude").agg(F.sort_array(F.collect_list(F.struct("_part", *walk.PARTS))).alias("parts"))
    scored = whole.select("_key", "trial", F.expr(walk.JOINED_SQL).alias("score"))
    return scored.groupBy("_key").agg(F.sort_array(F.collect_list(F.struct("trial", "score")))["score"].alias("scores"))


def _searched(curves: DataFrame, process: Callable, axes: list[np.ndarray], rounds: int | None, scaled: bool) -> DataFrame:
    """``_key`` and ``_best``: the best point of each curve and its score last (see ``walk.Search``), a round of trials at a time."""
    usable = "_n > 1 and array_max(_m) > array_min(_m)" if scaled else "_n > 1"
    curves = curves.where(usable)
    scale = f"if({str(scaled).lower()}, sqrt({ratio(total('_d', 'x*x'), '_n - 1')}), 1D)"
    stretches = stretched(
        curves,
        # The process is at rest before the first epoch, as it is after an endless gap.
        _gap=f"concat(array(double('inf')), {differences('_t')})",
        _d=bound("o", mean("_m"), "transform(_m, x -> x - o)"),
        _y=bound("s", scale, f"transform(_d, x -> {ratio('x', 's')})"),
        _noise=bound("s", scale, f"transform(_e, x -> {ratio('x*x', 's*s')})"),
    )
    width = len(axes) + 1

    def at(turn: int, best: pd.Series, half: pd.Series) -> walk.Search:
        found = walk.Search(axes, len(best), rounds)
        found.turn = turn
        if turn:
            found.best, found.half = np.stack(best), np.stack(half)
        return found

    nothing = F.lit(None).cast("array<double>")
    state = curves.select("_key").distinct().select("_key", nothing.alias("best"), nothing.alias("half"), F.lit(True).alias("active"))
    state, done, turn = checkpointed(state, "search"), None, 0
    while True:

        @F.pandas_udf("amplitude array<double>, rate array<double>")
        def propose(best: pd.Series, half: pd.Series) -> pd.DataFrame:
            amplitude, rate = process(*at(turn, best, half).trials())
            return pd.DataFrame({"amplitude": list(amplitude), "rate": list(rate)})

        @F.pandas_udf("best array<double>, half array<double>, active boolean")
        def advance(best: pd.Series, half: pd.Series, scores: pd.Series) -> pd.DataFrame:
            found = at(turn, best, half)
            found.advance(found.trials(), np.stack(scores).astype(float))
            return pd.DataFrame({"best": list(found.best), "half": list(found.half), "active": found.active})

        asked = state.withColumn("_at", propose("best", "half")).select("_key", "_at.amplitude", "_at.rate")
        scores = _walk_scores(_walk_parts(stretches, asked))
        moved = state.join(scores, "_key").withColumn("_at", advance("best", "half", "scores")).select("_key", "_at.*")
        moved = checkpointed(moved, "search")
        ended = moved.where(~F.col("active")).select("_key", F.col("best").alias("_best"))
        done = ended if done is None else done.union(ended)
        state, turn = moved.where("active"), turn + 1
        if state.isEmpty():
            return done.where(F.size("_best") == width)


def with_random_walk(curves: DataFrame, log_amplitude: tuple, log_rate: tuple, rounds: int | None = None) -> DataFrame:
    """``GP_DRW_sigma``, ``GP_DRW_tau`` and ``_walk_score`` of keyed curves."""
    found = _searched(curves, walk.walk_process, [np.linspace(*log_amplitude), np.linspace(*log_rate)], rounds, scaled=False)
    named = found.selectExpr("_key", "exp(_best[0]) as GP_DRW_sigma", "exp(-_best[1]) as GP_DRW_tau", "_best[2] as _walk_score")
    return curves.join(named, "_key", "left")


def with_autoregression(curves: DataFrame, phis: tuple, rounds: int | None = None) -> DataFrame:
    """``IAR_phi`` and ``_iar_score`` of keyed curves."""
    found = _searched(curves, walk.autoregression_process, [np.linspace(*phis)], rounds, scaled=True)
    return curves.join(found.selectExpr("_key", "_best[0] as IAR_phi", "_best[1] as _iar_score"), "_key", "left")


# ---------------------------------------------------------------- periodogram

_SUMS = ("c", "s", "yc", "ys", "c2", "s2")


def _power_sql() -> str:
    """The statistic of ``kernels.aov`` as SQL text, from the six sums and ``n``, ``ym``, ``spread`` of the curve."""
    yc, ys = "(yc - ym*c)", "(ys - ym*s)"
    cc, ss, cs = "((1 + c2)/2 - c*c)", "((1 - c2)/2 - s*s)", "(s2/2 - c*s)"
    det = f"({cc}*{ss} - {cs}*{cs})"
    share = f"least(greatest(({ss}*{yc}*{yc} + {cc}*{ys}*{ys} - 2*{cs}*{yc}*{ys})/(spread*{det}), 0D), 1D - 1e-9D)"
    return f"(n - 3)/2D*(if({det} > 1e-9D, {share}, 0D)/(1 - if({det} > 1e-9D, {share}, 0D)))"


def _summed(parts: DataFrame, base: DataFrame, value: str) -> DataFrame:
    """``_key``, ``k`` and ``power``: the sums of the stretches (arrays by name in ``_SUMS``) added up, trial by trial."""
    rows = parts.select("_key", F.posexplode(F.arrays_zip(*(F.col(f"{value}.{n}").alias(n) for n in _SUMS))).alias("k", "z")).select("_key", "k", "z.*")
    sums = rows.groupBy("_key", "k").agg(*(F.sum(n).alias(n) for n in _SUMS))
    return sums.join(base, "_key").selectExpr("_key", "k", f"{_power_sql()} as power")


def _columns(sums: list[np.ndarray]) -> pd.DataFrame:
    """One row of six arrays for each stretch."""
    rows = [(c.real, c.imag, y.real, y.imag, d.real, d.imag) for c, y, d in sums]
    return pd.DataFrame(rows, columns=list(_SUMS))


_STRUCT = ", ".join(f"{n} array<double>" for n in _SUMS)


def with_period(curves: DataFrame, start: float, step: float, count: int, top: int, optima: int, fine_step: float) -> DataFrame:
    """``_best`` (``freq``, ``power``, ``top``) of keyed curves, as ``kernels.best_period`` has it."""
    usable = curves.where("_n >= 4 and forall(_e, x -> x > 0) and forall(_t, x -> abs(x) < double('inf')) and forall(_m, x -> abs(x) < double('inf'))")
    usable = usable.where("array_max(_m) > array_min(_m)")
    stretches = stretched(
        usable,
        _u=bound("o", "_t[0]", "transform(_t, x -> x - o)"),
        _w=bound("s", total("_e", ratio("1D", "x*x")), f"transform(_e, x -> {ratio('1D', 'x*x*s')})"),
        _y=bound("o", mean("_m"), "transform(_m, x -> x - o)"),
    )
    base = stretches.groupBy("_key").agg(*(F.sum(F.expr(e)).alias(n) for n, e in (
        ("n", "size(_u)"), ("ym", total("zip_with(_w, _y, (w, y) -> w*y)")), ("yy", total("zip_with(_w, _y, (w, y) -> w*y*y)"))
    )))
    base = checkpointed(base.selectExpr("_key", "n", "ym", "yy - ym*ym as spread"), "long-curve-spreads")

    @F.pandas_udf(_STRUCT)
    def on_grid(times: pd.Series, weights: pd.Series, mags: pd.Series) -> pd.DataFrame:
        return _columns([kernels.grid_sums(*curve, start, step, count) for curve in zip(times, weights, mags, strict=True)])

    @F.pandas_udf(_STRUCT)
    def at_listed(times: pd.Series, weights: pd.Series, mags: pd.Series, freqs: pd.Series) -> pd.DataFrame:
        return _columns([kernels.direct_sums(*row) for row in zip(times, weights, mags, freqs, strict=True)])

    @F.pandas_udf("freq double, power double, top array<double>, near array<double>")
    def picked(powers: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([kernels.picks(p, start, step, top, optima, fine_step) for p in powers], columns=["freq", "power", "top", "near"])

    power = _summed(stretches.withColumn("sums", on_grid("_u", "_w", "_y")), base, "sums")
    # As many powers as the grid has frequencies, whatever the epochs.
    whole = power.groupBy("_key").agg(F.sort_array(F.collect_list(F.struct("k", "power")))["power"].alias("powers"))
    coarse = checkpointed(whole.select("_key", picked("powers").alias("at")).select("_key", "at.*"), "long-curve-peaks")
    near = coarse.select("_key", "near").where(F.size("near") > 0)
    fine = _summed(stretches.join(near, "_key").withColumn("sums", at_listed("_u", "_w", "_y", "near")), base, "sums")
    finest = fine.groupBy("_key").agg(F.max_by("k", F.struct("power", -F.col("k"))).alias("place"), F.max("power").alias("refined"))
    found = coarse.join(finest, "_key", "left")
    better = F.coalesce(F.col("refined") > F.col("power"), F.lit(False))
    best = F.struct(
        F.when(better, F.get("near", F.col("place"))).otherwise(F.col("freq")).alias("freq"), F.when(better, F.col("refined")).otherwise(F.col("power")).alias("power"), "top"
    )
    return curves.join(found.select("_key", best.alias("_best")), "_key", "left")
