"""Poisson regressions of several training sets at the same time.

Newton steps on the log link. A step is one scan, in which every row adds to the gradient and
curvature of all training sets it belongs to; a few numbers for each set come back.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthtide.operators.moments import LABEL, LinearFit, Moments, feature_columns

MAX_STEPS = 100
#: The last step is the one that promises to raise the log-likelihood by less than this share.
TOLERANCE = 1e-10
#: Sums in another order differ by less than this share.
ROUNDING = 1e-12


def fit_poisson(
    data: DataFrame, members: Sequence[Column], known: Sequence[Moments], label: str = LABEL
) -> list[LinearFit]:
    """A fit for each training set: the rows of ``data`` where its column is true.

    ``known`` are the sets' moments, which centre and scale the features and give the start. A
    step that would lower the likelihood is halved.
    """
    names = feature_columns(data)
    size = len(names) + 1
    for m in known:
        if not m.rows or m.means[-1] <= 0:
            raise ValueError("a Poisson regression needs rows, and a label above 0 in one of them")
    scales = []
    for m in known:
        scale = np.sqrt(np.maximum(np.diag(m.spread)[:-1], 0.0) / m.rows)
        scales.append(np.where(scale > 0, scale, np.inf))
    at = [np.append(np.log(m.means[-1]), np.zeros(size - 1)) for m in known]
    best: list[tuple[float, np.ndarray] | None] = [None] * len(at)
    open_ = list(range(len(at)))
    for _ in range(MAX_STEPS):
        found = data.agg(
            *[c for k in open_ for c in _step(names, members[k], known[k], scales[k], at[k], k, label)]
        ).first()
        still = []
        for k in open_:
            height = found[f"height_{k}"]
            if best[k] is not None and not height >= best[k][0] - ROUNDING * abs(best[k][0]):
                # too far, or not a number: half way back
                at[k] = (best[k][1] + at[k]) / 2
                still.append(k)
                continue
            best[k] = (height, at[k])
            slope = np.array([found[f"slope_{k}_{i}"] for i in range(size)])
            curve = np.zeros((size, size))
            for i in range(size):
                for j in range(i + 1):
                    curve[i, j] = curve[j, i] = found[f"curve_{k}_{i}_{j}"]
            move = np.linalg.lstsq(curve, slope, rcond=1e-12)[0]
            at[k] = at[k] + move
            if slope @ move > TOLERANCE * max(1.0, abs(height)):
                still.append(k)
        open_ = still
        if not open_:
            break
    fits = []
    for x, m, scale in zip(at, known, scales):
        weights = x[1:] / scale
        fits.append(LinearFit(float(x[0] - weights @ m.means[:-1]), weights, log_link=True))
    return fits


def _step(
    names: list[str], member: Column, m: Moments, scale: np.ndarray, x: np.ndarray, k: int, label: str
) -> list[Column]:
    """The log-likelihood (but for a constant), its slope and its curvature of a training set."""
    y = F.col(label).cast("double")
    features = [F.lit(1.0)] + [
        (F.col(c).cast("double") - float(mean)) / float(s) if np.isfinite(s) else F.lit(0.0)
        for c, mean, s in zip(names, m.means, scale)
    ]
    score = sum((F.lit(float(v)) * f for v, f in zip(x[1:], features[1:])), F.lit(float(x[0])))
    mean = F.exp(score)

    def total(value: Column, name: str) -> Column:
        return F.sum(F.when(member, value)).alias(name)

    out = [total(y * score - mean, f"height_{k}")]
    out += [total((y - mean) * f, f"slope_{k}_{i}") for i, f in enumerate(features)]
    out += [
        total(mean * features[i] * features[j], f"curve_{k}_{i}_{j}")
        for i in range(len(features))
        for j in range(i + 1)
    ]
    return out
