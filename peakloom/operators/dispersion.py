"""A count model for differential regions: negative binomial with a dispersion that regions share.

Counts of a region in replicates of one condition are taken as negative binomial with a common mean and
variance mean + dispersion * mean**2.  With equal libraries the sum of the replicates says all about the
mean, so the likelihood of the dispersion given that sum is free of it; it is evaluated on a fixed grid for
each region, and the grids are added up over all tasks.  The sum has one maximum for all regions; a region's
own dispersion is where its own curve plus a share of the common one is highest.  The test is exact: given
the total of both conditions, how likely is so large or so small a part of it in the first.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..runtime import cut_lineage
from .normalise import p_adjust

#: log2 of the dispersions that are tried: 1/512 to 8, four steps an octave.
GRID = np.arange(-9, 3.01, 0.25)
#: Degrees of freedom that the common curve counts for.
PRIOR_DF = 10.0
#: Count added on either side of a fold change, for a library of average size.
PRIOR_COUNT = 0.5
#: Outcomes of tests that are added up in one array.
STEP = 1 << 16
#: A sum ends when less than this share of it is left.
LEAST = 1e-17

_SERIES = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188, -691 / 360360)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """log of the gamma function for x > 0: shifted to 9 or more, then the asymptotic series."""
    x = np.array(x, float)
    small = np.zeros_like(x)
    low = x < 9
    if low.any():
        few = x[low]
        small[low] = np.log(np.prod([few + i for i in range(9)], axis=0))
        x[low] = few + 9
    square = 1 / (x * x)
    series = np.zeros_like(x)
    for c in reversed(_SERIES):
        series = series * square + c
    return (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + series / x - small


def _log_gammas(values: np.ndarray, size: np.ndarray) -> np.ndarray:
    """log_gamma(value + size) for all pairs, worked out once for values that repeat."""
    different, where = np.unique(values, return_inverse=True)
    return log_gamma(different[:, None] + size)[where]


def conditional_curves(counts: np.ndarray, groups: Sequence[np.ndarray]) -> np.ndarray:
    """Log-likelihood of each grid dispersion (columns) for each region (rows of ``counts``), given the group totals."""
    size = 1 / 2**GRID
    out = np.zeros((len(counts), len(size)))
    for mine in groups:
        n = len(mine)
        if n < 2:
            continue
        own = sum(_log_gammas(counts[:, j], size) for j in mine)
        out += own - _log_gammas(counts[:, mine].sum(axis=1), n * size) + log_gamma(n * size) - n * log_gamma(size)
    return out


def peak_of(curves: np.ndarray) -> np.ndarray:
    """Dispersion at the maximum of each curve: a parabola through the best grid point and its neighbours."""
    best = curves.argmax(axis=1)
    inner = np.clip(best, 1, curves.shape[1] - 2)
    row = np.arange(len(curves))
    left, here, right = curves[row, inner - 1], curves[row, inner], curves[row, inner + 1]
    bend = left - 2 * here + right
    shift = np.where(bend < 0, 0.5 * (left - right) / np.where(bend < 0, bend, 1), 0.0)
    shift = np.where(inner == best, np.clip(shift, -1, 1), best - inner)
    return 2 ** (GRID[inner] + shift * (GRID[1] - GRID[0]))


def _terms(x: np.ndarray, y: np.ndarray, size_first, size_second) -> np.ndarray:
    """log chance of x in the first and y in the second condition, but for what depends on x + y."""
    return log_gamma(x + size_first) - log_gamma(x + 1) + log_gamma(y + size_second) - log_gamma(y + 1)


def _tail(x: np.ndarray, y: np.ndarray, size_x: np.ndarray, size_y: np.ndarray) -> np.ndarray:
    """Chance of x or less beside that of x itself, with x + y given: each term follows from the one before.

    With sizes from 1 on the terms fall faster and faster once they fall, and a sum ends when what is left
    cannot change it.  Arrays hold about ``STEP`` terms.
    """
    out, at, term, done = np.ones(len(x)), np.flatnonzero(x > 0), np.ones(np.count_nonzero(x > 0)), 0
    falling = (size_x >= 1) & (size_y >= 1)
    while len(at):
        steps = done + np.arange(max(16, STEP // len(at)))
        here, other = x[at, None] - steps, y[at, None] + steps
        left = np.maximum(here, 1)
        ratio = np.where(here > 0, left * (other + size_y[at, None]) / ((left - 1 + size_x[at, None]) * (other + 1)), 0)
        terms = np.cumprod(ratio, axis=1) * term[:, None]
        out[at] += terms.sum(axis=1)
        done, term, last = done + len(steps), terms[:, -1], ratio[:, -1]
        settled = falling[at] & (last < 1) & (term * last <= LEAST * (1 - last) * out[at])
        go = (x[at] > done) & ~settled
        at, term = at[go], term[go]
    return out


def exact_p(first: np.ndarray, second: np.ndarray, size_first: np.ndarray, size_second: np.ndarray) -> np.ndarray:
    """Twice the smaller tail of ``first`` given first + second, at most 1, for negative binomials of these sizes.

    With sizes from 1 on, the tail on the near side of the mean is added up and the other one follows from it
    (neither is small where it is the difference); otherwise both are added up.
    """
    total = first + second
    front = log_gamma(total + 1.0) + log_gamma(size_first + size_second) - log_gamma(total + size_first + size_second) - log_gamma(size_first) - log_gamma(size_second)
    own = np.exp(front + _terms(first, second, size_first, size_second))
    under = first * (size_first + size_second) <= total * size_first
    pick = lambda a, b: np.where(under, a, b)
    near = own * _tail(pick(first, second), pick(second, first), pick(size_first, size_second), pick(size_second, size_first))
    far = 1 + own - near
    both = np.flatnonzero((size_first < 1) | (size_second < 1))
    far[both] = own[both] * _tail(pick(second, first)[both], pick(first, second)[both], pick(size_second, size_first)[both], pick(size_first, size_second)[both])
    return np.minimum(1, 2 * np.minimum(near, far))


def differential_counts_nb(
    counts: DataFrame, conditions: Mapping[str, Sequence[str]], libraries: Mapping[str, float] | None = None,
    prior_df: float = PRIOR_DF, prior_count: float = PRIOR_COUNT,
) -> DataFrame:
    """Per region log2 fold change (second condition over first), mean log2 CPM, dispersion, exact test and FDR.

    ``counts`` is long (``peak_id, sample, count``), a missing row is 0; ``conditions`` names the samples of
    two conditions and ``libraries`` their sizes, by default the counted reads.  Counts are scaled to the
    geometric mean of the library sizes; the test takes the condition totals as whole numbers.  Without two
    replicates in any condition there is no dispersion: it, p and fdr are null, as they are for regions
    without counts.  Samples without reads are left out of the scaling (their counts are 0).
    """
    (first, samples_1), (second, samples_2) = conditions.items()
    samples = [*samples_1, *samples_2]
    groups = [np.arange(len(samples_1)), np.arange(len(samples_1), len(samples))]
    freedom = sum(max(len(g) - 1, 0) for g in groups)
    known = counts.where(F.col("sample").isin(samples))
    # One column a sample: they are parameters, so this is one aggregation.
    wide = cut_lineage(known.groupBy("peak_id").agg(*[F.coalesce(F.sum(F.when(F.col("sample") == s, F.col("count"))), F.lit(0)).cast("double").alias(f"c{i}") for i, s in enumerate(samples)]))
    columns = [f"c{i}" for i in range(len(samples))]
    if libraries is None:
        found = wide.agg(*[F.sum(c).alias(c) for c in columns]).first()
        sizes = np.array([found[c] or 0.0 for c in columns])
    else:
        sizes = np.array([float(libraries[s]) for s in samples])
    target = float(np.exp(np.log(sizes[sizes > 0]).mean())) if (sizes > 0).any() else 1.0
    scale = np.where(sizes > 0, target / np.where(sizes > 0, sizes, 1), 1.0)

    def scaled(frame: pd.DataFrame) -> np.ndarray:
        return frame[columns].to_numpy(float) * scale

    def curves(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Sums of the curves of the regions with counts, a row a grid point and batch."""
        for frame in frames:
            y = scaled(frame)
            y = y[y.sum(axis=1) > 0]
            total = conditional_curves(y, groups).sum(axis=0)
            yield pd.DataFrame({"at": np.arange(len(GRID)), "total": total, "n": len(y)})

    shared = wide.mapInPandas(curves, "at int, total double, n long").groupBy("at").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    rows = {r["at"]: r for r in shared.collect()} if freedom else {}
    share = np.array([rows[k]["total"] / max(rows[k]["n"], 1) for k in range(len(GRID))]) if rows else np.zeros(len(GRID))
    weight = prior_df / max(freedom, 1)

    def test(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            y = scaled(frame)
            one, two = (y[:, g].sum(axis=1) for g in groups)
            out = pd.DataFrame({"peak_id": frame["peak_id"]})
            out["log_cpm"] = np.log2((y.mean(axis=1) + prior_count) * 1e6 / target)
            out["log_fc"] = np.log2((two / len(samples_2) + prior_count) / (one / len(samples_1) + prior_count))
            out["dispersion"], out["p_value"] = np.nan, np.nan
            some = np.flatnonzero(one + two > 0) if rows else np.zeros(0, int)
            if len(some):
                phi = peak_of(conditional_curves(y[some], groups) + weight * share)
                whole = np.floor(np.stack([one[some], two[some]], axis=1) + 0.5).astype(np.int64)
                p = exact_p(whole[:, 0], whole[:, 1], len(samples_1) / phi, len(samples_2) / phi)
                out.iloc[some, out.columns.get_loc("dispersion")] = phi
                out.iloc[some, out.columns.get_loc("p_value")] = p
            yield out

    kind = counts.schema["peak_id"].dataType.simpleString()
    made = wide.mapInPandas(test, f"peak_id {kind}, log_cpm double, log_fc double, dispersion double, p_value double")
    clean = made.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ("dispersion", "p_value")})
    return p_adjust(cut_lineage(clean), "p_value", "BH", name="fdr")
