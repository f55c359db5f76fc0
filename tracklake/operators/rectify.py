"""Smoothing of trajectories: penalised least squares, with an outlier term and limits on speed, acceleration and jerk.

Built for numpy alone. D_k is the k-th difference over dt^k; z are the observed samples, H picks them:

    1/M |z - H x - e|^2 + lam2/(N-2) |D2 x|^2 + lam3/(N-3) |D3 x|^2 + lam1/M |e|_1

Without lam1, e is 0 (a free e would absorb every residual). The quadratic part is one linear solve. With an
outlier term or limits it is a convex quadratic program, solved by a primal-dual interior point method in
which e is eliminated by hand, so that each step is a solve in x alone.

Every matrix has three diagonals on either side of the main one and is kept as such (Band); a solve goes through it
block by block, so time and memory grow in proportion to the length of a series, and one method serves every length.
"""

from __future__ import annotations

from functools import lru_cache
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

DT = 1 / 30
MOST_ACCELERATION = MOST_JERK = 10.0
#: Fixed values of the weights that follow the result.
WEIGHT_STEP, TRIES, TOO_FAST = 1e-6, 11, 6.0
#: Rows of a diagonal block in a solve.
BLOCK = 48
WIDTH = 3


@lru_cache(maxsize=64)
def differences(n: int, k: int, dt: float = DT) -> np.ndarray:
    """The (n - k) x n matrix of k-th differences over dt^k."""
    return np.diff(np.eye(n), k, axis=0) / dt**k


def _taps(k: int, dt: float) -> list[float]:
    return [(-1) ** (k - a) * comb(k, a) / dt**k for a in range(k + 1)]


def _spread(y: np.ndarray, taps: list[float], n: int) -> np.ndarray:
    """The transpose of a difference, over n samples."""
    out = np.zeros(n)
    for a, c in enumerate(taps):
        out[a : a + len(y)] += c * y
    return out


class Band:
    """A symmetric matrix with WIDTH diagonals on either side: diagonals[j][i] is its entry (i, i + j)."""

    def __init__(self, diagonals: np.ndarray):
        self.diagonals = diagonals

    @classmethod
    def diagonal(cls, v: np.ndarray) -> Band:
        out = np.zeros((WIDTH + 1, len(v)))
        out[0] = v
        return cls(out)

    @classmethod
    def squares(cls, taps: list[float], w: np.ndarray, n: int) -> Band:
        """D' diag(w) D for the difference D with these taps."""
        out = np.zeros((WIDTH + 1, n))
        for a, c in enumerate(taps):
            for b in range(a, len(taps)):
                out[b - a, a : a + len(w)] += c * taps[b] * w
        return cls(out)

    def __add__(self, other: Band) -> Band:
        return Band(self.diagonals + other.diagonals)

    def times(self, by: float) -> Band:
        return Band(self.diagonals * by)

    def __matmul__(self, x: np.ndarray) -> np.ndarray:
        n, out = len(x), self.diagonals[0] * x
        for j in range(1, min(WIDTH + 1, n)):
            out[: n - j] += self.diagonals[j, : n - j] * x[j:]
            out[j:] += self.diagonals[j, : n - j] * x[: n - j]
        return out

    def _block(self, a: int, b: int) -> np.ndarray:
        n, out = b - a, np.zeros((b - a, b - a))
        for j in range(min(WIDTH + 1, n)):
            i = np.arange(n - j)
            out[i, i + j] = out[i + j, i] = self.diagonals[j, a : b - j]
        return out

    def solve(self, right: np.ndarray, ridge: float = 1e-14) -> np.ndarray:
        """x with (self + ridge) x = right: each block's unknowns as a line in the first WIDTH of the next block's."""
        n, steps = len(right), []
        corner, carried = np.zeros((0, 0)), np.zeros(0)
        for a in range(0, n, BLOCK):
            b = min(a + BLOCK, n)
            own, r = self._block(a, b), right[a:b].copy()
            own[np.arange(b - a), np.arange(b - a)] += ridge
            own[: len(corner), : len(corner)] -= corner
            r[: len(carried)] -= carried
            k = min(WIDTH, n - b)
            link = np.zeros((b - a, k))
            for j in range(1, WIDTH + 1):
                for row in range(max(a, b - j), b):
                    if row + j < b + k:
                        link[row - a, row + j - b] = self.diagonals[j, row]
            solved = np.linalg.solve(own, np.column_stack([r, link]))
            carried, corner = link.T @ solved[:, 0], link.T @ solved[:, 1:]
            steps.append((a, b, solved))
        x = np.empty(n)
        for a, b, solved in reversed(steps):
            x[a:b] = solved[:, 0] - solved[:, 1:] @ x[b : b + solved.shape[1] - 1]
        return x


def _penalty(n: int, lam2: float, lam3: float, dt: float) -> Band:
    out = Band(np.zeros((WIDTH + 1, n)))
    for k, lam in ((2, lam2), (3, lam3)):
        if lam and n > k:
            out = out + Band.squares(_taps(k, dt), np.full(n - k, lam / (n - k)), n)
    return out


def _quadratic(z: np.ndarray, lam2: float, lam3: float, dt: float) -> tuple[Band, np.ndarray, int]:
    n, seen = len(z), ~np.isnan(z)
    m = int(seen.sum())
    if m == 0 or n <= 3:
        raise ZeroDivisionError("nothing observed, or too few samples")
    return _penalty(n, lam2, lam3, dt) + Band.diagonal(seen / m), seen, m


def least_squares(z: np.ndarray, lam2: float = 0.0, lam3: float = 1e-7, dt: float = DT) -> np.ndarray:
    """The smooth series without outlier term or limits; missing samples are null in z (NaN)."""
    q, seen, m = _quadratic(z, lam2, lam3, dt)
    return q.solve(np.where(seen, z, 0.0) / m)


def _shrink(v: np.ndarray, by: float) -> np.ndarray:
    return np.sign(v) * np.maximum(np.abs(v) - by, 0.0)


class _Limits:
    """g x <= h: no backward motion, bounded acceleration and jerk; rows of g have length 1."""

    def __init__(self, n: int, direction: int | None, dt: float):
        self.n, self.parts = n, []
        if direction is not None:
            for k, signs, most in ((1, (-direction,), 0.0), (2, (1, -1), MOST_ACCELERATION), (3, (1, -1), MOST_JERK)):
                taps = _taps(k, dt)
                scale = float(np.linalg.norm(taps))
                self.parts += [(k, sign, [c / scale for c in taps], most / scale) for sign in signs]
        self.cuts = np.cumsum([n - k for k, *_ in self.parts])[:-1] if self.parts else []
        self.h = np.concatenate([np.full(n - k, h) for k, _, _, h in self.parts] or [np.zeros(0)])

    def times(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([sign * np.correlate(x, taps, "valid") for _, sign, taps, _ in self.parts] or [np.zeros(0)])

    def transposed(self, y: np.ndarray) -> np.ndarray:
        out = np.zeros(self.n)
        for own, (_, sign, taps, _) in zip(np.split(y, self.cuts), self.parts, strict=False):
            out += sign * _spread(own, taps, self.n)
        return out

    def squares(self, w: np.ndarray) -> Band:
        out = Band(np.zeros((WIDTH + 1, self.n)))
        for own, (_, _, taps, _) in zip(np.split(w, self.cuts), self.parts, strict=False):
            out = out + Band.squares(taps, own, self.n)
        return out


class NotSettled(ArithmeticError):
    """The interior point method did not reach its tolerance; `x` is where it stood."""

    def __init__(self, x: np.ndarray):
        super().__init__("no optimum within the rounds allowed")
        self.x = x


def solve(z: np.ndarray, lam1: float = 0.0, lam2: float = 0.0, lam3: float = 1e-7, direction: int | None = None, dt: float = DT, rounds: int = 100, tolerance: float = 1e-10, strict: bool = False) -> np.ndarray:
    """The series that minimises the objective; with a direction, under direction * D1 x >= 0, |D2 x| <= 10, |D3 x| <= 10.

    e = p - m with p, m >= 0. Slacks s and prices y of the limits, and prices up and um of p and m, stay
    positive; every step aims at a tenth of the present gap. Where `rounds` do not bring it to the tolerance, the last
    series is returned, or NotSettled raised if strict.
    """
    z = np.asarray(z, float)
    if not lam1 and direction is None:
        return least_squares(z, lam2, lam3, dt)
    q, seen, count = _quadratic(z, lam2, lam3, dt)
    n, a = len(z), 2 / count
    smooth = _penalty(n, lam2, lam3, dt).times(2.0)
    known = np.where(seen, z, 0.0)
    limits = _Limits(n, direction, dt)
    h = limits.h
    x = q.solve(known / count)
    s, y = np.maximum(h - limits.times(x), 1.0), np.ones(len(h))
    p, m = np.where(seen, 1.0, 0.0), np.where(seen, 1.0, 0.0)
    up = um = np.where(seen, max(lam1, 1e-3) / count, 0.0)
    pairs = len(h) + (2 * count if lam1 else 0)
    safe = lambda v: np.where(seen, v, 1.0)
    for _ in range(rounds):
        r = np.where(seen, known - x - (p - m if lam1 else 0.0), 0.0)
        off = limits.times(x) + s - h
        gap = (s @ y + (p @ up + m @ um if lam1 else 0.0)) / max(pairs, 1)
        slope_x = smooth @ x - a * r + limits.transposed(y)
        slope_p, slope_m = (np.where(seen, lam1 / count - sign * a * r - u, 0.0) for sign, u in ((1, up), (-1, um)))
        worst = max(np.abs(slope_x).max(), np.abs(off).max(initial=0.0), np.abs(slope_p).max() if lam1 else 0.0, np.abs(slope_m).max() if lam1 else 0.0)
        if gap < tolerance and worst < 1e-8:
            break
        aim, w = 0.1 * gap, y / s
        right = -slope_x - limits.transposed(aim / s - y + w * off)
        matrix = smooth + limits.squares(w)
        if lam1:
            wp, wm = up / safe(p), um / safe(m)
            bp, bm = -slope_p + aim / safe(p) - up, -slope_m + aim / safe(m) - um
            det = safe(a * (wp + wm) + wp * wm)
            matrix = matrix + Band.diagonal(np.where(seen, a * wp * wm / det, 0.0))
            right = right - np.where(seen, a * (wm * bp - wp * bm) / det, 0.0)
        else:
            matrix = matrix + Band.diagonal(a * seen)
        dx = matrix.solve(right)
        ds = -off - limits.times(dx)
        dy = aim / s - y - w * ds
        moves = [(s, ds), (y, dy)]
        if lam1:
            dp, dm = (np.where(seen, v / det, 0.0) for v in ((a + wm) * bp + a * bm - a * wm * dx, a * bp + (a + wp) * bm + a * wp * dx))
            dup, dum = (np.where(seen, aim / safe(v) - u - wv * dv, 0.0) for v, u, wv, dv in ((p, up, wp, dp), (m, um, wm, dm)))
            moves += [(p, dp), (m, dm), (up, dup), (um, dum)]
        step = min([1.0, *(0.99 * float((v[d < 0] / -d[d < 0]).min()) for v, d in moves if (d < 0).any())])
        x, s, y = x + step * dx, s + step * ds, y + step * dy
        if lam1:
            p, m, up, um = p + step * dp, m + step * dm, up + step * dup, um + step * dum
    else:
        if strict:
            raise NotSettled(x)
    return x


def objective(x: np.ndarray, z: np.ndarray, lam1: float, lam2: float, lam3: float, dt: float = DT) -> float:
    """The objective at x with the best e."""
    seen = ~np.isnan(z)
    m, n = int(seen.sum()), len(z)
    r = (z - x)[seen]
    e = _shrink(r, lam1 / 2) if lam1 else np.zeros(len(r))
    return float(((r - e) ** 2).sum() / m + lam1 / m * np.abs(e).sum() + lam2 / (n - 2) * ((differences(n, 2, dt) @ x) ** 2).sum() + lam3 / (n - 3) * ((differences(n, 3, dt) @ x) ** 2).sum())


def mean_error(x: np.ndarray, z: np.ndarray) -> float:
    return float(np.nanmean(np.abs(x - z)))


def with_growing_outlier_term(z: np.ndarray, lam1: float, lam2: float, lam3: float, direction: int | None, dt: float = DT, step: float = 1e-3, most: int = 11, rounds: int = 100) -> tuple[np.ndarray, float]:
    """Solves with lam1 raised by `step` until the mean error on observed samples stops falling."""
    before, error, x = 999.0, 998.0, None
    for _ in range(most):
        if error >= before:
            break
        lam1 += step
        x = solve(z, lam1, lam2, lam3, direction, dt, rounds)
        before, error = error, mean_error(x, z)
    return x, error


def receding(z: np.ndarray, horizon: int, step: int, lam1: float = 0.0, lam2: float = 0.0, lam3: float = 1e-7, dt: float = DT, fixed: int = 3) -> np.ndarray:
    """Windows of `horizon` samples that advance by `step`; the first `fixed` states of each are those of the last.

    A window without observations follows from its first states and the smoothness alone.
    """
    z = np.asarray(z, float)
    out = np.full(len(z), np.nan)
    for start in range(0, max(1, len(z) - fixed), step):
        stop = min(start + horizon, len(z))
        own, n = z[start:stop], stop - start
        k = min(fixed, n) if start else 0
        if n <= 3:
            out[start + k : stop] = own[k:] if not np.isnan(own[k:]).any() else out[start + k - 1]
            break
        seen = ~np.isnan(own)
        m = max(1, int(seen.sum()))
        q = _penalty(n, lam2, lam3, dt) + Band.diagonal(seen / m)
        free = Band(q.diagonals[:, k:])
        x = np.zeros(n)
        x[:k] = out[start : start + k]
        known = (q @ x)[k:]
        x[k:] = free.solve((np.where(seen, own, 0.0) / m)[k:] - known)
        if lam1:
            for _ in range(20):  # outliers by turns of e and x
                e = np.where(seen, _shrink(np.where(seen, own, 0.0) - x, lam1 / 2), 0.0)
                x[k:] = free.solve((np.where(seen, own - e, 0.0) / m)[k:] - known)
        out[start:stop] = x
        if stop == len(z):
            break
    return out


#: status: solved; not settled, where the rounds did not suffice and x, y are the last iterate; failed, where x, y are null.
_SCHEMA = "id long, slot long, x double, y double, x_score double, y_score double, status string"
METHODS = ("opt1", "opt2", "opt1_l1", "opt2_l1", "constrained", "receding")


def adaptive(z: np.ndarray, lam1: float, lam2: float, lam3: float, direction: int, dt: float = DT, rounds: int = 100) -> np.ndarray:
    """The outlier term and both penalties, with weights that follow the result, each WEIGHT_STEP at a time: lam3 grows
    while the slowest step goes backward, then lam2 while an acceleration exceeds TOO_FAST, then lam1 while
    that makes the mean error smaller. Every weight is tried TRIES times at most and stays one step above its last try."""

    def tried(weights: dict, name: str, enough) -> np.ndarray:
        for _ in range(TRIES):
            x = solve(z, weights["lam1"], weights["lam2"], weights["lam3"], None, dt, rounds, strict=True)
            weights[name] += WEIGHT_STEP
            if enough(x):
                break
        return x

    weights = {"lam1": lam1, "lam2": lam2, "lam3": lam3}
    fastest = lambda x: np.abs(np.diff(x, 2)).max() / dt**2
    x = tried(weights, "lam3", lambda x: (direction * np.diff(x)).min() >= 0)
    if fastest(x) > TOO_FAST:
        x = tried(weights, "lam2", lambda x: fastest(x) <= TOO_FAST)
    weights["lam1"] += WEIGHT_STEP
    errors = [mean_error(x, z)]

    def no_better(x):
        errors.append(mean_error(x, z))
        return errors[-1] >= errors[-2]

    return tried(weights, "lam1", no_better)


def rectified(grid: DataFrame, method: str = "constrained", lam1: float = 1e-3, lam2: float = 0.0, lam3: float = 1e-7, dt: float = DT, horizon: int = 400, rounds: int = 60) -> DataFrame:
    """Smooth series of each id; grid: id, slot, x, y (null: missing), direction, on consecutive slots.

    method: opt1 (third differences), opt2 (second and third), opt1_l1, opt2_l1 (x with weights that follow the result),
    constrained, receding (windows of `horizon` samples). Each is the same at every length; one id's series is one task's work, in time proportional to
    its length. Ids of at most three slots, or without any observed x or y, are left out; `status` tells of ids
    whose solve failed (their x and y are null) or did not settle.
    """
    if method not in METHODS:
        raise ValueError(f"unknown method: {method}")

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("slot")
        x, y = pdf["x"].to_numpy(float, na_value=np.nan), pdf["y"].to_numpy(float, na_value=np.nan)
        direction = int(pdf["direction"].iloc[0])
        l2 = lam2 or (1e-5 if method in ("opt2", "opt2_l1") else 0.0)
        if len(x) <= 3 or np.isnan(x).all() or np.isnan(y).all():
            return pd.DataFrame({c.split()[0]: pd.Series([], dtype=object) for c in _SCHEMA.split(", ")})
        base, status = np.nanmin(x), "solved"
        own = lam1 if method.endswith("l1") else 0.0

        def settled(v, *args, by=lambda *a: solve(*a, strict=True)):
            nonlocal status
            try:
                return by(v, *args, dt, rounds)
            except NotSettled as stopped:
                status = "not settled"
                return stopped.x

        try:
            if method == "receding":
                fx, fy = (receding(v, horizon, max(1, horizon // 2), own, l2, lam3, dt) for v in (x - base, y))
            elif method == "constrained":
                fx, _ = with_growing_outlier_term(x - base, lam1, l2, lam3, direction, dt, rounds=rounds)
                fy = settled(y, 0.0, l2, lam3, None)
            else:
                fx = settled(x - base, own, l2, lam3, direction, by=adaptive) if method == "opt2_l1" else settled(x - base, own, l2, lam3, None)
                fy = settled(y, own, l2, lam3, None)
            fx = fx + base
        except np.linalg.LinAlgError:
            status, fx, fy = "failed", np.full(len(x), np.nan), np.full(len(y), np.nan)
        own_score = (lambda f, v: mean_error(f, v)) if status != "failed" else lambda f, v: np.nan
        told = pd.Series([status] * len(pdf), index=pdf.index, dtype=object)
        return pd.DataFrame({"id": pdf["id"], "slot": pdf["slot"], "x": fx, "y": fy, "x_score": own_score(fx, x), "y_score": own_score(fy, y), "status": told})

    return grid.groupBy("id").applyInPandas(one, _SCHEMA)


def savitzky_golay(v: np.ndarray, window: int, order: int = 3) -> np.ndarray:
    """Local polynomial smoothing; the ends take the polynomial of the first and last full window."""
    n = len(v)
    window = min(window, n if n % 2 else n - 1)
    if window <= order:
        return v.copy()
    half = window // 2
    basis = np.vander(np.arange(-half, half + 1), order + 1, increasing=True)
    projector = basis @ np.linalg.pinv(basis)
    middle = np.convolve(v, projector[half][::-1], mode="valid")
    return np.concatenate([projector[:half] @ v[:window], middle, projector[half + 1 :] @ v[-window:]])


def ransac_line(t: np.ndarray, v: np.ndarray, threshold: float, rounds: int = 100, seed: int = 0) -> tuple[float, float, np.ndarray]:
    """A robust line: slope, intercept and the inliers of the best of `rounds` seeded two-point lines, refitted."""
    rng = np.random.default_rng(seed)
    best = np.zeros(len(t), bool)
    for _ in range(rounds):
        i, j = rng.choice(len(t), 2, replace=False)
        if t[i] == t[j]:
            continue
        slope = (v[j] - v[i]) / (t[j] - t[i])
        inside = np.abs(v - (v[i] + slope * (t - t[i]))) <= threshold
        if inside.sum() > best.sum():
            best = inside
    if best.sum() < 2:
        best = np.ones(len(t), bool)
    slope, intercept = np.polyfit(t[best], v[best], 1)
    return float(slope), float(intercept), best
