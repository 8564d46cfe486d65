"""Incremental eigendecomposition of a scatter matrix by rank-one updates.

A spectrum is (n, mean, values, vectors): of n vectors their mean and the
eigenvalues (ascending) and eigenvectors (columns) of their centred scatter
matrix.  Adding x to Q diag(d) Q' + x x' needs the roots of the secular equation
1 + sum(z_j^2 / (d_j - mu)) = 0 with z = Q'x: one between any two neighbouring
d_j, one above the last.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
Spectrum = tuple[int, np.ndarray, np.ndarray, np.ndarray]


def secular_roots(d: np.ndarray, w: np.ndarray) -> np.ndarray:
    """For ascending distinct d and positive w: gaps[i, j] = d_j - mu_i of the roots mu.

    A root is sought as its distance from the nearer of its two poles, so that
    the gaps keep their relative accuracy however close it lies.
    """
    k = len(d)
    width = np.append(d[1:], d[-1] + w.sum()) - d
    row = np.arange(k)
    left = row[None, :] <= row[:, None]                 # poles at or below the root
    middle = 1 + (w / ((d[None, :] - d[:, None]) - width[:, None] / 2)).sum(1)
    base = np.where((middle > 0) | (row == k - 1), row, row + 1)
    diff = d[None, :] - d[base][:, None]
    lo = np.where(base > row, -width / 2, np.where(middle > 0, 0.0, width / 2))
    hi = np.where(base > row, 0.0, np.where(middle > 0, width / 2, width))
    below = diff[row, row]
    above = diff[row, np.minimum(row + 1, k - 1)]
    t, live = (lo + hi) / 2, np.ones(k, bool)
    with np.errstate(all="ignore"):
        for turn in range(200):
            gap = diff - t[:, None]
            part = w / gap
            psi, phi = (part * left).sum(1), (part * ~left).sum(1)
            f = 1 + psi + phi
            lo, hi = np.where(f > 0, lo, t), np.where(f > 0, t, hi)
            live &= (np.abs(f) > EPS * k * (1 + np.abs(psi) + np.abs(phi))) & (hi - lo > 2 * EPS * np.abs(t))
            if not live.any():
                break
            slope = part / gap
            dpsi, dphi = (slope * left).sum(1), (slope * ~left).sum(1)
            a, b = below - t, above - t
            # Each sum is replaced by a constant and one pole with its value and slope.
            c = f - a * dpsi - b * dphi
            p, q = c * (a + b) + a * a * dpsi + b * b * dphi, a * b * f
            root = np.sqrt(np.maximum(p * p - 4 * q * c, 0))
            step = np.where(p <= 0, (p - root) / (2 * c), 2 * q / (p + root))
            step[-1] = a[-1] + a[-1] ** 2 * dpsi[-1] / (f[-1] - a[-1] * dpsi[-1])
            new = t + step
            good = (new > lo) & (new < hi) if turn < 20 else np.zeros(k, bool)
            t = np.where(live, np.where(good, new, (lo + hi) / 2), t)
    return diff - t[:, None]


def _merge_close(d: np.ndarray, z: np.ndarray, vectors: np.ndarray, keep: np.ndarray, tol: float) -> None:
    """Rotate neighbours whose values are as good as equal, so that one has no share in z."""
    at = np.flatnonzero(keep)
    i = at[0]
    for j in at[1:]:
        size = np.hypot(z[i], z[j])
        c, s = z[j] / size, z[i] / size
        if (d[j] - d[i]) * abs(c * s) <= tol:
            vi, vj = vectors[:, i].copy(), vectors[:, j].copy()
            vectors[:, i], vectors[:, j] = c * vi - s * vj, s * vi + c * vj
            d[i], d[j] = c * c * d[i] + s * s * d[j], s * s * d[i] + c * c * d[j]
            z[i], z[j] = 0.0, size
            keep[i] = False
        i = j


def rank_one(values: np.ndarray, vectors: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (ascending) and vectors of vectors diag(values) vectors' + x x'."""
    z = vectors.T @ x
    norm = float(z @ z)
    if not norm > 0:
        return values, vectors
    tol = 8 * EPS * max(float(np.abs(values).max()), norm)
    d, vectors = values.copy(), vectors.copy()
    keep = np.abs(z) * np.sqrt(norm) > tol              # the others stay as they are
    if keep.sum() > 1:
        e, y = d[keep], z[keep]
        if ((e[1:] - e[:-1]) * np.abs(y[1:] * y[:-1]) <= tol * (y[1:] ** 2 + y[:-1] ** 2)).any():
            _merge_close(d, z, vectors, keep, tol)
    if keep.any():
        e = d[keep]
        order = np.argsort(e, kind="stable")
        at = np.flatnonzero(keep)[order]
        e, sign = e[order], np.sign(z[at])
        gaps = secular_roots(e, z[at] ** 2)
        # z anew from the roots, for which they are exact: the vectors are orthogonal.
        apart = e[:, None] - e[None, :]
        np.fill_diagonal(apart, 1.0)
        exact = sign * np.sqrt(np.prod(-gaps / apart, axis=0))
        turn = (exact[None, :] / gaps).T
        turn /= np.linalg.norm(turn, axis=0)
        near = np.abs(gaps).argmin(1)
        d[at] = e[near] - gaps[np.arange(len(e)), near]
        vectors[:, at] = vectors[:, at] @ turn
    order = np.argsort(d, kind="stable")
    return d[order], vectors[:, order]


def empty(dim: int) -> Spectrum:
    return 0, np.zeros(dim), np.zeros(dim), np.eye(dim)


def absorb(state: Spectrum, n: int, mean: np.ndarray, rows: np.ndarray) -> Spectrum:
    """The spectrum with n more vectors of that mean, the sum of whose centred
    squares is rows' rows: one update for each row, one for the shift of the mean."""
    held, centre, values, vectors = state
    if not n:
        return state
    for x in rows:
        values, vectors = rank_one(values, vectors, x)
    shift = mean - centre
    if held:
        values, vectors = rank_one(values, vectors, np.sqrt(held * n / (held + n)) * shift)
    return held + n, centre + shift * (n / (held + n)), values, vectors


def absorb_block(state: Spectrum, block: np.ndarray) -> Spectrum:
    """Add the rows of an integer matrix.  A block with more rows than columns is
    first turned by an orthogonal matrix into as many rows as columns, of the
    same centred scatter."""
    n = len(block)
    if not n:
        return state
    total = block.sum(0)
    rows = (n * block - total) / n
    if n > block.shape[1]:
        rows = np.linalg.qr(rows, mode="r")
    return absorb(state, n, total / n, rows)


def combine(a: Spectrum, b: Spectrum) -> Spectrum:
    """Both spectra's vectors together, by updates with b's scaled eigenvectors."""
    if a[0] < b[0]:
        a, b = b, a
    n, mean, values, vectors = b
    return absorb(a, n, mean, (vectors * np.sqrt(np.maximum(values, 0))).T)
