"""The largest eigenvalues of symmetric matrices and their vectors, for many matrices of one size at a time.

`numpy.linalg.eigh` finds all vectors, and most of its time goes there. Here each matrix is brought to tridiagonal form (by
LAPACK's own routine, as numpy carries it); the largest eigenvalues of all matrices are bracketed together by Sturm counts
and refined with their vectors by twisted factorizations. What isn't proved to be them (by residuals, distances and a count), and
all in a numpy without these routines, is left to `eigh`; so results agree with it to about 1e-10.
"""

from __future__ import annotations

import ctypes

import numpy as np

#: Halvings of the first bracket in 32 bits, then in 64; and steps of refinement (each about squares the error).
HALVINGS, STEPS = ((np.float32, 13), (np.float64, 9)), 3
#: Eigenvalues nearer to each other than this are not told apart here.
APART = 1e-6
#: A residual up to this, of matrices whose entries are about one, is of rounding.
RESIDUAL = 1e-13


def _routines() -> tuple | None:
    """LAPACK's dsytrd and dormtr with 64-bit integers; None where numpy was built with another LAPACK."""
    try:
        lib = ctypes.CDLL(np.linalg._umath_linalg.__file__)
        return lib.scipy_dsytrd_64_, lib.scipy_dormtr_64_
    except (AttributeError, OSError):
        return None


def _call(routine, *args) -> None:
    """A LAPACK routine by reference: bytes are options (their lengths go last), ints and arrays as they are; info is checked."""
    info = ctypes.c_int64()
    refs = [a if isinstance(a, bytes) else ctypes.byref(ctypes.c_int64(a)) if isinstance(a, int) else ctypes.c_void_p(a.ctypes.data) for a in args]
    routine(*refs, ctypes.byref(info), *[ctypes.c_size_t(1) for a in args if isinstance(a, bytes)])
    if info.value:
        raise ValueError(f"LAPACK: {info.value}")


def tridiagonal_top(d: np.ndarray, e: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of tridiagonal matrices (diagonals d: n x b, beside them e: n - 1 x b): their k largest eigenvalues (k x b, rising), vectors
    (n x k x b), and for which matrices all of this is proved."""
    n, b = d.shape
    none = np.zeros((1, b))
    reach = np.abs(np.concatenate([none, e])) + np.abs(np.concatenate([e, none]))
    low, high = np.repeat((d - reach).min(0)[None], k, 0), np.repeat((d + reach).max(0)[None], k, 0)
    slack = (high - low) * 1e-5 + 1e-12
    e2 = np.maximum(e * e, 1e-30)  # so that nothing is 0 / 0; an inf is followed by the right count
    below = np.arange(n - k, n)[:, None]  # how many eigenvalues lie below the wanted one
    tmp, down, up, z, start = np.empty((k, b)), *(np.empty((n, k, b)) for _ in range(4))

    def pivots(q: np.ndarray, e2: np.ndarray, order: range, back: int, tmp: np.ndarray) -> None:
        """Pivots of d - theta from one end to the other, in place."""
        for i in order:
            np.divide(e2[min(i, i + back)], q[i + back], out=tmp)
            np.subtract(q[i], tmp, out=q[i])

    for kind, times in HALVINGS:
        low, high = low - slack, high + slack
        diagonal, beside, q, t = d[:, None].astype(kind), e2.astype(kind), np.empty((n, k, b), kind), np.empty((k, b), kind)
        for _ in range(times):
            x = (low + high) / 2
            np.subtract(diagonal, x.astype(kind), out=q)
            pivots(q, beside, range(1, n), -1, t)
            above = np.add.reduce((q < 0).view(np.int8), 0, dtype=np.int16) > below
            high, low = np.where(above, x, high), np.where(above, low, x)
    theta = (low + high) / 2
    for step in range(STEPS):
        np.subtract(d[:, None], theta, out=z)
        down[:], up[:] = z, z
        pivots(down, e2, range(1, n), -1, tmp)
        pivots(up, e2, range(n - 2, -1, -1), 1, tmp)
        np.subtract(down, z, out=z)
        z += up
        twist = np.abs(z, out=start).argmin(0)[None]
        gamma = np.take_along_axis(z, twist, 0)[0]
        # from the twist outwards, towards one end by one kind of pivots, towards the other by the other
        z[:], start[:] = 0, 0
        np.put_along_axis(z, twist, 1.0, 0)
        np.put_along_axis(start, twist, 1.0, 0)
        np.divide(-e[:, None], down[:-1], out=down[:-1])
        np.divide(-e[:, None], up[1:], out=up[1:])
        for i in range(n - 2, -1, -1):
            np.multiply(z[i + 1], down[i], out=tmp)
            z[i] += tmp
        for i in range(1, n):
            np.multiply(start[i - 1], up[i], out=tmp)
            start[i] += tmp
        z += start
        np.put_along_axis(z, twist, 1.0, 0)
        square = np.einsum("ikb,ikb->kb", z, z)
        residual = np.abs(gamma) / np.sqrt(square)
        if step < STEPS - 1:
            theta = theta + gamma / square
    z /= np.sqrt(square)
    # k eigenvalues apart from each other, and no more than k from the least of them upwards
    least = d - (theta[0] - APART / 2)
    pivots(least, e2, range(1, n), -1, np.empty(b))
    proved = (residual <= RESIDUAL).all(0) & (np.diff(theta, axis=0) > APART).all(0) & ((least < 0).sum(0) == n - k)
    return theta, z, proved


def largest(matrices: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of symmetric matrices (b x n x n, overwritten): the k largest eigenvalues (b x k, rising) and their vectors (b x n x k)."""
    b, n = matrices.shape[:2]
    values, vectors = np.empty((b, k)), np.empty((b, n, k))
    routines, done = _routines(), np.zeros(b, bool)
    if routines and n >= 2 and k < n:
        kept = np.diagonal(matrices, axis1=1, axis2=2).copy()
        diagonal, beside, reflectors, work = np.empty((b, n)), np.empty((b, n - 1)), np.empty((b, n - 1)), np.empty(64 * n)
        for i in range(b):  # "L" by columns is above the diagonal here; what lies below stays
            _call(routines[0], b"L", n, matrices[i], n, diagonal[i], beside[i], reflectors[i], work, 16 * n)
        with np.errstate(all="ignore"):  # what isn't finite isn't proved
            theta, z, done = tridiagonal_top(np.ascontiguousarray(diagonal.T), np.ascontiguousarray(beside.T), k)
        values, z = np.ascontiguousarray(theta.T), np.ascontiguousarray(z.transpose(2, 1, 0))
        for i in np.flatnonzero(done):
            _call(routines[1], b"L", b"L", b"N", n, k, matrices[i], n, reflectors[i], z[i], n, work, len(work))
            vectors[i] = z[i].T
        matrices[:, np.arange(n), np.arange(n)] = kept
    for i in np.flatnonzero(~done):
        value, vector = np.linalg.eigh(matrices[i], "L")
        values[i], vectors[i] = value[-k:], vector[:, -k:]
    return values, vectors
