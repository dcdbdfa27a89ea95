"""Linear solvers over summary matrices.

Everything here works on p x p matrices of sums that Spark has already aggregated; no row is seen.
`S` is the centred cross-product of the features, `r` the centred cross-product with the target.
"""

from __future__ import annotations

import numpy as np


def ols(S: np.ndarray, r: np.ndarray) -> np.ndarray:
    return np.linalg.lstsq(S, r, rcond=1e-10)[0]


def ridge(S: np.ndarray, r: np.ndarray, alpha: float) -> np.ndarray:
    """min ||y - Xw||^2 + alpha ||w||^2"""
    if alpha < 0:
        raise ValueError("alpha must not be negative")
    if alpha == 0:
        return ols(S, r)
    return np.linalg.solve(S + alpha * np.eye(len(r)), r)


def elastic_net(
    S: np.ndarray, r: np.ndarray, n: float, alpha: float, l1_ratio: float,
    max_iter: int = 20000, tol: float = 1e-7, start: np.ndarray | None = None,
) -> np.ndarray:
    """min 1/(2n) ||y - Xw||^2 + alpha l1_ratio ||w||_1 + alpha (1 - l1_ratio)/2 ||w||^2.

    Coordinate descent with covariance updates (Friedman, Hastie and Tibshirani, 2010).
    """
    if alpha < 0:
        raise ValueError("alpha must not be negative")
    A, b = S / n, r / n
    p = len(b)
    l1, l2 = alpha * l1_ratio, alpha * (1 - l1_ratio)
    w = np.zeros(p) if start is None else start.copy()
    grad = b - A @ w
    diag = A.diagonal()
    usable = np.flatnonzero(diag > 1e-14)
    active = usable
    for it in range(max_iter):
        change = 0.0
        for j in active:
            old = w[j]
            rho = grad[j] + diag[j] * old
            new = np.sign(rho) * max(abs(rho) - l1, 0.0) / (diag[j] + l2)
            if new != old:
                grad -= A[:, j] * (new - old)
                w[j] = new
                change = max(change, abs(new - old) * np.sqrt(diag[j]))
        if change < tol:
            if len(active) == len(usable):
                break
            active = usable  # the working set is settled: check every coordinate again
        else:
            active = np.flatnonzero(w) if it % 10 else usable
    return w


def lasso(S: np.ndarray, r: np.ndarray, n: float, alpha: float, **kw) -> np.ndarray:
    return elastic_net(S, r, n, alpha, 1.0, **kw)


def bayesian_ridge(
    S: np.ndarray, r: np.ndarray, yy: float, n: float, alpha_1: float = 1e-6, alpha_2: float = 1e-6,
    lambda_1: float = 1e-6, lambda_2: float = 1e-6, max_iter: int = 300, tol: float = 1e-3,
    spectrum: tuple[np.ndarray, np.ndarray] | None = None,
) -> np.ndarray:
    """Evidence maximisation over noise precision a and weight precision l (MacKay, 1992).

    One eigen-decomposition of S; each iteration is then a few vector operations.
    """
    values, vectors = spectrum if spectrum is not None else np.linalg.eigh(S)
    values = np.maximum(values, 0.0)
    rot = vectors.T @ r
    a = 1.0 / (yy / n + np.finfo(float).eps)
    lam = 1.0
    old = None
    for _ in range(max_iter):
        coef = vectors @ (rot / (values + lam / a))
        sse = max(yy - 2 * coef @ r + coef @ S @ coef, 0.0)
        gamma = np.sum(a * values / (lam + a * values))
        lam = (gamma + 2 * lambda_1) / (coef @ coef + 2 * lambda_2)
        a = (n - gamma + 2 * alpha_1) / (sse + 2 * alpha_2)
        if old is not None and np.abs(old - coef).sum() < tol:
            break
        old = coef
    return vectors @ (rot / (values + lam / a))
