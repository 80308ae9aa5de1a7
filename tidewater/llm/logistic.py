"""Logistic regression on a small matrix of features."""

from __future__ import annotations

import numpy as np


def fit(features: np.ndarray, labels: np.ndarray, ridge: float = 1e-3, steps: int = 40) -> tuple[np.ndarray, ...]:
    """Mean, scale and weights (the last is the bias) by damped Newton steps.

    Without rows, or with labels of one kind only, the share of ones is all there is to learn:
    the weights of the features are zero.
    """
    width = features.shape[1]
    if len(labels) == 0 or labels.min() == labels.max():
        share = (labels.sum() + 0.5) / (len(labels) + 1) if len(labels) else 1e-9
        return np.zeros(width), np.ones(width), np.append(np.zeros(width), np.log(share / (1 - share)))
    mean, scale = features.mean(0), features.std(0) + 1e-9
    x = np.column_stack([(features - mean) / scale, np.ones(len(features))])
    w = np.zeros(width + 1)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(width + 1)
        step = np.linalg.solve(hessian, x.T @ (labels - p) - ridge * w)
        w += step * min(1.0, 5 / (np.abs(step).max() + 1e-9))
    return mean, scale, w


def predict(model: tuple[np.ndarray, ...], features: np.ndarray) -> np.ndarray:
    mean, scale, w = model
    return 1 / (1 + np.exp(-np.clip(((features - mean) / scale) @ w[:-1] + w[-1], -500, 500)))
