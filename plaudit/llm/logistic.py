"""Logistic regression on a few features of a bounded sample, by Newton steps."""

from __future__ import annotations

import numpy as np


class Logistic:
    """Probability of label 1. Features are centred and scaled; a label that is missing leaves the smoothed share."""

    def __init__(self, features: np.ndarray, labels: np.ndarray, ridge: float = 1.0, balanced: bool = False) -> None:
        features, labels = np.asarray(features, float), np.asarray(labels, float)
        self.mean = features.mean(axis=0) if len(features) else np.zeros(features.shape[1])
        self.scale = np.maximum(features.std(axis=0), 1e-9) if len(features) else np.ones(features.shape[1])
        ones = labels.sum()
        share = (ones + 1) / (len(labels) + 2)
        self.weights = np.zeros(features.shape[1] + 1)
        self.weights[0] = np.log(share / (1 - share))
        if not 0 < ones < len(labels):
            return
        x = self._design(features)
        weight = np.where(labels == 1, 0.5 / ones, 0.5 / (len(labels) - ones)) * len(labels) if balanced else 1.0
        penalty = np.full(x.shape[1], ridge)
        penalty[0] = 1e-6
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))
            slope = x.T @ (weight * (p - labels)) + penalty * self.weights
            bend = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(penalty)
            step = np.linalg.solve(bend, slope)
            self.weights -= np.clip(step, -5, 5)
            if np.abs(step).max() < 1e-8:
                break

    def _design(self, features: np.ndarray) -> np.ndarray:
        return np.c_[np.ones(len(features)), np.clip((features - self.mean) / self.scale, -8, 8)]

    def __call__(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._design(np.asarray(features, float)) @ self.weights, -30, 30)))
