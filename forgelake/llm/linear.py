"""Sparse multinomial logistic regression: follow-the-regularised-leader, then a temperature."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Settings:
    """Step size, its offset, and the two parts of the elastic-net penalty."""

    alpha: float = 0.1
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.5
    epochs: int = 4


class FollowTheLeader:
    """Weights are kept as sums of gradients; a weight is zero until its sum outgrows ``l1``."""

    def __init__(self, classes: int, features: int, settings: Settings | None = None):
        self.s = settings or Settings()
        self.z = np.zeros((features + 1, classes))
        self.n = np.zeros((features + 1, classes))

    def weights(self, rows=slice(None)) -> np.ndarray:
        z, n, s = self.z[rows], self.n[rows], self.s
        shrunk = -(z - np.sign(z) * s.l1) / ((s.beta + np.sqrt(n)) / s.alpha + s.l2)
        return np.where(np.abs(z) <= s.l1, 0.0, shrunk)

    def fit_one(self, index: np.ndarray, value: np.ndarray, label: int, weight: float = 1.0) -> None:
        """One example; its last feature, always 1, is the intercept."""
        index = np.append(index, len(self.z) - 1)
        value = np.append(value, 1.0)
        w = self.weights(index)
        error = softmax(value @ w)
        error[label] -= 1.0
        g = weight * value[:, None] * error[None, :]
        n = self.n[index]
        self.z[index] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.s.alpha * w
        self.n[index] = n + g * g

    def fit(self, examples: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 5) -> FollowTheLeader:
        order = np.random.default_rng(seed)
        for _ in range(self.s.epochs):
            for i in order.permutation(len(examples)):
                self.fit_one(*examples[i])
        return self


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits under which the labels are likeliest; 1 without examples."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        p = softmax(logits / np.exp(log_t))
        return -float(np.log(p[np.arange(len(labels)), labels]).mean())

    # not below 1/2: few examples without an error are no proof of certainty
    grid = np.linspace(np.log(0.5), np.log(20.0), 121)
    return float(np.exp(min(grid, key=loss)))
