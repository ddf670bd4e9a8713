"""A small logistic regression with pairwise products, fitted by Newton steps."""

from __future__ import annotations

import numpy as np


def expand(x: np.ndarray, products: bool) -> np.ndarray:
    return np.hstack([x, *[x[:, [i]] * x[:, i:] for i in range(x.shape[1])]]) if products else x


class Logistic:
    def __init__(self, x: np.ndarray, y: np.ndarray, prior: float, products: bool = True, l2: float = 1.0):
        """``prior``: the share of label 1 among all learning rows; the sample may be balanced.  With
        one class only, or no rows, every score is the prior."""
        self.products, self.prior, self.w = products, float(np.clip(prior, 1e-3, 1 - 1e-3)), None
        if len(y) and 0 < y.mean() < 1:
            e = expand(x, products)
            self.mean, self.std = e.mean(0), e.std(0) + 1e-9
            z = np.hstack([(e - self.mean) / self.std, np.ones((len(e), 1))])
            w = np.zeros(z.shape[1])
            ridge = np.r_[np.full(len(w) - 1, l2), 1e-6]
            for _ in range(40):
                p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
                step = np.linalg.solve((z * (p * (1 - p) + 1e-6)[:, None]).T @ z + np.diag(ridge), z.T @ (y - p) - ridge * w)
                w += step
                if np.abs(step).max() < 1e-6:
                    break
            w[-1] += np.log(self.prior / (1 - self.prior)) - np.log(y.mean() / (1 - y.mean()))
            self.w = w

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if self.w is None or not len(x):
            return np.full(len(x), self.prior)
        z = (expand(x, self.products) - self.mean) / self.std
        return 1 / (1 + np.exp(-np.clip(z @ self.w[:-1] + self.w[-1], -30, 30)))
