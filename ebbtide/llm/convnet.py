"""Small convolutional networks in numpy: embeddings, several filter widths, max pooling, one linear layer."""

from __future__ import annotations

import numpy as np


class ByteNet:
    """Byte embeddings -> filters of several widths -> maximum over the window -> softmax."""

    def __init__(self, classes: list[str], dim: int = 8, filters: int = 10, widths: tuple[int, ...] = (2, 3, 4), seed: int = 3):
        rng = np.random.default_rng(seed)
        self.classes, self.widths, self.filters = classes, widths, filters
        self.p = {"e": rng.normal(0, .5, (256, dim)), "o": rng.normal(0, .3, (filters * len(widths), len(classes))), "b": np.zeros(len(classes))}
        self.p |= {f"w{k}": rng.normal(0, (k * dim) ** -.5, (k, dim, filters)) for k in widths}
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def pooled(self, x: np.ndarray, places: bool = False):
        """Pooled features of windows x (n, length) of bytes, and where each maximum lies."""
        e, feats, where = self.p["e"][x], [], []
        for k in self.widths:
            w, length = self.p[f"w{k}"], x.shape[1] - k + 1
            z = e[:, :length] @ w[0]
            for j in range(1, k):
                z += e[:, j:j + length] @ w[j]
            feats.append(z.max(1))
            if places:
                where.append(z.argmax(1))
        return np.maximum(np.concatenate(feats, 1), 0), where

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return softmax(self.pooled(x)[0] @ self.p["o"] + self.p["b"])

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 4, batch: int = 64, rate: float = .01, seed: int = 5) -> None:
        rng, adam = np.random.default_rng(seed), Adam(self.p, rate)
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(order), batch):
                rows = order[at:at + batch]
                xb, n = x[rows], len(rows)
                h, where = self.pooled(xb, True)
                d = softmax(h @ self.p["o"] + self.p["b"])
                d[np.arange(n), y[rows]] -= 1
                d /= n
                g = {"o": h.T @ d, "b": d.sum(0), "e": np.zeros_like(self.p["e"])}
                dh = (d @ self.p["o"].T) * (h > 0)
                for i, k in enumerate(self.widths):
                    dz = dh[:, i * self.filters:(i + 1) * self.filters]
                    at_bytes = xb[np.arange(n)[:, None, None], where[i][:, :, None] + np.arange(k)]  # row, filter, place
                    seen = self.p["e"][at_bytes]
                    g[f"w{k}"] = np.einsum("nf,nfkd->kdf", dz, seen)
                    np.add.at(g["e"], at_bytes, np.einsum("nf,kdf->nfkd", dz, self.p[f"w{k}"]))
                adam.step(g)


class Adam:
    def __init__(self, p: dict[str, np.ndarray], rate: float):
        self.p, self.rate, self.t = p, rate, 0
        self.m, self.v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))

    def step(self, g: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, x in g.items():
            self.m[k] += .1 * (x - self.m[k])
            self.v[k] += .001 * (x * x - self.v[k])
            self.p[k] -= (self.rate * self.m[k] / (1 - .9 ** self.t) / (np.sqrt(self.v[k] / (1 - .999 ** self.t)) + 1e-8)).astype(np.float32)


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)
