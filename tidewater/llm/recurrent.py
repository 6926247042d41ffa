"""A small bidirectional gated recurrent network with attention pooling, in numpy.

Windows of word numbers go in, one logit a window comes out.  The inputs of a
word never change, so its share of all gates is one row of a table, made once
for the distinct words at hand.
"""

from __future__ import annotations

import numpy as np

F32 = np.float32


def sigmoid(x: np.ndarray) -> np.ndarray:
    return F32(0.5) * np.tanh(F32(0.5) * x) + F32(0.5)


class Network:
    """``inputs`` features a word, ``hidden`` units in each direction, ``attend`` units of attention."""

    def __init__(self, inputs: int, hidden: int = 8, attend: int = 8, seed: int = 0):
        r = np.random.default_rng(seed)

        def w(*shape):
            return (r.standard_normal(shape) / np.sqrt(shape[0])).astype(F32)

        self.hidden = hidden
        self.p = {}
        for d in "fb":
            self.p |= {f"W{d}": w(inputs, 3 * hidden), f"c{d}": np.zeros(3 * hidden, F32), f"U{d}": w(hidden, 3 * hidden) * F32(0.5)}
        self.p |= {"A": w(2 * hidden, attend), "a": np.zeros(attend, F32), "v": w(attend), "o": w(2 * hidden), "b": np.zeros(1, F32)}

    def table(self, features: np.ndarray) -> dict[str, np.ndarray]:
        """Each word's share of the gates, by direction."""
        return {d: features @ self.p[f"W{d}"] + self.p[f"c{d}"] for d in "fb"}

    def _run(self, d: str, x: np.ndarray, words: np.ndarray, keep: list | None) -> np.ndarray:
        """States (step, window, unit) of one direction."""
        n, steps = words.shape
        h, hid = np.zeros((n, self.hidden), F32), self.hidden
        out = np.empty((steps, n, hid), F32)
        u = self.p[f"U{d}"]
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            g, y = x[words[:, t]], h @ u
            zr = sigmoid(g[:, : 2 * hid] + y[:, : 2 * hid])
            z, r, yn = zr[:, :hid], zr[:, hid:], y[:, 2 * hid :]
            cand = np.tanh(g[:, 2 * hid :] + r * yn)
            if keep is not None:
                keep.append((t, h, z, r, yn, cand))
            h = cand + z * (h - cand)
            out[t] = h
        return out

    def logits(self, table: dict[str, np.ndarray], words: np.ndarray, real: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """One logit a window; ``real`` tells words from filling."""
        hs = np.concatenate([self._run(d, table[d], words, None if keep is None else keep.setdefault(d, [])) for d in "fb"], axis=2)
        k = np.tanh(hs @ self.p["A"] + self.p["a"])
        e = np.where(real.T, k @ self.p["v"], F32(-30))
        e = np.exp(e - e.max(axis=0))
        a = e / e.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", a, hs)
        if keep is not None:
            keep |= {"hs": hs, "k": k, "att": a, "pooled": pooled}
        return pooled @ self.p["o"] + self.p["b"][0]

    def gradients(self, features: np.ndarray, words: np.ndarray, real: np.ndarray, target: np.ndarray, weight: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Weighted log loss and its gradient by every parameter."""
        p, hid = self.p, self.hidden
        keep: dict = {}
        y = self.logits(self.table(features), words, real, keep)
        prob = sigmoid(y)
        loss = float((weight * (np.logaddexp(0, y) - target * y)).sum() / weight.sum())
        dy = (weight * (prob - target) / weight.sum()).astype(F32)
        g = {"o": keep["pooled"].T @ dy, "b": np.array([dy.sum()], F32)}
        dpool = dy[:, None] * p["o"]
        hs, k, a = keep["hs"], keep["k"], keep["att"]
        da = np.einsum("nh,tnh->tn", dpool, hs)
        dhs = a[:, :, None] * dpool
        de = a * (da - (a * da).sum(axis=0))
        g["v"] = np.einsum("tn,tnk->k", de, k)
        dk = de[:, :, None] * p["v"] * (1 - k * k)
        g["A"] = np.einsum("tnh,tnk->hk", hs, dk)
        g["a"] = dk.sum(axis=(0, 1))
        dhs = dhs + dk @ p["A"].T
        for i, d in enumerate("fb"):
            gw, gu, gc = np.zeros_like(p[f"W{d}"]), np.zeros_like(p[f"U{d}"]), np.zeros_like(p[f"c{d}"])
            dh = np.zeros((len(words), hid), F32)
            for t, h, z, r, yn, cand in reversed(keep[d]):
                dh = dh + dhs[t][:, i * hid : (i + 1) * hid]
                dn = dh * (1 - z) * (1 - cand * cand)
                dz = dh * (h - cand) * z * (1 - z)
                dr = dn * yn * r * (1 - r)
                dx = np.concatenate([dz, dr, dn], axis=1)
                dyy = np.concatenate([dz, dr, dn * r], axis=1)
                gu += h.T @ dyy
                gw += features[words[:, t]].T @ dx
                gc += dx.sum(axis=0)
                dh = dh * z + dyy @ p[f"U{d}"].T
            g |= {f"W{d}": gw, f"U{d}": gu, f"c{d}": gc}
        return loss, g


class Adam:
    """Adam over a dictionary of parameters."""

    def __init__(self, p: dict[str, np.ndarray], rate: float = 0.01):
        self.p, self.rate, self.n = p, rate, 0
        self.m = {k: np.zeros_like(x) for k, x in p.items()}
        self.v = {k: np.zeros_like(x) for k, x in p.items()}

    def step(self, g: dict[str, np.ndarray]) -> None:
        self.n += 1
        for k, x in g.items():
            self.m[k] = 0.9 * self.m[k] + 0.1 * x
            self.v[k] = 0.999 * self.v[k] + 0.001 * x * x
            m, v = self.m[k] / (1 - 0.9**self.n), self.v[k] / (1 - 0.999**self.n)
            self.p[k] -= (self.rate * m / (np.sqrt(v) + 1e-8)).astype(self.p[k].dtype)


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Weights (the last is the intercept) of a logistic regression, by Newton's method."""
    x = np.c_[x, np.ones(len(x))].astype(np.float64)
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - y)) / weight.sum() + ridge * w
        hess = (x.T * (weight * p * (1 - p))) @ x / weight.sum() + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step * min(1.0, 4 / max(1e-9, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-6:
            break
    return w
