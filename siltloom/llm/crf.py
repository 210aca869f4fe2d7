"""A small linear-chain conditional random field: exact gradient training with numpy, Viterbi decoding in plain Python."""

from __future__ import annotations

import json
from pathlib import Path

import numpy as np


class Chain:
    """Weights of features by label, and of label pairs.  ``labels[0]`` is the label of no interest."""

    def __init__(self, labels: list[str], weights: dict[str, list[float]], pairs: list[list[float]]):
        self.labels, self.weights, self.pairs = labels, weights, pairs

    def viterbi(self, rows: list[list[str]]) -> list[str]:
        """The best labels of one sequence of feature lists; an empty sequence gives []."""
        n = len(self.labels)
        spread = range(n)
        score, back = None, []
        get, pairs = self.weights.get, self.pairs
        for row in rows:
            own = [0.0] * n
            for name in row:
                w = get(name)
                if w is not None:
                    for k in spread:
                        own[k] += w[k]
            if score is None:
                score = own
                continue
            new, ptr = [], []
            for k in spread:
                best, at = max((score[j] + pairs[j][k], -j) for j in spread)
                new.append(best + own[k])
                ptr.append(-at)
            score = new
            back.append(ptr)
        if score is None:
            return []
        k = max(spread, key=lambda j: (score[j], -j))
        path = [k]
        for ptr in reversed(back):
            k = ptr[k]
            path.append(k)
        return [self.labels[j] for j in reversed(path)]

    def save(self, path: str | Path) -> None:
        kept = {k: [round(x, 3) for x in v] for k, v in sorted(self.weights.items()) if max(map(abs, v)) >= 0.02}
        Path(path).write_text(json.dumps({"labels": self.labels, "pairs": [[round(x, 3) for x in r] for r in self.pairs], "weights": kept}, ensure_ascii=False, indent=0))

    @classmethod
    def load(cls, path: str | Path) -> Chain:
        x = json.loads(Path(path).read_text())
        return cls(x["labels"], x["weights"], x["pairs"])


def train(data: list[tuple[list[list[str]], list[str]]], labels: list[str], rounds: int = 30, rate: float = 0.4, decay: float = 1e-3, seed: int = 7) -> Chain:
    """Maximum likelihood with AdaGrad steps of one sequence each; the same data and seed give the same weights."""
    n, at = len(labels), {k: i for i, k in enumerate(labels)}
    index: dict[str, int] = {}
    coded = []
    for rows, tags in data:
        if rows:
            coded.append(([np.array([index.setdefault(f, len(index)) for f in row], dtype=np.int64) for row in rows], [at[t] for t in tags]))
    w, wp = np.zeros((len(index), n)), np.zeros((n, n))
    gw, gp = np.full((len(index), n), 1e-2), np.full((n, n), 1e-2)
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        for i in rng.permutation(len(coded)):
            rows, tags = coded[i]
            size = len(rows)
            own = np.stack([w[r].sum(0) for r in rows])
            alpha, beta = np.zeros((size, n)), np.zeros((size, n))
            alpha[0] = own[0]
            for t in range(1, size):
                alpha[t] = own[t] + np.logaddexp.reduce(alpha[t - 1][:, None] + wp, axis=0)
            for t in range(size - 2, -1, -1):
                beta[t] = np.logaddexp.reduce(wp + (own[t + 1] + beta[t + 1])[None, :], axis=1)
            z = np.logaddexp.reduce(alpha[-1])
            p = np.exp(alpha + beta - z)
            grad_pairs = -decay * wp
            for t in range(size):
                g = -p[t]
                g[tags[t]] += 1
                r = rows[t]
                step = g - decay * w[r]
                gw[r] += step * step
                w[r] += rate * step / np.sqrt(gw[r])
                if t:
                    q = np.exp(alpha[t - 1][:, None] + wp + (own[t] + beta[t])[None, :] - z)
                    grad_pairs -= q
                    grad_pairs[tags[t - 1], tags[t]] += 1
            gp += grad_pairs**2
            wp = wp + rate * grad_pairs / np.sqrt(gp)
    return Chain(labels, {f: [float(x) for x in w[i]] for f, i in index.items()}, [[float(x) for x in r] for r in wp])
