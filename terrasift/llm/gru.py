"""A gated recurrent layer in numpy, forward and backward, and Adam."""

from __future__ import annotations

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def init(rng: np.random.Generator, *shape: int, scale: float | None = None) -> np.ndarray:
    return (rng.standard_normal(shape) * (scale or shape[0] ** -0.5)).astype(np.float32)


def forward(x: np.ndarray, u: np.ndarray, h: np.ndarray, mask: np.ndarray | None = None, keep: bool = False):
    """States (T, B, H) for projected inputs x (T, B, 3H: update, reset, new), from h (B, H). Where mask (T, B) is false the state stays."""
    steps, size = len(x), u.shape[0]
    out = np.empty((steps, *h.shape), dtype=np.float32)
    tape = []
    for t in range(steps):
        hu = h @ u
        gates = sigmoid(x[t, :, : 2 * size] + hu[:, : 2 * size])
        z, r = gates[:, :size], gates[:, size:]
        n = np.tanh(x[t, :, 2 * size :] + r * hu[:, 2 * size :])
        new = n + z * (h - n)
        if mask is not None:
            new = np.where(mask[t][:, None], new, h)
        if keep:
            tape.append((h, z, r, n, hu[:, 2 * size :]))
        h = out[t] = new
    return (out, tape) if keep else out


def backward(grad: np.ndarray, tape: list, u: np.ndarray, mask: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the projected inputs and of u, for grad (T, B, H) of the states."""
    steps, batch, size = grad.shape
    dx, du = np.empty((steps, batch, 3 * size), dtype=np.float32), np.zeros_like(u)
    dh = np.zeros((batch, size), dtype=np.float32)
    for t in range(steps - 1, -1, -1):
        h, z, r, n, hn = tape[t]
        dh = dh + grad[t]
        now = dh if mask is None else dh * mask[t][:, None]
        past = now * z if mask is None else now * z + dh * ~mask[t][:, None]
        dn = now * (1 - z) * (1 - n * n)
        dz = now * (h - n) * z * (1 - z)
        dr = dn * hn * r * (1 - r)
        dx[t] = np.concatenate((dz, dr, dn), axis=1)
        dhu = np.concatenate((dz, dr, dn * r), axis=1)
        du += h.T @ dhu
        dh = past + dhu @ u.T
    return dx, du


class Adam:
    def __init__(self, params: dict[str, np.ndarray], rate: float):
        self.params, self.rate, self.t = params, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, grads: dict[str, np.ndarray]) -> None:
        self.t += 1
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        for k, g in grads.items():
            g = g * min(1.0, 5.0 / (norm + 1e-9))
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            self.params[k] -= self.rate * (self.m[k] / (1 - 0.9**self.t)) / (np.sqrt(self.v[k] / (1 - 0.999**self.t)) + 1e-8)
