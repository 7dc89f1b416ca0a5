"""Linear-chain conditional random field over feature vectors, in numpy: training by gradient on many sequences at once, decoding by Viterbi."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def _pad(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, inside): where each step of the sequences, laid one after another, goes in a padded (sequence, step) table."""
    longest = int(lengths.max()) if len(lengths) else 0
    inside = np.arange(longest)[None, :] < lengths[:, None]
    return np.flatnonzero(inside.ravel()), inside


@dataclass
class Crf:
    emit: np.ndarray  # feature x state
    move: np.ndarray  # state x state
    start: np.ndarray  # state

    def _table(self, features: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        place, inside = _pad(lengths)
        table = np.zeros((inside.size, self.emit.shape[1]))
        table[place] = features @ self.emit
        return table.reshape(*inside.shape, -1), inside, place

    def gradient(self, features: np.ndarray, labels: np.ndarray, lengths: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean log-likelihood of a step, and its gradient for emit, move and start."""
        score, inside, place = self._table(features, lengths)
        n, steps, k = score.shape
        top, top_move, top_start = score.max(axis=2), self.move.max(), self.start.max()
        emit, move = np.exp(score - top[:, :, None]), np.exp(self.move - top_move)
        fore, back, scale = np.empty_like(score), np.ones_like(score), np.ones((n, steps))
        for t in range(steps):  # forward chances, made to sum to one at each step
            new = (fore[:, t - 1] @ move if t else np.exp(self.start - top_start)) * emit[:, t]
            total = new.sum(axis=1)
            on = inside[:, t]
            scale[on, t] = total[on]
            fore[:, t] = np.where(on[:, None], new / total[:, None], fore[:, t - 1])
        for t in range(steps - 2, -1, -1):
            new = (emit[:, t + 1] * back[:, t + 1] / scale[:, t + 1, None]) @ move.T
            back[:, t] = np.where(inside[:, t + 1, None], new, 1)
        whole = (np.log(scale) + np.where(inside, top, 0)).sum() + top_move * inside[:, 1:].sum() + top_start * n
        belief = (fore * back).reshape(-1, k)[place]
        on = inside[:, 1:]
        moves = move * (fore[:, :-1][on].T @ (emit * back / scale[:, :, None])[:, 1:][on])
        y = np.zeros(n * steps, np.int64)
        y[place] = labels
        y = y.reshape(n, steps)
        real = np.bincount(y[:, :-1][on] * k + y[:, 1:][on], minlength=k * k).reshape(k, k).astype(float)
        truth = np.eye(k)[labels]
        total = len(labels)
        at = score.reshape(-1, k)[place]
        gold = at[np.arange(total), labels].sum() + (self.move * real).sum() + self.start[y[:, 0]].sum()
        return (gold - whole) / total, [features.T @ (truth - belief) / total, (real - moves) / total, (np.eye(k)[y[:, 0]] - fore[:, 0] * back[:, 0]).sum(0) / total]

    def decode(self, features: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The likeliest state of each step (Viterbi)."""
        if not len(features):
            return np.zeros(0, np.int64)
        score, inside, place = self._table(features, lengths)
        n, steps, k = score.shape
        best, came = self.start + score[:, 0], np.zeros((n, steps, k), np.int64)
        for t in range(1, steps):
            reach = best[:, :, None] + self.move[None]
            new = reach.max(1) + score[:, t]
            came[:, t] = np.where(inside[:, t, None], reach.argmax(1), np.arange(k))
            best = np.where(inside[:, t, None], new, best)
        state = np.zeros((n, steps), np.int64)
        state[:, -1] = best.argmax(1)
        for t in range(steps - 1, 0, -1):
            state[:, t - 1] = came[np.arange(n), t, state[:, t]]
        return state.ravel()[place]


def train(features: np.ndarray, labels: np.ndarray, lengths: np.ndarray, states: int, rounds: int = 200, rate: float = 0.15, decay: float = 1e-4, gain: float = 2e-5) -> Crf:
    """Maximum likelihood with weight decay by Adam over all sequences; deterministic. Ends after `rounds`, or when ten of them gain less than `gain`."""
    model = Crf(np.zeros((features.shape[1], states)), np.zeros((states, states)), np.zeros(states))
    weights = [model.emit, model.move, model.start]
    mean, square = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    features = features.astype(float)
    before = -np.inf
    for step in range(1, rounds + 1):
        value, slope = model.gradient(features, labels, lengths)
        if step % 10 == 0:
            if value - before < gain:
                break
            before = value
        for w, g, m, s in zip(weights, slope, mean, square):
            g = g - decay * w
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            w += rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    return model
