"""A linear-chain conditional random field over small feature ids, in numpy.

A position has a fixed number of feature slots; slot f holds an id into the
weight table, and a position's score for a tag is the sum of its slots' weights.
Training maximises the conditional likelihood (forward-backward, Adagrad) of
padded, labelled sequences; decoding is Viterbi. Sequences are handled side by
side: the loop runs over positions, numpy over sequences.
"""

from __future__ import annotations

import numpy as np


class Chain:
    def __init__(self, n_ids: int, n_tags: int):
        self.weights = np.zeros((n_ids, n_tags))
        self.moves = np.zeros((n_tags, n_tags))  # from, to
        self.begin = np.zeros(n_tags)

    def scores(self, ids: np.ndarray) -> np.ndarray:
        """(..., tags) scores of positions whose slots are the last axis of ``ids``."""
        out = self.weights[ids[..., 0]]
        for f in range(1, ids.shape[-1]):
            out = out + self.weights[ids[..., f]]
        return out

    def train(
        self, ids: np.ndarray, tags: np.ndarray, mask: np.ndarray, weight: np.ndarray | None = None,
        rounds: int = 120, rate: float = 0.3, ridge: float = 1e-3,
    ) -> float:
        """Fit to sequences (S, T, slots) with tags (S, T); mask says which positions exist (a prefix each).

        Returns the mean log-likelihood per sequence at the end.
        """
        s, t, slots = ids.shape
        n_tags = len(self.begin)
        weight = np.ones(s) if weight is None else weight
        total = max(weight.sum(), 1e-9)
        use = mask * weight[:, None]
        gold = np.eye(n_tags)[tags]
        flat = ids.reshape(-1, slots)
        observed_moves = np.einsum("st,sti,stj->ij", use[:, 1:], gold[:, :-1], gold[:, 1:])
        seen = [np.full_like(x, 1e-6) for x in (self.weights, self.moves, self.begin)]
        value = 0.0
        for _ in range(rounds):
            e = self.scores(ids)
            alpha = np.empty((s, t, n_tags))
            alpha[:, 0] = e[:, 0] + self.begin
            for k in range(1, t):
                a = _logsumexp(alpha[:, k - 1, :, None] + self.moves[None], axis=1) + e[:, k]
                alpha[:, k] = np.where(mask[:, k, None], a, alpha[:, k - 1])
            beta = np.zeros((s, t, n_tags))
            for k in range(t - 2, -1, -1):
                b = _logsumexp(self.moves[None] + (e[:, k + 1] + beta[:, k + 1])[:, None, :], axis=2)
                beta[:, k] = np.where(mask[:, k + 1, None], b, 0.0)
            z = _logsumexp(alpha[:, -1], axis=1)
            p = np.exp(alpha + beta - z[:, None, None]) * use[:, :, None]
            pairs = alpha[:, :-1, :, None] + self.moves[None, None] + (e[:, 1:] + beta[:, 1:])[:, :, None, :] - z[:, None, None, None]
            expected_moves = np.einsum("st,stij->ij", use[:, 1:], np.exp(np.minimum(pairs, 0)))
            miss = (gold * use[:, :, None] - p).reshape(-1, n_tags)
            grads = [np.zeros_like(self.weights), observed_moves - expected_moves, (gold[:, 0] * weight[:, None] - p[:, 0]).sum(axis=0)]
            for f in range(slots):
                for c in range(n_tags):
                    grads[0][:, c] += np.bincount(flat[:, f], weights=miss[:, c], minlength=len(self.weights))
            for x, g, h in zip((self.weights, self.moves, self.begin), grads, seen):
                g = g / total - ridge * x
                h += g * g
                x += rate * g / np.sqrt(h)
            path = (e * gold).sum(axis=2) * mask
            steps = self.moves[tags[:, :-1], tags[:, 1:]] * mask[:, 1:]
            value = float(((path.sum(axis=1) + steps.sum(axis=1) + self.begin[tags[:, 0]] - z) * weight).sum() / total)
        return value

    def swing(self) -> float:
        """The most that two transitions can gain by changing one position's tag."""
        edges = np.concatenate([self.moves, self.begin[None]])
        return 2 * float(edges.max() - edges.min())

    def viterbi(self, e: np.ndarray, lengths: np.ndarray, before: np.ndarray | None = None, after: np.ndarray | None = None) -> np.ndarray:
        """The best tags (S, T) for scores e (S, T, tags) of sequences of these lengths (1 or more).

        before, after: the tag known to stand next to a sequence, or -1 at the
        end of a text.
        """
        s, t, n_tags = e.shape
        edge = np.concatenate([self.moves, self.begin[None]])  # row -1: the text begins here
        best = np.empty((s, t, n_tags))
        back = np.zeros((s, t, n_tags), dtype=np.int64)
        best[:, 0] = e[:, 0] + edge[before if before is not None else np.full(s, -1)]
        for k in range(1, t):
            step = best[:, k - 1, :, None] + self.moves[None]
            back[:, k] = step.argmax(axis=1)
            best[:, k] = step.max(axis=1) + e[:, k]
        rows = np.arange(s)
        last = best[rows, lengths - 1]
        if after is not None:
            leave = np.concatenate([self.moves, np.zeros((n_tags, 1))], axis=1).T  # row -1: the text ends here
            last = last + leave[after]
        out = np.zeros((s, t), dtype=np.int64)
        tag = last.argmax(axis=1)
        for k in range(t - 1, -1, -1):
            inside = k < lengths
            out[inside, k] = tag[inside]
            if k:
                tag = np.where(inside, back[rows, k, tag], tag)
        return out


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def decode(chain: Chain, e: np.ndarray, text: np.ndarray, common: int) -> np.ndarray:
    """The Viterbi tags of all texts' positions (scores e, text number per position), exactly.

    Where the tag ``common`` leads by more than any two transitions can make
    up for, it is on every best path, so the chain falls apart there. Only the
    runs between such positions are decoded, runs of similar length together.
    """
    n, n_tags = e.shape
    tags = np.full(n, common, dtype=np.int64)
    rest = np.delete(e, common, axis=1).max(axis=1)
    unsure = e[:, common] - rest <= chain.swing()
    at = np.flatnonzero(unsure)
    if not len(at):
        return tags
    new = np.ones(len(at), dtype=bool)
    new[1:] = (np.diff(at) > 1) | (text[at[1:]] != text[at[:-1]])
    first = np.flatnonzero(new)
    lengths = np.diff(np.append(first, len(at)))
    start = at[first]
    end = start + lengths
    before = np.where((start > 0) & (text[np.maximum(start - 1, 0)] == text[start]), common, -1)
    after = np.where((end < n) & (text[np.minimum(end, n - 1)] == text[start]), common, -1)
    size = np.ceil(np.log2(lengths)).astype(np.int64)
    for k in np.unique(size):
        runs = np.flatnonzero(size == k)
        width = 1 << int(k)
        step = max(1, (1 << 20) // width)
        for lo in range(0, len(runs), step):
            r = runs[lo : lo + step]
            place = start[r][:, None] + np.minimum(np.arange(width)[None, :], lengths[r][:, None] - 1)
            found = chain.viterbi(e[place], lengths[r], before[r], after[r])
            inside = np.arange(width)[None, :] < lengths[r][:, None]
            tags[place[inside]] = found[inside]
    return tags
