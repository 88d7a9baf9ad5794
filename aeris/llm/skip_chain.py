"""Skip-chain conditional random field: learning by pseudo-likelihood, loopy message passing (numpy).

Nodes carry features; ``chain`` edges join neighbours in the text and have a learned matrix over
label pairs, ``skip`` edges of several kinds join distant nodes that are the same or alike and have a learned
reward for equal labels.  Many documents are handled at a time as one graph of separate parts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

ROUNDS = 12
DAMPING = 0.3


@dataclass
class Graph:
    features: np.ndarray  # node x feature, 0 or 1
    label: np.ndarray  # what is known of a node, -1 where nothing is
    chain: np.ndarray  # edge x 2, the earlier node first
    skip: np.ndarray  # edge x 2
    skip_kind: np.ndarray


@dataclass
class Weights:
    node: np.ndarray  # feature x label
    chain: np.ndarray  # label x label
    skip: np.ndarray  # kind of edge


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)


def beliefs(g: Graph, w: Weights, rounds: int = ROUNDS) -> np.ndarray:
    """Label probabilities of every node by damped sum-product messages; known labels are held fast."""
    labels = w.chain.shape[0]
    own = g.features @ w.node
    known = g.label >= 0
    own[known] = -1e3
    own[known, g.label[known]] = 0.0
    agree = np.eye(labels)
    tables = np.concatenate([np.broadcast_to(w.chain, (len(g.chain), labels, labels)), w.skip[g.skip_kind][:, None, None] * agree])
    edges = np.concatenate([g.chain, g.skip]).reshape(-1, 2)
    source, target = np.r_[edges[:, 0], edges[:, 1]], np.r_[edges[:, 1], edges[:, 0]]
    tables = np.concatenate([tables, tables.transpose(0, 2, 1)])  # [message, label of source, label of target]
    n = len(edges)
    back = np.r_[np.arange(n, 2 * n), np.arange(n)]
    message = np.zeros((2 * n, labels))
    for _ in range(rounds if n else 0):
        total = own.copy()
        np.add.at(total, target, message)
        sent = np.where(known[source][:, None], own[source], total[source] - message[back])  # no number of messages moves a known label
        new = _log_sum(sent[:, :, None] + tables, 1)
        message = DAMPING * message + (1 - DAMPING) * (new - _log_sum(new, 1)[:, None])
    total = own.copy()
    np.add.at(total, target, message)
    total[known] = own[known]
    return np.exp(total - _log_sum(total, 1)[:, None])


def pseudo_likelihood(g: Graph, truth: np.ndarray, asked: np.ndarray, w: Weights, ridge: float) -> tuple[float, Weights]:
    """Mean log probability of the asked nodes given the true labels of their neighbours, and its gradient."""
    labels = w.chain.shape[0]
    score = g.features @ w.node
    a, b = g.chain[:, 0], g.chain[:, 1]
    np.add.at(score, a, w.chain[:, truth[b]].T)
    np.add.at(score, b, w.chain[truth[a]])
    u, v = g.skip[:, 0], g.skip[:, 1]
    reward = w.skip[g.skip_kind]
    np.add.at(score, (u, truth[v]), reward)
    np.add.at(score, (v, truth[u]), reward)
    log_p = score - _log_sum(score, 1)[:, None]
    n = max(1, int(asked.sum()))
    miss = -np.exp(log_p)
    miss[np.arange(len(truth)), truth] += 1
    miss[~asked] = 0
    chain, skip = np.zeros_like(w.chain), np.zeros_like(w.skip)
    np.add.at(chain.T, truth[b], miss[a])
    np.add.at(chain, truth[a], miss[b])
    np.add.at(skip, g.skip_kind, miss[u, truth[v]] + miss[v, truth[u]])
    value = log_p[np.arange(len(truth)), truth][asked].sum() / n
    value -= ridge * sum(float((x * x).sum()) for x in (w.node, w.chain, w.skip)) / 2
    return value, Weights(g.features.T @ miss / n - ridge * w.node, chain / n - ridge * w.chain, skip / n - ridge * w.skip)


def learn(g: Graph, truth: np.ndarray, asked: np.ndarray, labels: int, kinds: int, rounds: int = 300, rate: float = 0.1,
          ridge: float = 1e-3) -> Weights:
    """Weights of greatest pseudo-likelihood, by gradient steps with running moments."""
    w = Weights(np.zeros((g.features.shape[1], labels)), np.zeros((labels, labels)), np.zeros(kinds))
    moments = [(np.zeros_like(x), np.zeros_like(x)) for x in (w.node, w.chain, w.skip)]
    for t in range(1, rounds + 1):
        _, grad = pseudo_likelihood(g, truth, asked, w, ridge)
        for x, d, (m, s) in zip((w.node, w.chain, w.skip), (grad.node, grad.chain, grad.skip), moments, strict=True):
            m += 0.1 * (d - m)
            s += 0.01 * (d * d - s)
            x += rate * (m / (1 - 0.9 ** t)) / (np.sqrt(s / (1 - 0.99 ** t)) + 1e-8)
    return w
