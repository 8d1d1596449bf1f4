"""A conditional random field over token graphs: pseudo-likelihood training and loopy belief propagation.

Nodes have binary features. A chain edge joins neighbouring tokens and has one potential for each ordered pair of
labels; a skip edge joins distant tokens that are alike and has a symmetric potential. Graphs of many documents are
processed together, since no edge crosses documents.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

ROUNDS = 20
DAMPING = 0.3
SETTLED = 1e-3
# Log-potential against labels that a node is known not to have.
BARRED = -40.0


@dataclass
class Weights:
    node: np.ndarray  # features x labels
    chain: np.ndarray  # label before x label after
    skip: np.ndarray  # labels x labels, symmetric


@dataclass
class Graph:
    """Edges are node numbers; a chain edge goes from the earlier token to the later one."""

    features: np.ndarray  # nodes x features, bool
    chain: np.ndarray  # edges x 2
    skip: np.ndarray  # edges x 2


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def _send(inside: np.ndarray, potential: np.ndarray) -> np.ndarray:
    """Messages over edges with one potential, a label of the receiver at a time; each sums to one."""
    out = np.stack([_log_sum(inside + potential[:, b], 1) for b in range(potential.shape[1])], axis=1)
    return out - _log_sum(out, 1)[:, None]


def marginals(graph: Graph, weights: Weights, known: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Beliefs of every node (nodes x labels); known holds a label or -1 for each node.

    Sum-product messages pass along all edges at once until they settle; on graphs without loops the beliefs are
    the exact marginals.
    """
    n, n_labels = len(graph.features), weights.node.shape[1]
    own = graph.features.astype(np.float64) @ weights.node
    fixed = np.flatnonzero(known >= 0)
    own[fixed] = BARRED
    own[fixed, known[fixed]] = 0.0
    both = np.concatenate([graph.chain, graph.skip])
    n_chain, n_edges = len(graph.chain), len(both)
    sender = np.concatenate([both[:, 0], both[:, 1]])
    receiver = np.concatenate([both[:, 1], both[:, 0]])
    kinds = [
        (slice(0, n_chain), weights.chain), (slice(n_chain, n_edges), weights.skip),
        (slice(n_edges, n_edges + n_chain), weights.chain.T), (slice(n_edges + n_chain, 2 * n_edges), weights.skip),
    ]
    message = np.full((2 * n_edges, n_labels), -np.log(n_labels))

    def beliefs() -> np.ndarray:
        heard = [np.bincount(receiver, message[:, k], minlength=n) for k in range(n_labels)]
        return own + np.stack(heard, axis=1)

    for _ in range(rounds if n_edges else 0):
        # What a sender knows without what this receiver told it.
        inside = beliefs()[sender] - np.roll(message, n_edges, axis=0)
        new = np.empty_like(message)
        for part, potential in kinds:
            new[part] = _send(inside[part], potential)
        moved = np.abs(new - message).max()
        message = (1 - DAMPING) * new + DAMPING * message
        if moved < SETTLED:
            break
    total = beliefs()
    return np.exp(total - _log_sum(total, 1)[:, None])


@dataclass
class Patterns:
    """Distinct surroundings of labelled nodes with the number of times each was seen."""

    features: np.ndarray
    before: np.ndarray  # label of the chain neighbour, or -1
    after: np.ndarray
    skip: np.ndarray  # rows x labels: how many skip neighbours have each label
    label: np.ndarray
    count: np.ndarray


def train(given: Patterns, n_labels: int, steps: int = 800, rate: float = 0.05, ridge: float = 1e-5) -> Weights:
    """Weights that make each node's label likely given its features and its neighbours' labels.

    The pseudo-likelihood is concave; a fixed number of steps from zero makes the result repeat exactly.
    """
    x = given.features.astype(np.float64)
    hot = np.eye(n_labels + 1)
    # Row -1 of the unit matrix stands for a missing neighbour and is cut off.
    before, after = hot[given.before][:, :n_labels], hot[given.after][:, :n_labels]
    skip, target = given.skip.astype(np.float64), hot[given.label][:, :n_labels]
    share = np.log1p(given.count)
    share = (share / max(share.sum(), 1e-9))[:, None]
    w = Weights(np.zeros((x.shape[1], n_labels)), np.zeros((n_labels, n_labels)), np.zeros((n_labels, n_labels)))
    means = [np.zeros_like(p) for p in (w.node, w.chain, w.skip)]
    spread = [np.zeros_like(p) for p in (w.node, w.chain, w.skip)]
    for step in range(1, steps + 1):
        score = x @ w.node + before @ w.chain + after @ w.chain.T + skip @ w.skip
        error = (target - np.exp(score - _log_sum(score, 1)[:, None])) * share
        pull = skip.T @ error
        slopes = [x.T @ error, before.T @ error + error.T @ after, pull + pull.T]
        for k, p in enumerate((w.node, w.chain, w.skip)):
            slope = slopes[k] - ridge * p
            means[k] = 0.9 * means[k] + 0.1 * slope
            spread[k] = 0.99 * spread[k] + 0.01 * slope**2
            p += rate * (means[k] / (1 - 0.9**step)) / (np.sqrt(spread[k] / (1 - 0.99**step)) + 1e-9)
    return w
