"""Scaled forward and backward recursions over many sequences at once.

Sequences are laid out time-major, longest first, so that step t of all live
sequences is one slice; a step costs two array operations whatever the number
of sequences.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np


class Layout(NamedTuple):
    order: np.ndarray  # element index at each time-major place
    place: np.ndarray  # time-major place of each element
    begin: np.ndarray  # first place of each step, and the end
    rank: np.ndarray  # row of each sequence inside its steps


def layout(offsets: np.ndarray) -> Layout:
    lengths = np.diff(offsets)
    rank = np.empty(len(lengths), dtype=np.int64)
    rank[np.argsort(-lengths, kind="stable")] = np.arange(len(lengths))
    longest = int(lengths.max()) if len(lengths) else 0
    live = len(lengths) - np.cumsum(np.bincount(lengths, minlength=longest + 1))[:longest]
    begin = np.concatenate([[0], np.cumsum(live)]).astype(np.int64)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    step = np.arange(len(owner)) - (offsets[owner] - offsets[0])
    place = begin[step] + rank[owner]
    order = np.empty(len(place), dtype=np.int64)
    order[place] = np.arange(len(place))
    return Layout(order, place, begin, rank)


def forward(emission: np.ndarray, lay: Layout, start: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(alpha with sum 1, normaliser) of every time-major place; the normalisers multiply to the likelihood."""
    alpha = np.empty_like(emission)
    norm = np.empty(len(emission), dtype=emission.dtype)
    ones = np.ones(emission.shape[1], dtype=emission.dtype)
    before = None
    for t in range(len(lay.begin) - 1):
        lo, hi = lay.begin[t], lay.begin[t + 1]
        a, total = alpha[lo:hi], norm[lo:hi]
        if before is None:
            np.multiply(emission[lo:hi], start, out=a)
        else:
            np.matmul(before[: hi - lo], move, out=a)
            a *= emission[lo:hi]
        np.matmul(a, ones, out=total)
        a *= (1 / total)[:, None]
        before = a
    return alpha, norm


def backward(
    emission: np.ndarray, alpha: np.ndarray, norm: np.ndarray, lay: Layout, move: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(posterior of every time-major place, expected number of moves between states).

    Backward values are scaled by the forward normalisers, so alpha * beta sums
    to 1 at every place and neighbouring places need no normaliser of their own.
    """
    beta = np.ones_like(emission)
    weight = emission * (1 / norm)[:, None]
    back = np.ascontiguousarray(move.T)
    moves = np.zeros(move.shape, dtype=np.float64)
    for t in range(len(lay.begin) - 2, 0, -1):
        lo, hi = lay.begin[t], lay.begin[t + 1]
        earlier = slice(lay.begin[t - 1], lay.begin[t - 1] + hi - lo)
        y = beta[lo:hi] * weight[lo:hi]
        np.matmul(y, back, out=beta[earlier])
        moves += alpha[earlier].T @ y
    return alpha * beta, moves * move
