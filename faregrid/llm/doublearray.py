"""Double-array tries over dense codes, packed and walked with numpy.

A trie over sequences of codes 1..m is held in two arrays. The child of state ``s`` by code
``c`` is at ``t = BASE[s] + c``, and it is a child of ``s`` if ``CHECK[t] == s``. States are
places in the arrays; the root is place 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Nodes:
    """Nodes of a trie, numbered level by level, the root first; children of a node are neighbours."""

    parent: np.ndarray
    code: np.ndarray
    depth: np.ndarray
    last: np.ndarray  # node where each sequence ends


def nodes_of(codes: np.ndarray, start: np.ndarray) -> Nodes:
    """Nodes of sequences in lexicographic order of any fixed order of the codes.

    Sequence i is ``codes[start[i]:start[i + 1]]``; repeated sequences are allowed.
    """
    length = np.diff(start)
    at = np.zeros(len(length), dtype=np.int64)
    parent, code, depth = [np.array([-1])], [np.array([0])], [np.array([0])]
    total, level = 1, 0
    alive = np.flatnonzero(length > 0)
    while len(alive):
        up, own = at[alive], codes[start[alive] + level]
        new = np.r_[True, (up[1:] != up[:-1]) | (own[1:] != own[:-1])]
        parent.append(up[new])
        code.append(own[new])
        level += 1
        depth.append(np.full(int(new.sum()), level))
        at[alive] = total + np.cumsum(new) - 1
        total += int(new.sum())
        alive = alive[length[alive] > level]
    return Nodes(*(np.concatenate(x) for x in (parent, code, depth)), at)


@dataclass
class DoubleArray:
    base: np.ndarray
    check: np.ndarray
    place: np.ndarray  # of each node
    node: np.ndarray  # of each place, -1 for none

    def step(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The next state of every state; -1 where there is none. Code 0 has no child."""
        found = self.base[states] + codes
        return np.where((self.check[found] == states) & (codes > 0), found, -1)


def pack(nodes: Nodes, most_code: int) -> DoubleArray:
    """BASE and CHECK for ``nodes``.

    Nodes with several children take the first place that fits, the largest families first;
    single children then fill the gaps. Places begin beyond the largest code, so that
    every BASE is positive, and the arrays end one alphabet after the last place.
    """
    n = len(nodes.parent)
    first = most_code + 1
    head = np.flatnonzero(np.r_[True, nodes.parent[1:] != nodes.parent[:-1]])[1:]
    tail = np.r_[head[1:], n]
    size = tail - head
    taken = np.zeros(first + 2 * n + most_code + 2, dtype=bool)
    base_of = np.zeros(n, dtype=np.int64)
    place = np.zeros(n, dtype=np.int64)
    low = first
    several = np.flatnonzero(size > 1)
    for k in several[np.argsort(-size[several], kind="stable")]:
        lo, hi = head[k], tail[k]
        shape = nodes.code[lo:hi] - nodes.code[lo:hi].min()
        begin, step = low, max(1, (1 << 16) // len(shape))
        while True:
            if begin + step + shape.max() >= len(taken):
                taken = np.r_[taken, np.zeros(len(taken) + step + int(shape.max()), dtype=bool)]
            tried = begin + np.flatnonzero(~taken[begin : begin + step])
            fits = ~taken[tried[:, None] + shape[None, :]].any(axis=1)
            if fits.any():
                here = tried[fits.argmax()]
                break
            begin += step
        place[lo:hi] = here + shape
        taken[place[lo:hi]] = True
        base_of[nodes.parent[lo]] = here - nodes.code[lo:hi].min()
        while taken[low]:
            low += 1
    single = head[size == 1]
    free = np.flatnonzero(~taken[first : first + n + int(taken.sum())]) + first
    place[single] = free[: len(single)]
    base_of[nodes.parent[single]] = place[single] - nodes.code[single]
    width = int(place.max()) + most_code + 2
    base, check = np.zeros(width, dtype=np.int64), np.full(width, -1, dtype=np.int64)
    node = np.full(width, -1, dtype=np.int64)
    base[place] = base_of
    check[place[1:]] = place[nodes.parent[1:]]
    node[place] = np.arange(n)
    return DoubleArray(base, check, place, node)


def dense(values: np.ndarray) -> tuple[np.ndarray, int]:
    """Codes from 1 by first occurrence, and the largest one."""
    _, at, inverse = np.unique(values, return_index=True, return_inverse=True)
    rank = np.empty(len(at), dtype=np.int64)
    rank[np.argsort(at)] = np.arange(1, len(at) + 1)
    return rank[inverse], len(at)
