"""BagMinHash signatures of multisets, vectorised over many documents at once.

Every element carries independent Poisson processes on the dyadic levels (0,1], (1,2], (2,4], (4,8], ... of its
discretised weight. A point of a process has a time, a signature component and a height inside its level; it counts
for an element of weight w when its height is at most w. Component i of the signature is the value of the earliest
counted point that fell on i. Two multisets agree on a component with probability sum(min)/sum(max), without bias.
Points come in order of time, so an element stops as soon as its next point is later than everything it could still
improve; long documents therefore look at little more than the first point of each element.
"""

from __future__ import annotations

import numpy as np

from .textcore import batches, mix, shingle_hashes, uniform

COMPONENTS = 80
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD1B54A32D192ED03)


def _levels(keys: np.ndarray, weights: np.ndarray, owner: np.ndarray):
    """One row per (element, dyadic level): the process's key, level floor and width, the element's weight, its document."""
    depth = np.where(weights <= 1, 0, np.ceil(np.log2(np.maximum(weights, 1))).astype(np.int64))
    times = depth + 1
    row = np.repeat(np.arange(len(keys)), times)
    level = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    floor = np.where(level == 0, 0.0, 2.0 ** (level - 1.0))
    width = np.where(level == 0, 1.0, floor)
    return mix(keys[row] + _GOLD * (level.astype(np.uint64) + np.uint64(1))), floor, width, weights[row].astype(float), owner[row]


def signatures(keys: np.ndarray, weights: np.ndarray, owner: np.ndarray, documents: int, components: int = COMPONENTS) -> np.ndarray:
    """Signatures (documents x components, unsigned 32 bit) of the multisets given as distinct (owner, key) with weights.

    A document without elements has a row of zeros.
    """
    times = np.full(documents * components, np.inf)
    values = np.zeros(documents * components, dtype=np.uint64)
    if len(keys):
        state, floor, width, weight, doc = _levels(keys, weights, owner)
        now = np.zeros(len(state))
        total = np.bincount(owner, weights=weights, minlength=documents)
        # a first guess of each document's latest component; documents for which it is too early get twice as much
        limit = np.where(total > 0, (np.log(components) + 3.0) / np.maximum(total, 1e-9), np.inf)

        def advance(rows: np.ndarray) -> None:
            state[rows] = mix(state[rows])
            now[rows] -= np.log(uniform(state[rows])) / (components * width[rows])

        active, parked = np.arange(len(state)), []
        advance(active)
        while True:
            while len(active):
                due = now[active] <= limit[doc[active]]
                parked.append(active[~due])
                active = active[due]
                if len(active):
                    own = mix(state[active] ^ _STEP)
                    height = floor[active] + width[active] * uniform(mix(own + _GOLD))
                    counted = height <= weight[active]
                    cell = (doc[active] * components + (own % np.uint64(components)).astype(np.int64))[counted]
                    when, own = now[active][counted], own[counted]
                    np.minimum.at(times, cell, when)
                    won = when == times[cell]
                    values[cell[won]] = mix(own[won] + _STEP)
                    advance(active)
            early = (times.reshape(documents, components).max(axis=1) > limit) & (total > 0)
            if not early.any():
                break
            active = np.concatenate(parked)
            active, parked = active[early[doc[active]]], []
            limit[early] *= 2.0
    return (values >> np.uint64(32)).astype(np.uint32).reshape(documents, components)


def signed_texts(texts, components: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of the texts' shingle multisets, in pieces of bounded size, and the shingles of each text."""
    out = np.zeros((len(texts), components), dtype=np.uint32)
    total = np.zeros(len(texts), dtype=np.int64)
    for piece in batches(texts):
        hashes, counts = shingle_hashes(texts[piece])
        owner = np.repeat(np.arange(len(counts)), counts)
        keys, owner, weights = _distinct(hashes, owner)
        out[piece] = signatures(keys, weights, owner, len(counts), components)
        total[piece] = counts
    return out, total


def text_signatures(texts, components: int = COMPONENTS) -> np.ndarray:
    return signed_texts(texts, components)[0]


def _distinct(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (owner, hash) with their counts."""
    order = np.lexsort((hashes, owner))
    h, o = hashes[order], owner[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    at = np.flatnonzero(new)
    return h[at], o[at], np.diff(np.append(at, len(h)))
