"""Sparse weighted MinHash signatures by throwing darts.

Every element of a set throws hashed darts into its region, weight by rank: one dart in
each cell of a unit grid over weight and rank. A dart lands at a weight, a rank and one of
k coordinates, all of them hashes of the element and the cell, so that equal elements of
different sets throw equal darts. A coordinate keeps its dart of the lowest rank. Two sets
agree in a coordinate with the probability of their weighted Jaccard similarity. Some
k ln k + 2k darts fill a signature, however large the set, where plain MinHash hashes
every element k times.
"""

from __future__ import annotations

import numpy as np

_EMPTY = np.uint64(2**64 - 1)
#: Darts held at once: few enough to stay in a processor's cache.
DARTS = 100_000


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64: 64 bits in, 64 well mixed bits out."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def signatures(elements: np.ndarray, lengths: np.ndarray, k: int, weights: np.ndarray | None = None, seed: int = 1) -> np.ndarray:
    """The signatures, one row of k coordinates per set.

    elements: the sets' hashed elements, one set after the other, each element once in a set;
    lengths: the sets' sizes; weights: positive numbers, 1 if absent. k is a power of two. An
    empty set, and one of weight zero alone, has a row of _EMPTY.
    """
    sets = len(lengths)
    signature = np.full(sets * k, _EMPTY, np.uint64)
    owner = np.repeat(np.arange(sets, dtype=np.int64), lengths)
    if weights is None:
        total, cells = lengths.astype(float), None
    else:
        total = np.bincount(owner, weights=weights, minlength=sets)
        # an element of weight w covers ceil(w) cells, the last of them in part
        cells = np.ceil(weights).astype(np.int64)
        level = np.arange(int(cells.sum())) - np.repeat(np.cumsum(cells) - cells, cells)
        part = np.minimum(np.repeat(weights, cells) - level, 1.0)
        owner = np.repeat(owner, cells)
        elements = np.repeat(elements, cells) + level.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    base = mix(elements.astype(np.uint64) ^ mix(np.array([seed], np.uint64)))
    with np.errstate(divide="ignore"):
        reach = np.where(total > 0, np.ceil((k * np.log(k) + 2 * k) / total), 0).astype(np.int64)
    lo = np.zeros(sets, np.int64)
    mask, shift = np.uint64(k - 1), np.uint64(28)
    todo = np.arange(len(base))
    while len(todo):
        own = owner[todo]
        # sets of like reach go together, so that the grid of darts is a full rectangle
        order = np.argsort(reach[own] - lo[own], kind="stable")
        todo, own = todo[order], own[order]
        need = (reach[own] - lo[own])[:, None]
        at = 0
        while at < len(todo):
            rows = max(1, min(len(todo) - at, DARTS // max(1, int(need[min(len(todo) - 1, at + DARTS // max(1, int(need[at, 0]))), 0]))))
            part_of = slice(at, at + rows)
            wide = int(need[part_of].max())
            band = (lo[own[part_of]][:, None] + np.arange(wide)).astype(np.uint64)
            dart = mix(base[todo[part_of], None] + band * np.uint64(0x9E3779B97F4A7C15))
            spot = own[part_of, None] * k + (dart & mask).astype(np.int64)
            # rank: the band, then 24 bits of place within it; 28 bits more tell the dart
            value = (((band << np.uint64(24)) | (dart >> np.uint64(40))) << shift) | ((dart >> np.uint64(12)) & np.uint64((1 << 28) - 1))
            keep = np.arange(wide) < need[part_of]
            if cells is not None:
                height = (mix(dart) >> np.uint64(11)).astype(float) / 2**53
                keep &= height < part[todo[part_of], None]
            if keep.all():
                np.minimum.at(signature, spot.ravel(), value.ravel())
            else:
                np.minimum.at(signature, spot[keep], value[keep])
            at += rows
        # sets with a coordinate no dart has hit throw as many darts again
        hollow = (signature.reshape(sets, k) == _EMPTY).any(axis=1) & (total > 0)
        lo, reach = reach, np.where(hollow, 2 * reach, reach)
        todo = todo[hollow[own]]
    return signature.reshape(sets, k)


def bands(signature: np.ndarray, count: int, rows: int, seed: int = 1) -> np.ndarray:
    """count keys per set, each over rows coordinates; bands share coordinates where k < count * rows.

    The coordinates of a band are drawn once from the seed, so they are the same everywhere.
    """
    k = signature.shape[1]
    rng = np.random.Generator(np.random.PCG64(seed))
    if count * rows <= k:
        chosen = np.arange(count * rows).reshape(count, rows)
    else:
        chosen = np.concatenate([rng.permutation(k) for _ in range(-(-count * rows // (k // rows * rows)))]).reshape(-1, k)[:, : k // rows * rows].reshape(-1, rows)[:count]
    keys = np.empty((len(signature), count), np.uint64)
    for b, at in enumerate(chosen):
        key = np.full(len(signature), (b + 1) * 0x9E3779B97F4A7C15 % 2**64, np.uint64)
        for j in at:
            key = mix(key + signature[:, j])
        keys[:, b] = key
    return keys
