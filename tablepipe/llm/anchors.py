"""Content-defined anchors of byte strings: the positions that every window of
``length`` bytes picks by the smallest hash of its ``gram``-byte pieces.  Equal
windows pick the same place, so repeats of at least ``length`` bytes meet at
their anchors and only about 2 in (length - gram + 2) positions are looked at."""

from __future__ import annotations

import numpy as np

_CHUNK = 1 << 19
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15 | 1)
_BYTES = np.random.default_rng(77).integers(1, 1 << 63, 256, np.uint64) * _U(2) + _U(1)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, 1 << 16)
        inverse = _U(pow(int(_BASE), -1, 1 << 64))
        for name, base in (("up", _BASE), ("down", inverse)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def find(data: bytes, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(positions, hash of the gram there, hash of all bytes that a window holding
    the gram can reach, with the gram's place among them)."""
    n = len(data)
    empty = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    if n < length:
        return empty
    raw = np.frombuffer(data, np.uint8)
    found = []
    for first in range(0, n - length + 1, _CHUNK):  # windows that start in [first, first + _CHUNK)
        last = min(first + _CHUNK, n - length + 1)
        lo, hi = max(0, first + gram - length), min(n, last + 2 * length)
        up, down = _powers(hi - lo + 1)
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(_BYTES[raw[lo:hi]] * up[: hi - lo], out=sums[1:])
        at, to = first - lo, last - lo + length - gram  # gram starts of the windows
        key = mix((sums[at + gram : to + gram] - sums[at:to]) * down[at:to])
        grams = key
        key = (key & ~_U((1 << 20) - 1)) | np.arange(len(key), dtype=np.uint64)
        width, span = length - gram + 1, 1
        while span * 2 <= width:
            key = np.minimum(key[:-span], key[span:])
            span *= 2
        if span < width:
            key = np.minimum(key[: len(key) - (width - span)], key[width - span :])
        place = np.unique((key & _U((1 << 20) - 1)).astype(np.int64))
        p = place + first
        left, right = np.maximum(p + gram - length, 0), np.minimum(p + length, n)
        around = mix((sums[right - lo] - sums[left - lo]) * down[left - lo])
        around = mix(around ^ ((p - left).astype(np.uint64) << _U(32)) ^ (right - p).astype(np.uint64))
        found.append((p, grams[place], around))
    p, g, e = (np.concatenate([f[j] for f in found]) for j in range(3))
    keep = np.ones(len(p), bool)
    keep[1:] = p[1:] != p[:-1]  # chunks may share an anchor
    order = np.argsort(p, kind="stable")
    p, g, e = p[order], g[order], e[order]
    keep = np.concatenate([[True], p[1:] != p[:-1]]) if len(p) else keep
    return p[keep], g[keep], e[keep]
