"""Content anchors and window codes of byte strings, for operator 3 (helpers inside tasks)."""

from __future__ import annotations

import numpy as np

#: Bytes that make the first digit.
GRAM = 24
#: Window starts handled at a time, so that a very long text needs bounded memory.
CORE = 1 << 17
_POSITION_BITS = 20

_rng = np.random.Generator(np.random.PCG64(20))
_CODES = _rng.integers(1, 1 << 63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASES = [int(x) * 8 + 5 for x in _rng.integers(1, 1 << 60, 2, dtype=np.uint64)]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


class Coder:
    """Rolling codes of all windows of a byte string, by prefix sums modulo 2^64; two independent ones."""

    def __init__(self, window: int):
        n = CORE + 8 * window + 64
        self.up = [_powers(b % (1 << 64), n) for b in _BASES]
        self.down = [_powers(pow(b, -1, 1 << 64), n) for b in _BASES]

    def prefix(self, data: np.ndarray, which: int) -> np.ndarray:
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_CODES[which][data] * self.up[which][:len(data)], out=out[1:])
        return out

    def code(self, prefix: np.ndarray, starts, stops, which: int) -> np.ndarray:
        return mix((prefix[stops] - prefix[starts]) * self.down[which][starts])


def mix(x: np.ndarray) -> np.ndarray:
    """Spread a code over all 64 bits (one to one)."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _window_least(values: np.ndarray, w: int) -> np.ndarray:
    """Least value of each w neighbours, from block-wise running minima forwards and backwards."""
    n = len(values) - w + 1
    blocks = -(-len(values) // w)
    padded = np.full(blocks * w, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(values)] = values
    grid = padded.reshape(blocks, w)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[w - 1:w - 1 + n])


def runs(data: np.ndarray, coder: Coder, window: int):
    """Runs of windows that share an anchor: (gram, ext, first start, number of windows, anchor).

    A window's anchor is the leftmost of its grams with the least code, so equal
    windows have equal anchors at equal offsets, wherever they stand. gram is the
    anchor's code, ext the code of all bytes the run's windows cover.
    """
    n, w = len(data) - window + 1, window - GRAM + 1
    low = np.uint64((1 << _POSITION_BITS) - 1)
    for core in range(0, max(n, 0), CORE):
        a, b = max(0, core - w), min(n, core + CORE + w)
        part = data[a:b + window - 1]
        p0, p1 = coder.prefix(part, 0), coder.prefix(part, 1)
        grams = coder.code(p0, np.s_[:len(part) - GRAM + 1], np.s_[GRAM:], 0)
        places = np.arange(len(grams), dtype=np.uint64)
        least = _window_least((grams & ~low) | places, w) & low
        first = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
        last = np.append(first[1:], b - a) - 1
        own = (first + a >= core) & (first + a < core + CORE) & ((first > 0) | (a == 0))
        first, last = first[own], last[own]
        yield (grams[least[first].astype(np.int64)].view(np.int64), coder.code(p1, first, last + window, 1).view(np.int64),
               first + a, last - first + 1, least[first].astype(np.int64) + a)


def _stretches(first: np.ndarray, stop: np.ndarray):
    """Index ranges of sorted stretches that lie close enough together to be coded at once."""
    at = 0
    while at < len(first):
        end = int(np.searchsorted(first, first[at] + CORE, side="left"))
        yield slice(at, end), int(first[at]), int(stop[at:end].max())
        at = end


def _spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first, first + 1, ... (count of them) of every pair, one after the other."""
    return np.repeat(first - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())


def sub_runs(data: np.ndarray, coder: Coder, window: int, step: int, first, count, anchor):
    """Runs (sorted by first) cut at multiples of step before their anchor: (core, ext, first start, number of windows).

    core is the code of the bytes that all windows of a full step share (any
    clipped one has them too), ext of all bytes covered. Equal windows lie in
    sub-runs of equal core.
    """
    for part, a, b in _stretches(first, first + count + window):
        p0, p1 = coder.prefix(data[a:b], 0), coder.prefix(data[a:b], 1)
        f, c, at = first[part], count[part], anchor[part]
        least, most = (at - f - c + 1) // step, (at - f) // step
        pieces = most - least + 1
        run = np.repeat(np.arange(len(f)), pieces)
        q = _spread(least, pieces)
        near = np.maximum(q * step, (at - f - c + 1)[run])
        far = np.minimum(q * step + step - 1, (at - f)[run])
        whole = np.minimum(q * step + step - 1, window - GRAM)
        at = at[run] - a
        core = coder.code(p0, at - q * step, at - whole + window, 0) ^ q.astype(np.uint64)
        ext = coder.code(p1, at - far, at - near + window, 1) ^ (near * 1024 + far).astype(np.uint64)
        yield mix(core).view(np.int64), mix(ext).view(np.int64), at - far + a, far - near + 1


def window_codes(data: np.ndarray, coder: Coder, window: int, first: np.ndarray, count: np.ndarray):
    """(code, code, start) of every window of the given runs (sorted by first)."""
    for part, a, b in _stretches(first, first + count + window):
        starts = _spread(first[part] - a, count[part])
        x, y = (coder.code(coder.prefix(data[a:b], i), starts, starts + window, i).view(np.int64) for i in (0, 1))
        yield x, y, starts + a
