"""Word shingles of whole Arrow string columns as 64-bit hashes, without a loop per word.

Words are runs of bytes other than blank, tab, LF, VT, FF and CR; A-Z are lower-cased. A
word's hash is a polynomial over its bytes, read from prefix sums of the whole batch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_POWERS: dict[str, np.ndarray] = {}


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser: spreads every input bit over all output bits."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def byte_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, n of each at least."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, 1 << 16)
        up, down = np.full(size, _BASE, np.uint64), np.full(size, _INVERSE, np.uint64)
        up[0] = down[0] = 1
        _POWERS["up"], _POWERS["down"] = np.cumprod(up), np.cumprod(down)
    return _POWERS["up"], _POWERS["down"]


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the n + 1 offsets of its values; null counts as empty."""
    texts = texts.cast(pa.large_string()).fill_null("") if texts.null_count else texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    body = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return body, at - at[0]


def words(texts: pa.Array, piece: int = 1 << 21) -> tuple[np.ndarray, np.ndarray]:
    """(row of each word, hash of each word) in text order.

    The bytes are read in pieces of about ``piece`` bytes that end at white space or at the
    end of a text, so the work arrays stay small however long the texts are."""
    body, at = raw_bytes(texts)
    rows, hashes, lo = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], 0
    while lo < len(body):
        hi = min(lo + piece, len(body))
        while hi < len(body):  # move the cut on to white space
            stop = np.flatnonzero(_SPACE[body[hi:hi + piece]])
            hi = hi + int(stop[0]) if len(stop) else min(hi + piece, len(body))
            if len(stop):
                break
        first, last = np.searchsorted(at, lo, "right"), np.searchsorted(at, hi, "left")
        starts, h = _piece_words(body[lo:hi], at[first:last] - lo)
        rows.append(np.searchsorted(at, starts + lo, side="right") - 1)
        hashes.append(h)
        lo = hi
    return np.concatenate(rows), np.concatenate(hashes)


def _piece_words(body: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of the words in ``body``; words end at ``cuts``, where texts begin."""
    inside = ~_SPACE[body]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    cuts = cuts[(cuts > 0) & (cuts < len(body))]
    begins[cuts] = inside[cuts]
    ends[cuts - 1] = inside[cuts - 1]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    up, down = byte_powers(len(body) + 1)
    sums = np.zeros(len(body) + 1, np.uint64)
    np.cumsum((_LOWER[body].astype(np.uint64) + np.uint64(1)) * up[:len(body)], out=sums[1:])
    return starts, mix64((sums[stops] - sums[starts]) * down[starts])


def shingles(texts: pa.Array, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct k-word shingles, sorted by row and hash; a row with fewer
    words has one shingle of all of them, a row without words has none."""
    row, h = words(texts)
    if not len(row):
        return row, h
    counts = np.bincount(row, minlength=len(texts))
    begin = np.concatenate([[0], np.cumsum(counts)])[:-1]
    long_rows = counts[row] >= k
    index = np.arange(len(row))
    heads = index[long_rows & (index + k <= (begin + counts)[row])]
    factors = mix64(np.arange(1, k + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)
    acc = np.zeros(len(heads), np.uint64)
    for j in range(k):
        acc += mix64(h[heads + j] + np.uint64(j)) * factors[j]
    short = np.flatnonzero((counts > 0) & (counts < k))
    sacc = np.zeros(len(short), np.uint64)
    for j in range(k - 1):
        has = counts[short] > j
        sacc[has] += mix64(h[begin[short[has]] + j] + np.uint64(j)) * factors[j]
    sacc = mix64(sacc ^ (counts[short].astype(np.uint64) << np.uint64(56)))
    rows = np.concatenate([row[heads], short])
    hashes = np.concatenate([mix64(acc), sacc])
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    return rows[new], hashes[new]
