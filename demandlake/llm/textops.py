"""Vectorised text helpers for Arrow batches (numpy inside Spark tasks).

A batch's strings are one contiguous UTF-8 buffer plus offsets, so words,
windows and lines are found with array operations and no per-word Python.
Words are runs of bytes outside ``\\x20 \\x09-\\x0D``; all separators are
ASCII, so byte runs equal code-point runs.  Hashes are 64 bits wide: a
polynomial over a random byte table, finished by an avalanche mix.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_ODD = U(0x9E3779B97F4A7C15)
_BASE = 0xD1342543DE82EF95  # odd, hence invertible modulo 2^64
_INV = pow(_BASE, -1, 1 << 64)
_TABLE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)

WS = np.zeros(256, bool)
WS[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of text handled by one round of array work.
CHUNK_BYTES = 2 << 20
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finisher (uint64 in, uint64 out)."""
    x = x.astype(np.uint64)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def _powers(name: str, base: int, n: int) -> np.ndarray:
    have = _POWERS.get(name)
    if have is None or len(have) < n:
        size = next(s for s in (CHUNK_BYTES // 4, CHUNK_BYTES + 4096, n) if s >= n)
        out = np.full(size, U(base), np.uint64)
        out[0] = U(1)
        out = np.multiply.accumulate(out)
        if n > 8 * CHUNK_BYTES:  # one giant text: do not hold its powers for the worker's life
            return out
        _POWERS[name] = have = out
    return have


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    if not wide and not pa.types.is_string(column.type):
        column, wide = column.cast(pa.large_string()), True
    _, offs, data = column.buffers()
    off = np.frombuffer(offs, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = CHUNK_BYTES):
    """(rows, bytes, offsets) of slices of at most ``limit`` text bytes (one
    row at least), so array work stays small whatever the batch holds."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, off = utf8(batch.column(text))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(off, off[at] + limit, "right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at), data[off[at] : off[to]], off[at : to + 1] - off[at]
            at = to


def prefix_hash(data: np.ndarray) -> np.ndarray:
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_TABLE[data] * _powers("up", _BASE, len(data))[: len(data)], out=out[1:])
    return out


def span_hash(pre: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each byte span [start, end): equal bytes, equal hash."""
    down = _powers("down", _INV, len(pre))
    return mix((pre[end] - pre[start]) * down[start] + (end - start).astype(np.uint64) * _ODD)


def words(data: np.ndarray, off: np.ndarray, sep: np.ndarray = WS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, word_off): byte spans of all words, and for each text
    the index of its first word (one more entry closes the last text)."""
    solid = ~sep[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    inner = off[(off > 0) & (off < len(data))]
    first[inner] |= solid[inner]
    last[inner - 1] |= solid[inner - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(start, off)


def windows(word_hash: np.ndarray, word_off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first word, text) of every window of k words inside one text."""
    n = len(word_hash)
    doc = np.repeat(np.arange(len(word_off) - 1), np.diff(word_off))
    if n < k:
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), z, z
    acc = word_hash[: n - k + 1].copy()
    for j in range(1, k):
        acc = acc * U(_BASE) + word_hash[j : n - k + 1 + j]
    at = np.flatnonzero(doc[: n - k + 1] == doc[k - 1 :])
    return mix(acc[at]), at, doc[at]


def per_text(key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """One key for (value, text), so that equal keys mean both are equal."""
    return mix(key + mix(doc.astype(np.uint64) + _ODD))


def repeated(key: np.ndarray) -> np.ndarray:
    """Mask of entries whose key occurs at least twice."""
    s = np.sort(key)
    again = s[1:][s[1:] == s[:-1]]
    if not len(again):
        return np.zeros(len(key), bool)
    again = again[np.r_[True, again[1:] != again[:-1]]]
    pos = np.searchsorted(again, key)
    pos[pos == len(again)] = 0
    return again[pos] == key


def later(key: np.ndarray) -> np.ndarray:
    """Mask of entries equal to an earlier one."""
    out = np.zeros(len(key), bool)
    idx = np.flatnonzero(repeated(key))
    if len(idx):
        sub = key[idx]
        o = np.argsort(sub, kind="stable")
        out[idx[o[1:][sub[o[1:]] == sub[o[:-1]]]]] = True
    return out


def totals(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sum of ``values[off[i]:off[i+1]]`` for each i; a text's float sum does
    not depend on its neighbours."""
    if values.dtype.kind == "f":
        out = np.zeros(len(off) - 1)
        some = np.flatnonzero(np.diff(off))
        if len(some):
            out[some] = np.add.reduceat(values, off[:-1][some])
        return out
    acc = np.zeros(len(values) + 1, np.uint64 if values.dtype == np.uint64 else np.int64)
    np.cumsum(values, out=acc[1:])
    return acc[off[1:]] - acc[off[:-1]]
