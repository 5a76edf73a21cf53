"""Vectorised helpers over Arrow batches: bytes, words, hashes, packed rows.

All functions work on one Arrow batch (or a slice of it) inside a task. Null
texts count as empty. Words are maximal runs of bytes outside
``\\x20 \\x09-\\x0D``; they never cross a document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard

U64 = np.uint64
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

_C1, _C2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)


def mix64(a: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (wraps around on overflow)."""
    a = a ^ (a >> U64(30))
    a = a * _C1
    a = a ^ (a >> U64(27))
    a = a * _C2
    return a ^ (a >> U64(31))


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def longs(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return column(batch, name).to_numpy(zero_copy_only=False).astype(np.int64)


def string_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a string column as one byte array and their offsets."""
    if col.null_count:
        col = pc.fill_null(col, b"" if pa.types.is_binary(col.type) else "")
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    kind = np.int64 if wide else np.int32
    off = np.frombuffer(col.buffers()[1], kind)[col.offset:col.offset + len(col) + 1]
    off = off.astype(np.int64)
    buf = col.buffers()[2]
    data = np.frombuffer(buf, np.uint8) if buf is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def slices(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of documents with about ``limit`` bytes each (one at least), so
    that temporary arrays stay small whatever a batch holds."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def word_spans(data: np.ndarray, offsets: np.ndarray):
    """``starts, ends`` (byte positions) of all words and ``first``: index of
    the first word of each document, with the total at the end."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    inside = ~SPACE[data]
    opens = np.zeros(n + 1, dtype=bool)
    opens[offsets] = True
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | opens[:-1]))
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | opens[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


_P, _PINV = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64))
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 16)
        out = []
        for base in (_P, _PINV):
            a = np.full(size, base, dtype=np.uint64)
            a[0] = 1
            out.append(np.cumprod(a, dtype=np.uint64))
        _POWERS[:] = out
    return _POWERS


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every word: differences of one polynomial prefix sum."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    up, down = _powers(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:len(data)], dtype=np.uint64, out=total[1:])
    h = (total[ends] - total[starts]) * down[starts]
    return mix64(h + (ends - starts).astype(np.uint64))


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` consecutive words from each word on (``len-k+1``)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    a = h[:n].copy()
    for j in range(1, k):
        a = a * U64(_P) + h[j:n + j]
    return mix64(a)


def sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    """Minimum over each ``width`` consecutive values, by doubling."""
    n = len(a) - width + 1
    if n <= 0:
        return a[:0]
    m, s = a, 1
    while 2 * s <= width:
        m = np.minimum(m[:-s], m[s:])
        s *= 2
    return np.minimum(m[:n], m[width - s:width - s + n])


class Memo:
    """Bounded memory of a worker in two generations: what is used stays, what
    was not used while ``size`` new keys came is forgotten. A long key counts
    once for each 64 characters."""

    def __init__(self, size: int):
        self.now: dict = {}
        self.before: dict = {}
        self.size, self.held = size, 0

    @staticmethod
    def weight(keys) -> int:
        return len(keys) + sum([n >> 6 for n in map(len, keys)])

    def missing(self, keys: set) -> list:
        """Keys to be added to ``now``; all others of ``keys`` are in it."""
        new = keys.difference(self.now)
        self.held += self.weight(new)
        if self.held > self.size:
            self.before, self.now = self.now, {}
            new, self.held = keys, self.weight(keys)
        if self.before:
            kept = {k: self.before[k] for k in new if k in self.before}
            self.now.update(kept)
            new = new.difference(kept)
        return list(new)


# Packed rows: many small rows of one bucket travel as one compressed blob.

def pack(cols: list[tuple[np.ndarray, int]]) -> bytes:
    """Columns (64-bit arrays, bytes kept of each) as one compressed blob of
    byte planes."""
    n = len(cols[0][0])
    planes = [np.ascontiguousarray(a).view(np.uint8).reshape(n, 8)[:, :w].T.tobytes()
              for a, w in cols]
    return n.to_bytes(8, "little") + zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpack(blob: bytes, widths: list[int]) -> list[np.ndarray]:
    n = int.from_bytes(blob[:8], "little")
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[8:]), np.uint8)
    out, at = [], 0
    for w in widths:
        a = np.zeros((n, 8), np.uint8)
        a[:, :w] = raw[at:at + n * w].reshape(w, n).T
        out.append(a.reshape(-1).view(np.uint64))
        at += n * w
    return out


BLOB = "bucket int, kind int, payload binary"
BLOB_ARROW = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("payload", pa.binary())])


def to_blobs(bucket: np.ndarray, kind: int, cols: list[tuple[np.ndarray, int]],
             deltas: int | None = None) -> pa.RecordBatch:
    """One blob per bucket. ``deltas``: index of a column kept as differences
    (document ids, which rise inside a batch)."""
    order = np.argsort(bucket, kind="stable")
    b = bucket[order]
    sorted_cols = [(a[order], w) for a, w in cols]
    cuts = np.flatnonzero(np.r_[True, b[1:] != b[:-1]]) if len(b) else np.zeros(0, np.int64)
    ends = np.r_[cuts[1:], len(b)]
    payloads = []
    for i, j in zip(cuts.tolist(), ends.tolist()):
        part = [(a[i:j], w) for a, w in sorted_cols]
        if deltas is not None:
            a, w = part[deltas]
            part[deltas] = (np.diff(a.view(np.int64), prepend=0).view(np.uint64), w)
        payloads.append(pack(part))
    return pa.RecordBatch.from_arrays(
        [pa.array(b[cuts].astype(np.int32)), pa.array(np.full(len(cuts), kind, np.int32)),
         pa.array(payloads, pa.binary())], schema=BLOB_ARROW)


def from_blobs(payloads: list[bytes], widths: list[int], deltas: int | None = None) -> list[np.ndarray]:
    parts = []
    for p in payloads:
        cols = unpack(p, widths)
        if deltas is not None:
            cols[deltas] = np.cumsum(cols[deltas].view(np.int64)).view(np.uint64)
        parts.append(cols)
    return [np.concatenate(c) for c in zip(*parts)]


def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict[int, list[bytes]]]]:
    """Blobs of a partition sorted by bucket, one bucket at a time."""
    now, held = None, {}
    for batch in batches:
        buckets = column(batch, "bucket").to_pylist()
        kinds = column(batch, "kind").to_pylist()
        payloads = column(batch, "payload")
        for i, (b, k) in enumerate(zip(buckets, kinds)):
            if b != now and held:
                yield now, held
                held = {}
            now = b
            held.setdefault(k, []).append(payloads[i].as_py())
    if held:
        yield now, held


def bucket_count(spark) -> int:
    """Buckets follow the session's shuffle partitions, so a bucket keeps its
    size when data and cluster grow together."""
    return 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def group_edges(*keys: np.ndarray) -> np.ndarray:
    """Start index of each group in arrays sorted by ``keys``, and the length."""
    n = len(keys[0])
    new = np.zeros(n, dtype=bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.r_[np.flatnonzero(new), n]
