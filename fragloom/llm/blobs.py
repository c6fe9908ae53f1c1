"""Arrays as compressed blobs: what operators send in place of very many small rows.

Numbers are laid out by byte plane, so that high bytes, mostly zero, cost next to nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard

KINDS = (np.uint8, np.uint16, np.uint32, np.int64)


def dump(*arrays) -> bytes:
    head, body = [len(arrays)], []
    for x in arrays:
        head += [KINDS.index(x.dtype.type), len(x)]
        body.append(x.tobytes() if x.itemsize == 1 else np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes())
    return zstandard.ZstdCompressor(level=5).compress(np.array(head, np.int64).tobytes() + b"".join(body))


def load(blob: bytes) -> list[np.ndarray]:
    body = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(body, np.int64, 1)[0])
    head, at, out = np.frombuffer(body, np.int64, 2 * n, 8), 8 + 16 * n, []
    for kind, length in head.reshape(n, 2):
        size = np.dtype(KINDS[kind]).itemsize
        raw = np.frombuffer(body, np.uint8, length * size, at)
        out.append(np.ascontiguousarray(raw.reshape(size, length).T).reshape(-1).view(KINDS[kind]))
        at += length * size
    return out


def by_key(keys, make):
    """(key, blob) rows for each key that occurs: make(places) gives the arrays of its places."""
    order = np.argsort(keys, kind="stable")
    used, first = np.unique(keys[order], return_index=True)
    return [(int(key), dump(*make(part))) for key, part in zip(used, np.split(order, first[1:]), strict=True)] if len(used) else []


def batch(rows, name):
    """Rows (key, blob) as an Arrow batch."""
    return pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.int32()), pa.array([b for _, b in rows], pa.binary())], names=[name, "blob"])


def loaded(column, n):
    """The n arrays of each blob of an Arrow column, joined end to end."""
    parts = [load(x.as_py()) for x in column]
    return [np.concatenate([p[i] for p in parts]) for i in range(n)] if parts else [np.zeros(0, np.int64)] * n
