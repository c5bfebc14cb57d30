"""Substring removal over bytes with a multi-document Burrows-Wheeler transform.

The collection's transform is built column by column: in round j one symbol of
every document (the j-th from its end) is inserted.  The transform of all
suffixes of at most j-1 symbols is read, each document's new suffix is placed by
last-to-first mapping, and the transform and the array of common prefixes are
rewritten to the next pair of external files, front to back.  A new suffix's
common prefix with its neighbour is one more than the least common prefix
between the occurrences of its first symbol that precede and follow.

The collections are shards of candidate segments (see ``repeats.py``): every
shard has a bounded number of segments of fewer than two windows each, so the
number of rounds is bounded whatever the length of the texts.  In the finished
order, windows with equal content are neighbours whose common prefix is at
least a window long.
"""

from __future__ import annotations

import hashlib
import os
import tempfile

import numpy as np
from pyspark.sql import DataFrame

from hourglass.llm.repeats import removed_mask, repeated_spans

END = 255  # stands before a document's first byte; never occurs in UTF-8
_TABLE = np.random.default_rng(20240101).integers(0, 1 << 64, 256, dtype=np.uint64)


class Bytes:
    @staticmethod
    def payload(text: str) -> np.ndarray:
        return np.frombuffer(text.encode("utf-8"), dtype=np.uint8)

    @staticmethod
    def hashes(text: str) -> np.ndarray:
        return _TABLE[Bytes.payload(text)]


class ColumnFiles:
    """Transform and common prefixes of a collection in alternating files,
    opened once and rewritten from the front."""

    def __init__(self, folder: str):
        self.files = [[open(os.path.join(folder, f"{w}.{t}"), "w+b") for w in ("bwt", "lcp")] for t in (0, 1)]
        self.turn, self.size = 0, 0

    def write(self, *columns: np.ndarray) -> None:
        self.turn ^= 1
        self.size = len(columns[0])
        for f, c in zip(self.files[self.turn], columns):
            f.seek(0)
            f.write(c.data)
            f.flush()

    def read(self) -> list[np.ndarray]:
        out = []
        for f in self.files[self.turn]:
            f.seek(0)
            out.append(np.frombuffer(f.read(self.size), dtype=np.uint8))
        return out

    def close(self) -> None:
        for pair in self.files:
            for f in pair:
                f.close()


def _least_between(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Minimum of ``values[first..last]`` for every pair, ``first`` ascending."""
    padded = np.append(values, 0)
    return np.minimum.reduceat(padded, np.stack([first, last + 1], axis=1).ravel())[::2]


def build_transform(docs: list[bytes], cap: int, folder: str) -> tuple[np.ndarray, np.ndarray]:
    """``bwt, lcp`` of the collection; common prefixes are counted up to ``cap``."""
    n = len(docs)
    lens = np.array([len(d) for d in docs])
    deep = int(lens.max(initial=0))
    back = np.full((n, deep + 1), END, dtype=np.uint8)  # column j: j-th symbol from the end
    for i, d in enumerate(docs):
        back[i, : len(d)] = np.frombuffer(d, dtype=np.uint8)[::-1]
    files = ColumnFiles(folder)
    files.write(back[:, 0].copy(), np.zeros(n, dtype=np.uint8))
    at = np.arange(n)
    live = np.flatnonzero(lens > 0)
    for j in range(1, deep + 1):
        live = live[lens[live] >= j]
        bwt, lcp = files.read()
        order = np.argsort(bwt, kind="stable")
        order = order[: len(bwt) - np.count_nonzero(bwt == END)]
        to = np.empty(len(bwt), dtype=np.int64)
        to[order] = np.arange(len(order))
        here = np.sort(at[live])
        rank = to[here]
        symbol = bwt[here]
        # neighbours that start with the same symbol, and the least prefix up to them
        new_lcp = np.zeros(len(here), dtype=np.uint8)
        next_lcp = np.zeros(len(here), dtype=np.uint8)
        before = order[np.maximum(rank - 1, 0)]
        ok = np.flatnonzero((rank > 0) & (bwt[before] == symbol))
        by = ok[np.argsort(before[ok], kind="stable")]
        new_lcp[by] = np.minimum(_least_between(lcp, before[by] + 1, here[by]).astype(np.int16) + 1, cap) if len(by) else 0
        after = order[np.minimum(rank + 1, len(order) - 1)]
        ok = np.flatnonzero((rank + 1 < len(order)) & (bwt[after] == symbol))
        if len(ok):
            next_lcp[ok] = np.minimum(_least_between(lcp, here[ok] + 1, after[ok]).astype(np.int16) + 1, cap)
        place = n + rank
        total = n + len(order)
        old = np.ones(total, dtype=bool)
        old[place] = False
        bwt2, lcp2 = np.empty(total, dtype=np.uint8), np.empty(total, dtype=np.uint8)
        bwt2[old], lcp2[old] = bwt, lcp
        follow = place + 1 < total
        lcp2[place[follow] + 1] = next_lcp[follow]
        lcp2[place] = new_lcp
        at[live] = n + to[at[live]]
        bwt2[at[live]] = back[live, j]
        files.write(bwt2, lcp2)
    done = files.read()
    files.close()
    return tuple(done)


def seen_windows(docs: list[bytes], width: int) -> list[np.ndarray]:
    """Per document: which of its windows also stand in an earlier document of
    the list (a window never repeats inside one segment)."""
    n = len(docs)
    lens = np.array([len(d) for d in docs])
    out = [np.zeros(max(0, m - width + 1), dtype=bool) for m in lens]
    with tempfile.TemporaryDirectory() as folder:
        bwt, lcp = build_transform(docs, width, folder)
    order = np.argsort(bwt, kind="stable")[: len(bwt) - np.count_nonzero(bwt == END)]
    to = np.empty(len(bwt), dtype=np.int64)
    to[order] = n + np.arange(len(order))
    group = np.cumsum(lcp < width)  # equal for windows of equal content
    first = np.full(group[-1] + 1 if len(group) else 1, n, dtype=np.int64)
    at, live = np.arange(n), np.arange(n)
    places = []
    for j in range(1, int(lens.max(initial=0)) + 1):
        live = live[lens[live] >= j]
        at[live] = to[at[live]]
        if j >= width:
            g = group[at[live]]
            np.minimum.at(first, g, live)
            places.append((j, live, g))
    for j, who, g in places:
        for i in who[first[g] < who]:
            out[i][lens[i] - j] = True
    return out


def remove_repeats(docs: DataFrame, width: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row ``_id, kept (binary), n_bytes, n_removed, n_spans,
    kept_sha256``: the UTF-8 bytes left when every byte covered by a string of
    ``width`` bytes that also starts earlier is removed.

    Null texts are empty; texts shorter than a window stay whole; rows
    repeating id and text are one document; a missing id sorts last.
    """
    gram = 1 << max(0, (2 * width // 5).bit_length() - 1)
    base, spans = repeated_spans(docs, Bytes, width, gram, seen_windows, id_col, text_col)

    def apply(batches):
        import pyarrow as pa

        for b in batches:
            out = []
            for text, cut, copy in zip(*(b.column(c).to_pylist() for c in ("_text", "_spans", "_copy"))):
                raw = Bytes.payload(text)
                gone = removed_mask(cut, len(raw), copy and len(raw) >= width)
                kept = raw[~gone].tobytes()
                starts = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(gone[:1].any())
                out.append((kept, len(raw), int(gone.sum()), starts, hashlib.sha256(kept).hexdigest()))
            if out:
                types = ("binary", "int64", "int64", "int64", "string")
                yield pa.RecordBatch.from_arrays(
                    [b.column("_id"), *(pa.array(list(c), t) for c, t in zip(zip(*out), types))],
                    ["_id", "kept", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return base.join(spans, ["_ord", "_v"], "left").select("_id", "_text", "_copy", "_spans").mapInArrow(
        apply, "_id long, kept binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
