"""Vector bin packing of token sequences by the dot-product heuristic.

Every piece of a document demands a vector: tokens, one segment, and its
loss-bearing tokens.  A sequence has a capacity in each of them.  Sequences are
filled one at a time: of the pieces that still fit in every dimension, the one
with the largest dot product of its demand and what the sequence has left,
weighted by the mean demand of the dimension, goes in next.  When nothing fits
and tokens are left, the longest waiting piece is cut (if cutting is allowed)
so that the sequence becomes full; the rest of that piece waits on.

Documents longer than a sequence are cut into full pieces first.  Pieces are
dealt evenly to tasks by a hash of document and position; a task streams its
share through a window of bounded size, so memory is bounded at any input size
and no document has to be in one place.  A sequence that another limit or the
end of the task leaves short is cut into power-of-two lengths, which need no
padding.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.llm.common import partitions, prepare, text_or_empty
from hourglass.llm.tokens import encode_with_end, tokenizer_path


@dataclass(frozen=True)
class Limits:
    """Capacity of a sequence."""

    tokens: int = 1024
    segments: int = 128
    loss_tokens: int = 1024


ITEM = "_id long, start long, n long, doc_tokens long, ids binary, mask binary, crc long"
PIECE = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "loss_tokens long, ids binary"
)


def document_items(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
    end_id: int = 0, limits: Limits = Limits(), keep_ids: bool = True, loss: bool = True,
) -> DataFrame:
    """Pieces of at most ``limits.tokens`` ids of every document (null text:
    only the end id).  All tokens bear loss (``loss``) or none do.  Without
    ``keep_ids`` full pieces carry only their crc32."""
    prepare(docs)
    vocab = tokenizer or tokenizer_path()
    size = limits.tokens if not loss else min(limits.tokens, limits.loss_tokens)
    if limits.segments < 1 or size < 1:
        raise ValueError("every limit must be at least one")

    def cut(batches):
        import pyarrow as pa

        for batch in batches:
            docs_in, rows = batch.column("_id").to_pylist(), []
            for doc, ids in zip(docs_in, encode_with_end(batch.column("_text"), vocab, end_id)):
                ids = ids.astype("<u4", copy=False)
                for a in range(0, len(ids), size):
                    part = ids[a : a + size]
                    whole = len(part) == limits.tokens and not keep_ids
                    rows.append((doc, a, len(part), len(ids), None if whole else part.tobytes(),
                                 None if loss else bytes(len(part)), zlib.crc32(part)))
                if len(rows) >= 4096:
                    yield _batch(pa, rows, ITEM)
                    rows = []
            if rows:
                yield _batch(pa, rows, ITEM)

    return docs.select(F.col(id_col).cast("long").alias("_id"), text_or_empty(text_col).alias("_text")).mapInArrow(cut, ITEM)


def example_items(examples: DataFrame, id_col: str, ids_col: str, mask_col: str | None = None) -> DataFrame:
    """Items from tokenised examples: ``ids_col`` binary little-endian u32 ids,
    ``mask_col`` binary with one 0/1 byte per id (null: all bear loss).
    Null or empty ids give no item."""
    n = (F.octet_length(ids_col) / 4).cast("long")
    return examples.filter(F.octet_length(ids_col) > 0).select(
        F.col(id_col).cast("long").alias("_id"), F.lit(0).cast("long").alias("start"), n.alias("n"),
        n.alias("doc_tokens"), F.col(ids_col).alias("ids"),
        (F.col(mask_col) if mask_col else F.lit(None).cast("binary")).alias("mask"), F.lit(0).cast("long").alias("crc"),
    )


def _batch(pa, rows, ddl: str):
    kinds = {"long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in ddl.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), kinds[k]) for c, (_, k) in zip(zip(*rows), fields)], [name for name, _ in fields]
    )


class _Window:
    """Waiting pieces of one task, packed into sequences."""

    def __init__(self, limits: Limits, cut: bool, size: int):
        self.cap = np.array([limits.tokens, limits.segments, limits.loss_tokens], dtype=np.float64)
        self.cut, self.size = cut, size
        self.items: list = []  # (doc, start, ids, mask, doc_tokens)
        self.need = np.zeros((0, 3))

    def add(self, items: list) -> None:
        need = [(len(i[2]) // 4, 1, len(i[2]) // 4 if i[3] is None else sum(i[3])) for i in items]
        self.items += items
        self.need = np.concatenate([self.need, np.array(need, dtype=np.float64).reshape(-1, 3)])

    def _drop(self, gone: list[int]) -> None:
        stay = np.ones(len(self.items), dtype=bool)
        stay[gone] = False
        self.items = [x for x, s in zip(self.items, stay) if s]
        self.need = self.need[stay]

    def sequence(self) -> list:
        """Pieces of the next sequence."""
        demand = self.need / self.cap
        weight = demand.mean(axis=0) + 1e-9
        left = np.ones(3)
        waiting = np.ones(len(self.items), dtype=bool)
        got = []
        while True:
            fits = waiting & (demand <= left + 1e-12).all(axis=1)
            if not fits.any():
                break
            score = np.where(fits, demand @ (weight * left), -1.0)
            best = int(score.argmax())
            got.append(best)
            waiting[best] = False
            left = left - demand[best]
        out = [self.items[i] for i in got]
        room = np.rint(left * self.cap).astype(int)
        rest = np.flatnonzero(waiting)
        if self.cut and len(rest) and (room > 0).all():
            i = int(rest[self.need[rest, 0].argmax()])
            doc, start, ids, mask, total = self.items[i]
            n = min(room[0], len(ids) // 4 - 1)
            if mask is None:
                n = min(n, room[2])
            else:
                bears = np.cumsum(np.frombuffer(mask[: n], dtype=np.uint8))
                n = min(n, int(np.searchsorted(bears, room[2], side="right")))
            if n > 0:
                out.append((doc, start, ids[: 4 * n], mask and mask[:n], total))
                tail = (doc, start + int(n), ids[4 * n :], mask and mask[n:], total)
                self.items[i] = tail
                m = len(tail[2]) // 4
                self.need[i] = (m, 1, m if tail[3] is None else sum(tail[3]))
        if not got and not out:
            raise ValueError("a piece exceeds a limit and may not be cut")
        self._drop(got)
        return out


def _powers(pieces: list) -> list[list]:
    """A sequence cut into sequences of power-of-two lengths, longest first."""
    total = sum(len(p[2]) // 4 for p in pieces)
    sizes = [1 << b for b in range(total.bit_length() - 1, -1, -1) if total >> b & 1]
    out, queue = [], list(pieces)
    for size in sizes:
        seq, room = [], size
        while room:
            doc, start, ids, mask, n_doc = queue.pop(0)
            n = len(ids) // 4
            if n > room:
                queue.insert(0, (doc, start + room, ids[4 * room :], mask and mask[room:], n_doc))
                ids, mask, n = ids[: 4 * room], mask and mask[:room], room
            seq.append((doc, start, ids, mask, n_doc))
            room -= n
        out.append(seq)
    return out


def pack(items: DataFrame, limits: Limits = Limits(), cut: bool = True, window: int = 1024, keep_ids: bool = True) -> DataFrame:
    """Place items into sequences; one row per piece (see module text).

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    loss_tokens, ids.  ``cut=False`` keeps every item whole; one that exceeds a
    limit then raises.  Repeated rows are packed each for itself; rows without
    an id are packed like any other; an empty table gives no sequence.
    """
    spark = prepare(items)

    def place(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        task, serial = TaskContext.get().partitionId(), 0
        win = _Window(limits, cut, window)

        def rows_of(seq):
            nonlocal serial
            offset, rows = 0, []
            for doc, start, ids, mask, total in seq:
                n = len(ids) // 4
                rows.append((doc, start, n, zlib.crc32(ids), total, (task << 40) | serial, offset,
                             n if mask is None else sum(mask), ids if keep_ids else None))
                offset += n
            serial += 1
            return rows

        def place_all(seq):
            # stopped by segments, loss or the end of the task: power-of-two lengths need no padding
            short = cut and sum(len(p[2]) // 4 for p in seq) < limits.tokens
            return [row for s in (_powers(seq) if short else [seq]) for row in rows_of(s)]

        out: list = []
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("_id", "start", "n", "doc_tokens", "ids", "mask", "crc")]
            fresh = []
            for doc, start, n, total, ids, mask, crc in zip(*cols):
                if ids is None:  # a full piece: a sequence of its own
                    out.append((doc, start, n, crc, total, (task << 40) | serial, 0, n, None))
                    serial += 1
                else:
                    fresh.append((doc, start, ids, mask, total))
            for a in range(0, len(fresh), window):
                win.add(fresh[a : a + window])
                while len(win.items) >= window:
                    out += place_all(win.sequence())
                if len(out) >= 4096:
                    yield _batch(pa, out, PIECE)
                    out = []
        while win.items:
            out += place_all(win.sequence())
        if out:
            yield _batch(pa, out, PIECE)

    dealt = items.repartition(partitions(spark), F.xxhash64("_id", "start")).sortWithinPartitions("_id", "start", "crc")
    return dealt.mapInArrow(place, PIECE)


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
                   end_id: int = 0, limits: Limits = Limits(), keep_ids: bool = True) -> DataFrame:
    """Tokenise whole documents and pack them (all tokens bear loss)."""
    return pack(document_items(docs, id_col, text_col, tokenizer, end_id, limits, keep_ids), limits, keep_ids=keep_ids)
