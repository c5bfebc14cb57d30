"""Sum-of-squares packing of documents into sequences.

``N(g)`` open sequences have room for exactly g more tokens.  A document of s
tokens goes where the sum of all N(g)^2 becomes smallest: into an open
sequence of room g (then N(g) falls and N(g - s) rises) for the g of smallest
change; ties go to the smaller room.  A sequence is opened when none has room.
Longer documents come first, which leaves the short ones to even out what is
left, and fewer sequences than in order of arrival.

Pieces are dealt evenly to tasks by a hash of document, position and content; a task
takes its pieces in order of length and knows only its open sequences, so
what it holds does not grow with the tokens.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.llm.common import partitions, prepare
from hourglass.llm.tokens import encode_with_end, tokenizer_path

WORD_BPE = "word_bpe_49k.json"
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"


class SumOfSquares:
    """Open sequences of one task by their room."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.n = np.zeros(capacity, dtype=np.int64)  # N(g); full sequences are closed
        self.open: dict[int, list[int]] = {}
        self.serial = 0

    def place(self, size: int) -> tuple[int, int]:
        """``(sequence, offset)`` of the next piece."""
        c = self.capacity
        if not 0 < size <= c:
            raise ValueError("a piece must have between one token and the capacity")
        room = self.n[size:]  # of g = size, size + 1, ...
        if size < c and room.any():
            change = 2 * (self.n[: c - size] - room) + 2
            change[0] = 1 - 2 * room[0]  # filled up: no other count rises
            change[room == 0] = np.iinfo(np.int64).max
            g = size + int(change.argmin())
            seq = self.open[g].pop()
            self.n[g] -= 1
        else:
            g, seq, self.serial = c, self.serial, self.serial + 1
        left = g - size
        if left:
            self.n[left] += 1
            self.open.setdefault(left, []).append(seq)
        return seq, c - g


def document_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
                    end_id: int = 1, capacity: int = 4096, keep_ids: bool = True) -> DataFrame:
    """Rows ``PIECE``: the ids of every document with ``end_id`` after them;
    documents over ``capacity`` are cut into pieces of that length, the last may
    be shorter.  Null text is the empty text (only the end id).  Rows without id
    and repeated rows are pieces like any other; extra columns are not read."""
    prepare(docs)
    vocab = tokenizer or tokenizer_path(WORD_BPE)

    def work(batches):
        import pyarrow as pa

        kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
        fields = [f.split() for f in PIECE.split(", ")]

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, (_, t) in zip(zip(*rows), fields)], [k for k, _ in fields])

        for b in batches:
            rows, held = [], 0
            for doc, ids in zip(b.column("_id").to_pylist(), encode_with_end(b.column("_text"), vocab, end_id)):
                ids = ids.astype("<u4", copy=False)
                for k, a in enumerate(range(0, len(ids), capacity)):
                    part = ids[a : a + capacity]
                    rows.append((doc, k, a, len(part), zlib.crc32(part), part.tobytes() if keep_ids else None))
                    held += len(part) if keep_ids else 0
                if len(rows) >= 4096 or held >= 2_000_000:
                    yield batch(rows)
                    rows, held = [], 0
            if rows:
                yield batch(rows)

    return docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text")).mapInArrow(work, PIECE)


def pack(pieces: DataFrame, capacity: int = 4096) -> DataFrame:
    """``pieces`` (rows ``PIECE``, each of at most ``capacity`` tokens) with
    ``sequence_id`` and ``offset``, gapless in every sequence.  Equal rows are
    packed each for itself; no pieces, no sequences."""
    spark = prepare(pieces)

    def place(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        base, state = TaskContext.get().partitionId() << 40, SumOfSquares(capacity)
        for b in batches:
            got = [state.place(n) for n in b.column("length").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([base | s for s, _ in got], pa.int64()), pa.array([o for _, o in got], pa.int64())],
                [*b.schema.names, "sequence_id", "offset"])

    dealt = pieces.select(*[f.split()[0] for f in PIECE.split(", ")]).repartition(
        partitions(spark), F.xxhash64("doc_id", "piece", "ids_crc32"))
    ordered = dealt.sortWithinPartitions(F.desc("length"), "doc_id", "piece", "ids_crc32")
    return ordered.mapInArrow(place, PIECE + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
                   end_id: int = 1, capacity: int = 4096, keep_ids: bool = True) -> DataFrame:
    """Tokenise whole documents and pack them."""
    return pack(document_pieces(docs, id_col, text_col, tokenizer, end_id, capacity, keep_ids), capacity)
