"""Alignment of two tokenizers' tokens by interval coalescing.

A token is an interval of the text's bytes.  All intervals of both tokenizers
are sorted by start (lexsort), the running maximum of the ends is taken
(``maximum.accumulate``) and a group ends where a start reaches it: there both
tokenizers have a boundary.  Overlaps are expanded inside the groups; a link is
an overlapping pair whose intervals end together.

Both tokenizers cut before a blank or line feed that follows another character,
so texts are cut there (``tokens.cut``) and each distinct piece is encoded and
aligned once per worker.  Documents are dealt with in chunks of bounded size: a
chunk lists its distinct linked id pairs once, and a document its positions in
that list.  Pair totals are a grouped sum over the lists, and go back to the
chunks by a join, so a pair that occurs everywhere costs one row per chunk.
"""

from __future__ import annotations

import hashlib
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.llm import tokens
from hourglass.llm.common import partitions, prepare, store

PIECE_MODEL = "piece_bpe_32k.model"
# one row per distinct pair of a chunk (kind 0), one per document (kind 1)
PARTS = (
    "kind int, chunk long, pos int, pair long, times long, doc_id long, n_a long, n_b long, n_groups long, "
    "n_links long, groups_sha256 string, at binary, n binary, groups string"
)


def coalesce(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Group number of every interval: chains of overlapping intervals."""
    order = np.lexsort((end, start))
    reach = np.maximum.accumulate(end[order])
    opens = np.ones(len(order), dtype=bool)
    opens[1:] = start[order][1:] >= reach[:-1]
    group = np.empty(len(order), dtype=np.int64)
    group[order] = np.cumsum(opens) - 1
    return group


def overlaps(a_start, a_end, b_start, b_end) -> tuple[np.ndarray, np.ndarray]:
    """Positions ``(i, j)`` of all overlapping pairs of two lists of disjoint
    intervals in ascending order."""
    lo = np.searchsorted(b_end, a_start, side="right")
    n = np.maximum(np.searchsorted(b_start, a_end, side="left") - lo, 0)
    return np.repeat(np.arange(len(a_start)), n), tokens.ragged(lo, n)


class Alignments(tokens.PieceTable):
    """Alignment of distinct pieces.  Tables by row: ``n_a, n_b, n_groups,
    valid``, linked pairs (``a << 32 | b``), and the groups as text."""

    def __init__(self, path_a: str, path_b: str, max_pieces: int = 300_000, max_bytes: int = 16_000_000):
        import sentencepiece

        self.a = tokens.PieceEncoder(path_a, plain=True, max_pieces=max_pieces // 2)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        shown = {int(c): i for i, c in enumerate(self.a.letters) if i}
        vocab = self.a.tokenizer.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (1 + max(vocab.values()))
        nul = ord(self.a.nul)
        for word, i in vocab.items():
            self.a_bytes[i] = bytes(0 if ord(c) == nul else shown.get(ord(c), 0) for c in word)
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(w[3:5], 16)]) if self.b.is_byte(i) else w.replace("▁", " ").encode()
            for i, w in enumerate(names)
        ]
        # pieces are cut before blanks and line feeds
        self.safe = not any(b" " in w.lstrip(b" ") or (b"\n" in w and len(w) > 1) for w in self.b_bytes)
        self.a_len, self.b_len = (np.array(list(map(len, x)), dtype=np.int64) for x in (self.a_bytes, self.b_bytes))
        self.blank = self.b.piece_to_id("▁")
        most = max(len(self.a_bytes), len(self.b_bytes))
        self.digits = list(map(str, range(most)))
        self.digit_len = np.array(list(map(len, self.digits)), dtype=np.int64)
        self.stats = np.zeros((0, 4), dtype=np.int64)
        self.pairs, self.begin, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.text: list[str] = []
        super().__init__(max_pieces, max_bytes)

    def keep(self, rows: np.ndarray) -> None:
        pairs, count = self.pairs[tokens.ragged(self.begin[rows], self.count[rows])], self.count[rows]
        self.pairs, self.count, self.begin = pairs, count, np.cumsum(count) - count
        self.stats, self.text = self.stats[rows], [self.text[r] for r in rows.tolist()]

    def pieces(self, texts):
        if self.safe:
            return tokens.cut(texts)
        return texts, np.ones(len(texts), dtype=np.int64)

    def _b_ids(self, pieces: list[str]):
        """The model adds a blank; pieces bring their own."""
        got = self.b.encode([p[1:] if p[:1] == " " else p for p in pieces], num_threads=1)
        for i, p in enumerate(pieces):
            if p == " ":
                got[i] = [self.blank]
            elif p and p[0] != " ":
                got[i] = got[i][1:]
        return np.array(list(chain.from_iterable(got)), dtype=np.int64), np.array(list(map(len, got)), dtype=np.int64)

    def learn(self, pieces: list[str]) -> list[str]:
        order, a, n_a = self.a.coded(pieces)
        b, n_b = self._b_ids(order)
        raw = [p.encode() for p in order]
        # keep pieces whose tokens spell their bytes
        valid = np.ones(len(order), dtype=bool)
        a_join, b_join = (b"".join(map(w.__getitem__, x.tolist())) for w, x in ((self.a_bytes, a), (self.b_bytes, b)))
        size = np.array(list(map(len, raw)), dtype=np.int64)
        sizes = [np.diff(np.concatenate([[0], np.cumsum(w[x])])[np.concatenate([[0], np.cumsum(n)])])
                 for w, x, n in ((self.a_len, a, n_a), (self.b_len, b, n_b))]
        if not (a_join == b_join == b"".join(raw) and (sizes[0] == size).all() and (sizes[1] == size).all()):
            for join, s in ((a_join, sizes[0]), (b_join, sizes[1])):
                upto = np.cumsum(s)
                valid &= np.array([join[u - k : u] == r for u, k, r in zip(upto.tolist(), s.tolist(), raw)], dtype=bool)
            a, b = a[np.repeat(valid, n_a)], b[np.repeat(valid, n_b)]
        n_a, n_b = np.where(valid, n_a, 0), np.where(valid, n_b, 0)
        ends = np.cumsum(np.where(valid, size, 0))  # of the pieces, one text after the other
        a_end, b_end = np.cumsum(self.a_len[a]), np.cumsum(self.b_len[b])
        a_start, b_start = a_end - self.a_len[a], b_end - self.b_len[b]
        group = coalesce(np.concatenate([a_start, b_start]), np.concatenate([a_end, b_end]))
        i, j = overlaps(a_start, a_end, b_start, b_end)
        together = a_end[i] == b_end[j]
        i, j = i[together], j[together]
        links = a[i].astype(np.int64) << 32 | b[j]
        n_links = np.diff(np.concatenate([[0], np.searchsorted(a_end[i], ends, side="right")]))
        first = np.searchsorted(group[: len(a)], np.arange(group.max() + 1 if len(group) else 0))
        n_groups = np.diff(np.concatenate([[0], np.searchsorted(a_start[first], ends, side="left")]))
        self.stats = np.concatenate([self.stats, np.stack([n_a, n_b, n_groups, valid], axis=1)])
        self.begin = np.concatenate([self.begin, len(self.pairs) + np.cumsum(n_links) - n_links])
        self.count = np.concatenate([self.count, n_links])
        self.pairs = np.concatenate([self.pairs, links])
        self.text += self._texts(a, b, group, n_a + n_b, valid)
        return order

    def _texts(self, a, b, group, n, valid) -> list[str]:
        """``a1,a2|b1;...;`` of every piece: the groups' ids, A's before B's."""
        kind = np.repeat([0, 1], [len(a), len(b)])
        at = np.lexsort((kind, group))  # stable: tokens stay in order
        ids, kind, group = np.concatenate([a.astype(np.int64), b])[at], kind[at], group[at]
        last = np.ones(len(at), dtype=bool)
        last[:-1] = (group[1:] != group[:-1]) | (kind[1:] != kind[:-1])
        code = np.where(last, 1 + kind, 0)
        text = "".join(chain.from_iterable(zip(map(self.digits.__getitem__, ids.tolist()), map(",|;".__getitem__, code.tolist()))))
        upto = np.concatenate([[0], np.cumsum(self.digit_len[ids] + 1)])[np.concatenate([[0], np.cumsum(n)])].tolist()
        return [text[s:e] for s, e in zip(upto, upto[1:])]


def _aligner(path_a: str, path_b: str) -> Alignments:
    return tokens.kept(("align", path_a, path_b), lambda: Alignments(path_a, path_b))


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``counts`` rows."""
    upto = np.concatenate([np.zeros((1, *values.shape[1:]), values.dtype), np.cumsum(values, axis=0)])
    return np.diff(upto[np.concatenate([[0], np.cumsum(counts)])], axis=0)


def align_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_a: str | None = None,
                    path_b: str | None = None, keep_groups: bool = False) -> DataFrame:
    """Stored rows ``PARTS``: the distinct linked pairs of each chunk, and every
    document's counts, digest and positions in its chunk's list.

    Tokenizer A encodes a blank and the text, B the text (and adds the blank).
    Texts that are null or empty, or whose tokens do not spell the text, have no
    tokens: zeros and an empty digest.  Repeated rows count each for itself, rows
    without id too; extra columns are not read; an empty table gives no row.  A
    very long text is a chunk of its own.  ``keep_groups`` adds the groups as
    text (``a1,a2|b1;a3|b2,b3``).
    """
    prepare(docs)
    path_a, path_b = path_a or tokens.tokenizer_path(), path_b or tokens.tokenizer_path(PIECE_MODEL)

    def work(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        table = _aligner(path_a, path_b)
        chunk = (TaskContext.get().partitionId() << 32) - 1
        for batch in batches:
            texts = pc.fill_null(batch.column("_text"), "")
            for lo, hi in tokens.chunks(texts):
                chunk += 1
                yield from _chunk(pa, pc, table, chunk, batch.column("_id")[lo:hi], texts[lo:hi], keep_groups)
                tokens.trim()

    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    return store(rows.mapInArrow(work, PARTS), "alignment")


def _chunk(pa, pc, table: Alignments, chunk: int, ids, texts, keep_groups: bool):
    """Rows of one chunk of documents."""
    pieces, per_doc = table.pieces(pc.binary_join_element_wise(" ", texts, ""))
    rows = table.rows(pieces)
    some = pc.not_equal(texts, "").to_numpy(zero_copy_only=False)
    ok = some & (_sums(1 - table.stats[rows, 3], per_doc) == 0)
    stats = _sums(table.stats[rows, :3], per_doc) * ok[:, None]
    text, upto = table.text, np.concatenate([[0], np.cumsum(per_doc)]).tolist()
    at = rows.tolist()
    full = ("".join(map(text.__getitem__, at[s:e]))[:-1] if good else "" for s, e, good in zip(upto, upto[1:], ok.tolist()))
    sha, groups = [], []
    for t in full:
        sha.append(hashlib.sha256(t.encode()).hexdigest() if t else "")
        if keep_groups:
            groups.append(t)
    # pairs of the rows in use, numbered; then (document, number) with its count
    doc = np.repeat(np.arange(len(texts)), per_doc)
    rows, doc = rows[ok[doc]], doc[ok[doc]]
    used, where = np.unique(rows, return_inverse=True)
    n_used = table.count[used]
    names, number = np.unique(table.pairs[tokens.ragged(table.begin[used], n_used)], return_inverse=True)
    first = np.cumsum(n_used) - n_used
    n_links = n_used[where]
    number = number[tokens.ragged(first[where], n_links)]
    times = np.bincount(number, minlength=len(names))
    held, n = np.unique(np.repeat(doc, n_links) * max(len(names), 1) + number, return_counts=True)
    links = np.bincount(np.repeat(doc, n_links), minlength=len(texts))
    cuts = np.searchsorted(held, np.arange(len(texts) + 1) * max(len(names), 1))
    pos = held % max(len(names), 1)
    step = np.diff(pos, prepend=0)
    lead = cuts[:-1][cuts[1:] > cuts[:-1]]
    step[lead] = pos[lead]  # each document's first position stands as it is
    step, n = step.astype("<u4"), n.astype("<u4")
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [f.split() for f in PARTS.split(", ")]

    def batch(rows_n, **cols):
        return pa.RecordBatch.from_arrays(
            [pa.nulls(rows_n, kinds[t]) if k not in cols else cols[k] if isinstance(cols[k], pa.Array) else pa.array(cols[k], kinds[t])
             for k, t in fields], [k for k, _ in fields])

    m = len(names)
    if m:
        yield batch(m, kind=np.zeros(m, np.int32), chunk=np.full(m, chunk), pos=np.arange(m), pair=names, times=times)
    d, c = len(texts), cuts.tolist()
    yield batch(d, kind=np.ones(d, np.int32), chunk=np.full(d, chunk), pos=np.arange(d), doc_id=ids, n_a=stats[:, 0], n_b=stats[:, 1],
                n_groups=stats[:, 2], n_links=links, groups_sha256=sha, at=[step[s:e].tobytes() for s, e in zip(c, c[1:])],
                n=[n[s:e].tobytes() for s, e in zip(c, c[1:])], **({"groups": groups} if keep_groups else {}))


def pair_counts(parts: DataFrame) -> DataFrame:
    """``pair, a_id, b_id, links, best``: how many links hold each id pair, and
    whether no pair of the same B id has more."""
    counts = parts.filter("kind = 0").groupBy("pair").agg(F.sum("times").alias("links"))
    low = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    counts = counts.withColumn("b_id", low)
    most = counts.groupBy("b_id").agg(F.max("links").alias("_most"))
    return counts.join(most, "b_id").select(
        "pair", F.shiftright("pair", 32).alias("a_id"), "b_id", "links", (F.col("links") == F.col("_most")).alias("best"))


def aligned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_a: str | None = None,
            path_b: str | None = None, keep_groups: bool = False) -> DataFrame:
    """Per document ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256`` (and ``groups``): ``n_best`` links have the corpus-wide highest count of their B
    id, ``count_sum`` sums the corpus-wide counts over the links.  Null, empty
    and odd texts: see :func:`align_documents`."""
    spark = prepare(docs)
    parts = align_documents(docs, id_col, text_col, path_a, path_b, keep_groups)
    known = pair_counts(parts).select("pair", (F.col("links") * 2 + F.col("best").cast("long")).alias("times"))
    told = parts.filter("kind = 0").select("kind", "chunk", "pos", "pair").join(known, "pair").drop("pair")
    both = told.unionByName(parts.filter("kind = 1").drop("pair"), allowMissingColumns=True)
    out = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string" + (
        ", groups string" if keep_groups else "")

    def score(batches):
        import pyarrow as pa

        now, code = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            chunk, kind = batch.column("chunk").to_numpy(), batch.column("kind").to_numpy()
            cuts = np.flatnonzero((np.diff(chunk) != 0) | (np.diff(kind) != 0)) + 1
            for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(chunk)]):
                if chunk[s] != now:
                    now, code = chunk[s], []
                part = batch.slice(s, e - s)
                if kind[s] == 0:
                    code.append(part.column("times").to_numpy())
                    continue
                code = [np.concatenate(code)] if code else [np.zeros(0, np.int64)]
                at = [np.cumsum(np.frombuffer(x, "<u4").astype(np.int64)) for x in part.column("at").to_pylist()]
                n = np.frombuffer(b"".join(part.column("n").to_pylist()), "<u4").astype(np.int64)
                per = np.array(list(map(len, at)))
                got = code[0][np.concatenate(at)] if len(n) else np.zeros(0, np.int64)
                sums = _sums(np.stack([(got & 1) * n, (got >> 1) * n], axis=1), per)
                cols = {k: part.column(k) for k in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups")}
                cols |= {"n_best": pa.array(sums[:, 0]), "count_sum": pa.array(sums[:, 1])}
                names = [f.split()[0] for f in out.split(", ")]
                yield pa.RecordBatch.from_arrays([cols[k] for k in names], names)

    return both.repartition(partitions(spark), "chunk").sortWithinPartitions("chunk", "kind", "pos").mapInArrow(score, out)
