"""Token-id files coded with Simple-8b.

A 64-bit word holds a 4-bit selector and as many ids as fit in the other 60
bits at the width the selector names.  Ids too wide for 60 bits are escapes:
their word has the escape selector and the id stands in the escape section.
Ids are cut into blocks of ``BLOCK`` ids; a file stores the first word and the
first escape of every block, so blocks decode independently and vectorised.

File layout (little endian): magic ``S8BT``, u32 block length, then u64 counts
of documents, ids, blocks, words, escapes; document ids (i64), their validity
(u8), their id counts (u64); first word of each block (u64, one more at the
end), first escape of each block (same); words (u64); escapes (u64).

Writing: documents are range-partitioned and sorted by id, each task writes
its files under a name of its own and renames them when whole, so a repeated
task replaces equal files.  A file is closed after ``file_ids`` ids; a longer
document has a file to itself.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hourglass.llm.common import partitions, prepare, shared_dir, store, text_or_empty
from hourglass.llm.tokens import encode_with_end, tokenizer_path

BLOCK = 256
# fixed values of the code: ids per word and bits per id, by selector
PER_WORD = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 0, 1], dtype=np.int64)
WIDTH = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 0, 0], dtype=np.int64)
SELECTORS = 14
BIT_LENGTH = np.frexp(np.arange(1 << 16, dtype=np.float64))[1].astype(np.uint8)
ESCAPE = 15
MAGIC = b"S8BT"
HEAD = struct.Struct("<4sIQQQQQ")


def encode_words(ids: np.ndarray, block: int = BLOCK):
    """``words, first word of each block, escapes, first escape of each block``."""
    ids = np.asarray(ids, dtype=np.uint64)
    nb = -(-len(ids) // block)
    reach = int(PER_WORD.max())
    grid = np.zeros((nb, block + reach), dtype=np.uint64)
    if nb:
        full = np.zeros(nb * block, dtype=np.uint64)
        full[: len(ids)] = ids
        grid[:, :block] = full.reshape(nb, block)
    size = np.full(nb, block, dtype=np.int64)
    if nb:
        size[-1] = len(ids) - (nb - 1) * block
    if nb and int(ids.max()) < len(BIT_LENGTH):
        bits = BIT_LENGTH[grid]
    else:
        bits = np.ones(grid.shape, dtype=np.uint8)
        for b in np.unique(WIDTH[:SELECTORS]):
            bits[grid >> np.uint64(b) > 0] = b + 1  # only compared with the widths
    # widest value among the next n ids, for n = powers of two, then any n
    best = np.full((nb, block), ESCAPE, dtype=np.uint8)
    power = {1: bits}
    n = 1
    while 2 * n <= reach:
        prev = power[n]
        power[2 * n] = np.maximum(prev[:, :-n], prev[:, n:])
        n *= 2
    for s in range(SELECTORS - 1, -1, -1):  # more ids per word later: the last that fits wins
        per, width = int(PER_WORD[s]), int(WIDTH[s])
        p = 1 << (per.bit_length() - 1)
        wide = np.maximum(power[p][:, :block], power[p][:, per - p : per - p + block])
        best[wide <= width] = s
    at = np.zeros(nb, dtype=np.int64)
    rows, cols, sels, step = [], [], [], []
    live, k = np.flatnonzero(at < size), 0
    while len(live):
        s = best[live, at[live]]
        rows.append(live), cols.append(at[live]), sels.append(s), step.append(np.full(len(live), k))
        at[live] += PER_WORD[s]
        live = live[at[live] < size[live]]
        k += 1
    if not rows:
        z = np.zeros(1, dtype=np.uint64)
        return np.zeros(0, np.uint64), z, np.zeros(0, np.uint64), z
    rows, cols, sels, step = map(np.concatenate, (rows, cols, sels, step))
    order = np.lexsort((step, rows))
    rows, cols, sels = rows[order], cols[order], sels[order].astype(np.int64)
    words = sels.astype(np.uint64) << np.uint64(60)
    for s in range(SELECTORS):
        m = np.flatnonzero(sels == s)
        if len(m):
            j = np.arange(PER_WORD[s])
            vals = grid[rows[m][:, None], cols[m][:, None] + j] << (j * WIDTH[s]).astype(np.uint64)
            words[m] |= np.bitwise_or.reduce(vals, axis=1)
    esc = sels == ESCAPE
    first = np.searchsorted(rows, np.arange(nb + 1)).astype(np.uint64)
    first_esc = np.searchsorted(rows[esc], np.arange(nb + 1)).astype(np.uint64)
    return words, first, grid[rows[esc], cols[esc]], first_esc


def decode_words(words, first, escapes, n_ids: int, block: int = BLOCK) -> np.ndarray:
    """Inverse of :func:`encode_words` for all blocks at once."""
    if not n_ids:
        return np.zeros(0, dtype=np.uint64)
    sels = (words >> np.uint64(60)).astype(np.int64)
    body = words & np.uint64((1 << 60) - 1)
    per = PER_WORD[sels]
    upto = np.concatenate([[0], np.cumsum(per)])
    out = np.zeros(upto[-1], dtype=np.uint64)
    for s in range(SELECTORS):
        m = np.flatnonzero(sels == s)
        if len(m):
            j = np.arange(PER_WORD[s])
            mask = np.uint64((1 << int(WIDTH[s])) - 1)
            out[upto[m][:, None] + j] = (body[m][:, None] >> (j * WIDTH[s]).astype(np.uint64)) & mask
    out[upto[:-1][sels == ESCAPE]] = escapes
    # the last word of a block may name more ids than the block has
    first = first.astype(np.int64)
    begin = upto[first[:-1]]
    size = np.minimum(block, n_ids - block * np.arange(len(begin)))
    lead = np.concatenate([[0], np.cumsum(size)])
    return out[np.arange(n_ids) + np.repeat(begin - lead[:-1], size)]


def file_bytes(doc_ids: list, counts: list[int], ids: np.ndarray) -> bytes:
    words, first, escapes, first_esc = encode_words(ids)
    valid = np.array([d is not None for d in doc_ids], dtype=np.uint8)
    return b"".join([
        HEAD.pack(MAGIC, BLOCK, len(doc_ids), len(ids), len(first) - 1, len(words), len(escapes)),
        np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes(),
        valid.tobytes(),
        np.array(counts, dtype="<u8").tobytes(),
        *(x.astype("<u8").tobytes() for x in (first, first_esc, words, escapes)),
    ])


def parse_file(data: bytes):
    """``doc ids (None where missing), counts, ids`` of a file's bytes."""
    magic, block, nd, ni, nb, nw, ne = HEAD.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a Simple-8b token file")
    at = HEAD.size

    def take(dtype, n):
        nonlocal at
        x = np.frombuffer(data, dtype=dtype, count=n, offset=at)
        at += x.nbytes
        return x

    docs, valid, counts = take("<i8", nd), take("u1", nd), take("<u8", nd)
    first, _, words, escapes = take("<u8", nb + 1), take("<u8", nb + 1), take("<u8", nw), take("<u8", ne)
    ids = decode_words(words, first, escapes, ni, block)
    return [int(d) if v else None for d, v in zip(docs, valid)], counts.astype(np.int64), ids


def _write_whole(fs, path: str, data: bytes, attempt: int) -> None:
    part = f"{path}.{attempt}.part"
    with fs.open_output_stream(part, compression=None) as f:
        f.write(data)
    fs.move(part, path)


def write_token_files(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
    end_id: int = 2, file_ids: int = 2_000_000, path: str | None = None,
) -> DataFrame:
    """Write the files and return their stored manifest:
    ``part, path, part_start, n_docs, n_ids, start`` (``start``: ids of all
    documents before the file, in ascending id order, missing ids last).

    Null text is the empty text (just the end id); rows repeating an id follow
    each other, ordered by a hash of their text.  ``path`` is a folder that
    executors and pyarrow can reach; by default one in the shared folder.
    """
    spark = prepare(docs)
    vocab = tokenizer or tokenizer_path()
    base = path or shared_dir(spark, "token-files")

    def write(batches):
        from pyarrow import RecordBatch, array, fs as pafs
        from pyspark import TaskContext

        ctx = TaskContext.get()
        fs, root = pafs.FileSystem.from_uri(base)
        fs.create_dir(root, recursive=True)
        names, counts, held, n_held, total, serial = [], [], [], 0, 0, 0

        def flush():
            nonlocal names, counts, held, n_held, total, serial
            file = f"{root}/part-{ctx.partitionId():06d}-{serial:06d}.s8b"
            _write_whole(fs, file, file_bytes(names, counts, np.concatenate(held)), ctx.taskAttemptId())
            row = [[ctx.partitionId()], [f"{base}/{file.rsplit('/', 1)[1]}"], [total], [len(names)], [n_held]]
            total, serial = total + n_held, serial + 1
            names, counts, held, n_held = [], [], [], 0
            return RecordBatch.from_arrays(
                [array(x, t) for x, t in zip(row, ("int32", "string", "int64", "int64", "int64"))],
                ["part", "path", "part_start", "n_docs", "n_ids"],
            )

        for batch in batches:
            ids_in = batch.column("_id").to_pylist()
            for doc, ids in zip(ids_in, encode_with_end(batch.column("_text"), vocab, end_id)):
                names.append(doc), counts.append(len(ids)), held.append(ids)
                n_held += len(ids)
                if n_held >= file_ids:
                    yield flush()
        if names:
            yield flush()

    rows = docs.select(F.col(id_col).cast("long").alias("_id"), text_or_empty(text_col).alias("_text"))
    ordered = rows.repartitionByRange(partitions(spark), F.col("_id").asc_nulls_last()).sortWithinPartitions(
        F.col("_id").asc_nulls_last(), F.xxhash64("_text")
    )
    files = store(
        ordered.mapInArrow(write, "part int, path string, part_start long, n_docs long, n_ids long"), "token-manifest"
    )
    # one row per task: the only global running total
    w = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    lead = files.groupBy("part").agg(F.sum("n_ids").alias("_n")).select(
        "part", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_lead")
    )
    return files.join(lead, "part").withColumn("start", F.col("_lead") + F.col("part_start")).drop("_lead")


def read_token_files(manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """Documents of the manifest's files: ``doc_id, start, n_tokens, ids_crc32``
    (crc32 over little-endian u32 ids) and, if asked, ``ids`` (array of long)."""
    prepare(manifest)
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")

    def read(batches):
        import pyarrow as pa
        from pyarrow import fs as pafs

        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                fs, file = pafs.FileSystem.from_uri(path)
                with fs.open_input_stream(file, compression=None) as f:
                    docs, counts, ids = parse_file(f.read())
                small = ids.astype("<u4")
                ends = np.cumsum(counts)
                begins = ends - counts
                cols = [
                    pa.array(docs, "int64"), pa.array(begins + start, "int64"), pa.array(counts, "int64"),
                    pa.array([zlib.crc32(small[a:b]) for a, b in zip(begins, ends)], "int64"),
                ]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    cols.append(pa.array([ids[a:b].astype(np.int64) for a, b in zip(begins, ends)], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    spark = manifest.sparkSession
    return manifest.select("path", "start").repartition(partitions(spark), "path").mapInArrow(read, schema)
