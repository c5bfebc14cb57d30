"""Exact removal of repeated windows across a whole corpus, distributed.

Shared frame of the two substring operators (words, bytes): remove every unit
covered by a window of ``width`` units whose content also starts earlier
(smaller document id, or same document, earlier start).

0. Of identical texts only the first is searched; every window of the others
   starts earlier, so they lose all their units if they are a window long.
1. Anchors.  Every window has one anchor: the leftmost of its grams with the
   smallest hash.  Equal windows have equal anchors at equal offsets.  Runs of
   windows with the same anchor form a segment (start, number of windows).
2. Only anchors that occur at least twice can hold repeated windows; a window
   function over the anchor hash keeps those.
3. The segments of these anchors are cut from the texts and dealt by anchor,
   so all equal windows meet in one group.  Equal segments are folded while
   streaming; the distinct ones, in order of position, go to the solver of the
   operator, which tells for every window whether its content was seen before.
   An anchor with more than ``hot`` occurrences is dealt by window content
   instead, so that each of its groups holds a single content.
4. Removable windows go back to their documents as spans.

The texts are exchanged once (all joins on the document use that exchange).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hourglass.llm.common import order_key, partitions, prepare, store, text_or_empty

_M = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63],
              dtype=np.uint64)
_POS_BITS = 23


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _M[0]
    return x ^ (x >> np.uint64(29))


def anchor_runs(units: np.ndarray, width: int, gram: int):
    """``key, start, n`` of the runs of windows that share an anchor.
    ``units``: 64-bit unit hashes of one document; ``gram`` a power of two."""
    step = 1 << (_POS_BITS - 1)
    keys, starts, counts = [], [], []
    for a in range(0, max(0, len(units) - width + 1), step):
        u = units[a : a + step + width - 1]  # windows starting in this block
        g, n, level = u, 1, 1
        while n < gram:
            g = g[:-n] * _M[level % 5] + _mix(g[n:])
            n, level = 2 * n, level + 1
        g = _mix(g)
        low = (g >> np.uint64(_POS_BITS) << np.uint64(_POS_BITS)) | np.arange(len(g), dtype=np.uint64)
        span, n = width - gram + 1, 1
        m = low
        while 2 * n <= span:
            m = np.minimum(m[:-n], m[n:])
            n *= 2
        if n < span:
            m = np.minimum(m[: len(m) - (span - n)], m[span - n :])
        cut = np.flatnonzero(np.concatenate([[True], m[1:] != m[:-1]]))
        keys.append(g[(m[cut] & np.uint64((1 << _POS_BITS) - 1)).astype(np.int64)].view(np.int64))
        starts.append(cut + a)
        counts.append(np.diff(np.append(cut, len(m))))
    if not keys:
        z = np.zeros(0, dtype=np.int64)
        return z, z, z
    return np.concatenate(keys), np.concatenate(starts), np.concatenate(counts)


def repeated_spans(docs: DataFrame, codec, width: int, gram: int, solve, id_col: str = "doc_id", text_col: str = "text",
                   hot: int = 100_000, batch: int = 4096) -> tuple[DataFrame, DataFrame]:
    """``(base, spans)``: base has ``_ord, _v, _id, _text`` and ``_copy`` (an
    identical text stands in an earlier document) per input row, spans
    ``_ord, _v, spans`` (array of start, end) for documents that lose units.

    ``codec`` names the unit: ``codec.hashes(text)`` and ``codec.payload(text)``
    (an array whose slices are segment contents); ``solve(list of contents)``
    returns a boolean array per content.  Rows repeating id and text count as
    one document; a missing id sorts last.
    """
    prepare(docs)
    text = text_or_empty(text_col)
    base = docs.select(
        order_key(id_col).alias("_ord"),
        F.xxhash64(text).bitwiseAND(F.lit(0xFFFFFF)).cast("int").alias("_v"),
        F.col(id_col).cast("long").alias("_id"),
        text.alias("_text"),
    )

    # one row per later copy; copies fold per task before the exchange
    heads = store(base.select("_ord", "_v", F.unhex(F.sha2(F.col("_text").cast("binary"), 256)).alias("_sha")), "heads")
    first = heads.groupBy("_sha").agg(F.min(F.struct("_ord", "_v")).alias("_first"), F.count(F.lit(1)).alias("_c"))
    later = store(
        heads.join(first.filter("_c > 1"), "_sha").filter(F.struct("_ord", "_v") > F.col("_first"))
        .select("_ord", "_v", F.lit(True).alias("_copy")).distinct(), "copies")
    base = base.join(later, ["_ord", "_v"], "left").withColumn("_copy", F.coalesce("_copy", F.lit(False)))

    def find(batches):
        import pyarrow as pa

        for b in batches:
            out, of = [], []
            for i, t in enumerate(b.column("_text").to_pylist()):
                run = anchor_runs(codec.hashes(t), width, gram)
                if len(run[0]):
                    out.append(run)
                    of.append(np.full(len(run[0]), i))
            if out:
                which = pa.array(np.concatenate(of))
                cols = [np.concatenate(c) for c in zip(*out)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0]), b.column("_ord").take(which), b.column("_v").take(which),
                     pa.array(cols[1].astype(np.int32)), pa.array(cols[2].astype(np.int32))],
                    ["h", "_ord", "_v", "s", "n"])

    runs = base.filter(~F.col("_copy")).select("_ord", "_v", "_id", "_text").mapInArrow(find, "h long, _ord long, _v int, s int, n int")
    seen = runs.withColumn("c", F.count(F.lit(1)).over(Window.partitionBy("h"))).filter("c > 1")
    wanted = seen.groupBy("_ord", "_v").agg(
        F.collect_list(F.struct("h", "s", "n", (F.col("c") > hot).alias("hot"))).alias("_cand"))  # within one document

    def cut(batches):
        import pyarrow as pa
        import xxhash

        names = ["h", "_ord", "_v", "s", "n", "seg"]
        types = ["int64", "int64", "int32", "int32", "int32", "binary"]
        for b in batches:
            rows = []
            for o, v, t, cand in zip(*(b.column(c).to_pylist() for c in ("_ord", "_v", "_text", "_cand"))):
                body = codec.payload(t)
                for c in cand:
                    if c["hot"]:
                        for s in range(c["s"], c["s"] + c["n"]):
                            seg = body[s : s + width].tobytes()
                            rows.append((xxhash.xxh64_intdigest(seg) - (1 << 63), o, v, s, 1, seg))
                    else:
                        rows.append((c["h"], o, v, c["s"], c["n"], body[c["s"] : c["s"] + c["n"] + width - 1].tobytes()))
                if len(rows) >= 8192:
                    yield pa.RecordBatch.from_arrays([pa.array(list(x), k) for x, k in zip(zip(*rows), types)], names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(list(x), k) for x, k in zip(zip(*rows), types)], names)

    def judge(batches):
        """Rows come sorted by anchor, then position."""
        import pyarrow as pa

        waiting, owners, found = [], [], []  # distinct contents of multi-content groups
        last, first = None, {}
        names, types = ["_ord", "_v", "s", "e"], ["int64", "int32", "int32", "int32"]

        def close():
            if len(first) > 1:
                for seg, who in first.items():
                    waiting.append(seg)
                    owners.append(who)
            first.clear()

        def settle():
            for (o, v, s), seen_before in zip(owners, solve(waiting, width)):
                edge = np.flatnonzero(np.diff(np.concatenate([[0], seen_before.astype(np.int8), [0]])))
                for a, z in zip(edge[::2], edge[1::2]):
                    found.append((o, v, s + int(a), s + int(z) + width - 1))
            waiting.clear()
            owners.clear()

        def emit():
            out = pa.RecordBatch.from_arrays([pa.array(list(x), k) for x, k in zip(zip(*found), types)], names)
            found.clear()
            return out

        for b in batches:
            for h, o, v, s, n, seg in zip(*(b.column(c).to_pylist() for c in ("h", "_ord", "_v", "s", "n", "seg"))):
                if h != last:
                    close()
                    last = h
                    if len(waiting) >= batch:
                        settle()
                who = first.setdefault(seg, (o, v, s))
                if who != (o, v, s):  # all of it stands earlier
                    found.append((o, v, s, s + n + width - 1))
            if len(found) >= 8192:
                yield emit()
        close()
        if waiting:
            settle()
        if found:
            yield emit()

    # only first texts have candidates; same rows and columns as in the last join, so that both read one exchange
    segments = base.join(wanted, ["_ord", "_v"]).select("_ord", "_v", "_id", "_text", "_copy", "_cand").mapInArrow(
        cut, "h long, _ord long, _v int, s int, n int, seg binary")
    dealt = segments.repartition(partitions(docs.sparkSession), "h").sortWithinPartitions("h", "_ord", "_v", "s")
    spans = dealt.mapInArrow(judge, "_ord long, _v int, s int, e int").groupBy("_ord", "_v").agg(
        F.collect_list(F.struct("s", "e")).alias("_spans"))
    return base, spans


def removed_mask(spans, n: int, everything: bool = False) -> np.ndarray:
    """Units covered by the spans (list of {s, e} or None)."""
    if everything:
        return np.ones(n, dtype=bool)
    edge = np.zeros(n + 1, dtype=np.int32)
    for x in spans or ():
        edge[x["s"]] += 1
        edge[x["e"]] -= 1
    return np.cumsum(edge[:n]) > 0
