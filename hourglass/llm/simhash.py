"""SimHash near-duplicates through multi-index hashing.

Fingerprints: a bit is set when it is set in more than half of the XXH64
values of the text's word shingles.  Two fingerprints link when they differ in
at most two bits.

Search.  The 64 bits are cut into two 32-bit segments.  If two fingerprints
differ in at most two bits, either their first segments differ in at most one
bit or their second segments are equal, so a Hamming ball of radius one around
the first segment and of radius zero around the second finds every pair.  The
ball is enumerated upwards only (bits flipped from 0 to 1): of two segments one
bit apart, one reaches the other.  Table matches are verified on all 64 bits.

Dense buckets.  A table entry shared by more than ``bucket_cap`` fingerprints
is not joined.  Its fingerprints, and those whose balls reach it, are linked
through single-bit neighbours instead: two fingerprints differ in at most two
bits exactly when their 65-element balls of radius one over all bits share an
element.  Such an element is shared by at most 65 fingerprints, so this is
linear whatever the bucket size, and no link is lost.

Components come from alternating large-star and small-star rounds over the
links between *distinct* fingerprints, each round stored in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourglass.llm.common import prepare, store, text_or_empty, whole_row

SEED = 42


def fingerprint_bytes(text: bytes, shingle: int = 3, block: int = 1 << 16) -> int:
    """64-bit SimHash of one text (UTF-8), whole text, bounded memory."""
    import numpy as np
    import xxhash

    words = text.lower().split()  # bytes: lower-cases A-Z, splits at 09-0D and 20
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, dtype=np.int64)
    for a in range(0, n, block):
        b = min(n, a + block)
        cut = [words[a + k : b + k] for k in range(shingle)] if len(words) >= shingle else None
        parts = map(b" ".join, zip(*cut)) if cut else [b" ".join(words)]
        h = np.fromiter((digest(s, SEED) for s in parts), dtype=np.uint64, count=b - a)
        for c in range(0, b - a, 4096):
            bits = np.unpackbits(h[c : c + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
    set_bits = np.flatnonzero(2 * ones > n)
    return sum(1 << int(i) for i in set_bits)


def with_fingerprint(docs: DataFrame, text_col: str = "text", shingle: int = 3, out: str = "_fp") -> DataFrame:
    """``docs`` plus a LONG fingerprint (two's complement of the 64 bits)."""
    prepare(docs)

    @F.pandas_udf(T.LongType())
    def fp(texts):
        import pandas as pd

        from hourglass.llm import tokens

        tokens.release()
        v = [fingerprint_bytes(t.encode("utf-8"), shingle) for t in texts]
        return pd.Series([x - (1 << 64) if x >> 63 else x for x in v], dtype="int64")

    return docs.withColumn(out, fp(text_or_empty(text_col)))


def _segments(fps: DataFrame) -> DataFrame:
    return fps.select(
        "fp",
        F.shiftrightunsigned("fp", 32).alias("s1"),
        F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)).alias("s2"),
    )


def links(fps: DataFrame, max_bits: int = 2, bucket_cap: int = 256) -> DataFrame:
    """Pairs ``a, b`` of distinct fingerprints that connect everything within
    ``max_bits`` (1 or 2) bits; ``fps`` has one distinct LONG column ``fp``."""
    if max_bits not in (1, 2):
        raise ValueError("max_bits must be 1 or 2: the balls are enumerated for these")
    seg = _segments(fps)
    one = F.lit(1).cast("long")
    up = F.filter(F.sequence(F.lit(0), F.lit(31)), lambda i: F.getbit("s1", i) == 0)
    ball = F.concat(
        F.array(F.col("s1")),
        F.transform(up, lambda i: F.col("s1") + F.call_function("shiftleft", one, i)),
    )
    table = seg.select(F.lit(1).alias("t"), F.col("s1").alias("v"), F.col("fp").alias("b")).unionByName(
        seg.select(F.lit(2).alias("t"), F.col("s2").alias("v"), F.col("fp").alias("b"))
    )
    probes = seg.select(F.lit(1).alias("t"), F.explode(ball).alias("v"), F.col("fp").alias("a")).unionByName(
        seg.select(F.lit(2).alias("t"), F.col("s2").alias("v"), F.col("fp").alias("a"))
    )
    load = table.groupBy("t", "v").agg(F.count(F.lit(1)).alias("n"))
    dense = load.filter(F.col("n") > bucket_cap).drop("n")
    light = load.filter(F.col("n") <= bucket_cap).drop("n")
    pairs = (
        probes.join(table.join(light, ["t", "v"]), ["t", "v"])
        .filter((F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits))
        .select("a", "b")
    )
    crowded = probes.join(dense, ["t", "v"], "left_semi").select(F.col("a").alias("fp")).distinct()
    if max_bits == 2:
        near = F.concat(
            F.array(F.col("fp")),
            F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.col("fp").bitwiseXOR(F.call_function("shiftleft", one, i))),
        )
        meet = crowded.select("fp", F.explode(near).alias("m")).groupBy("m").agg(
            F.min("fp").alias("a"), F.collect_set("fp").alias("all")  # at most 65 fingerprints share m
        )
        dense_pairs = meet.select("a", F.explode("all").alias("b")).filter("a != b")
    else:
        flip = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.col("fp").bitwiseXOR(F.call_function("shiftleft", one, i)))
        dense_pairs = (
            crowded.select(F.col("fp").alias("a"), F.explode(flip).alias("b"))
            .join(crowded.select(F.col("fp").alias("b")), "b", "left_semi")
            .select("a", "b")
        )
    return pairs.unionByName(dense_pairs).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    ).distinct()


def components(pairs: DataFrame) -> DataFrame:
    """``node, root``: smallest node of each connected component (nodes without
    a link are absent).  Alternating large-star / small-star contraction; every
    round is stored, so lineage stays short and executors may be lost."""
    edges = store(pairs.select(F.col("a").alias("u"), F.col("b").alias("v")), "cc")
    while True:
        # large star: neighbours larger than u go to u's smallest neighbour
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: u and its smaller neighbours go to the smallest of them
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low2, "u")
        small = (
            joined.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low2.select("u", F.col("m").alias("v")))
            .distinct()
        )
        new = store(small.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")), "cc")
        # stars only: no node is both a centre and a leaf, and no leaf has two centres
        leaves = new.groupBy(F.col("v").alias("x")).agg(F.count(F.lit(1)).alias("n"))
        bad = leaves.filter("n > 1").select("x").unionByName(
            new.select(F.col("u").alias("x")).join(leaves, "x", "left_semi")
        )
        edges = new
        if bad.isEmpty():
            return edges.select(F.col("v").alias("node"), F.col("u").alias("root"))


def simhash_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
    max_bits: int = 2, bucket_cap: int = 256,
) -> DataFrame:
    """One row per input row: ``_id, _fp, component_id`` (smallest id reachable
    through links; null only if no row of the component has an id).

    Null text counts as empty (fingerprint zero, linked like any other).  Rows
    without id follow their component.  Repeated rows give repeated results;
    an empty table gives an empty result.
    """
    rows = store(
        with_fingerprint(docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text")), "_text", shingle)
        .select("_id", "_fp"),
        "simhash",
    )
    # copies fold into one node per fingerprint before any exchange of pairs
    nodes = store(rows.groupBy(F.col("_fp").alias("fp")).agg(F.min("_id").alias("lo")), "simhash-nodes")
    comp = components(links(nodes.select("fp"), max_bits, bucket_cap))
    rooted = nodes.join(comp, nodes.fp == comp.node, "left").select(
        "fp", "lo", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("lo").alias("component_id"))
    label = rooted.join(least, "root").select(F.col("fp").alias("_fp"), "component_id")
    return rows.join(label, "_fp")


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """``docs`` with one row per component: the one whose id is smallest.
    Rows of a component in which no row has an id are all kept; of rows that
    repeat the smallest id one is kept.  All columns are retained, whatever
    their names."""
    classes = simhash_classes(docs, id_col, text_col, **kw)
    stay = (
        classes.filter(F.col("_id").eqNullSafe(F.col("component_id")))
        .groupBy(F.col("_id").alias("_kid")).agg(F.count(F.lit(1)).alias("_rows"))
    )
    left = docs.select(whole_row(docs), F.col(id_col).cast("long").alias("_own")).join(stay, F.col("_own").eqNullSafe(F.col("_kid")))
    once = left.filter("_rows = 1 or _kid is null").select("_row.*")
    again = left.filter("_rows > 1 and _kid is not null").dropDuplicates(["_kid"]).select("_row.*")
    return once.unionByName(again)
