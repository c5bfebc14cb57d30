"""Hard negatives by Fagin's threshold algorithm.

Rows are dealt into shards of bounded size.  A shard keeps, per dimension, its
rows sorted by that component.  For an anchor every list is read from its top
(positive anchor component) or its bottom (negative one), some rows deeper each
round; rows met for the first time are scored by random access.  No row that
was not met can score more than the threshold, the anchor's product with the
components at the current depth.  Reading stops once the threshold lies
strictly below the k-th best score of every window (an interval of scores in
which the best k rows are wanted), or below the window itself.

The same search finds the positives (one window without bounds over rows of
the anchor's label) and the negatives (one window a positive over the other
rows).  It runs over a few shards first; the k-th scores found there are lower
bounds for all others, which then stop earlier and return less.

Scores are integers: components are floor(scale * x).  Anchors are a stated
query set; every anchor visits every shard.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hourglass.llm.common import partitions, prepare, store

LEAST = -(1 << 62)
MOST = 1 << 62
SHARD_ROWS = 131_072
FIRST_SHARDS = 16  # one shard in so many is searched first
COMPONENT_LIMIT = 1 << 27


def integer_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                    scale: float = 256.0) -> DataFrame:
    """``row, id, label, q``: rows that take part, with components
    floor(scale * x) as packed little-endian integers (as narrow as a batch of
    rows allows; the first byte is the width).  Left out are null labels, null
    vectors and vectors with a null or non-finite component.  Components are
    held within 2^27, so that scores fit a long."""
    prepare(df)
    ok = F.forall(F.col(vec_col), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.filter(F.col(label_col).isNotNull() & F.col(vec_col).isNotNull() & ok).select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
        F.col(vec_col).cast("array<double>").alias("vec"))

    def work(batches):
        import pyarrow as pa

        for b in batches:
            lists = b.column("vec")
            x = np.floor(lists.flatten().to_numpy(zero_copy_only=False) * scale)
            x = np.clip(x, -COMPONENT_LIMIT, COMPONENT_LIMIT).astype(np.int64)
            width = 2 if not len(x) or np.abs(x).max() < 1 << 15 else 4
            raw, sign = x.astype(f"<i{width}").tobytes(), bytes([width])
            ends = (np.cumsum(lists.value_lengths().to_numpy()) * width).tolist()
            q = [sign + raw[s:e] for s, e in zip([0, *ends], ends)]
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("id"), b.column("label"), pa.array(q, pa.binary())],
                                             ["row", "id", "label", "q"])

    return rows.mapInArrow(work, "row long, id long, label long, q binary")


def _unpack(packed: list[bytes], size: int | None = None) -> np.ndarray:
    """Vectors as rows of doubles (exact for these integers); shorter ones are
    filled up with zeros."""
    parts = [np.frombuffer(p, f"<i{p[0]}", offset=1) for p in packed]
    size = size or max(map(len, parts), default=0)
    out = np.zeros((len(parts), size))
    for row, p in zip(out, parts):
        row[: min(len(p), size)] = p[:size]
    return out


class Shard:
    """Rows of one shard with their sorted lists."""

    def __init__(self, ids, rows, labels, packed):
        self.ids, self.rows, self.labels = (np.array(x, dtype=np.int64) for x in (ids, rows, labels))
        self.x = _unpack(packed)
        self.big = float(np.abs(self.x).max()) if self.x.size else 0.0
        self.lists = np.argsort(self.x, axis=0, kind="stable").T.astype(np.int32)

    def _scores(self, at: np.ndarray, a: np.ndarray, exact: bool) -> np.ndarray:
        if exact:
            return (self.x[at] @ a).astype(np.int64)
        return self.x[at].astype(np.int64) @ a.astype(np.int64)

    def search(self, anchor_row: int, label: int, a: np.ndarray, same: bool, windows, k: int):
        """For every window ``(low, high, bound)`` the shard's best k rows with a
        score within ``low .. high``, of at least ``bound``: lists of
        ``(score, id)``; ties to the smaller id."""
        n, size = self.x.shape
        a = np.pad(a, (0, max(size - len(a), 0)))[:size]
        exact = max(size, 1) * max(self.big, 1.0) * max(float(np.abs(a).max()) if size else 0.0, 1.0) < 2.0**52
        dims = np.flatnonzero(a)
        ups = dims[a[dims] > 0]
        downs = dims[a[dims] < 0]
        # the best score that counts: nothing below a window's lower end or a known k-th score
        floors = np.array([max(low, bound) for low, _, bound in windows], dtype=np.int64)
        highs = np.array([high for _, high, _ in windows], dtype=np.int64)
        seen = np.zeros(n, dtype=bool)
        found, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        depth, step = 0, 16
        open_ = floors <= highs
        while n and open_.any():
            if len(dims):
                to = min(depth + step, n)
                at = np.concatenate([self.lists[ups, n - to : n - depth].ravel(), self.lists[downs, depth:to].ravel()])
            else:
                to, at = n, np.arange(n)  # every row scores 0
            seen_new = np.zeros(n, dtype=bool)
            seen_new[at] = True
            seen_new &= ~seen
            seen |= seen_new
            at = np.flatnonzero(seen_new)
            fits = (self.labels[at] == label) == same
            at = at[fits & (self.rows[at] != anchor_row)]
            got = self._scores(at, a, exact)
            useful = got >= floors.min()
            found, scores = np.concatenate([found, at[useful]]), np.concatenate([scores, got[useful]])
            depth, step = to, step * 2
            if depth >= n or seen.all():
                break
            edge = np.concatenate([self.x[self.lists[ups, n - depth], ups] * a[ups], self.x[self.lists[downs, depth - 1], downs] * a[downs]])
            limit = int(edge.astype(np.int64).sum())
            for w in np.flatnonzero(open_):
                if limit < floors[w]:
                    open_[w] = False
                    continue
                inside = scores[(scores >= floors[w]) & (scores <= highs[w])]
                if len(inside) >= k and limit < np.partition(inside, len(inside) - k)[len(inside) - k]:
                    open_[w] = False
        out = []
        for low, high in zip(floors, highs):
            m = np.flatnonzero((scores >= low) & (scores <= high))
            m = m[np.lexsort((self.ids[found[m]], -scores[m]))[:k]]
            out.append((scores[m], self.ids[found[m]]))
        return out


NO_ID = np.iinfo(np.int64).max
TASK = "row long, id long, label long, q binary, windows array<struct<w:int,low:long,high:long,bound:long>>"
HIT = "row long, w int, score long, hit long"


def _visit(shards: DataFrame, asked: DataFrame, count: int, same: bool, k: int, which) -> DataFrame:
    """Search of ``asked`` anchors (``TASK``) in the shards that ``which`` (a
    condition on column ``shard``) selects."""
    spark = shards.sparkSession
    n = int(count)
    visits = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).filter(which)
    rows = shards.filter(which).withColumn("kind", F.lit(0)).unionByName(visits.withColumn("kind", F.lit(1)), allowMissingColumns=True)

    def work(batches):
        import pyarrow as pa

        now, held, shard = None, [], None
        for b in batches:
            if not b.num_rows:
                continue
            where, kind = b.column("shard").to_numpy(), b.column("kind").to_numpy()
            cuts = np.flatnonzero((np.diff(where) != 0) | (np.diff(kind) != 0)) + 1
            for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(where)]):
                part = b.slice(s, e - s)
                cols = [part.column(c).to_pylist() for c in ("id", "row", "label", "q")]
                if where[s] != now:
                    now, held, shard = where[s], [], None
                if kind[s] == 0:
                    held.append(cols)
                    continue
                if shard is None:
                    lists = [[x for c in held for x in c[i]] for i in range(4)]
                    shard, held = Shard([NO_ID if i is None else i for i in lists[0]], *lists[1:]), []
                out = [[], [], [], []]
                for row, label, q, windows in zip(*cols[1:], part.column("windows").to_pylist()):
                    got = shard.search(row, label, _unpack([q])[0], same, [(x["low"], x["high"], x["bound"]) for x in windows], k)
                    for x, (score, hit) in zip(windows, got):
                        for o, v in zip(out, (np.full(len(score), row), np.full(len(score), x["w"]), score, hit)):
                            o.append(v)
                if out[0]:
                    cat = [np.concatenate(o) for o in out]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cat, (pa.int64(), pa.int32(), pa.int64(), pa.int64()))],
                                                     ["row", "w", "score", "hit"])

    dealt = rows.repartition(max(partitions(spark), n), "shard").sortWithinPartitions("shard", "kind", "row")
    return dealt.select("shard", "kind", "row", "id", "label", "q", "windows").mapInArrow(work, HIT)


def _best(hits: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("row", "w").orderBy(F.desc("score"), "hit")
    return hits.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def best_in_windows(shards: DataFrame, asked: DataFrame, count: int, same: bool, k: int) -> DataFrame:
    """``row, w, score, hit, rank``: the first k rows of every anchor's every
    window, best first, ties to the smaller id."""
    early = F.col("shard") % FIRST_SHARDS == 0
    first = store(_best(_visit(shards, asked, count, same, k, early), k).drop("rank"), "negatives-first")
    if count == 1:
        return _best(first, k)
    bounds = first.groupBy("row", "w").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).otherwise(F.lit(LEAST)).alias("bound"))
    known = bounds.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("w", "bound"))).alias("_bounds"))
    narrowed = asked.join(known, "row", "left").withColumn(
        "windows", F.transform("windows", lambda x: x.withField("bound", F.coalesce(F.col("_bounds")[x["w"]], F.lit(LEAST))))).drop("_bounds")
    later = _visit(shards, narrowed, count, same, k, ~early)
    return _best(first.unionByName(later), k)


def mine(df: DataFrame, is_anchor, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, relabel=None,
         scale: float = 256.0, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score``: for every anchor (condition on column ``id``) and each of
    its first ``positives`` other rows of the same label, the first
    ``negatives`` rows of other labels with
    ``low * positive <= 100 * negative <= high * positive``.  Higher integer
    scores come first, ties by smaller id.

    ``relabel``: expression over ``id`` and ``label`` that replaces the label.
    Rows that :func:`integer_vectors` leaves out take no part.  Rows repeating an
    id are rows of their own; rows without an id come after all others of equal score and are returned
    with a null id.  Vectors of unequal length are compared as if the shorter
    ended in zeros; empty vectors score 0.  A positive whose window holds no row
    gives no row; an empty table gives none.
    """
    spark = prepare(df)
    rows = integer_vectors(df, id_col, vec_col, label_col, scale)
    if relabel is not None:
        rows = rows.withColumn("label", relabel.cast("long")).filter("label is not null")
    rows = store(rows, "negatives-rows")
    total = rows.count()
    count = max(min(partitions(spark), -(-total // 4096)), -(-total // SHARD_ROWS), 1)
    shards = rows.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(count)).cast("int"))
    anchors = rows.filter(F.coalesce(is_anchor, F.lit(False)))
    window = "array<struct<w:int,low:long,high:long,bound:long>>"
    whole = F.array(F.struct(F.lit(0), F.lit(LEAST), F.lit(MOST), F.lit(LEAST))).cast(window)
    found = store(best_in_windows(shards, anchors.withColumn("windows", whole), count, True, positives).select(
        "row", (F.col("rank") - 1).cast("int").alias("w"), F.col("score").alias("positive_score"), F.col("hit").alias("positive")), "negatives-positives")
    # 100 * negative >= low * positive, 100 * negative <= high * positive, in integers
    hundred = lambda x: F.floor(x / F.lit(100).cast("decimal(3,0)")).cast("long")
    p = F.col("positive_score").cast("decimal(19,0)")
    spans = found.withColumn("low", -hundred(-(p * low))).withColumn("high", hundred(p * high))
    wanted = spans.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("w", "low", "high", F.lit(LEAST).alias("bound")))).cast(window).alias("windows"))
    hits = best_in_windows(shards, anchors.join(wanted, "row"), count, False, negatives)
    real = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return hits.join(found, ["row", "w"]).join(anchors.select("row", F.col("id").alias("anchor_id")), "row").select(
        "anchor_id", real("positive").alias("positive_id"), "rank", real("hit").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
