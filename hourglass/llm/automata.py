"""Substring removal over words with suffix automata.

Reference shards become generalised suffix automata; documents are streamed
through them for matching statistics (at every word, the length of the longest
suffix read so far that the shard contains), and maximal spans of at least
``width`` words are removed.

Two uses.  ``remove_reference_spans`` removes what a given reference table
(say, benchmarks) contains: its rows are cut into shards of bounded size, each
shard's automaton is broadcast and all documents stream past it.
``remove_repeats`` compares a corpus with itself.  There the reference grows
with the corpus, so shards are not broadcast: the frame of ``repeats.py`` deals
the candidate segments by anchor, each anchor's segments are one shard, and its
automaton is built and read in the same pass: the matching statistic of a word
against everything before it falls out of inserting it.
"""

from __future__ import annotations

import hashlib
import pickle

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.llm.common import prepare, store, text_or_empty
from hourglass.llm.repeats import removed_mask, repeated_spans

_KNOWN: dict[bytes, int] = {}


def split_words(text: str) -> list[bytes]:
    """Maximal runs of bytes other than blank and 09-0D."""
    return text.encode("utf-8").split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    """XXH64 of every word, remembered per worker (bounded)."""
    import xxhash

    if len(_KNOWN) > 500_000:
        _KNOWN.clear()
    get = _KNOWN.get
    found = list(map(get, words))
    if None in found:
        for w in {w for w, f in zip(words, found) if f is None}:
            _KNOWN[w] = xxhash.xxh64_intdigest(w)
        found = list(map(get, words))
    return np.fromiter(found, dtype=np.uint64, count=len(found))


class SuffixAutomaton:
    """Generalised suffix automaton over hashable symbols."""

    def __init__(self):
        self.next, self.link, self.length = [{}], [-1], [0]

    def _state(self, edges: dict, link: int, length: int) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def insert(self, seq) -> list[int]:
        """Add a sequence; returns, per position, the length of the longest
        suffix ending there that also ended somewhere before."""
        nxt, link, length = self.next, self.link, self.length
        last, seen = 0, []
        for c in seq:
            q = nxt[last].get(c)
            size = length[last] + 1
            if q is not None:
                last = q if length[q] == size else self._split(last, c, q)
                seen.append(size)
                continue
            cur = self._state({}, 0, size)
            p = last
            while p != -1 and c not in nxt[p]:
                nxt[p][c] = cur
                p = link[p]
            if p != -1:
                q = nxt[p][c]
                link[cur] = q if length[q] == length[p] + 1 else self._split(p, c, q)
            last = cur
            seen.append(length[link[cur]])
        return seen

    def _split(self, p: int, c, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        clone = self._state(dict(nxt[q]), link[q], length[p] + 1)
        link[q] = clone
        while p != -1 and nxt[p].get(c) == q:
            nxt[p][c] = clone
            p = link[p]
        return clone

    def matching(self, seq) -> list[int]:
        """Matching statistics of a sequence."""
        nxt, link, length = self.next, self.link, self.length
        state, size, out = 0, 0, []
        for c in seq:
            while state and c not in nxt[state]:
                state = link[state]
                size = length[state]
            if c in nxt[state]:
                state, size = nxt[state][c], size + 1
            out.append(size)
        return out


class Words:
    @staticmethod
    def hashes(text: str) -> np.ndarray:
        return word_hashes(split_words(text))

    payload = hashes


def seen_windows(segments: list[bytes], width: int) -> list[np.ndarray]:
    """Per segment (bytes of word hashes): which windows stood in an earlier
    segment.  Segments of different anchors share no window, so one automaton
    may hold several anchors' shards."""
    shard = SuffixAutomaton()
    out = []
    for seg in segments:
        stat = shard.insert(np.frombuffer(seg, dtype=np.uint64).tolist())
        out.append(np.array(stat[width - 1 :]) >= width)
    return out


def remove_repeats(docs: DataFrame, width: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row ``_id, kept_text, n_words, n_removed, kept_sha256``: the
    words left when every window of ``width`` words that also starts earlier
    is removed, joined by one blank.

    Null and empty texts have no words.  Texts shorter than a window stay
    whole.  Rows repeating id and text are one document and get equal results;
    a missing id sorts last.  Words are compared by 64-bit hash.
    """
    base, spans = repeated_spans(docs, Words, width, _gram(width), seen_windows, id_col, text_col)

    def apply(batches):
        import pyarrow as pa

        for b in batches:
            out = []
            for text, cut, copy in zip(*(b.column(c).to_pylist() for c in ("_text", "_spans", "_copy"))):
                words = split_words(text)
                gone = removed_mask(cut, len(words), copy and len(words) >= width)
                kept = b" ".join(w for w, g in zip(words, gone) if not g) if gone.any() else b" ".join(words)
                out.append((kept.decode("utf-8"), len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest()))
            if out:
                cols = [pa.array(list(c), t) for c, t in zip(zip(*out), ("string", "int64", "int64", "string"))]
                yield pa.RecordBatch.from_arrays([b.column("_id"), *cols],
                                                 ["_id", "kept_text", "n_words", "n_removed", "kept_sha256"])

    return base.join(spans, ["_ord", "_v"], "left").select("_id", "_text", "_copy", "_spans").mapInArrow(
        apply, "_id long, kept_text string, n_words long, n_removed long, kept_sha256 string")


def _gram(width: int) -> int:
    """Anchor length: the largest power of two up to two fifths of a window."""
    return 1 << max(0, (2 * width // 5).bit_length() - 1)


def remove_reference_spans(docs: DataFrame, reference: DataFrame, width: int = 20, text_col: str = "text",
                           ref_text_col: str = "text", shard_words: int = 200_000) -> DataFrame:
    """``docs`` plus ``kept_text`` and ``n_removed``: maximal spans of at least
    ``width`` words that the reference contains are removed.

    A shard holds about ``shard_words`` words (a longer reference text is a
    shard of its own) and only one shard is broadcast at a time.  Null texts
    keep a null ``kept_text``; an empty reference removes nothing.
    """
    spark = prepare(docs)
    sized = reference.select(text_or_empty(ref_text_col).alias("t")).withColumn("w", F.size(F.split("t", r"[ \t-\r]+")))
    total = sized.agg(F.sum("w")).first()[0] or 0
    count = max(1, -(-int(total) // shard_words))

    def build(key, pdf):
        import pandas as pd

        shard = SuffixAutomaton()
        for t in pdf["t"]:
            shard.insert(word_hashes(split_words(t)).tolist())
        return pd.DataFrame({"k": [key[0]], "a": [pickle.dumps(shard)]})

    shards = store(sized.withColumn("k", F.pmod(F.xxhash64("t"), F.lit(count))).groupBy("k").applyInPandas(build, "k long, a binary"),
                   "automata")
    now = docs.withColumn("_hit", F.array().cast("array<int>"))
    for k in range(count):
        row = shards.filter(F.col("k") == k).select("a").first()
        if row is None:
            continue
        held = spark.sparkContext.broadcast(bytes(row["a"]))
        now = _stream_past(now, held, width, text_col)
    text = F.udf(_without, "struct<kept_text:string,n_removed:long>")
    return now.withColumn("_r", text(F.col(text_col), F.col("_hit"))).select(*docs.columns, "_r.kept_text", "_r.n_removed")


def _stream_past(docs: DataFrame, held, width: int, text_col: str) -> DataFrame:
    @F.pandas_udf("array<int>")
    def spans(texts, hits):
        import pandas as pd

        shard = pickle.loads(held.value)
        out = []
        for t, old in zip(texts, hits):
            new = list(old)
            if t is not None:
                stat = shard.matching(word_hashes(split_words(t)).tolist())
                for e, m in enumerate(stat):
                    if m >= width:
                        new += [e - m + 1, e + 1]
            out.append(new)
        return pd.Series(out)

    return docs.withColumn("_hit", spans(F.col(text_col), F.col("_hit")))


def _without(text, hits):
    if text is None:
        return None, 0
    words = split_words(text)
    gone = removed_mask([{"s": s, "e": e} for s, e in zip(hits[::2], hits[1::2])], len(words))
    return b" ".join(w for w, g in zip(words, gone) if not g).decode("utf-8"), int(gone.sum())
