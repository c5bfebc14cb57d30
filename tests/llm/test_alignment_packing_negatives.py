"""Interval alignment, sum-of-squares packing and threshold negatives against
brute force, on tables with nulls, empty and long texts, ties, repeated rows,
extra columns and empty tables."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hourglass.llm import alignment, hard_negatives, sos_packing, tokens

SCHEMA = "doc_id long, text string, kind int, chunk long, pos int, score double, _id string"


def corpus():
    rng = random.Random(5)
    bits = ["river", " ", "  ", "\n", "\n\n", "\t", " the", "straße", "漢字", "👍", "x\x01y", "<|endoftext|>", "<s>", "it's", "1234", "!!", "\r\n", "\x1c",
            "　", " é", "ΑΣ", " '", "\xa0"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randint(1, 60)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, " "), (103, "  "), (104, "a▁b"), (105, "same words here"), (106, "same words here"), (106, "same words here"),
             (None, "same words there"), (None, None), (107, "long word " * 20000), (108, "x" * 30000), (109, "\n"), (110, "end "), (111, "a\x00b")]
    return [(i, t, 7, 8, 9, 0.5, "z") for i, t in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(5)


def whole_alignment(text, a_tok, b_tok, a_bytes, b_bytes):
    """Groups and links of one text, token by token; None without tokens."""
    if not text:
        return None
    s = (" " + text).encode()
    a, b = a_tok.encode(" " + text, add_special_tokens=False).ids, b_tok.encode(text)
    if b"".join(map(a_bytes, a)) != s or b"".join(map(b_bytes, b)) != s:
        return None
    ends = [list(np.cumsum([len(f(i)) for i in ids])) for f, ids in ((a_bytes, a), (b_bytes, b))]
    groups, links, i, j = [], [], 0, 0
    for e in sorted(set(ends[0]) & set(ends[1])):
        k, m = ends[0].index(e, i) + 1, ends[1].index(e, j) + 1
        groups.append(",".join(map(str, a[i:k])) + "|" + ",".join(map(str, b[j:m])))
        links.append((a[k - 1], b[m - 1]))
        i, j = k, m
    return len(a), len(b), groups, links


def test_alignment_matches_whole_texts(spark, docs):
    import sentencepiece
    from tokenizers import Tokenizer, decoders

    a_tok = Tokenizer.from_file(tokens.tokenizer_path())
    a_tok.encode_special_tokens = True
    b_tok = sentencepiece.SentencePieceProcessor(model_file=tokens.tokenizer_path(alignment.PIECE_MODEL))
    alphabet = {chr(c): b for b, c in enumerate(tokens._byte_letters())}
    a_bytes = lambda i: bytes(alphabet[c] for c in a_tok.id_to_token(i))
    assert a_bytes(a_tok.encode("é").ids[0]).startswith("é".encode()[:1]) and decoders.ByteLevel().decode([a_tok.id_to_token(262)]) == a_bytes(262).decode()
    b_bytes = lambda i: bytes([int(b_tok.id_to_piece(i)[3:5], 16)]) if b_tok.is_byte(i) else b_tok.id_to_piece(i).replace("▁", " ").encode()
    whole = [(r[0], whole_alignment(r[1], a_tok, b_tok, a_bytes, b_bytes)) for r in corpus()]
    count = Counter(x for _, w in whole if w for x in w[3])
    best = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    want = []
    for i, w in whole:
        if w is None:
            want.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups, links = w
        want.append((i, a, b, len(groups), len(links), sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links),
                     hashlib.sha256(";".join(groups).encode()).hexdigest()))
    got = alignment.aligned(docs, keep_groups=True)
    rows = got.collect()
    cols = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    assert sorted(map(str, want)) == sorted(str(tuple(r[c] for c in cols)) for r in rows)
    assert all(r["groups_sha256"] == (hashlib.sha256(r["groups"].encode()).hexdigest() if r["groups"] else "") for r in rows)
    assert sum(w is None for _, w in whole) >= 4 and sum(w is not None for _, w in whole) > 50
    pairs = alignment.pair_counts(alignment.align_documents(docs)).collect()
    assert {(r["a_id"], r["b_id"]): r["links"] for r in pairs} == dict(count)
    assert all(r["best"] == (r["links"] == best[r["b_id"]]) for r in pairs)
    assert alignment.aligned(docs.limit(0)).count() == 0


def test_forgetting_does_not_change_an_alignment():
    import pyarrow as pa

    texts = [r[1] or "" for r in corpus()]
    path_b = tokens.tokenizer_path(alignment.PIECE_MODEL)
    small = alignment.Alignments(tokens.tokenizer_path(), path_b, max_pieces=20)
    large = alignment.Alignments(tokens.tokenizer_path(), path_b)
    for t in texts:
        got = []
        for table in (small, large):
            pieces, _ = table.pieces(pa.array([" " + t]))
            rows = table.rows(pieces)
            got.append((table.stats[rows].tolist(), [table.text[r] for r in rows],
                        table.pairs[tokens.ragged(table.begin[rows], table.count[rows])].tolist()))
        assert got[0] == got[1]
    assert len(small.table) < len(large.table)


def test_coalesced_groups_and_overlaps():
    rng = random.Random(1)
    for _ in range(200):
        n = rng.randint(1, 30)
        cuts = [sorted(rng.sample(range(1, n), rng.randint(0, n - 1))) + [n] for _ in range(2)]
        (a_s, a_e), (b_s, b_e) = [(np.array([0, *c[:-1]]), np.array(c)) for c in cuts]
        group = alignment.coalesce(np.concatenate([a_s, b_s]), np.concatenate([a_e, b_e]))
        common = sorted(set(cuts[0]) & set(cuts[1]))
        assert group.tolist() == [sum(c < e for c in common) for e in [*a_e, *b_e]]
        i, j = alignment.overlaps(a_s, a_e, b_s, b_e)
        want = [(x, y) for x in range(len(a_s)) for y in range(len(b_s)) if a_s[x] < b_e[y] and b_s[y] < a_e[x]]
        assert list(zip(i.tolist(), j.tolist())) == want


@pytest.mark.parametrize("name,plain", [("byte_bpe_50k.json", False), ("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_piece_encoder_equals_the_untouched_library(name, plain):
    import pyarrow as pa
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(tokens.tokenizer_path(name))
    tk.encode_special_tokens = plain
    rng = random.Random(1)
    bits = ["a", "b ", " ", "\n", "\t", "'s", "é", "é", "1", "!!", "  ", "\x01", "<|endoftext|>", "<|startoftext|>", "\r\n", "\x1c", " word", "Σ", "ΑΣ ",
            "▁", "　", "漢字", "٠", "👍", "ﬁ", "İ", "\x00", "½", "\x85", "\xa0", "ẞ", "\U00011f02", "ª", "￿"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    enc = tokens.PieceEncoder(tokens.tokenizer_path(name), plain, max_pieces=300)
    for a in range(0, len(texts), 400):
        ids, counts = enc.encode(pa.array(texts[a : a + 400]))
        want = [e.ids for e in tk.encode_batch(texts[a : a + 400], add_special_tokens=False)]
        assert [len(w) for w in want] == counts.tolist() and ids.tolist() == [x for w in want for x in w]


def library_ids(end):
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(tokens.tokenizer_path(sos_packing.WORD_BPE))
    return [(r[0], np.array(tk.encode(r[1] or "", add_special_tokens=False).ids + [end], dtype="<u4")) for r in corpus()]


@pytest.mark.parametrize("keep_ids", [True, False])
def test_sum_of_squares_packing(spark, docs, keep_ids):
    size = 64
    got = sos_packing.pack_documents(docs, capacity=size, keep_ids=keep_ids).collect()
    want = Counter()
    for i, ids in library_ids(1):
        for k in range(0, len(ids), size):
            part = ids[k : k + size]
            want[i, k // size, k, len(part), zlib.crc32(part)] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] if keep_ids else r["ids"] is None for r in got)
    seqs = {}
    for r in got:
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for s in seqs.values():
        s.sort()
        assert [o for o, _ in s] == [0, *np.cumsum([n for _, n in s])[:-1]] and sum(n for _, n in s) <= size
    assert sos_packing.pack_documents(docs.limit(0)).count() == 0


def test_places_have_the_smallest_sum_of_squares():
    rng = random.Random(2)
    for cap in (1, 7, 12, 40):
        state, rooms = sos_packing.SumOfSquares(cap), {}
        for _ in range(150):
            size = rng.randint(1, cap)
            options = {g for g in rooms.values() if g >= size}

            def squares(g, size=size):
                after = Counter(g2 for g2 in rooms.values() if g2)
                after[g] -= 1
                if g > size:
                    after[g - size] += 1
                return sum(n * n for n in after.values())

            seq, offset = state.place(size)
            if options:
                assert cap - offset == min(options, key=lambda g: (squares(g), g)) == rooms[seq]
            else:
                assert offset == 0 and seq not in rooms
            rooms[seq] = cap - offset - size


def test_few_sequences(spark):
    rng = random.Random(3)
    rows = [(i, 0, 0, min(4096, int(rng.lognormvariate(6, 1.2)) + 1), i, None) for i in range(8000)]
    got = sos_packing.pack(spark.createDataFrame(rows, sos_packing.PIECE)).toPandas()
    assert got.sequence_id.nunique() <= 1.01 * got.length.sum() / 4096 + 8  # eight tasks


def brute_negatives(rows, step=20):
    use = [(i, lab, np.floor(256 * np.array(v, dtype=np.float64)).astype(np.int64)) for i, v, lab in rows
           if lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    use = [(i, (lab + 1) % 10 if i is not None and i % 7 == 0 else lab, q) for i, lab, q in use]
    key = lambda r: (-r[0], r[1] is None, r[1] or 0)
    out = []
    for n, (i, lab, q) in enumerate(use):
        if i is None or i % step:
            continue
        score = [(int((q[: len(c)] * c[: len(q)]).sum()), j, other) for m, (j, other, c) in enumerate(use) if m != n]
        for p, j, _ in sorted((s for s in score if s[2] == lab), key=key)[:5]:
            neg = sorted((s for s in score if s[2] != lab and 30 * p <= 100 * s[0] <= 90 * p), key=key)[:10]
            out += [(i, j, r + 1, k, p, s) for r, (s, k, _) in enumerate(neg)]
    return out


def negatives_rows(n, dims, tied):
    rng = np.random.default_rng(7)
    x = rng.standard_normal((n, dims)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if tied:
        x[::3] = np.round(x[::3] * 2) / 2  # many equal scores
    rows = [(i, v.tolist(), int(i % 3) if i % 5 else 4) for i, v in enumerate(x)]
    rows[5] = (5, rows[5][1], None)
    rows[20] = (20, None, 1)
    rows[6], rows[8], rows[9] = (6, [None] * dims, 1), (8, [float("nan")] * dims, 1), (9, [float("inf")] * dims, 0)
    return rows + [(40, rows[40][1], 1), (None, rows[60][1], 2), (-60, rows[61][1], 1), (1000000, [0.0] * dims, 2), (1000020, [0.5] * (dims // 2), 1),
                   (1000040, [], 2), (1000060, [0.3] * dims, 77)]


@pytest.mark.parametrize("tied", [False, True])
def test_negatives_match_brute_force(spark, tied):
    rows = negatives_rows(900, 8, tied)
    df = spark.createDataFrame([(*r, 1, "q") for r in rows], "vec_id long, embedding array<float>, label int, shard int, q string")
    moved = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = hard_negatives.mine(df, F.col("id") % 20 == 0, relabel=moved).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute_negatives(rows)))
    assert hard_negatives.mine(df.limit(0), F.col("id") % 20 == 0).count() == 0


def test_many_shards_and_bounds_give_the_same_rows(spark, monkeypatch):
    rows = negatives_rows(600, 6, True)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    moved = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    monkeypatch.setattr(hard_negatives, "SHARD_ROWS", 20)
    got = hard_negatives.mine(df, F.col("id") % 20 == 0, relabel=moved).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute_negatives(rows)))


def test_reading_stops_early_where_the_threshold_allows():
    rng = np.random.default_rng(3)
    x = np.rint(rng.exponential(40, (4000, 3)))
    packed = [bytes([4]) + v.astype("<i4").tobytes() for v in x]
    shard = hard_negatives.Shard(range(4000), range(4000), np.zeros(4000), packed)
    seen = []
    score = shard._scores
    shard._scores = lambda at, a, exact: seen.append(len(at)) or score(at, a, exact)
    a = np.array([3.0, 2.0, 1.0])
    (got, ids), = shard.search(-1, 0, a, True, [(hard_negatives.LEAST, hard_negatives.MOST, hard_negatives.LEAST)], 10)
    full = (x @ a).astype(np.int64)
    assert list(ids) == np.lexsort((np.arange(4000), -full))[:10].tolist() and list(got) == full[ids].tolist()
    assert sum(seen) < 2000


def test_printable_pieces_are_merged_together(tmp_path):
    """Ids and counts of pieces merged as joined words are the library's, and a
    vocabulary with a token over a cut is not joined."""
    import json

    from tokenizers import Tokenizer

    path = tokens.tokenizer_path()
    enc, lib = tokens.PieceEncoder(path), Tokenizer.from_file(path)
    rng = np.random.default_rng(21)
    letters = list("abcdeABCxyz0123.,;-!()")
    pieces = [rng.choice([" ", "\n"]) + "".join(rng.choice(letters, rng.integers(1, 12))) for _ in range(500)]
    ids, count = enc._joined(pieces)
    want = [lib.encode(p, add_special_tokens=False).ids for p in pieces]
    assert ids.tolist() == [i for w in want for i in w] and count.tolist() == [len(w) for w in want]
    with open(path, encoding="utf-8") as f:
        conf = json.load(f)
    conf["model"]["vocab"]["a1"] = max(conf["model"]["vocab"].values()) + 1
    conf["model"]["merges"].insert(0, ["a", "1"] if isinstance(conf["model"]["merges"][0], list) else "a 1")
    crossing = str(tmp_path / "crossing.json")
    with open(crossing, "w", encoding="utf-8") as f:
        json.dump(conf, f)
    enc, lib = tokens.PieceEncoder(crossing), Tokenizer.from_file(crossing)
    assert enc.width is None
    ids, count = enc.encode(pa.array(["a1 ba1 a1", " xa1"]))
    assert ids.tolist() == [i for t in ("a1 ba1 a1", " xa1") for i in lib.encode(t, add_special_tokens=False).ids]
