"""Training-data operators against brute force on small tables with nulls,
empty and long texts, ties, repeated rows, extra columns and empty tables."""

import hashlib
import random
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from hourglass.llm import (
    automata, exact_dedup, langid, mixing, nndescent, packing, simhash, simple8b, suffix_dedup, tokens, warc,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, _keep string"


def corpus():
    rng = random.Random(5)
    words = {"en": "the of and thing over river stone light", "de": "der die und über ein schloss straße nacht"}
    rows = []
    for i in range(60):
        lang = "en" if i % 3 else "de"
        rows.append((i, " ".join(rng.choice(words[lang].split()) + rng.choice(["", "x", "ing", "er"]) for _ in range(rng.randint(3, 90))), lang))
    passage = " ".join(f"shared{k}" for k in range(40))
    rows += [(100, rows[3][1], "en"), (101, rows[3][1], "en"), (101, rows[3][1], "en"), (102, None, None), (103, "", "en"),
             (104, "a " + passage + " b", "en"), (105, passage + " c", "en"), (None, rows[4][1], "en"),
             (106, "12 34 !!", None), (107, ("long " * 30000) + "end", "en"), (108, rows[5][1] + " more", "en"),
             (109, "  odd\t\tspaces \n\n x  ", "en"), (110, "same " * 300, "en"), (111, "same " * 300 + "y", "en")]
    return [(i, t, lang, "s" + str((i or 0) % 3), None, 0.5, "k") for i, t, lang in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA)


def rows_of():
    return [(r[0], r[1] or "") for r in corpus()]


def test_exact_dedup(spark, docs):
    got = exact_dedup.exact_classes(docs, keep="max").collect()
    texts = [t for _, t in rows_of()]
    assert len(got) == len(texts)
    best, size = {}, {}
    for i, t in rows_of():
        sha = hashlib.sha256(t.encode()).digest()
        best[sha] = max((x for x in (best.get(sha), i) if x is not None), default=None)
        size[sha] = size.get(sha, 0) + 1
    assert all(r["_keep"] == best[bytes(r["_sha"])] and r["_n"] == size[bytes(r["_sha"])] for r in got)
    assert sum(r["kept"] for r in got) == len(set(texts))
    left = exact_dedup.exact_dedup(docs, keep="max")
    assert left.columns == docs.columns and left.count() == len(set(texts))
    assert exact_dedup.exact_dedup(docs.limit(0)).count() == 0


def fingerprint(t):
    w = t.encode().lower().split()
    sh = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(fps):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in fps:
        for b in fps:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    return {f: find(f) for f in fps}


def test_simhash(spark, docs):
    rows = rows_of()
    fps = [fingerprint(t) for _, t in rows]
    comp = components(set(fps))
    least = {}
    for (i, _), f in zip(rows, fps):
        if i is not None:
            least[comp[f]] = min(least.get(comp[f], i), i)
    want = sorted((str(i), f - (1 << 64) if f >> 63 else f, least.get(comp[f])) for (i, _), f in zip(rows, fps))
    got = sorted((str(r["_id"]), r["_fp"], r["component_id"]) for r in simhash.simhash_classes(docs).collect())
    assert got == want
    left = simhash.simhash_dedup(docs)
    assert left.columns == docs.columns and left.count() == len(set(comp.values()))


@pytest.mark.parametrize("cap", [1, 256])
def test_simhash_links_lose_nothing(spark, cap):
    rng = random.Random(2)
    fps = {rng.getrandbits(64) for _ in range(20)}
    for f in list(fps)[:8]:
        fps |= {f ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(6)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    pairs = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), 2, cap)
    found = {r["node"]: r["root"] for r in simhash.components(pairs).collect()}
    want = components(fps)
    groups = {}
    for f, s in zip(fps, signed):
        groups.setdefault(found.get(s, s), set()).add(f)
    byroot = {}
    for f, r in want.items():
        byroot.setdefault(r, set()).add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, byroot.values()))


def test_simple8b_round_trip():
    rng = np.random.default_rng(0)
    for n in (0, 1, 5, 255, 256, 257, 3000):
        a = rng.integers(0, 2**63, n, dtype=np.uint64) >> rng.integers(0, 64, n).astype(np.uint64)
        if n > 3:
            a[2] = 2**64 - 1  # escape
        words, first, escapes, _ = simple8b.encode_words(a)
        assert (simple8b.decode_words(words, first, escapes, n) == a).all()


def token_ids(end):
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(tokens.tokenizer_path())
    return [(i, np.array(tk.encode(t, add_special_tokens=False).ids + [end], dtype="<u4")) for i, t in rows_of()]


def test_token_files(spark, docs):
    got = simple8b.read_token_files(simple8b.write_token_files(docs, file_ids=5000), with_ids=True).collect()
    want = token_ids(2)
    key = lambda i, a: (i is None, i or 0, a)
    assert sorted(key(r["doc_id"], r["ids"]) for r in got) == sorted(key(i, a.tolist()) for i, a in want)
    start = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == start and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], dtype="<u4"))
        start += r["n_tokens"]
    order = [(r["doc_id"] is None, r["doc_id"] or 0) for r in sorted(got, key=lambda r: r["start"])]
    assert order == sorted(order)
    assert simple8b.read_token_files(simple8b.write_token_files(docs.limit(0))).count() == 0


def test_packing(spark, docs):
    limits = packing.Limits(tokens=64, segments=4, loss_tokens=50)
    got = packing.pack(packing.document_items(docs, limits=limits), limits).collect()
    total = {}
    for i, a in token_ids(0):
        total[i] = total.get(i, 0) + len(a)
    have, seqs = {}, {}
    for r in got:
        have[r["doc_id"]] = have.get(r["doc_id"], 0) + r["length"]
        seqs.setdefault(r["sequence_id"], []).append(r)
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
    assert have == total
    for s in seqs.values():
        s.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in s] == list(np.cumsum([0] + [r["length"] for r in s])[:-1])
        assert sum(r["length"] for r in s) <= 64 and len(s) <= 4 and sum(r["loss_tokens"] for r in s) <= 50
    once = {i: a for i, a in token_ids(0) if i not in (None, 101)}
    for r in got:
        if r["doc_id"] in once:
            assert r["ids"] == once[r["doc_id"]][r["start"] : r["start"] + r["length"]].tobytes()
    assert packing.pack_documents(docs.limit(0)).count() == 0


def test_packing_whole_examples(spark):
    rows = [(i, np.arange(n, dtype="<u4").tobytes(), bytes([1] * k + [0] * (n - k))) for i, (n, k) in enumerate([(5, 2), (3, 3), (8, 1), (1, 0), (4, 4)])]
    ex = spark.createDataFrame(rows, "id long, ids binary, mask binary")
    out = packing.pack(packing.example_items(ex, "id", "ids", "mask"), packing.Limits(8, 2, 4), cut=False).collect()
    assert sorted(r["doc_id"] for r in out) == [0, 1, 2, 3, 4] and all(r["start"] == 0 for r in out)
    for s in {r["sequence_id"] for r in out}:
        part = [r for r in out if r["sequence_id"] == s]
        assert sum(r["length"] for r in part) <= 8 and len(part) <= 2 and sum(r["loss_tokens"] for r in part) <= 4


def covered(units, width):
    seen, out = {}, []
    for i, (_, u) in enumerate(units):
        m = np.zeros(len(u), dtype=bool)
        for a in range(len(u) - width + 1):
            k = u[a : a + width]
            k = k if isinstance(k, bytes) else tuple(k)
            if seen.setdefault(k, (i, a)) != (i, a):
                m[a : a + width] = True
        out.append(m)
    return out


def distinct_in_order():
    seen, out = set(), []
    for i, t in sorted(rows_of(), key=lambda r: (r[0] is None, r[0] or 0)):
        if (i, t) not in seen:
            seen.add((i, t))
            out.append((i, t))
    return out


def test_automaton_repeats(spark, docs):
    units = [(i, t.encode().split()) for i, t in distinct_in_order()]
    want = {(i, hashlib.sha256(b" ".join(w for w, g in zip(u, m) if not g)).hexdigest(), len(u), int(m.sum()))
            for (i, u), m in zip(units, covered(units, 20))}
    got = automata.remove_repeats(docs).collect()
    assert {(r["_id"], r["kept_sha256"], r["n_words"], r["n_removed"]) for r in got} == want and len(got) == len(rows_of())
    assert automata.remove_repeats(docs.limit(0)).count() == 0


def test_suffix_array_repeats(spark, docs):
    units = [(i, t.encode()) for i, t in distinct_in_order()]
    want = set()
    for (i, u), m in zip(units, covered(units, 100)):
        kept = np.frombuffer(u, dtype=np.uint8)[~m].tobytes()
        want.add((i, hashlib.sha256(kept).hexdigest(), len(u), int(m.sum()), int((np.diff(np.concatenate([[0], m.astype(int)])) == 1).sum())))
    got = suffix_dedup.remove_repeats(docs).collect()
    assert {(r["_id"], r["kept_sha256"], r["n_bytes"], r["n_removed"], r["n_spans"]) for r in got} == want


def test_hot_anchors_take_the_same_windows(spark, docs):
    _, a = automata.repeated_spans(docs, automata.Words, 20, 8, automata.seen_windows)
    _, b = automata.repeated_spans(docs, automata.Words, 20, 8, automata.seen_windows, hot=1)

    def words(spans):
        return {(r["_ord"], p) for r in spans.collect() for s in r["_spans"] for p in range(s["s"], s["e"])}

    assert words(a) == words(b)


def test_transform_and_automaton_solvers():
    rng = random.Random(3)
    for _ in range(60):
        w = rng.choice([3, 5, 8])
        segs = {bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 14))) for _ in range(20)}
        segs = [d for d in segs if len({d[a : a + w] for a in range(len(d) - w + 1)}) == max(0, len(d) - w + 1)] or [b"abc"]
        seen, want = {}, []
        for i, d in enumerate(segs):
            want.append([seen.setdefault(d[a : a + w], i) < i for a in range(len(d) - w + 1)])
        assert [x.tolist() for x in suffix_dedup.seen_windows(segs, w)] == want
        wide = [np.frombuffer(d, dtype=np.uint8).astype(np.uint64).tobytes() for d in segs]
        assert [x.tolist() for x in automata.seen_windows(wide, w)] == want


def test_reference_spans(spark):
    docs = spark.createDataFrame([(1, "x a b c d y"), (2, "a b c"), (3, None), (4, "")], "doc_id long, text string")
    ref = spark.createDataFrame([("a b c d e",), (None,), ("q r s t",)], "text string")
    got = {r["doc_id"]: (r["kept_text"], r["n_removed"]) for r in automata.remove_reference_spans(docs, ref, 4, shard_words=3).collect()}
    assert got == {1: ("x y", 4), 2: ("a b c", 0), 3: (None, 0), 4: ("", 0)}


def test_language_id(spark, docs):
    model = langid.train(docs.filter(langid.learnable()))
    got = langid.identify(docs, model).collect()
    assert len(got) == len(rows_of())
    known = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 60]
    assert np.mean([r["lang_pred"] == r["lang"] for r in known]) >= 0.95
    for r in got:
        letters = r["text"] is not None and any(c.isalpha() for c in r["text"])
        assert (r["lang_pred"] != "und") == letters and 0 <= r["score"] <= 1
    assert langid.train(docs.filter("lang is null")) is None
    assert {r["lang_pred"] for r in langid.identify(docs, None).collect()} == {"und"}
    assert langid.recognised(docs, model).columns == docs.columns


def test_codewords_stand_apart():
    for k in (1, 2, 4, 7, 12):
        c = langid.codewords(k)
        assert len({tuple(r) for r in c}) == k and set(np.unique(c)) <= {-1.0, 1.0}


def test_raking_meets_all_marginals(spark):
    cells = spark.createDataFrame([(s, la, t, (i * 37) % 50 + 5) for i, (s, la, t) in enumerate(
        (s, la, t) for s in ("a", "b", None) for la in ("x", "y") for t in ("p", "q"))], "source string, lang string, topic string, tokens long")
    out = mixing.rake(cells, targets={"lang": {"x": 0.3, "y": 0.7}, "topic": {"p": 0.5, "q": 0.5}}, rounds=12).toPandas()
    share = out.groupby("lang").raked.sum() / out.raked.sum()
    assert share["x"] == pytest.approx(0.3, abs=1e-6)
    assert (out.groupby("topic").raked.sum() / out.raked.sum())["p"] == pytest.approx(0.5, abs=1e-9)
    assert out.probability.max() == pytest.approx(1.0) and (out.probability > 0).all()
    assert np.allclose(out.probability / out.probability.max(), (out.raked / out.tokens) / (out.raked / out.tokens).max())


def test_raking_goes_on_until_the_marginals_hold(spark):
    cells = spark.createDataFrame([("a", "x", "p", 1000), ("a", "y", "p", 1), ("b", "x", "p", 1), ("b", "y", "p", 1000)],
                                  "source string, lang string, topic string, tokens long")  # sources nearly tied to languages
    out = mixing.rake(cells, targets={"source": {"a": 0.5, "b": 0.5}, "lang": {"x": 0.3, "y": 0.7}}).toPandas()
    for d, due in (("source", {"a": 0.5, "b": 0.5}), ("lang", {"x": 0.3, "y": 0.7})):
        share = out.groupby(d).raked.sum() / out.raked.sum()
        assert all(abs(share[k] / v - 1) <= 1.01e-4 for k, v in due.items())
    tied = cells.filter("tokens > 1")  # no weights meet these targets
    assert mixing.rake(tied, targets={"source": {"a": 0.5, "b": 0.5}, "lang": {"x": 0.3, "y": 0.7}}).count() == 2


def test_mix_stage_keeps_the_rows_of_a_brute_force_rake(spark):
    import corpus_pipeline as cp

    rng = random.Random(8)
    rows = []
    for i in range(400):
        lang = "en" if rng.random() < 0.8 else "de"
        source = "s1" if (lang == "en") == (rng.random() < 0.98) else "s2"
        rows.append((i, " ".join(["w"] * (rng.randint(1, 60) if i % 3 else rng.randint(100, 300))), lang, source))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    cell, tokens = [(s, la, "note" if len(t.split()) < 100 else "article") for _, t, la, s in rows], {}
    for c, (_, t, _, _) in zip(cell, rows):
        tokens[c] = tokens.get(c, 0) + len(t.split())
    sums = lambda w, d: {v: sum(x for c, x in w.items() if c[d] == v) for v in {c[d] for c in w}}
    due = [{v: m**0.85 / sum(x**0.85 for x in sums(tokens, d).values()) for v, m in sums(tokens, d).items()} for d in range(3)]
    w = {c: float(x) for c, x in tokens.items()}
    for _ in range(500):
        for d in range(3):
            have = sums(w, d)
            w = {c: x * due[d][c[d]] * sum(tokens.values()) / have[c[d]] for c, x in w.items()}
    factor = {c: w[c] / tokens[c] for c in w}
    want, near = set(), set()
    for c, (i, *_) in zip(cell, rows):
        p = factor[c] / max(factor.values())
        u = int(hashlib.md5(f"mix:{i}".encode()).hexdigest()[:13], 16) / (1 << 52)
        (near if abs(u - p) < 1e-3 else want if u < p else set()).add(i)  # the tolerance leaves ``near`` open
    got = [r.doc_id for r in cp.mix(spark, df, "").collect()]
    assert len(near) < 5 and len(got) == len(set(got)) and set(got) - near == want


def test_mixing_rows(spark, docs):
    got = mixing.mix(docs)
    assert got.count() == len(rows_of())
    left = mixing.sample_mixture(docs)
    assert left.columns == docs.columns
    assert left.count() == got.filter("sampled").count()
    assert mixing.sample_mixture(docs.limit(0)).count() == 0


CLASHES = ("_rows _kid _ksha _sha_row _own _row _id _sha _keep _n kept _digest _run _fp component_id probability sampled _tokens _topic _source _lang "
           "_draw tokens raked source2 _ecoc lang_pred score ambiguous _text c")


def test_stages_keep_columns_of_any_name(spark, docs):
    """Extra columns named like the operators' own come through unchanged."""
    extra = docs.select("doc_id", "text", "lang", "source", *[F.lit(f"x {c}").alias(c) for c in CLASHES.split()])
    model = langid.train(extra.filter(langid.learnable()))
    for stage in (lambda d: langid.recognised(d, model), lambda d: exact_dedup.exact_dedup(d, keep="max"), simhash.simhash_dedup, mixing.sample_mixture):
        got, plain = stage(extra), stage(docs)
        assert got.columns == extra.columns
        rows = got.collect()
        assert rows and all(r[c] == f"x {c}" for r in rows for c in CLASHES.split())
        assert sorted(str((r.doc_id, r.text, r.lang, r.source)) for r in rows) == sorted(str((r.doc_id, r.text, r.lang, r.source)) for r in plain.collect())


def test_empty_tables(spark, docs):
    import corpus_pipeline as cp

    none = docs.limit(0)
    assert suffix_dedup.remove_repeats(none).count() == 0 and simhash.simhash_classes(none).count() == 0
    assert simhash.simhash_dedup(none).count() == 0 and langid.identify(none, langid.train(none)).count() == 0
    now = none.select("doc_id", "text", "lang", "source")
    for name, stage in cp.STAGES:
        now = stage(spark, now, "")
        assert now.count() == 0, name


def test_short_texts_are_packed_without_padding(spark):
    df = spark.createDataFrame([(i, "a b c" if i % 2 else "d e") for i in range(3000)], "doc_id long, text string")
    got = packing.pack_documents(df, keep_ids=False).toPandas()
    assert got.length.sum() == 1500 * 4 + 1500 * 3 and got.ids.isna().all()
    size = got.groupby("sequence_id").length.sum()
    assert all(n & (n - 1) == 0 for n in size) and got.groupby("sequence_id").size().max() <= 128


def test_packing_without_ids_gives_the_same_checksums(spark, docs):
    limits = packing.Limits(tokens=64)
    got = packing.pack_documents(docs, limits=limits, keep_ids=False).collect()
    assert all(r["ids"] is None for r in got)
    have = {}
    for r in got:
        have.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["ids_crc32"]))
    for i, a in token_ids(0):
        if i not in (None, 101):
            parts = sorted(have[i])
            assert [p[0] for p in parts] == [0, *np.cumsum([p[1] for p in parts])[:-1]] and sum(p[1] for p in parts) == len(a)
            assert all(zlib.crc32(a[s : s + n].tobytes()) == c for s, n, c in parts)


def test_language_id_against_plain_least_squares_and_decoding(spark, docs):
    """Features by hand, weights by the normal equations, decoding by a loop."""
    learn = docs.filter(langid.learnable())
    model = langid.train(learn, dims_log2=8, rows_per_lang=10_000, max_rows=10_000)
    rows = [r for r in learn.collect() if r.lang and r.text and any(c.isalpha() for c in r.text)]
    x = np.stack([langid.ngram_features(r.text, 8) for r in rows]).astype(np.float64)
    langs = sorted({r.lang for r in learn.collect() if r.lang and r.text is not None})
    assert model.langs == langs
    label = np.array([langs.index(r.lang) for r in rows])
    n = np.bincount(label, minlength=len(langs))
    w = len(label) / len(langs) / n[label]
    ridge = 0.1 * 0.03 * len(label) / len(langs)
    beta = np.linalg.solve(x.T @ (x * w[:, None]) + ridge * np.eye(x.shape[1]), x.T @ (w[:, None] * model.code[label]))
    assert np.allclose(model.weights, beta, atol=2e-3)
    for r in langid.identify(docs, model).collect():
        if r.text is None or not any(c.isalpha() for c in r.text):
            assert r.lang_pred == "und"
            continue
        f = np.clip(langid.ngram_features(r.text, 8) @ model.weights, -3, 3)
        loss = [sum(t * np.exp(-f[b] * model.code[k][b]) for b, t in enumerate(model.trust)) for k in range(len(langs))]
        two = sorted(loss)[:2]
        assert two[1] - two[0] < 1e-4 or r.lang_pred == langs[int(np.argmin(loss))]
        assert abs(two[1] - two[0] - 0.05) < 1e-4 or r.ambiguous == (two[1] - two[0] < 0.05)


def test_many_languages_and_rare_labels(spark):
    rng = random.Random(1)
    alphabet = "абвгдежзиклм"
    rows = [(i, " ".join(alphabet[i % 12] * rng.randint(1, 3) + rng.choice("xyz") for _ in range(20)), f"l{i % 12:02d}") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    few = langid.train(df, max_langs=5)
    assert few.langs == [f"l{k:02d}" for k in range(5)]
    model = langid.train(df)
    got = langid.identify(df, model).collect()
    assert np.mean([r.lang_pred == r.lang for r in got]) > 0.98


def test_nearest(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((300, 8))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(300, None), (301, [0.0] * 8), (302, [float("nan")] + [1.0] * 7), (303, [None] + [1.0] * 7), (304, [9.0]), (None, [1.0] * 8), (7, x[7].tolist()),
             (305, []), (9, (-x[9]).tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = nndescent.nearest(df, F.col("id") % 20 == 0, top=20, rounds=1).toPandas()
    ids = np.array([*range(300), 304, 9])  # the short vector ends in zeros, the repeated id is a row of its own
    x = np.concatenate([x, [[9.0] + [0.0] * 7], [-x[9]]])
    hit = short = 0
    for i in range(0, 300, 20):
        s = x @ x[i]
        order = [k for k in np.lexsort((ids, -s)) if ids[k] != i][:20]
        mine = got[got.query_id == i].sort_values("rank")
        assert len(mine) == 20 and (np.diff(mine.score) <= 0).all()
        for v, q in zip(mine.vec_id, mine.score):
            assert min(abs(s[ids == v] - q)) < 1e-9
        hit += len({(ids[k], round(s[k], 6)) for k in order} & {(v, round(q, 6)) for v, q in zip(mine.vec_id, mine.score)})
        short += 304 in set(mine.vec_id)
    assert hit / (15 * 20) >= 0.9 and short
    few = nndescent.nearest(df.filter("vec_id < 5"), F.col("id") % 20 == 0, top=20, rounds=1).collect()
    assert sorted(r["vec_id"] for r in few) == [1, 2, 3, 4]
    assert nndescent.nearest(df.limit(0), F.col("id") % 20 == 0).count() == 0


def test_nearest_settles_and_unfolds_copies(spark):
    rng = np.random.default_rng(9)
    x = rng.standard_normal((3000, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[::3] = x[0]  # a third of the table is one vector
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = nndescent.nearest(df, F.col("id") % 20 == 0, top=20).toPandas().sort_values(["query_id", "rank"])
    found = {q: g for q, g in got.groupby("query_id")}
    assert sorted(found) == list(range(0, 3000, 20))
    hit = 0
    for q, g in found.items():
        best = [int(i) for i in np.lexsort((np.arange(3000), -np.round(x @ x[q], 12))) if i != q][:20]
        assert list(g["rank"]) == list(range(1, 21)) and g.vec_id.is_unique
        if q % 3 == 0:
            assert list(g.vec_id) == best == [i for i in range(0, 64, 3) if i != q][:20]
        hit += len(set(best) & set(g.vec_id))
    assert hit >= 0.9 * 20 * len(found)


def test_search_holds_a_pool_and_ends(spark):
    """A query's state is its pool, however many candidates it meets; members of
    the pool are all expanded, so none of their neighbours beats the pool."""
    rng = np.random.default_rng(12)
    x = rng.standard_normal((2000, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vec array<double>")
    nodes, edges = nndescent.build_graph(df, rounds=2)
    met = nndescent.search(df.filter("id % 20 = 0").select("id"), nodes, edges, pool=100, expand=30).toPandas()
    to = edges.select("v", "u").toPandas().groupby("v").u.apply(list).to_dict()
    assert sorted(set(met.q)) == list(range(0, 2000, 20))
    raw = dict(nodes.select("id", "q").collect())
    q8 = nndescent._matrix(np.array([np.frombuffer(raw[i], dtype=np.int8) for i in range(2000)]))
    for q, g in met.groupby("q"):
        assert len(g) == 100 and g.u.is_unique and q not in set(g.u)
        sims = q8 @ q8[q]
        np.testing.assert_allclose(g.sim, sims[g.u], atol=1e-5)
        beyond = {u for v in g.u for u in to[v]} - set(g.u) - {q}
        assert max(sims[list(beyond)], default=-9) <= g.sim.min() + 1e-5
        assert len(set(np.argsort(-sims)[1:21]) & set(g.u)) >= 18


def test_warc(spark):
    rows = [(1, "u1", "x" * 2000), (2, "u 2", "x" * 2000), (2, "u 2", "x" * 2000), (None, "u", "x" * 2000), (3, None, None),
            (4, "a", "é" * 499), (5, "b", "é" * 499), (6, "", "é" * 500), (7, "c", "é" * 500), (None, None, "z" * 1500)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = warc.read_warc(warc.write_warc(df, file_bytes=400), with_payload=True).collect()
    kinds = sorted((str(r["page_id"]), r["payload_bytes"], r["record_type"], r["refers_to"]) for r in got)
    assert kinds == sorted([("1", 2000, "revisit", 2), ("2", 2000, "response", None), ("2", 2000, "revisit", 2), ("None", 2000, "revisit", 2),
                            ("3", 0, "response", None), ("4", 998, "response", None), ("5", 998, "response", None),
                            ("6", 1000, "revisit", 7), ("7", 1000, "response", None), ("None", 1500, "response", None)])
    for r in got:
        if r["record_type"] == "response":
            assert hashlib.sha1(r["payload"]).hexdigest() == r["payload_digest"]
    assert warc.read_warc(warc.write_warc(df.limit(0))).count() == 0


def test_warc_members_across_any_chunks():
    import zlib as z

    recs = [warc._record("response", f"u{i}", "x", "2024-01-01T00:00:00Z", hashlib.sha1(b"a" * i).hexdigest(), b"h\r\n\r\n" + bytes([65 + i % 20]) * (i * i * 50), [])
            for i in range(60)]
    data = b"".join(recs)
    for size in (1, 7, 1000, 1 << 17, len(data)):
        if size < 7 and len(data) > 200_000:
            continue
        got = list(warc.parse_records(data[a : a + size] for a in range(0, len(data), size)))
        assert [b for _, b in got] == [z.decompress(r, 31).partition(b"\r\n\r\n")[2][:-4] for r in recs]
    with pytest.raises(ValueError):
        list(warc.parse_records([data[:-3]]))


def test_warc_keeps_the_largest_id_apart_from_missing_ones(spark):
    top = (1 << 63) - 1
    df = spark.createDataFrame([(top, "u", "x" * 2000), (None, "v", "x" * 2000), (5, "w", "x" * 2000)], "page_id long, url string, html string")
    got = warc.read_warc(warc.write_warc(df)).collect()
    assert sorted((str(r["page_id"]), r["record_type"], r["refers_to"]) for r in got) == sorted(
        [(str(top), "response", None), ("None", "revisit", top), ("5", "revisit", top)])


def test_pipeline_matches_brute_force(spark, docs, tmp_path):
    import corpus_pipeline as cp

    path = f"{tmp_path}/documents.parquet"
    docs.drop("score", "_keep").write.parquet(path)
    now = spark.read.parquet(path)
    sizes = []
    for name, stage in cp.STAGES:
        before = now
        now = stage(spark, now, str(tmp_path))
        if name != "packing":
            assert now.columns == before.columns
            sizes.append({(r["doc_id"], r["text"]) for r in now.collect()})
            assert sizes[-1] <= {(r["doc_id"], r["text"]) for r in before.collect()}
    assert not any(t is None or not any(c.isalpha() for c in t) for _, t in sizes[0])
    last = {}
    for i, t in sizes[0]:
        last[t] = max((x for x in (last.get(t), i) if x is not None), default=None)
    assert sizes[1] == {(i, t) for t, i in last.items()}
    fps = {(i, t): fingerprint(t) for i, t in sizes[1]}
    comp = components(set(fps.values()))
    best = {}
    for (i, t), f in fps.items():
        if i is not None:
            best[comp[f]] = min(best.get(comp[f], i), i)
    assert sizes[2] == {(i, t) for (i, t), f in fps.items() if i == best.get(comp[f])}
    total = dict(token_ids(0))
    pieces = now.collect()
    have = {}
    for r in pieces:
        have[r["doc_id"]] = have.get(r["doc_id"], 0) + r["length"]
    assert have == {i: len(total[i]) for i, _ in sizes[3]}
    assert cp.run(spark, str(tmp_path)).count() == len(pieces)
