"""Language identification with error-correcting output codes.

Every language has a codeword of +1/-1 bits; one binary classifier per bit
predicts it from hashed byte n-grams of the lower-cased letters of the whole
text (square-root counts, unit length).  The classifiers are regularised least
squares, solved in closed form on a bounded sample of labelled rows.  Decoding
adds up, over the bits, the exponential loss of the predicted margin against
the codeword, weighted by the classifier's training accuracy; the codeword
with the least loss wins.  If the runner-up is within ``ambiguity`` of it, the
row is flagged.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.llm.common import prepare, whole_row

LETTER = re.compile(r"[^\W\d_]")
_KEEP = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))
_ODD = np.array([2654435761, 2246822519, 3266489917, 668265263], dtype=np.uint32)


def ngram_features(text: str, dims_log2: int, orders=(2, 3, 4), block: int = 1 << 20) -> np.ndarray:
    """Unit vector of square-root n-gram counts, plus a constant 1 at the end."""
    raw = b" " + b" ".join(text.lower().encode("utf-8", "replace").translate(_KEEP).split()) + b" "
    b = np.frombuffer(raw, dtype=np.uint8)
    counts = np.zeros(1 << dims_log2)
    shift = np.uint32(32 - dims_log2)
    for a in range(0, len(b), block):
        c = b[a : a + block + max(orders) - 1].astype(np.uint32) + np.uint32(1)
        for n in orders:
            m = min(block, len(c) - n + 1)
            if m > 0:
                h = c[:m] * _ODD[0]
                for k in range(1, n):
                    h = (h ^ (h >> np.uint32(15))) * _ODD[k] + c[k : k + m]
                h = (h ^ (h >> np.uint32(13))) * _ODD[0]
                counts += np.bincount(h >> shift, minlength=len(counts))
    v = np.sqrt(counts)
    norm = np.sqrt((v * v).sum())
    return np.append(v / norm if norm else v, 1.0).astype(np.float32)


def codewords(k: int, seed: int = 7) -> np.ndarray:
    """k codewords of +1/-1: exhaustive for up to 7 languages, else random
    bits, the best of some draws by least distance of two codewords."""
    if k == 1:
        return np.ones((1, 1))
    if k <= 7:
        n = (1 << (k - 1)) - 1
        cols = [[1] + [1 if c >> r & 1 else -1 for r in range(k - 1)] for c in range(n)]
        return np.array(cols, dtype=np.float64).T
    bits = 15 * int(np.ceil(np.log2(k)))
    rng = np.random.default_rng(seed)
    draws = [np.where(rng.random((k, bits)) < 0.5, -1.0, 1.0) for _ in range(20)]
    return max(draws, key=lambda m: -(m @ m.T - bits * np.eye(k) * 2).max())


@dataclass
class EcocModel:
    langs: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # features x bits
    trust: np.ndarray  # per bit
    dims_log2: int

    def losses(self, x: np.ndarray) -> np.ndarray:
        """Weighted decoding loss, rows x languages."""
        f = np.clip(x @ self.weights, -3, 3)
        return (self.trust * np.exp(-f[:, None, :] * self.code[None])).sum(axis=2)


def learnable(id_col: str = "doc_id", fold: int = 1, folds: int = 3):
    """Rows that may be learned from: crc32 of the id as text, modulo
    ``folds``, is not ``fold``.  Rows without id are never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds != fold, F.lit(False))


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
          rows_per_lang: int = 250, max_rows: int = 2000, max_langs: int = 1000, dims_log2: int = 12,
          ridge: float = 0.03) -> EcocModel | None:
    """Fit on a bounded sample: at most about ``rows_per_lang`` whole texts a
    language and ``max_rows`` in all, chosen by a hash of the id, of the
    ``max_langs`` languages with most rows (ties by name); rarer labels cannot
    be learned from so few rows.  Only fixed-size feature vectors reach
    the driver, however long the texts.  Rows repeating an id are drawn
    together.  None if nothing is labelled, as in an empty table.
    """
    prepare(docs)
    rows = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = rows.groupBy(F.col(lang_col).alias("_l")).agg(F.count(F.lit(1)).alias("_c"))
    found = {r["_l"]: r["_c"] for r in counts.orderBy(F.desc("_c"), "_l").limit(max_langs).collect()}
    if not found:
        return None
    langs = sorted(found)
    share = min(rows_per_lang, max(1, max_rows // len(langs)))
    draw = F.pmod(F.xxhash64(F.col(id_col), F.lit(11)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    frac = F.create_map(*[x for lang in langs for x in (F.lit(lang), F.lit(min(1.0, share / found[lang])))])
    sample = rows.filter(draw < F.coalesce(frac[F.col(lang_col)], F.lit(0.0))).select(
        F.col(lang_col).alias("_l"), F.col(text_col).alias("_t"), draw.alias("_d"))

    def vectors(batches):
        import pyarrow as pa

        for batch in batches:
            x = [ngram_features(t, dims_log2).tobytes() if LETTER.search(t) else None for t in batch.column("_t").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("_l"), batch.column("_d"), pa.array(x, pa.binary())], ["l", "d", "x"])

    got = (sample.mapInArrow(vectors, "l string, d double, x binary").filter("x is not null")
           .orderBy("d", "l", "x").limit(2 * max_rows).collect())
    if not got:
        return None
    at = {lang: i for i, lang in enumerate(langs)}
    label = np.array([at[r["l"]] for r in got])
    x = np.empty((len(got), (1 << dims_log2) + 1), dtype=np.float32)
    for i in range(len(got)):
        x[i] = np.frombuffer(got[i]["x"], dtype=np.float32)
        got[i] = None  # the driver holds every vector once
    code = codewords(len(langs))
    y = code[label]
    row_w = np.sqrt(len(label) / len(langs) / np.bincount(label, minlength=len(langs))[label]).astype(np.float32)[:, None]
    x *= row_w  # languages count alike
    alpha = np.linalg.solve((x @ x.T).astype(np.float64) + 0.1 * ridge * len(label) / len(langs) * np.eye(len(label)), y * row_w)
    w = x.T @ alpha.astype(np.float32)
    hit = ((x @ w > 0) == (y > 0)).mean(axis=0)
    return EcocModel(langs, code, w.astype(np.float32), hit / hit.sum(), dims_log2)


def predictor(spark, model: EcocModel | None, ambiguity: float = 0.05):
    """Pandas UDF text -> struct(lang_pred, score, ambiguous)."""
    shared = spark.sparkContext.broadcast(model)  # dims x bits weights: fixed size

    @F.pandas_udf("lang_pred string, score double, ambiguous boolean")
    def predict(texts):
        import pandas as pd

        from hourglass.llm import tokens

        tokens.release()
        m = shared.value
        out = []
        for a in range(0, len(texts), 128):
            part = list(texts.iloc[a : a + 128])
            ok = [m is not None and t is not None and bool(LETTER.search(t)) for t in part]
            rows = [("und", 0.0, False)] * len(part)
            if any(ok):
                x = np.stack([ngram_features(t, m.dims_log2) for t, k in zip(part, ok) if k])
                loss = m.losses(x)
                order = np.sort(loss, axis=1)
                p = np.exp(-8.0 * (loss - order[:, :1]))
                p /= p.sum(axis=1, keepdims=True)
                best = loss.argmin(axis=1)
                near = order[:, 1] - order[:, 0] < ambiguity if loss.shape[1] > 1 else np.zeros(len(best), bool)
                found = iter(zip(best, p.max(axis=1), near))
                for i, k in enumerate(ok):
                    if k:
                        b, s, q = next(found)
                        rows[i] = (m.langs[b], float(s), bool(q))
            out += rows
        return pd.DataFrame(out, columns=["lang_pred", "score", "ambiguous"])

    return predict


def identify(docs: DataFrame, model: EcocModel | None, text_col: str = "text", ambiguity: float = 0.05) -> DataFrame:
    """``docs`` plus ``lang_pred`` ("und" for null texts and texts without a
    letter, or if nothing could be learned), ``score`` (0 to 1: share of the
    winner in exp(-loss), 0 for und) and ``ambiguous``.  Columns of ``docs``
    with these names are replaced."""
    found = docs.select(whole_row(docs), predictor(prepare(docs), model, ambiguity)(F.col(text_col)).alias("_ecoc"))
    rest = [c for c in docs.columns if c not in ("lang_pred", "score", "ambiguous")]
    return found.select(*[F.col("_row")[c].alias(c) for c in rest], "_ecoc.lang_pred", "_ecoc.score", "_ecoc.ambiguous")


def recognised(docs: DataFrame, model: EcocModel | None, text_col: str = "text", ambiguity: float = 0.05) -> DataFrame:
    """Rows of ``docs``, columns unchanged, that are neither ``und`` nor
    ambiguous.  With nothing to learn from, no row can be recognised or
    rejected by its language: then only texts without letters go."""
    if model is None:
        return docs.filter(F.col(text_col).rlike(r"\p{L}"))
    found = docs.select(whole_row(docs), predictor(prepare(docs), model, ambiguity)(F.col(text_col)).alias("_ecoc"))
    return found.filter((F.col("_ecoc.lang_pred") != "und") & ~F.col("_ecoc.ambiguous")).select("_row.*")
