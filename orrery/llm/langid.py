"""Language identification as multilingual mixture inference.

Training counts byte n-grams (1 to 3, within runs of letters, folded to lower
case) of labelled texts for each language, in a fixed number of hashed cells.
A document's n-grams are then explained as a mixture of the languages'
distributions: expectation-maximisation gives the proportions, and the set of
languages is the one of best penalised likelihood, found by dropping the
weakest language while the penalty saved exceeds the likelihood lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.llm.common import aside, back, batches, mapped, text_bytes

CELLS = 1 << 15
MAX_LANGUAGES = 512
UNKNOWN = "und"
ROUNDS = 40
# letters in the first 256 code points lower-cased as bytes: A-Z, and the second byte of U+00C0-U+00DE after 0xC3
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 0x20
_LETTER = np.zeros(256, bool)
_LETTER[0x61:0x7B] = True
_LETTER[0x80:] = True  # parts of longer characters


def grams(text: bytes) -> np.ndarray:
    """Hashed cells (below CELLS) of all n-grams of a text; other bytes than
    those of letters count as one blank, runs of them once."""
    b = _FOLD[np.frombuffer(text, np.uint8)]
    after = np.r_[False, b[:-1] == 0xC3]
    b = np.where(after & (b >= 0x80) & (b <= 0x9E) & (b != 0x97), b + 0x20, b)
    letter = _LETTER[b]
    keep = letter | np.r_[True, letter[:-1]]
    c = np.where(letter, b, 0x20)[keep].astype(np.uint32)
    c = np.r_[np.uint32(0x20), c, np.uint32(0x20)]
    two = c[:-1] | (c[1:] << 8)
    three = two[:-1] | (c[2:] << 16)
    out = []
    for n, g in enumerate((c, two | (1 << 28), three | (2 << 28))):
        h = (g.astype(np.uint64) + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        out.append((h >> np.uint64(49)).astype(np.int32))
    return np.concatenate(out)


def cell_counts(docs: DataFrame, label_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, cell, n): n-gram counts of all rows with a label. Each task adds
    up what it has read before anything is shuffled."""
    src = docs.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(label_col).alias("lang"), F.col(text_col).alias("text"))
    schema = T.StructType([src.schema["lang"]]).add("cell", "integer").add("n", "long")

    def run(it):
        sums: dict[str, np.ndarray] = {}
        for b in batches(it, 8 << 20, "text"):
            for lang, t in zip(b.column(0).to_pylist(), text_bytes(b.column(1))):
                if lang not in sums:
                    sums[lang] = np.zeros(CELLS, np.int64)
                sums[lang] += np.bincount(grams(t), minlength=CELLS)
        for lang, v in sums.items():
            at = np.flatnonzero(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(v[at])],
                names=["lang", "cell", "n"])

    return src.transform(mapped, run, schema).groupBy("lang", "cell").agg(F.sum("n").alias("n"))


class Model:
    """Language names and log-free probabilities p[language, cell]."""

    def __init__(self, langs: list[str], counts: np.ndarray, smooth: float = 0.5):
        self.langs = langs
        p = counts + smooth
        self.p = (p / p.sum(axis=1, keepdims=True)).astype(np.float64)

    def mixture(self, text: bytes, penalty: float = 1.0) -> tuple[list[int], np.ndarray]:
        """Chosen languages and their proportions. The penalty is ``penalty``
        * log(number of n-grams) / 2 for each language in the set, and at least
        a hundredth of the n-grams: a few borrowed words are no language."""
        cells, n = np.unique(grams(text), return_counts=True)
        total = n.sum()
        p = self.p[:, cells]
        price = max(penalty * np.log(max(total, 2)) / 2, 0.01 * total)
        chosen = list(range(len(self.langs)))
        share, like = _em(p, n, total)
        while len(chosen) > 1:
            weak = int(np.argmin(share))
            rest = [k for k in range(len(chosen)) if k != weak]
            share2, like2 = _em(p[rest], n, total, share[rest])
            if like - like2 > price:
                break
            chosen, p, share, like = [chosen[k] for k in rest], p[rest], share2, like2
        return chosen, share


def _em(p: np.ndarray, n: np.ndarray, total: int, start: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Proportions of the mixture of the rows of ``p`` and its log likelihood."""
    k = len(p)
    if k == 1:
        return np.ones(1), float(n @ np.log(p[0]))
    share = np.full(k, 1 / k) if start is None else (start + 1e-3) / (start + 1e-3).sum()
    for _ in range(ROUNDS):
        mix = share @ p
        new = share * (p @ (n / mix)) / total
        done = np.abs(new - share).max() < 1e-3
        share = new
        if done:
            break
    return share, float(n @ np.log(share @ p))


def train(docs: DataFrame, label_col: str = "lang", text_col: str = "text") -> Model:
    """Learn from every row with a label and a text. What reaches the driver is
    at most MAX_LANGUAGES x CELLS counts; more languages raise. No labelled
    row: a model without languages, which answers UNKNOWN."""
    counts = cell_counts(docs, label_col, text_col)
    rows = counts.groupBy("lang").agg(F.collect_list(F.struct("cell", "n")).alias("v")).orderBy("lang").limit(
        MAX_LANGUAGES + 1).collect()
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    table = np.zeros((len(rows), CELLS))
    for k, r in enumerate(rows):
        table[k, [c.cell for c in r.v]] = [c.n for c in r.v]
    return Model([r.lang for r in rows], table)


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred (language of the largest proportion), score
    (that proportion, 0 to 1) and mixture (array of struct<lang, share>, the
    chosen set).

    A text that is null or has no letter, or a model without languages, gives
    ``und``, score 0 and an empty mixture. Other columns stay; existing columns
    of these names are replaced. Only the text is looked at."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    src = docs.drop("lang_pred", "score", "mixture")
    at = src.columns.index(text_col)
    share_type = T.ArrayType(T.StructType().add("lang", "string").add("share", "double"))
    schema = T.StructType([*src.schema.fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()), T.StructField("mixture", share_type)])
    arrow_share = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))

    def run(it):
        m = shared.value
        for b in batches(it, 8 << 20, text_col):
            lang, score, mix = [], [], []
            for t in b.column(at).to_pylist():
                if not m.langs or not t or not any(map(str.isalpha, t)):
                    lang.append(UNKNOWN)
                    score.append(0.0)
                    mix.append([])
                    continue
                chosen, share = m.mixture(t.encode())
                best = int(np.argmax(share))
                lang.append(m.langs[chosen[best]])
                score.append(float(min(share[best], 1.0)))
                mix.append([{"lang": m.langs[c], "share": float(s)} for c, s in zip(chosen, share)])
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(lang, pa.string()), pa.array(score), pa.array(mix, arrow_share)],
                names=[*b.schema.names, "lang_pred", "score", "mixture"])

    return src.transform(mapped, run, schema)


def keep_known(docs: DataFrame, model: Model, text_col: str = "text", least: float = 0.0) -> DataFrame:
    """Rows of ``docs`` whose text has a language, of which the largest has at
    least the share ``least``: by default a text goes only if it has none (null,
    or no letter). The columns are those of ``docs``, whatever their names."""
    hidden, names = aside(docs, ("lang_pred", "score", "mixture"))
    got = predict(hidden, model, names.get(text_col, text_col))
    return back(got.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)), docs, names)
