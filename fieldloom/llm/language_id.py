"""Language identification by error-correcting output codes (operator 7).

Each language has a codeword. For each of its bits a logistic classifier over hashed character n-grams (one to
three characters, lower case, all non-letters as blanks) predicts the bit from a whole text. Decoding adds up, for
each language, the logistic losses between its codeword and the predicted margins, weighted by how well each bit
did in training, and chooses the nearest codeword; a small lead over the second flags the text as ambiguous.

The classifiers are fitted on a sample of at most ``PER_LANGUAGE`` distinct texts of each language (fewer where there
are many languages): those of the smallest hashes, so that the same ones are drawn in every run. Of copies of a text
one counts, so a large group of them neither swells the sample nor crowds out others, and no language goes unlearned.
"""

from __future__ import annotations

import itertools
import math
import pickle

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldloom.llm.common import Shared, map_texts, slices, small_batches
from fieldloom.llm.token_counts import DIGIT, LETTER, class_table

DIM = 4096
PER_LANGUAGE, SAMPLE_ROWS = 300, 3000
LONG_CODE = 31
STEPS, RATE, RIDGE = 100, 4.0, 1e-4
#: A text whose best language leads the second by less than this share of the decoding weight is ambiguous.
LEAD = 0.01


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def letters(classes: np.ndarray) -> np.ndarray:
    return (classes >= LETTER) & (classes < DIGIT)


def vectors(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows (root of the share of each hashed n-gram) and whether each text has a letter."""
    low = [t.lower() for t in texts]
    code = np.frombuffer((" ".join(low) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.fromiter((len(t) + 1 for t in low), np.int64, len(low))
    doc = np.repeat(np.arange(len(low)), size)
    is_letter = letters(class_table()[code])
    has = np.bincount(doc[is_letter], minlength=len(low)) > 0
    c = np.where(is_letter, code, 32).astype(np.uint32)
    counts = np.zeros(len(low) * DIM)
    base, gram = doc * DIM, np.zeros(len(c), np.uint32)
    for n in range(1, 4):
        gram[n - 1 :] = gram[n - 1 :] * np.uint32(0x9E3779B1) + c[: len(c) - n + 1] * np.uint32(2 * n + 0x85EBCA6B) + np.uint32(n)
        mixed = (gram ^ (gram >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        keep = is_letter | np.roll(is_letter, 1) if n > 1 else is_letter
        counts += np.bincount(base[keep] + (mixed[keep] >> np.uint32(20)).astype(np.int64), minlength=len(counts))
    x = counts.reshape(len(low), DIM)
    total = x.sum(axis=1, keepdims=True)
    return np.sqrt(x / np.maximum(total, 1)).astype(np.float32), has


def codewords(k: int, seed: int = 11) -> np.ndarray:
    """[k, bits] of -1 and 1: all distinct splits of up to five languages, else spread-out random ones."""
    if k <= 1:
        return np.ones((k, 1))
    if k <= 5:
        rows = [(1, *s) for s in itertools.product((1, -1), repeat=k - 1) if -1 in s]
        return np.array(rows, float).T
    rng = np.random.default_rng(seed)
    best, far = None, -1.0
    for _ in range(200):
        m = rng.choice([-1.0, 1.0], (k, LONG_CODE))
        gaps = (LONG_CODE - m @ m.T) / 2 + LONG_CODE * np.eye(k)
        if abs(m.sum(axis=0)).max() < k and gaps.min() > far:
            best, far = m, gaps.min()
    return best if best is not None else m


class Model:
    def __init__(self, langs: list[str], x: np.ndarray, y: np.ndarray):
        self.langs, self.code = langs, codewords(len(langs))
        bits = self.code[y]
        share = np.bincount(y, minlength=len(langs))
        heft = (1.0 / share[y] / len(langs))[:, None]
        w, b = np.zeros((x.shape[1], bits.shape[1])), np.zeros(bits.shape[1])
        speed, speed_b = np.zeros_like(w), np.zeros_like(b)
        for _ in range(STEPS):
            g = -bits * heft / (1 + np.exp(np.clip(bits * (x @ w + b), -30, 30)))
            speed = 0.9 * speed - RATE * (x.T @ g + RIDGE * w)
            speed_b = 0.9 * speed_b - RATE * g.sum(axis=0)
            w, b = w + speed, b + speed_b
        self.w, self.b = w.astype(np.float32), b.astype(np.float32)
        right = ((np.sign(x @ w + b) == bits) * heft).sum(axis=0)
        self.bit = np.maximum(right - 0.5, 1e-3)
        self.bit /= self.bit.sum()

    def margins(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """What each bit's classifier says of each text, and whether the text has a letter."""
        x, has = vectors(texts)
        return np.clip(x @ self.w + self.b, -8, 8), has

    def predict(self, texts: list[str]) -> tuple[list[str], list[float], list[bool]]:
        """The language (of equally near ones the first), its share of the decoding weight, and whether the text is ambiguous."""
        f, has = self.margins(texts)
        loss = np.stack([(np.logaddexp(0, -self.code[k] * f) * self.bit).sum(axis=1) for k in range(len(self.langs))], axis=1)
        p = np.exp(-4 * (loss - loss.min(axis=1, keepdims=True)))
        p /= p.sum(axis=1, keepdims=True)
        best = p.argmax(axis=1)
        top = p.max(axis=1)
        lead = top - (np.partition(p, -2, axis=1)[:, -2] if p.shape[1] > 1 else 0.0)
        return (
            [self.langs[k] if h else "und" for k, h in zip(best.tolist(), has.tolist())],
            [float(s) if h else 0.0 for s, h in zip(top.tolist(), has.tolist())],
            [not h or d < LEAD for d, h in zip(lead.tolist(), has.tolist())],
        )


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """A model of the rows that are not held out; None if there are none to learn from."""
    rows = df.filter(~held_out(F.col(id_col)) & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    rows = rows.select(F.col(lang_col).alias("l"), F.col(text_col).alias("t"), F.xxhash64(F.lit("sample"), F.col(text_col)).alias("h"))
    langs = sorted(r["l"] for r in rows.select("l").distinct().collect())
    if not langs:
        return None
    each = max(30, min(PER_LANGUAGE, SAMPLE_ROWS // len(langs)))
    # In two rounds, so that no task gets the hashes of every other one: each hands on its first ``each`` of a language, first
    # within a group of tasks, then from all groups. The smallest of all are among them however rows are grouped.
    groups = math.isqrt(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    drawn = rows.select("l", "h").distinct().withColumn("g", F.pmod(F.spark_partition_id(), F.lit(max(1, groups))))
    for keys in (["l", "g"], ["l"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy("h"))
        drawn = drawn.withColumn("place", place).filter(F.col("place") <= each).drop("place")
    drawn = F.broadcast(drawn.select(F.col("l").alias("d_l"), F.col("h").alias("d_h")))  # the sample's size
    number = F.create_map(*[F.lit(v) for k, lang in enumerate(langs) for v in (lang, k)])[F.col("l")]
    picked = rows.join(drawn, (F.col("l") == F.col("d_l")) & (F.col("h") == F.col("d_h")), "left_semi").select(number.alias("k"), "t", "h")
    picked = picked.dropDuplicates(["k", "h"])  # one of the copies

    def kernel(texts: list[str]) -> list[list]:
        return [[v.tobytes() for v in vectors(texts)[0].astype(np.float16)]]

    got = sorted((r["k"], bytes(r["x"])) for r in map_texts(picked, "k", "t", "k long, x binary", kernel).collect())
    x = np.stack([np.frombuffer(b, np.float16).astype(np.float32) for _, b in got])
    return Model(langs, x, np.array([k for k, _ in got]))


def predictor(df: DataFrame, model: Model | None):
    """A kernel for lists of texts: language, score, ambiguous. Without a model every text is ``und``."""
    blob = Shared(df.sparkSession, pickle.dumps(model))

    def kernel(texts: list[str]) -> list[list]:
        m = blob.get(pickle.loads)
        if m is None:
            return [["und"] * len(texts), [0.0] * len(texts), [True] * len(texts)]
        out: list[list] = [[], [], []]
        for i in range(0, len(texts), 256):
            for col, new in zip(out, m.predict(texts[i : i + 256])):
                col += new
        return out

    return kernel


def identify(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id, held_out, lang_pred, score, ambiguous) of every whole text.

    Null ids are not held out; repeated rows stay. Null texts and those without a letter are ``und``, score 0 and are
    ambiguous, as is every text of a table without a labelled one; an empty table gives no rows. A very long text is
    read whole. Of the other columns, whatever their names, none is read.
    """
    kernel = predictor(df, fit(df, id_col, text_col, lang_col))
    out = map_texts(df, id_col, text_col, f"{id_col} long, lang_pred string, score double, ambiguous boolean", kernel)
    return out.select(id_col, held_out(F.col(id_col)).alias("held_out"), "lang_pred", "score", "ambiguous")


def keep_identified(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows whose language is found, unchanged: texts without a letter and ambiguous ones go."""
    kernel = predictor(df, fit(df, id_col, text_col, lang_col))
    small_batches(df.sparkSession)

    @F.pandas_udf("boolean")
    def sure(texts: pd.Series) -> pd.Series:
        ts, out = [t or "" for t in texts], []
        for i, j in slices(ts):
            out += [not x for x in kernel(ts[i:j])[2]]
        return pd.Series(out, dtype=bool)

    return df.filter(sure(F.col(f"`{text_col}`")))
