"""Language identification with error-correcting output codes.

Every language has a codeword; each bit of it is predicted by a binary linear
classifier over hashed byte 3-grams of the lower-cased text. Codewords are
exhaustive for few languages and chosen for distance for many, so that some wrong
bits do not change the nearest codeword. Decoding is loss-weighted: a language's loss
is the sum over bits of the squared hinge loss of the bit's margin, times the
bit's weight, which is its log-odds of being right on rows left out of its training.
The language of least loss wins; ``ambiguous`` marks texts whose two best losses
are close.

Training reads about ``MAX_ROWS`` texts in expectation, spread evenly over the
languages by a hash of id and text, but about 8 a language (all of a language's rows if it
has fewer) as long as that makes no more than ``MOST_ROWS``, and at least that row of every language with the smallest
hash, so no language is lost; that sample is the only bound. A text's n-gram counts
are made on the executors; the driver gets the counts that are not zero of every sampled text, and solves a system of
as many equations as there are rows.

Defined results: ``und`` with score 0 for a NULL text or one without a letter,
and for every text if nothing was learned; with one learned language all others
get it with score 1; ties go to the language that comes first by code point;
NULL ids count as training rows if they have a language; repeated rows get equal results and enter the
sample together or not at all; a text of any length is hashed whole, a piece at a time; an empty table gives no rows.
Columns of the input named like an added one are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C
from .bpe import slices

DIM = 1 << 13
MAX_ROWS = 1200
MOST_ROWS = 4096     # sampled rows beyond which languages get fewer than 8
BROADCAST_LANGS = 10_000  # languages up to this number are broadcast (some 50 bytes each), more are joined by shuffle
RIDGE = 0.05
PIECE = 1 << 20      # bytes of a text that are hashed at a time
ROWS = 256           # texts whose counts are held at a time
CLOSE = 0.5          # difference of losses below which a text is ambiguous
UNKNOWN = "und"
# ASCII bytes that are not letters count as a space
_FOLD = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def gram_counts(text: str) -> np.ndarray:
    """Counts of the text's hashed byte 3-grams, with a space at either end."""
    raw = b" " + text.lower().encode("utf-8", "replace").translate(_FOLD) + b" "
    counts = np.zeros(DIM, dtype=np.int64)
    for k in range(0, len(raw) - 2, PIECE):
        b = np.frombuffer(raw[k:k + PIECE + 2], dtype=np.uint8).astype(np.uint32)
        h = (b[:-2] * np.uint32(0x9E3779B1)) ^ (b[1:-1] * np.uint32(0x85EBCA77)) ^ (b[2:] * np.uint32(0xC2B2AE3D))
        counts += np.bincount(h >> np.uint32(19), minlength=DIM)
    return counts


def features(counts: np.ndarray) -> np.ndarray:
    """Square roots of relative frequencies: rows of length 1."""
    total = np.maximum(counts.sum(axis=1, keepdims=True), 1)
    return np.sqrt(counts.astype(np.float32) / total.astype(np.float32))


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """(n, bits) matrix of -1 and 1; all rows differ and no column is constant or the complement of another."""
    if n < 2:
        return np.zeros((n, 0))
    if n <= 6:  # exhaustive: every split of the languages once
        cols = [c for c in product((1.0, -1.0), repeat=n) if c[0] == 1.0 and -1.0 in c]
        return np.array(cols).T
    bits = 4 * int(np.ceil(np.log2(n))) + 11
    rng = np.random.default_rng(seed)
    best, far = None, -1
    for _ in range(max(4, min(200, 20_000 // n))):
        code = rng.choice([-1.0, 1.0], size=(n, bits))
        least = min(_least_apart(code, k) for k in range(0, n, 512))
        if least > far and (np.abs(code.sum(axis=0)) < n).all():
            best, far = code, least
    return best


def _least_apart(code: np.ndarray, k: int) -> float:
    """Least distance of 512 codewords from row ``k`` on to any other."""
    apart = (code.shape[1] - code[k:k + 512] @ code.T) / 2
    apart[np.arange(len(apart)), k + np.arange(len(apart))] = np.inf
    return float(apart.min())


@dataclass
class Model:
    """Learned languages, their codewords, weights (DIM, bits), biases and bit weights."""

    langs: list
    code: np.ndarray
    w: np.ndarray
    b: np.ndarray
    bit_weight: np.ndarray

    def losses(self, counts: np.ndarray) -> np.ndarray:
        margin = features(counts) @ self.w + self.b
        if_one, if_not = (np.maximum(0.0, 1.0 - margin) ** 2 * self.bit_weight, np.maximum(0.0, 1.0 + margin) ** 2 * self.bit_weight)
        # a codeword's bits are 1 or -1: its loss is the mean of both sums and its bits times half their difference
        return ((if_one + if_not).sum(axis=1, keepdims=True) + (if_one - if_not) @ self.code.T) / 2

    def predict(self, texts: list) -> tuple[list, np.ndarray, np.ndarray]:
        """(languages, scores, ambiguous) of the texts."""
        known = [i for i, t in enumerate(texts) if t and has_letter(t)] if self.langs else []
        lang = [UNKNOWN] * len(texts)
        score, close = np.zeros(len(texts)), np.zeros(len(texts), dtype=bool)
        for k in range(0, len(known), ROWS):
            part = known[k:k + ROWS]
            loss = self.losses(np.stack([gram_counts(texts[i]) for i in part]))
            best = loss.argmin(axis=1)
            share = np.exp(loss.min(axis=1, keepdims=True) - loss)
            two = np.partition(loss, min(1, loss.shape[1] - 1), axis=1)[:, :2]
            for r, i in enumerate(part):
                lang[i] = self.langs[best[r]]
                score[i] = 1.0 / share[r].sum()
                close[i] = len(self.langs) > 1 and two[r, 1] - two[r, 0] < CLOSE
        return lang, score, close


def fit(x: np.ndarray, lang: list) -> Model:
    """Ridge classifiers of the rows of features ``x`` (which is overwritten) for all bits at once; bit weights from a
    split into two halves."""
    langs = sorted(set(lang))
    code = codewords(len(langs))
    if len(langs) < 2:
        return Model(langs, code, np.zeros((DIM, 0), np.float32), np.zeros(0), np.zeros(0))
    place = {v: i for i, v in enumerate(langs)}
    y = code[[place[v] for v in lang]]

    def solve(a, t):
        mean, off = a.mean(axis=0), t.mean(axis=0)
        a -= mean
        gram = a @ a.T
        gram = gram.astype(np.float64) if len(a) <= MOST_ROWS else gram
        gram[np.diag_indices(len(a))] += RIDGE
        w = a.T @ np.linalg.solve(gram, (t - off).astype(gram.dtype))
        return w, off - mean @ w

    half = np.arange(len(x)) % 2 == 0
    right = np.zeros(y.shape[1])
    for rows in (half, ~half) if len(x) >= 4 else ():
        w, b = solve(x[rows], y[rows])
        right += ((x[~rows] @ w + b) * y[~rows] > 0).sum(axis=0)
    share = (right + 1) / (len(x) + 2)
    w, b = solve(x, y)  # the features are not needed any more
    return Model(langs, code, w.astype(np.float32), b, np.maximum(np.log(share / (1 - share)), 0.1))


def train(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          max_rows: int = MAX_ROWS) -> Model:
    """Model of the languages of the rows of ``docs`` for which ``learn`` holds."""
    rows = docs.where(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    place = F.shiftrightunsigned(F.xxhash64(id_col, text_col), 11) / F.lit(float(1 << 53))
    counts = rows.groupBy(F.col(lang_col).alias("__lang")).agg(F.count(F.lit(1)).alias("__n"), F.min(place).alias("__first"))
    langs = counts.count()
    if not langs:
        return fit(np.zeros((0, DIM), np.float32), [])
    each = max(max_rows / langs, min(8.0, MOST_ROWS / langs))
    counts = F.broadcast(counts) if langs <= BROADCAST_LANGS else counts
    picked = rows.join(counts, F.col(lang_col) == F.col("__lang")).where(
        (place < F.lit(each) / F.col("__n")) | (place == F.col("__first")))

    def run(batches):
        for b in batches:
            found = [gram_counts(t) for t in b.column("text").to_pylist()]
            at = [np.flatnonzero(c).astype(np.uint16) for c in found]
            yield pa.RecordBatch.from_arrays(
                [b.column("lang"), pa.array([a.tobytes() for a in at], pa.binary()),
                 pa.array([c[a].astype(np.uint32).tobytes() for c, a in zip(found, at)], pa.binary())], ["lang", "at", "n"])

    texts = picked.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    got = C.map_arrow(texts, run, "lang string, at binary, n binary").toArrow()
    both = sorted(zip(*(got[c].to_pylist() for c in ("lang", "at", "n"))))  # the same order in every run
    del got
    x = np.zeros((len(both), DIM), np.float32)
    for row, (_, at, n) in zip(x, both):
        counted = np.zeros((1, DIM), np.int64)
        counted[0, np.frombuffer(at, np.uint16)] = np.frombuffer(n, np.uint32)
        row[:] = features(counted)[0]
    return fit(x, [v for v, _, _ in both])


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` without the text plus lang_pred, score and ambiguous; nothing is shuffled."""
    keep = [c for c in docs.columns if c not in (text_col, "lang_pred", "score", "ambiguous")]
    src = docs.select(*keep, F.col(text_col).alias("__text"))
    schema = docs.select(*keep, F.lit("").alias("lang_pred"), F.lit(0.0).alias("score"),
                         F.lit(False).alias("ambiguous")).schema
    names = schema.names
    shared = docs.sparkSession.sparkContext.broadcast(model)  # DIM x bits figures

    def run(batches):
        for batch in batches:
            for b in slices(batch, "__text"):
                lang, score, close = shared.value.predict(b.column("__text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*[b.column(c) for c in keep], pa.array(lang, pa.string()), pa.array(score), pa.array(close)], names)

    return C.map_arrow(src, run, schema)
