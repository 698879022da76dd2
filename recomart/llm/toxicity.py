"""Toxicity by a classifier chain.

Categories are predicted one after another; each later linear model reads the
probabilities of the earlier categories beside the words. In training those
probabilities are out-of-fold: the earlier model that rates a document has not
seen it, so later models do not trust the earlier ones more than they may when
scoring. The last link predicts the given ``toxic`` label and decides.

Labels exist for toxicity as a whole only. The earlier links' labels are weak:
a labelled toxic document belongs to a category if it holds one of the
category's seed words (``CATEGORIES``; toxic documents in other languages have
none and belong to "other"). Seeds make labels only; what a link reads are the
presence of the ``FEATURES`` words, word beginnings and repeated word beginnings that tell toxic from other
documents best (by chi-square over the labelled rows, among those with a higher rate in
toxic rows), found in the data, and the earlier links' probabilities.

Training uses ``MAX_ROWS`` labelled documents in expectation, picked by a hash, toxic and other ones
apart so that rare toxic labels are not lost (at most half of them toxic); each counts as often as it was
to be picked, which keeps the share of toxic documents. That bound is the only sampling. Scoring
reads every text whole.

Defined results: a NULL or empty text scores like one without any feature word;
rows without a label, with a NULL label or NULL id are scored but not learned
from; a document labelled twice counts with each label, equal rows count once in training; very long texts are
read whole and kept as their distinct words; without any toxic and
any other label all probabilities are 0 and nothing is rejected. Columns of the input that are named
like an added one are replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

#: Seed words of the weak category labels.
CATEGORIES = {
    "insult": ("idiot", "moron", "stupid", "clown", "dumb", "fool", "imbecile"),
    "contempt": ("loser", "pathetic", "worthless", "useless", "failure"),
    "dehumanising": ("scum", "trash", "disgusting", "filth", "vermin", "garbage"),
}
MAX_ROWS = 8_000
FEATURES = 256
BEGINNINGS = (4, 5, 6, 7)  # bytes
FOLDS = 5
THRESHOLD = 0.5
SLICE_ROWS = 512     # texts whose features are held at a time
_TOKEN = re.compile(rb"[a-z\x80-\xff]+")


def words(text: bytes | None) -> set:
    """Distinct lower-case words: runs of ASCII letters and non-ASCII bytes."""
    return set(_TOKEN.findall((text or b"").lower()))


def grams(found: set) -> set:
    """The words, their first 4 to 7 bytes marked by ``^``, and by ``^^`` if different words begin so."""
    out = set(found)
    for n in BEGINNINGS:
        many = Counter(w[:n] for w in found if len(w) >= n)
        out.update(b"^" + p for p in many)
        out.update(b"^^" + p for p, k in many.items() if k > 1)
    return out


@dataclass
class Chain:
    """Trained links over ``vocab``; weights[k] has a column per word, per earlier link and a bias."""

    vocab: dict
    names: list
    weights: list

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probabilities (rows, links); later links read the earlier columns."""
        p = np.zeros((len(x), len(self.weights)))
        for k, w in enumerate(self.weights):
            p[:, k] = sigmoid(np.hstack([x, p[:, :k]]) @ w[:-1] + w[-1])
        return p

    def features(self, texts: list) -> np.ndarray:
        x = np.zeros((len(texts), len(self.vocab)))
        for i, t in enumerate(texts):
            for w in grams(words(t)) & self.vocab.keys():
                x[i, self.vocab[w]] = 1.0
        return x


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def fit_logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, ridge: float = 0.1, rounds: int = 15) -> np.ndarray:
    """Newton steps for logistic regression of rows that count ``n`` times, with an L2 penalty on all but the bias."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    w[-1] = np.log((n @ y + 0.5) / (n @ (1 - y) + 0.5))
    pen = np.full(a.shape[1], ridge)
    pen[-1] = 1e-6
    for _ in range(rounds):
        p = sigmoid(a @ w)
        grad = a.T @ (n * (p - y)) + pen * w
        step = np.linalg.solve((a * (n * p * (1 - p))[:, None]).T @ a + np.diag(pen), grad)
        w -= step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-3:
            break
    return w


def fit_chain(x: np.ndarray, labels: np.ndarray, vocab: dict, names: list, folds: np.ndarray,
              weights: np.ndarray | None = None) -> Chain:
    """One link per column of ``labels``; ``folds`` gives each row's fold for the out-of-fold inputs, ``weights``
    how often it counts."""
    # rows with the same features, labels and fold are solved as one
    packed = np.packbits(np.hstack([x, labels]).astype(bool), axis=1)
    _, first, same = np.unique(np.hstack([packed, folds[:, None]]), axis=0, return_index=True, return_inverse=True)
    n = np.bincount(same.reshape(-1), weights=weights)
    x, labels, folds = x[first], labels[first], folds[first]
    out_of_fold = np.zeros(labels.shape)
    links = []
    for k in range(labels.shape[1]):
        inputs = np.hstack([x, out_of_fold[:, :k]])
        links.append(fit_logistic(inputs, labels[:, k], n))
        if k + 1 == labels.shape[1]:
            break  # nothing reads the last link
        for f in np.unique(folds):
            mine = folds == f
            if mine.all():
                continue
            w = fit_logistic(inputs[~mine], labels[~mine, k], n[~mine])
            out_of_fold[mine, k] = sigmoid(inputs[mine] @ w[:-1] + w[-1])
    return Chain(vocab, names, links)


def select_words(texts: list, toxic: np.ndarray, count: int = FEATURES) -> dict:
    """Grams with a higher rate in toxic texts, strongest chi-square first, ties by gram; equal texts count once."""
    rows = sorted(set(zip(texts, toxic.tolist())))
    n1 = sum(y for _, y in rows)
    n0 = len(rows) - n1
    seen = [Counter(), Counter()]
    for t, y in rows:
        seen[y].update(grams(words(t)))
    score = {}
    for w, c1 in seen[1].items():
        c0 = seen[0][w]
        if c1 < 3 or c1 * n0 <= c0 * n1:
            continue
        expect1 = (c0 + c1) * n1 / (n0 + n1)
        expect0 = (c0 + c1) * n0 / (n0 + n1)
        score[w] = (c1 - expect1) ** 2 * (1 / expect1 + 1 / expect0)
    best = sorted(score, key=lambda w: (-score[w], w))[:count]
    return {w: i for i, w in enumerate(best)}


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", max_rows: int = MAX_ROWS) -> Chain:
    """Chain fitted on about ``max_rows`` labelled documents, whose distinct words are collected to the driver."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), (F.col(label_col) != 0).alias("y")).distinct()
    # the bounded sample is chosen on the narrow table, by hash, so that what is collected does not depend on
    # the number of partitions; only its texts are then looked up
    n1, n0 = known.agg(F.count_if("y"), F.count_if(~F.col("y"))).first()
    most = min(n1, max_rows // 2)
    shares = {True: min(1.0, most / max(n1, 1)), False: min(1.0, (max_rows - most) / max(n0, 1))}
    share = F.when(F.col("y"), F.lit(int((1 << 53) * shares[True]))).otherwise(F.lit(int((1 << 53) * shares[False])))
    picked = known.where(F.shiftrightunsigned(F.xxhash64("id", "y"), 11) < share)
    sent = F.broadcast(picked)  # max_rows in expectation
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(sent, "id")
    # an id may occur in many rows of different texts: then a hash of the text picks among them
    found = docs.select(F.col(id_col).alias("id")).join(sent, "id").count()
    rows = rows.where(F.shiftrightunsigned(F.xxhash64("text", F.lit(1)), 11) < F.lit(int((1 << 53) * min(1.0, 2 * max_rows / max(found, 1)))))

    def run(batches):
        for b in batches:
            sets = [b" ".join(sorted(words(t))) for t in C.as_bytes(b.column("text"))]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("y"), pa.array(sets, pa.binary())],
                                             ["id", "y", "words"])

    kind = rows.schema["id"].dataType.simpleString()
    got = C.map_arrow(rows.select("id", "y", "text"), run, f"id {kind}, y boolean, words binary").distinct().toArrow()
    both = sorted(zip(got["id"].to_pylist(), got["y"].to_pylist(), got["words"].to_pylist()))
    texts, toxic = [w for _, _, w in both], np.array([y for _, y, _ in both], dtype=bool)
    names = [*CATEGORIES, "other", "toxic"]
    if not len(toxic) or toxic.all() or not toxic.any():
        return Chain({}, names, [np.array([0.0] * k + [-40.0]) for k in range(len(names))])
    vocab = select_words(texts, toxic)
    chain = Chain(vocab, names, [])
    x = chain.features(texts)
    y = np.zeros((len(texts), len(names)))
    for k, seeds in enumerate(CATEGORIES.values()):
        pattern = {s.encode() for s in seeds}
        y[:, k] = [bool(t and words(tx) & pattern) for t, tx in zip(toxic, texts)]
    y[:, -2] = toxic & ~y[:, :-2].any(axis=1)
    y[:, -1] = toxic
    return fit_chain(x, y, vocab, names, np.arange(len(texts)) % FOLDS, 1.0 / np.where(toxic, shares[True], shares[False]))


def score(docs: DataFrame, chain: Chain, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` plus p_<category> per link (p_toxic last) and boolean ``toxic``; nothing is shuffled."""
    added = [f"p_{n}" for n in chain.names]
    base = docs.drop(*added, "toxic")
    schema = base.select("*", *[F.lit(0.0).alias(a) for a in added], F.lit(False).alias("toxic")).schema
    names = schema.names
    model = docs.sparkSession.sparkContext.broadcast(chain)  # at most FEATURES words and len(CATEGORIES) + 1 links

    def run(batches):
        c = model.value
        for b in (batch.slice(k, SLICE_ROWS) for batch in batches for k in range(0, batch.num_rows, SLICE_ROWS)):
            p = c.predict(c.features(C.as_bytes(b.column(text_col))))
            yield pa.RecordBatch.from_arrays(
                [*b.columns, *[pa.array(p[:, k]) for k in range(p.shape[1])], pa.array(p[:, -1] >= threshold)],
                names)

    return C.map_arrow(base, run, schema)


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents that the chain rejects."""
    chain = train(docs, labels, id_col, text_col)
    return score(docs, chain, text_col, threshold).where("NOT toxic").select(*docs.columns)
