"""Alignment of two tokenizers' ids by merge-path partitioning of their token ends.

Both tokenizers' tokens cover the same bytes, a space and the text, so the byte
offsets at which tokens end are two rising sequences A and B, and the places where
both end cut the tokens into groups. The sequences of many documents are laid one
after the other. Their merge is divided at equally spaced diagonals: a binary search
on each diagonal tells how many ends of A and of B come before it (on ties A's comes
first), so every piece merges the same number of ends, whatever the documents'
lengths, without knowing the others. A piece emits the overlap that every A end closes:
the B token that covers that byte, and whether it ends there too. The last A end of a
piece may belong to the first B end of the next; such boundaries are stitched.

Tokenizing is done on chunks at whose borders neither tokenizer joins anything: in
front of a space or line feed that follows a visible character. Distinct chunks are
solved once per worker and remembered up to a bound. (A's splitting pattern has no
token with a visible character before white space. B is a byte-pair vocabulary in
which no piece has its space mark, or a line feed, behind something else; this is
checked when it is loaded.)

Counts. Two tokens that end together are suffixes of each other, so the number of
distinct linked id pairs is bounded by the vocabularies: at most the summed token
lengths, times the ids that share one byte string. That bound makes the table of corpus-wide counts small
enough to send to every task; counts are summed per task before the shuffle, and the
links themselves are never shuffled.

Defined results: texts that are NULL or empty, or whose joined A or B bytes differ
from space + text, have no tokens: zeros, an empty group list. Strings of special tokens in a text are
plain text. Repeated rows and NULL ids are rows like others, and repeats count as often
as they occur. Ties of the highest count are all best. Whole texts are used, in memory
proportional to a slice of rows or the longest text. Further columns play no part.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .bpe import PATTERN, byte_letters
from .chunks import Remembered, ragged, row_slices, together

#: Ends that one piece of a merge handles.
WORK = 1 << 15

#: Space or line feed, white space, then everything up to the next space or line feed that follows a visible
#: character (other white space stays inside).
CHUNK = re.compile(r"[ \n]\s*(?:\S+(?:[^\S \n]\s*\S+)*(?:[^\S \n]\s*\Z)?)?")


class Pair:
    """Both tokenizers, the bytes of their tokens, and the numbering of id pairs that can be linked."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        import tiktoken
        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        split = spec["pre_tokenizer"]
        if spec["normalizer"] or split["type"] != "ByteLevel" or split["add_prefix_space"] or not split["use_regex"]:
            raise ValueError("A must be a byte-level vocabulary without a normalizer or prefix space")
        letters, added = byte_letters(), {t["content"] for t in spec["added_tokens"]}
        ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in added}
        # tokens are numbered by age, so ids are ranks; special tokens are left out: their strings are plain text
        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a = [b""] * (1 + max(ranks.values()))
        for token, i in ranks.items():
            self.bytes_a[i] = token
        self.bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if re.search("[^▁]▁|\n", piece):
                raise ValueError(f"piece {piece!r} joins what the chunks cut apart")
            byte = re.fullmatch("<0x([0-9A-F]{2})>", piece)
            self.bytes_b.append(bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode())
        self.space_b = self.b.piece_to_id("▁")
        self.length_a = np.array([len(t) for t in self.bytes_a], np.int64)
        self.length_b = np.array([len(t) for t in self.bytes_b], np.int64)
        self.remember = Remembered(self._solve, tables=2)

    def _solve(self, chunks: list[str]):
        """Ids of the chunks by A and B, and whether both give the chunk's bytes back."""
        size = np.fromiter((len(c.encode()) for c in chunks), np.int64, len(chunks))
        text, ends = "".join(chunks), np.cumsum(size)
        # A: chunks that end in a visible character are split alike in one text, and told apart at their ends
        a = np.array(self.a.encode_ordinary(text), np.int32)
        at = np.cumsum(self.length_a[a])
        last = np.searchsorted(at, ends)
        parts = a, np.diff(np.r_[0, last + 1])
        if any(c[-1].isspace() for c in chunks) or not (at[last] == ends).all():
            parts = together([self.a.encode_ordinary(c) for c in chunks])
        # B puts a space mark in front: it stands for a chunk's own space, else it goes again
        b = self.b.encode([c[1:] if c[0] == " " else c for c in chunks], num_threads=1)
        b = together([[self.space_b] if c == " " else i if c[0] == " " else i[1:] if i[:1] == [self.space_b] else []
                      for i, c in zip(b, chunks)])
        both = (parts, self.bytes_a, self.length_a), (b, self.bytes_b, self.length_b)
        return [parts, b], np.logical_and(*(_same_bytes(*x, chunks, size, text) for x in both))

    def tokens(self, texts: list):
        """(ids, ids per text) of A and of B; texts without tokens have none."""
        split = [chunks_of(t) if t else [] for t in texts]
        many = np.fromiter(map(len, split), np.int64, len(split))
        doc = np.repeat(np.arange(len(texts)), many)
        e = self.remember.entries([c for s in split for c in s])
        bad = np.bincount(doc, weights=~self.remember.mark[e], minlength=len(texts)) > 0
        if bad.any():
            e, doc = e[~bad[doc]], doc[~bad[doc]]
        return [(self.remember.ids(e, k), np.bincount(doc, weights=self.remember.counts(e, k), minlength=len(texts))
                 .astype(np.int64)) for k in (0, 1)]


@lru_cache(maxsize=1)
def pair(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


def _same_bytes(parts, tokens: list[bytes], lengths: np.ndarray, chunks: list[str], size: np.ndarray, text: str) -> np.ndarray:
    """Whether each chunk's tokens have its bytes."""
    ids, counts = parts
    found, ends = b"".join(map(tokens.__getitem__, ids.tolist())), np.cumsum(lengths[ids])
    ends = np.r_[0, ends][np.cumsum(counts)]
    if found == text.encode() and (ends == np.cumsum(size)).all():
        return np.ones(len(chunks), bool)
    return np.array([found[i:j] == c.encode() for c, i, j in zip(chunks, [0, *ends], ends)], bool)


def chunks_of(text: str) -> list[str]:
    whole = " " + text
    found = CHUNK.findall(whole)
    return found if sum(map(len, found)) == len(whole) else [whole]


def diagonals(a: np.ndarray, b: np.ndarray, work: int) -> tuple[np.ndarray, np.ndarray]:
    """Borders (i, j) of pieces of ``work`` merged ends: the first i of ``a`` and j of ``b`` come before."""
    total = len(a) + len(b)
    d = np.append(np.arange(0, total, work), total)
    low, high = np.maximum(0, d - len(b)), np.minimum(d, len(a))
    while (low < high).any():
        mid = (low + high) // 2                    # is a[mid] among the first d? then it is not above b[d - mid - 1]
        open_ = low < high
        i, j = np.where(open_, mid, 0), np.where(open_, d - mid - 1, 0)
        more = a[i] <= b[j]
        low, high = np.where(open_ & more, mid + 1, low), np.where(open_ & ~more, mid, high)
    return low, d - low


def merge(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray]:
    """For every end of ``a`` the index of the token of ``b`` that covers its byte, and whether that ends there
    too. Both sequences rise and have the same last end."""
    cover, closes = np.empty(len(a), np.int64), np.empty(len(a), bool)
    i, j = diagonals(a, b, work)
    for i0, i1, j0, j1 in zip(i[:-1].tolist(), i[1:].tolist(), j[:-1].tolist(), j[1:].tolist()):
        if i0 == i1:
            continue
        at = np.searchsorted(b[j0:j1], a[i0:i1])   # j1 - j0: the covering token is the next piece's first
        cover[i0:i1] = j0 + at
        inside = at < j1 - j0
        closes[i0:i1] = False
        closes[i0:i1][inside] = b[j0:j1][at[inside]] == a[i0:i1][inside]
    border = i[1:-1][i[1:-1] > 0] - 1              # stitch: a piece's last A end and the next piece's first B end
    closes[border] = b[np.minimum(cover[border], len(b) - 1)] == a[border]
    return cover, closes


class Aligned:
    """Tokens, ends and groups of a slice of texts."""

    def __init__(self, tools: Pair, texts: list):
        (self.a, self.n_a), (self.b, self.n_b) = tools.tokens(texts)
        end_a, end_b = np.cumsum(tools.length_a[self.a]), np.cumsum(tools.length_b[self.b])
        cover, closes = merge(end_a, end_b)
        self.last_a = np.flatnonzero(closes)       # last A and B token of every group, all texts
        self.last_b = cover[closes]
        self.doc_a = np.repeat(np.arange(len(texts)), self.n_a)
        self.n_groups = np.bincount(self.doc_a[self.last_a], minlength=len(texts))

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Ids of A and B that end together, in order."""
        return self.a[self.last_a].astype(np.int64), self.b[self.last_b].astype(np.int64)

    def written(self, names: list[bytes]) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of every text; ``names`` has id and separator at 3 * id + (0 ',' 1 '|' 2 ';')."""
        many_a, many_b = np.diff(np.r_[-1, self.last_a]), np.diff(np.r_[-1, self.last_b])  # tokens of every group
        begin = np.cumsum(many_a + many_b) - many_a - many_b
        codes = np.empty(len(self.a) + len(self.b), np.int64)
        a, b = 3 * self.a.astype(np.int64), 3 * self.b.astype(np.int64)
        a[self.last_a] += 1
        b[self.last_b] += 2
        codes[ragged(begin, many_a)] = a
        codes[ragged(begin + many_a, many_b)] = b
        parts = list(map(names.__getitem__, codes.tolist()))
        ends = np.cumsum(self.n_a + self.n_b).tolist()
        return [b"".join(parts[i:j])[:-1] for i, j in zip([0, *ends], ends)]


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, the ids a and b, and groups: how many tokens of A and of B come up to the end
    of each group (struct a, b)."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = src.schema["id"].dataType.simpleString()

    def run(batches):
        tools = pair(path_a, path_b)
        for part in row_slices(batches, "text"):
            x = Aligned(tools, part.column("text").to_pylist())
            first_a, first_b = np.cumsum(x.n_a) - x.n_a, np.cumsum(x.n_b) - x.n_b
            doc = x.doc_a[x.last_a]
            ends = pa.StructArray.from_arrays([pa.array((x.last_a + 1 - first_a[doc]).astype(np.int32)),
                                               pa.array((x.last_b + 1 - first_b[doc]).astype(np.int32))], ["a", "b"])
            lists = [pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n)].astype(np.int32)), values)
                     for n, values in ((x.n_a, pa.array(x.a)), (x.n_b, pa.array(x.b)), (x.n_groups, ends))]
            yield pa.RecordBatch.from_arrays([part.column("id"), *lists], ["id", "a", "b", "groups"])

    return C.map_arrow(src, run, f"id {kind}, a array<int>, b array<int>, groups array<struct<a:int,b:int>>")


def digest(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    The aligned links are kept once, as id pairs, in the checkpoint folder; their counts are summed from there,
    and a second pass over them adds up what each document's links count."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    tools = pair(path_a, path_b)
    size_a, size_b = len(tools.bytes_a), len(tools.bytes_b)
    pair.cache_clear()
    del tools
    if size_a * size_b > 1 << 32:
        raise ValueError("id pairs of these vocabularies do not fit 32 bits")

    def link(batches):
        tools = pair(path_a, path_b)
        names = [b"%d%b" % (i, s) for i in range(max(size_a, size_b)) for s in (b",", b"|", b";")]
        for part in row_slices(batches, "text"):
            x = Aligned(tools, part.column("text").to_pylist())
            a, b = x.links()
            keys = (a * size_b + b).astype("<u4")
            at = np.r_[0, np.cumsum(x.n_groups)].tolist()
            written = [hashlib.sha256(w).hexdigest() if w else "" for w in x.written(names)]
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(x.n_a), pa.array(x.n_b), pa.array(x.n_groups.astype(np.int64)),
                 pa.array(written, pa.string()),
                 pa.array([keys[i:j].tobytes() for i, j in zip(at, at[1:])], pa.binary())],
                ["id", "n_a", "n_b", "n_groups", "groups_sha256", "links"])

    linked = C.cut(C.map_arrow(src, link, f"id {kind}, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, "
                                          f"links binary"))

    def count(batches):
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            new, n = np.unique(_keys(batch)[0], return_counts=True)
            keys, at = np.unique(np.concatenate((keys, new)), return_inverse=True)
            counts = np.bincount(at, weights=np.concatenate((counts, n)), minlength=len(keys)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], ["key", "n"])

    totals = (C.map_arrow(linked.select("links"), count, "key bigint, n bigint").groupBy("key")
              .agg(F.sum("n").alias("n")).toArrow())          # its size is bounded by the vocabularies
    order = np.argsort(keys := totals["key"].to_numpy())
    keys, counts = keys[order], totals["n"].to_numpy()[order]
    highest = np.zeros(size_b, np.int64)
    np.maximum.at(highest, keys % size_b, counts)
    best = counts == highest[keys % size_b]

    def score(batches):
        for batch in batches:
            found, n = _keys(batch)
            at, doc = np.searchsorted(keys, found), np.repeat(np.arange(len(n)), n)
            ends = np.r_[0, np.cumsum(n)]
            summed = np.r_[0, np.cumsum(counts[at])][ends]
            n_best = np.bincount(doc, weights=best[at], minlength=len(n)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("id", "n_a", "n_b", "n_groups")], pa.array(n), pa.array(n_best),
                 pa.array(np.diff(summed)), batch.column("groups_sha256")],
                ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return C.map_arrow(linked, score, f"id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
                                      f"n_best bigint, count_sum bigint, groups_sha256 string")


def _keys(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The id pairs of all rows, one after the other, and how many each row has."""
    links = batch.column("links").to_pylist()
    return (np.frombuffer(b"".join(links), "<u4").astype(np.int64),
            np.fromiter((len(x) // 4 for x in links), np.int64, len(links)))
