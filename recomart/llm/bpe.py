"""Byte-level BPE encoding by dynamic programming over prefixes, and decoding.

A piece (one match of the vocabulary's splitting pattern) of n bytes has n + 1
prefixes. For each prefix there is exactly one token that can end its encoding:
the vocabulary token that is a suffix of the prefix and whose pair with the last
token of the remaining shorter prefix is compatible, i.e. the two tokens
side by side encode to themselves. So one pass over the positions fills a table
of last tokens, and following back-pointers from the end gives the exact ids.

* Suffix matches: an automaton over all vocabulary tokens; its state after each
  byte knows the longest token ending there, and each token knows the next
  shorter one (its longest proper suffix in the vocabulary).
* Compatibility: token a was built by merges; the parts of a that touch the
  boundary are a, its right part, that one's right part ... and likewise for b on
  the left. Undoing the younger one step by step visits all parts that face each
  other at some time; the pair is compatible if none of them had a merge that
  came earlier than the merges that absorbed them.

Pieces of up to ``WIDE`` bytes are solved many at a time with arrays, longer ones
one by one with the same recurrence. Results of pieces are remembered per worker
in a table of bounded size; a piece that was forgotten is solved again.

Defined results: NULL text encodes like an empty one (no ids, empty decoded
text). Added tokens of the vocabulary file found in a text become their own id.
Repeated rows get equal ids; a text of any length is encoded whole, in memory proportional to it; ties cannot
occur, as the last token of a prefix is unique; an empty table gives no rows; other columns are passed on by ``encode``
and ``decode``, but for one named like the result, which is replaced.
"""

from __future__ import annotations

import hashlib
import json
from collections import deque
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

#: The splitting pattern of byte-level vocabularies and the stand-in
#: characters for bytes in their files (printable ones stand for themselves, the
#: others follow from U+0100 in order).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]

WIDE = 48            # bytes of a piece that is solved in an array with others
REMEMBERED = 200_000  # pieces in each of the two generations a worker remembers
SLICE_BYTES = 2 << 20  # text handled at a time


def byte_letters() -> dict[str, int]:
    rest = [b for b in range(256) if b not in set(PRINTABLE)]
    return {chr(b): b for b in PRINTABLE} | {chr(0x100 + k): b for k, b in enumerate(rest)}


class Vocabulary:
    """Tables of one byte-level BPE vocabulary; ``rank`` orders tokens by age."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, letters = spec["model"], byte_letters()
        if model["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["normalizer"]:
            raise ValueError("only byte-level BPE vocabularies without a normalizer are supported")
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        raw = {tok: bytes(letters[c] for c in tok) for tok in model["vocab"]}
        size = 1 + max([*model["vocab"].values(), *self.added.values()])
        self.bytes = [b""] * size
        for tok, i in model["vocab"].items():
            self.bytes[i] = raw[tok]
        for tok, i in self.added.items():
            self.bytes[i] = tok.encode()
        self.id_of = {raw[tok]: i for tok, i in model["vocab"].items()}
        # left and right part and age of every token (a single byte: no parts, age -1)
        self.left, self.right = np.arange(size), np.arange(size)
        self.age = np.full(size, -1, dtype=np.int64)
        self.pair_age: dict[tuple[int, int], int] = {}
        for rank, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            i, x, y = model["vocab"][a + b], model["vocab"][a], model["vocab"][b]
            self.left[i], self.right[i], self.age[i] = x, y, rank
            self.pair_age[x, y] = rank
        keys = np.array([x * size + y for x, y in self.pair_age], dtype=np.int64)
        order = np.argsort(keys)
        self.size, self.pair_keys = size, keys[order]
        self.pair_rank = np.array(list(self.pair_age.values()), dtype=np.int64)[order]
        self.length = np.array([len(b) for b in self.bytes], dtype=np.int64)
        self._automaton()
        self.known: dict[tuple[int, int], bool] = {}

    def _automaton(self) -> None:
        """Dense goto table, longest token per state, next shorter suffix token per token."""
        tokens = sorted(self.id_of)
        children: list[dict[int, int]] = [{}]
        token_at = [-1]
        for t in tokens:
            s = 0
            for b in t:
                nxt = children[s].get(b)
                if nxt is None:
                    nxt = children[s][b] = len(children)
                    children.append({})
                    token_at.append(-1)
                s = nxt
            token_at[s] = self.id_of[t]
        goto = np.zeros((len(children), 256), dtype=np.int32)
        longest = np.full(len(children), -1, dtype=np.int32)
        self.shorter = np.full(self.size, -1, dtype=np.int32)
        fail = np.zeros(len(children), dtype=np.int32)
        queue = deque()
        for b, s in children[0].items():
            goto[0, b] = s
            longest[s] = token_at[s]
            queue.append(s)
        while queue:
            s = queue.popleft()
            goto[s] = goto[fail[s]]
            for b, t in children[s].items():
                fail[t] = goto[fail[s], b]
                goto[s, b] = t
                below = longest[fail[t]]
                if token_at[t] >= 0:
                    longest[t] = token_at[t]
                    self.shorter[token_at[t]] = below
                else:
                    longest[t] = below
                queue.append(t)
        self.goto, self.longest = goto, longest

    # -- compatibility of two neighbouring tokens ---------------------------------

    def compatible(self, a: int, b: int) -> bool:
        """Whether tokens a, b side by side stay apart when their bytes are encoded."""
        got = self.known.get((a, b))
        if got is None:
            if len(self.known) > REMEMBERED:
                self.known.clear()
            got = self.known[a, b] = bool(self.compatible_many(np.array([a]), np.array([b]))[0])
        return got

    def compatible_many(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        ok = np.ones(len(a), dtype=bool)
        rows = np.arange(len(a))
        a, b = a.astype(np.int64), b.astype(np.int64)
        # the two parts face each other until this age; a merge of them before it breaks the pair
        until = np.full(len(a), np.iinfo(np.int64).max)
        while len(rows):
            key = a * self.size + b
            at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            broken = (self.pair_keys[at] == key) & (self.pair_rank[at] < until)
            ok[rows[broken]] = False
            go = ~broken & ((self.age[a] >= 0) | (self.age[b] >= 0))
            rows, a, b = rows[go], a[go], b[go]
            undo_a = self.age[a] > self.age[b]
            # equal rules apply left to right: absorbing a beats merging at the boundary, which beats absorbing b
            until = np.where(undo_a, self.age[a], self.age[b] + 1)
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_a, b, self.left[b])
        return ok

    # -- encoding -----------------------------------------------------------------

    def encode_long(self, piece: bytes) -> np.ndarray:
        """Ids of one piece."""
        last = [-1] * (len(piece) + 1)
        state, goto, longest, shorter, length = 0, self.goto, self.longest, self.shorter, self.length
        for i, byte in enumerate(piece, 1):
            state = goto[state, byte]
            t = int(longest[state])
            while True:
                start = i - int(length[t])
                if start == 0 or self.compatible(last[start], t):
                    break
                t = int(shorter[t])
            last[i] = t
        out, i = [], len(piece)
        while i:
            out.append(last[i])
            i -= int(length[last[i]])
        return np.array(out[::-1], dtype=np.uint32)

    def encode_wide(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of many pieces of 1 to WIDE bytes, all prefixes of one length at a time."""
        order = sorted(range(len(pieces)), key=lambda k: -len(pieces[k]))
        n = np.array([len(pieces[k]) for k in order])
        width = int(n[0])
        text = np.frombuffer(b"".join(pieces[k].ljust(width, b"\0") for k in order), dtype=np.uint8).reshape(-1, width)
        last = np.full((len(n), width + 1), -1, dtype=np.int32)
        state = np.zeros(len(n), dtype=np.int64)
        for i in range(1, width + 1):
            live = int(np.searchsorted(-n, -i, side="right"))  # pieces of at least i bytes come first
            state = self.goto[state[:live], text[:live, i - 1]]
            rows = np.arange(live)
            t = self.longest[state].astype(np.int64)
            while len(rows):
                start = i - self.length[t]
                before = last[rows, start]
                ok = start == 0
                ask = np.flatnonzero(~ok)
                ok[ask] = self.compatible_many(before[ask], t[ask])
                last[rows[ok], i] = t[ok]
                rows, t = rows[~ok], self.shorter[t[~ok]].astype(np.int64)
        # back-pointers, last token first
        ids = np.zeros((len(n), width), dtype=np.uint32)
        count = np.zeros(len(n), dtype=np.int64)
        at, rows = n.copy(), np.arange(len(n))
        while len(rows):
            t = last[rows, at[rows]]
            ids[rows, count[rows]] = t
            count[rows] += 1
            at[rows] -= self.length[t]
            rows = rows[at[rows] > 0]
        out = [None] * len(pieces)
        for r, k in enumerate(order):
            out[k] = ids[r, :count[r]][::-1]
        return out

    def decode(self, ids: np.ndarray) -> str:
        """Text of the ids; bytes that are not UTF-8 become U+FFFD."""
        return self.decode_bytes(ids).decode("utf-8", "replace")

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids.tolist()))


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Encoder:
    """Encodes whole texts; remembers pieces up to a bound."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.split = regex.compile(PATTERN).findall
        names = sorted(vocab.added, key=len, reverse=True)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.packed: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def pieces(self, text: str) -> list[str]:
        """Pieces of the text; added tokens appear as themselves, marked by a leading NUL pair."""
        if self.specials is None or not any(s in text for s in self.vocab.added):
            return self.split(text)
        out = []
        for k, part in enumerate(self.specials.split(text)):
            out += ["\0\0" + part] if k % 2 else self.split(part)
        return out

    def learn(self, pieces: set) -> None:
        """Solve the pieces that neither generation remembers; those in use move to the younger one."""
        new = [p for p in pieces if p not in self.packed]
        if len(self.packed) + len(new) > REMEMBERED:
            self.older, self.packed = self.packed, {}
            new = pieces
        wide, raw = [], []
        for p in new:
            known = self.older.get(p)
            if known is not None:
                self.packed[p] = known
                continue
            if p.startswith("\0\0") and p[2:] in self.vocab.added:
                self.packed[p] = np.uint32(self.vocab.added[p[2:]]).tobytes()
                continue
            b = p.encode()
            if len(b) <= WIDE:
                wide.append(p)
                raw.append(b)
            else:
                self.packed[p] = self.vocab.encode_long(b).tobytes()
        for k in range(0, len(wide), 1 << 15):
            for p, ids in zip(wide[k:k + (1 << 15)], self.vocab.encode_wide(raw[k:k + (1 << 15)])):
                self.packed[p] = ids.tobytes()

    def encode(self, texts: list) -> list[np.ndarray]:
        """uint32 ids of each text."""
        split = [self.pieces(t) if t else [] for t in texts]
        self.learn(set().union(*split))
        get = self.packed.__getitem__
        return [np.frombuffer(b"".join(map(get, p)), dtype=np.uint32) for p in split]


def slices(batch: pa.RecordBatch, column: str, size: int = SLICE_BYTES):
    """Row slices of about ``size`` bytes of text (at least one row)."""
    lengths = [len(x) if x is not None else 0 for x in C.as_bytes(batch.column(column))]
    start = total = 0
    for i, n in enumerate(lengths):
        if i > start and total + n > size:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < batch.num_rows:
        yield batch.slice(start)


def encode(docs: DataFrame, vocab_path: str, text_col: str = "text", out: str = "token_ids") -> DataFrame:
    """``docs`` without the text plus array<int> ``out``; nothing is shuffled."""
    keep = [c for c in docs.columns if c not in (text_col, out)]
    src = docs.select(*keep, F.col(text_col).alias("__text"))
    schema = docs.select(*keep, F.array(F.lit(0)).alias(out)).schema

    def run(batches):
        with task_encoder(vocab_path) as enc:
            for b in (part for batch in batches for part in slices(batch, "__text")):
                ids = enc.encode(b.column("__text").to_pylist())
                flat = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
                at = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                lists = pa.ListArray.from_arrays(pa.array(at), pa.array(flat))
                yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], lists], [*keep, out])

    return C.map_arrow(src, run, schema)


def decode(tokens: DataFrame, vocab_path: str, ids_col: str = "token_ids", out: str = "text") -> DataFrame:
    """``tokens`` without the ids plus the decoded string ``out`` (NULL ids: NULL)."""
    keep = [c for c in tokens.columns if c not in (ids_col, out)]
    src = tokens.select(*keep, F.col(ids_col).alias("__ids"))
    schema = tokens.select(*keep, F.lit("").alias(out)).schema

    def run(batches):
        voc = vocabulary(vocab_path)
        for b in batches:
            col = b.column("__ids")
            text = [None if not v.is_valid else voc.decode(v.values.to_numpy(zero_copy_only=False)) for v in col]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array(text, pa.string())],
                                             [*keep, out])

    return C.map_arrow(src, run, schema)


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(vocabulary(path))


@contextmanager
def task_encoder(path: str):
    """The encoder for one task; its tables are given back at the end, so that idle workers stay small."""
    try:
        yield _encoder(path)
    finally:
        _encoder.cache_clear()
        vocabulary.cache_clear()


def digest(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every text: id, n_tokens, ids_sha256, decoded_sha256 (both lower-case hex)."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = src.schema["id"].dataType.simpleString()

    def run(batches):
        with task_encoder(vocab_path) as enc:
            number = [str(i) for i in range(enc.vocab.size)].__getitem__
            for b in (part for batch in batches for part in slices(batch, "text")):
                n, ids_hash, text_hash = [], [], []
                for ids in enc.encode(b.column("text").to_pylist()):
                    listed = ids.tolist()
                    n.append(len(listed))
                    ids_hash.append(hashlib.sha256(",".join(map(number, listed)).encode()).hexdigest())
                    text_hash.append(hashlib.sha256(enc.vocab.decode(ids).encode()).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), pa.array(n, pa.int64()), pa.array(ids_hash, pa.string()),
                     pa.array(text_hash, pa.string())], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return C.map_arrow(src, run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
