"""Best-fit packing of token pieces into sequences, certified by lower bounds and repacked.

1. Texts become token ids; a document longer than a sequence is cut, nothing else is.
2. Pieces are dealt by a hash of their row number to groups of about GROUP pieces; no
   source, document or group of copies can make one large. Each group is packed by
   best-fit decreasing: longest first, into the fullest sequence that still has room.
3. Dual feasible functions bound from below how many sequences any packing of a group
   needs. Where the bound is reached, the group's count is certified. The
   other groups exchange documents: what lies in their sequences that are not full is
   dealt anew and packed by best-fit decreasing again. The emptiest sequence of every
   group takes part, as a sum of certified counts need not be the best in all.
4. Rounds end when the bound of everything still exchanged certifies its count, when a
   round saves no sequence (it is then not applied), or after ROUNDS.

Only the histogram of lengths of the exchanged pieces (at most ``capacity`` rows) and
counts reach the driver. Every round is written to the checkpoint folder.

Defined results: NULL and empty texts are documents of the end id alone; repeated rows,
NULL ids and equal lengths are packed row by row (ties by row number). An empty table
gives no rows. Very long texts are tokenized in parts cut at ASCII white space, which
the tokenizer drops. Further columns play no part.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .bpe import byte_letters
from .chunks import Remembered, ragged, row_slices, together

GROUP = 8192      # pieces of one best-fit run
ROUNDS = 4        # exchanges at most
STEPS = 12        # dual feasible functions of Fekete and Schepers for k = 1 .. STEPS


# -- pieces ------------------------------------------------------------------------


#: The normalisation and splitting that the quick route below knows.
NORMAL = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
                                              {"type": "Lowercase"}]}
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class WordTokens:
    """Ids of words by a byte-pair vocabulary with word ends, as its library gives them.

    Words of printable ASCII and the letters U+00C0 to U+00FF, nearly all words of western text, take a
    quick route: for them composing changes nothing and lower case depends on single characters, so the vocabulary's
    splitting pattern can be applied to all new words at once, and the parts, closed by a NUL that stands for the word
    end, are merged by rank (ids are numbered by age). All other words, those that may hold a special token or a
    NUL among them, are given to the library.
    """

    def __init__(self, path: str):
        self.path, self.library, self.quick = path, None, None
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, split = spec["model"], spec["pre_tokenizer"]
        end, letters = model["end_of_word_suffix"], byte_letters()
        added = {t["content"] for t in spec["added_tokens"]}
        known = (spec["normalizer"] == NORMAL and split["type"] == "Sequence" and end
                 and split["pretokenizers"][0].get("pattern") == {"Regex": SPLIT} and all("<|" in t for t in added))
        if known:
            import tiktoken
            ranks = {bytes(letters[c] for c in t.removesuffix(end)) + b"\0" * t.endswith(end): i
                     for t, i in model["vocab"].items() if t not in added}
            self.quick = tiktoken.Encoding("words", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={})
            self.parts = regex.compile(SPLIT + r"|\n").findall
            self.plain = re.compile("[!-~À-ÿ]+").fullmatch
            self.border = ranks[b"\n\0"]

    def _by_library(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self.library is None:
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            from tokenizers import Tokenizer
            self.library = Tokenizer.from_file(self.path)
            self.library.no_truncation()
            self.library.no_padding()
        return together([e.ids for e in self.library.encode_batch(words, add_special_tokens=False)])

    def _quickly(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        split = self.parts("\n".join(words).lower() + "\n")
        ids = np.array(self.quick.encode_ordinary("\0".join(split) + "\0"), np.int32)
        borders = np.flatnonzero(ids == self.border)
        return ids[ids != self.border], np.diff(np.r_[-1, borders]) - 1

    def solve(self, raw: list[bytes]):
        """Ids of all words, and ids per word (see ``Remembered``)."""
        words, marks = [w.decode() for w in raw], np.ones(len(raw), bool)
        easy = np.array([self.quick is not None and self.plain(w) is not None and "<|" not in w for w in words])
        if easy.all():
            return [self._quickly(words)], marks
        parts = [f([w for w, e in zip(words, easy) if e == kind]) for kind, f in
                 ((True, self._quickly if easy.any() else together), (False, self._by_library))]
        ids, counts = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(np.r_[np.flatnonzero(easy), np.flatnonzero(~easy)])
        start = np.cumsum(counts) - counts
        return [(ids[ragged(start[order], counts[order])], counts[order])], marks


@lru_cache(maxsize=1)
def _tokens(path: str) -> Remembered:
    return Remembered(WordTokens(path).solve, limit=400_000)


def token_ids(table: Remembered, texts: list[bytes | None]) -> list[np.ndarray]:
    """Ids of every text. The vocabulary's splitting drops white space and no normalisation reaches over it, so
    the words of a text can be encoded by themselves."""
    words = [(t or b"").split() for t in texts]
    entries = table.entries([w for t in words for w in t])
    count = np.r_[0, np.cumsum(table.counts(entries))]
    ends = count[np.cumsum([len(w) for w in words], dtype=np.int64)] if words else np.zeros(0, np.int64)
    ids = table.ids(entries)
    return [ids[i:j] for i, j in zip(np.r_[0, ends[:-1]], ends)]


def pieces(docs: DataFrame, vocab_path: str, capacity: int, end: int = 0, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """One row per piece of at most ``capacity`` ids (the text's and ``end``): id, piece, start, length, ids_crc32."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = src.schema["id"].dataType.simpleString()

    def run(batches):
        table = _tokens(vocab_path)
        for b in row_slices(batches, "text"):
            row, piece, length, crc = [], [], [], []
            for r, ids in enumerate(token_ids(table, C.as_bytes(b.column("text")))):
                ids = np.append(ids, end).astype("<u4")
                for k, i in enumerate(range(0, len(ids), capacity)):
                    part = ids[i:i + capacity]
                    row.append(r)
                    piece.append(k)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
            at = np.array(piece, np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column("id").take(pa.array(row, pa.int64())), pa.array(at), pa.array(at.astype(np.int64) * capacity),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())], ["id", "piece", "start", "length", "ids_crc32"])

    return C.map_arrow(src, run, f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


# -- one group ----------------------------------------------------------------------


def best_fit(lengths: list[int], capacity: int) -> list[int]:
    """Sequence of every piece, in the given (falling) order: the fullest one with room, else a new one."""
    with_room: list[list[int]] = [[] for _ in range(capacity + 1)]  # open sequences by room left
    rooms = 0                                                       # bit r: some sequence has room r
    made, out = 0, []
    for n in lengths:
        fits = rooms >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            seq = with_room[room].pop()
            if not with_room[room]:
                rooms ^= 1 << room
        else:
            room, seq = capacity, made
            made += 1
        if room > n:
            with_room[room - n].append(seq)
            rooms |= 1 << (room - n)
        out.append(seq)
    return out


def least_sequences(counts: np.ndarray, capacity: int) -> int:
    """Lower bound of the number of sequences for counts[n] pieces of length n, by dual feasible functions.

    Such a function f on [0, 1] never lets values of lengths that fit together sum to more than 1, so the sum of all
    values is a lower bound. Used: for a threshold t, f(x) is 1 above 1 - t, 0 below t and x (or u(x)) between, with u the
    rounding of Fekete and Schepers: x if (k + 1) x is whole, else floor((k + 1) x) / k. Whole numbers throughout."""
    x = np.arange(capacity + 1, dtype=np.int64)
    n = np.asarray(counts, np.int64)
    above = n.sum() - np.cumsum(n)                            # pieces longer than x
    t = np.arange(0, capacity // 2 + 1)
    best = 0
    for k in range(STEPS + 1):
        scale = max(k, 1) * capacity
        whole = (k + 1) * x % capacity == 0
        value = x if k == 0 else np.where(whole, k * x, (k + 1) * x // capacity * capacity)
        upto = np.r_[0, np.cumsum(value * n)]                 # of lengths below index
        sums = scale * above[capacity - t] + upto[capacity - t + 1] - upto[t]
        best = max(best, -(-int(sums.max()) // scale))
    return best


PACKED = "uid bigint, id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, " \
         "sequence_id bigint, offset bigint, exchange boolean"


def _pack_groups(open_: DataFrame, groups: int, turn: int, capacity: int) -> DataFrame:
    """Best-fit decreasing in each of ``groups`` groups; ``exchange`` marks what the next round may move."""
    kind = open_.schema["id"].dataType.simpleString()

    def pack_group(table: pa.Table) -> pa.Table:
        length, uid = table["length"].to_numpy(), table["uid"].to_numpy()
        order = np.lexsort((uid, -length))
        table, length = table.take(pa.array(order)), length[order]
        seq = np.array(best_fit(length.tolist(), capacity), np.int64)
        fill = np.bincount(seq, weights=length).astype(np.int64)
        by = np.argsort(seq, kind="stable")
        offset = np.empty(len(seq), np.int64)
        offset[by] = np.cumsum(length[by]) - length[by]
        offset -= (np.cumsum(fill) - fill)[seq]
        certified = len(fill) == least_sequences(np.bincount(length, minlength=capacity + 1), capacity)
        give = np.zeros(len(fill), bool) if certified else fill < capacity
        give[np.argmin(fill)] |= fill.min() < capacity
        names = turn * (1 << 56) + table["group"].to_numpy()[0] * (1 << 24) + seq
        out = table.drop_columns(["group"])
        for name, values in (("sequence_id", names), ("offset", offset), ("exchange", give[seq])):
            out = out.append_column(name, pa.array(values))
        return out

    dealt = open_.withColumn("group", F.pmod(F.xxhash64("uid", F.lit(turn)), F.lit(groups)).cast("bigint"))
    C.workers_find_package(open_.sparkSession)
    return C.cut(dealt.groupBy("group").applyInArrow(pack_group, PACKED.format(kind=kind)))


def pack(cut_pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces`` rows with sequence_id (numbers with gaps) and offset, the place in the sequence."""
    columns = [*cut_pieces.columns]
    rows = C.cut(cut_pieces.withColumn("uid", F.monotonically_increasing_id()).select("uid", *columns))
    layout = _pack_groups(rows, _groups(rows.count()), 0, capacity)
    for turn in range(1, ROUNDS + 1):
        pool = layout.where("exchange")
        counts = np.zeros(capacity + 1, np.int64)
        for r in pool.groupBy("length").count().collect():    # at most one row per length
            counts[r["length"]] = r["count"]
        used = _sequences(pool)
        if used <= least_sequences(counts, capacity):
            break
        again = _pack_groups(pool.drop("sequence_id", "offset", "exchange"), _groups(int(counts.sum())), turn, capacity)
        if _sequences(again) >= used:
            break
        layout = layout.where("NOT exchange").unionByName(again)
    return layout.select(*columns, "sequence_id", "offset")


def _groups(n: int) -> int:
    return max(1, -(-n // GROUP))


def _sequences(packed: DataFrame) -> int:
    """Sequences in use (each has exactly one piece at its beginning)."""
    return packed.where("offset = 0").count()
