"""Packing, token alignment and periodic runs against plain computations, and their edge rows."""

import hashlib
import zlib
from collections import Counter
from fractions import Fraction

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest

from recomart.llm import chunks, packing, periodic, queries, tokenalign
from test_llm_operators import EDGE, SF, docs_of, words

WORDS, BYTES, PIECES = (queries.vocab_path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))
ODD = ["a  b\n c", " a", "a\n\nb \n c\t d\t", "\tx", "x\t", "x ", "x  ", " ", "  ", "\n", "a▁b", "<s> </s> <unk>", "<|endoftext|> x",
       "é́ ﬁ", "x\x1c y \x85z  q", "日本語 😀😀", "a\x00b", "’s don't  x", "᠎ a ᠎", "ΑΣ ΑΣ. İI ǅ ́a ̈ x", "Ố ẹ̇",
       "<|endoftext|>x<|startoftext|> <|END"]


def corpus():
    return [*ODD, *pq.read_table(f"{SF}/documents.parquet")["text"].to_pylist()]


def unit_docs(spark, texts):
    return docs_of(spark, list(enumerate(texts)))


# -- helpers ------------------------------------------------------------------------


def test_remembered_chunks_are_forgotten_without_a_trace(monkeypatch):
    monkeypatch.setattr(chunks, "MAX_CHUNKS", 4)
    table = chunks.Remembered(lambda new: ([chunks.together([[len(c)] * len(c) for c in new])], np.array([len(c) > 1 for c in new])))
    for keys in (["a", "bb", "a"], ["ccc", "dddd", "a"], ["eeeee", "bb", "ccc", "a", "f", "gg"], []):
        e = table.entries(keys)
        assert table.ids(e).tolist() == [len(k) for k in keys for _ in k]
        assert table.mark[e].tolist() == [len(k) > 1 for k in keys]


# -- 11 packing ---------------------------------------------------------------------


def test_best_fit_decreasing_by_force():
    rng = np.random.default_rng(4)
    for _ in range(200):
        lengths = sorted(rng.integers(1, 21, rng.integers(0, 40)).tolist(), reverse=True)
        room = []
        for n in lengths:
            fits = [(r, i) for i, r in enumerate(room) if r >= n]
            i = min(fits)[1] if fits else len(room)
            room += [] if fits else [20]
            room[i] -= n
        got = packing.best_fit(lengths, 20)
        assert sorted(np.bincount(got, weights=lengths).tolist() if got else []) == sorted(20 - r for r in room)


def fewest(lengths, capacity):
    """The optimum by trying all packings."""
    best = len(lengths)

    def place(k, room):
        nonlocal best
        if len(room) >= best:
            return
        if k == len(lengths):
            best = len(room)
            return
        for i in {r: i for i, r in enumerate(room) if r >= lengths[k]}.values():
            place(k + 1, [r - lengths[k] * (j == i) for j, r in enumerate(room)])
        place(k + 1, [*room, capacity - lengths[k]])

    place(0, [])
    return best


def test_bounds_hold_and_are_often_reached():
    rng = np.random.default_rng(5)
    reached = 0
    for _ in range(300):
        lengths = sorted(rng.integers(1, 13, rng.integers(1, 9)).tolist(), reverse=True)
        bound = packing.least_sequences(np.bincount(lengths, minlength=13), 12)
        best = fewest(lengths, 12)
        assert -(-sum(lengths) // 12) <= bound <= best
        reached += bound == best
    assert reached > 270
    assert packing.least_sequences(np.bincount([7] * 5, minlength=13), 12) == 5      # two do not fit together
    assert packing.least_sequences(np.zeros(13), 12) == 0


def check_packing(rows, texts, capacity):
    """Every id of every text is in exactly one place; sequences are full without gaps up to their length."""
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(WORDS)
    by = {}
    for r in rows:
        by.setdefault(r["id"], []).append(r)
    assert Counter(r["id"] for r in rows if r["piece"] == 0) == Counter(i for i, _ in texts)
    for i, t in texts:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        copies = sum(1 for j, _ in texts if j == i)
        parts = sorted(by[i], key=lambda r: r["piece"])[::copies]
        assert [r["start"] for r in parts] == list(range(0, len(ids), capacity))
        for r in parts:
            part = ids[r["start"]:r["start"] + capacity]
            assert r["length"] == len(part) and r["ids_crc32"] == zlib.crc32(part.tobytes())
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        parts.sort()
        assert parts[0][0] == 0 and sum(n for _, n in parts) <= capacity
        assert all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:]))
    return len(sequences)


def test_packing_keeps_every_token(spark, monkeypatch):
    texts = list(enumerate(corpus())) + [(None, "a b"), (5000, None), (5001, ""), (5002, "long text " * 9000), (5003, "q" * 60_000)]
    monkeypatch.setattr(packing, "GROUP", 64)  # several groups and exchanges
    docs = docs_of(spark, texts)
    cut = packing.pieces(docs, WORDS, 2048)
    used = check_packing(packing.pack(cut, 2048).collect(), texts, 2048)
    lengths = [r["length"] for r in cut.collect()]
    assert used <= packing.least_sequences(np.bincount(lengths, minlength=2049), 2048) * 1.01 + 1
    copies = [(1, "same words here " * 40)] * 300 + [(2, None)] * 50
    assert check_packing(packing.pack(packing.pieces(docs_of(spark, copies), WORDS, 2048), 2048).collect(), copies, 2048) <= 21
    none = packing.pack(packing.pieces(docs.limit(0), WORDS, 2048), 2048)
    assert none.count() == 0 and none.columns[-2:] == ["sequence_id", "offset"]


def test_word_ids_equal_the_library():
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(WORDS)
    rng = np.random.default_rng(9)
    found = sorted({w for t in corpus() for w in (t or "").encode().split()})
    for letters in ([*range(33, 127), *range(0xC0, 0x100)], [*range(97, 123), *range(0xE0, 0x100), 39, 45],
                    [*range(33, 127), *range(0x80, 0x600), 0x300, 0x301, 0x3A3, 0x130, 0x1F600, 0xAC00, 0]):
        found += ["".join(map(chr, rng.choice(letters, n))).encode() for n in rng.integers(1, 16, 3000)]
    found += [b"<|endoftext|>x", b"a<|startoftext|>", b"<|", b"x\0y", "ΣΑΣ".encode(), "e\u0301".encode()]
    found = [w for w in found if w.split() == [w]]
    (ids, counts), = packing.WordTokens(WORDS).solve(found)[0]
    got = np.split(ids, np.cumsum(counts)[:-1])
    for w, g in zip(found, got):
        assert tok.encode(w.decode(), add_special_tokens=False).ids == g.tolist(), w


def test_exchange_saves_sequences(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 16)
    rows = spark.createDataFrame([(i, 0, 0, 1 + (i * 37) % 19, 0) for i in range(400)],
                                 "id long, piece int, start long, length long, ids_crc32 long")
    bound = packing.least_sequences(np.bincount([1 + (i * 37) % 19 for i in range(400)], minlength=21), 20)
    got = packing._sequences(packing.pack(rows, 20))
    monkeypatch.setattr(packing, "ROUNDS", 0)
    assert bound <= got < packing._sequences(packing.pack(rows, 20))


def test_op11_query(spark):
    texts = [(r["doc_id"], r["text"]) for r in queries.table(spark, SF, "documents").collect()]
    rows = queries.op11_best_fit_packing(spark, SF).withColumnRenamed("doc_id", "id").collect()
    check_packing(rows, texts, 2048)


# -- 12 alignment -------------------------------------------------------------------


def test_merge_pieces_by_force():
    rng = np.random.default_rng(6)
    for _ in range(300):
        end = int(rng.integers(1, 80))
        a, b = (np.unique(np.r_[rng.integers(1, end + 1, rng.integers(1, 60)), end]) for _ in range(2))
        for work in (1, 2, 3, 7, 1000):
            i, j = tokenalign.diagonals(a, b, work)
            assert (np.diff(i + j)[:-1] == work).all() and i[-1] == len(a) and j[-1] == len(b)
            cover, closes = tokenalign.merge(a, b, work)
            assert (cover == np.searchsorted(b, a)).all() and (closes == np.isin(a, b)).all()


def library_a():
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(BYTES)
    tok.encode_special_tokens = True
    return tok


def plain_alignment(tools, text, tok=None):
    """Ids of whole texts by the libraries, and the groups by walking along both."""
    if not text:
        return [], [], []
    whole = (" " + text).encode()
    a, b = (tok or library_a()).encode(" " + text, add_special_tokens=False).ids, tools.b.encode(text)
    if any(b"".join(table[i] for i in ids) != whole for table, ids in ((tools.bytes_a, a), (tools.bytes_b, b))):
        return [], [], []
    ends_b, at = {}, 0
    for k, i in enumerate(b):
        at += len(tools.bytes_b[i])
        ends_b[at] = k + 1
    groups, at, last = [], 0, (0, 0)
    for k, i in enumerate(a):
        at += len(tools.bytes_a[i])
        if at in ends_b:
            groups.append((a[last[0]:k + 1], b[last[1]:ends_b[at]]))
            last = k + 1, ends_b[at]
    return a, b, groups


def check_alignment(got, texts):
    tools = tokenalign.pair(BYTES, PIECES)
    tok = library_a()
    plain = [(i, *plain_alignment(tools, t, tok)) for i, t in texts]
    count = Counter((x[-1], y[-1]) for _, _, _, groups in plain for x, y in groups)
    highest = {}
    for (_, y), n in count.items():
        highest[y] = max(highest.get(y, 0), n)
    want = Counter()
    for i, a, b, groups in plain:
        n = [count[x[-1], y[-1]] for x, y in groups]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        want[i, len(a), len(b), len(groups), len(n), sum(k == highest[y[-1]] for k, (_, y) in zip(n, groups)), sum(n),
             hashlib.sha256(text.encode()).hexdigest() if groups else ""] += 1
    assert Counter(tuple(r) for r in got) == want


def test_alignment_by_force(spark, monkeypatch):
    monkeypatch.setattr(tokenalign, "WORK", 64)
    texts = list(enumerate(corpus())) + EDGE + [(7000, "x y " * 30_000), (7001, "z" * 20_000)]
    docs = docs_of(spark, texts)
    check_alignment(tokenalign.digest(docs, BYTES, PIECES).collect(), texts)
    assert tokenalign.digest(docs.limit(0), BYTES, PIECES).count() == 0
    tools, some = tokenalign.pair(BYTES, PIECES), dict(texts[:60])
    for r in tokenalign.align(docs.where("doc_id < 60"), BYTES, PIECES).collect():
        if r["id"] in some:
            a, b, groups = plain_alignment(tools, some[r["id"]])
            if a == r["a"]:
                ends = np.cumsum([[len(x), len(y)] for x, y in groups], axis=0).tolist() if groups else []
                assert b == r["b"] and [[g["a"], g["b"]] for g in r["groups"]] == ends


def test_op12_query(spark):
    texts = [(r["doc_id"], r["text"]) for r in queries.table(spark, SF, "documents").collect()]
    got = queries.op12_token_alignment(spark, SF)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    check_alignment(got.collect(), texts)


# -- 13 periodic runs ---------------------------------------------------------------


def plain_runs(w, least=6, times=4):
    found = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(least, times * q) and j > i:
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def test_runs_by_force():
    rng = np.random.default_rng(7)
    for turn in range(400):
        docs = []
        for _ in range(rng.integers(1, 4)):
            n = int(rng.integers(0, 60))
            w = rng.integers(0, rng.integers(1, 6), n).tolist()
            if n and turn % 2:
                p, a = int(rng.integers(1, 7)), int(rng.integers(0, n))
                w = [w[i] if i < a else w[min(n - 1, a + (i - a) % p)] for i in range(n)]
            docs.append(w)
        first = np.cumsum([0, *map(len, docs)])
        for least, times in ((6, 4), (3, 3), (10, 5)):
            got = periodic.find_runs(np.concatenate(docs).astype(np.int64), np.repeat(np.arange(len(docs)), np.diff(first)), least, times)
            want = sorted((s + first[k], n, q) for k, w in enumerate(docs) for s, n, q in plain_runs(w, least, times))
            assert list(zip(*(x.tolist() for x in got))) == want
    with pytest.raises(ValueError):
        periodic.find_runs(np.zeros(9, np.int64), np.zeros(9, np.int64), 6, 2)


def plain_digest(i, text):
    w = [x.decode() for x in words(text)]
    h, n = (zlib.crc32(str(i).encode()) if i is not None else 1), len(w)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
    found = plain_runs(w)
    gone = {k for s, n, q in found for k in range(s + q, s + n)}
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (i, len(found), *best, 1000 * best[1] // best[2] if found else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(" ".join(x for k, x in enumerate(w) if k not in gone)))


def test_op13_edges(spark):
    planted = [i for i in range(4000) if zlib.crc32(str(i).encode()) % 10 == 0][:40]
    rows = [*EDGE, (20, "a " * 30_000), (21, "a b c " * 4 + "x " + "a b c " * 6), (22, "k k k k k k l l l l l l"),
            *((i, " ".join(f"w{k % 7}" if i % 3 else f"w{k}" for k in range(i % 50))) for i in planted)]
    docs = docs_of(spark, rows)
    got = periodic.digest(periodic.runs(periodic.with_repeats(docs))).collect()
    assert Counter(map(tuple, got)) == Counter(plain_digest(*r[:2]) for r in rows)
    kept = {r["id"]: r for r in periodic.runs(docs_of(spark, rows)).collect()}
    assert kept[20]["collapsed"] == "a" and kept[22]["collapsed"] == "k l" and kept[20]["runs"][0]["length"] == 30_000
    assert periodic.with_repeats(docs).columns == docs.columns
    assert periodic.runs(docs.limit(0)).count() == 0


def test_op13_query_and_sql(spark):
    texts = [(r["doc_id"], r["text"]) for r in queries.table(spark, SF, "documents").collect()]
    want = Counter(plain_digest(*t) for t in texts)
    got = queries.op13_periodic_runs(spark, SF)
    names = got.columns
    assert Counter(map(tuple, got.collect())) == want
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    sql = db.execute(periodic.ORACLE)
    assert [c[0] for c in sql.description] == names
    assert Counter(sql.fetchall()) == want
