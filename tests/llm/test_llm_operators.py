"""Small tests of the training-data operators: brute force, round trips, held-out accuracy and edge rows."""

import contextlib
import hashlib
import re
import uuid

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from recomart.llm import bpe, common, crosspolytope, langid, lm, maxscore, mixing, queries, secret_scan, simhash, toxicity, warc
from recomart.session import ensure_checkpoint_dir

SF = "/root/testdata/sf0.001"
DOCS = ("doc_id long, text string, lang string, source string, n_chars long, id long, fp string, size string, "
        "__key string, target string")


def docs_of(spark, rows):
    """Documents with columns whose names clash with those that operators add."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or ""), 7, "x", "y", "z", "t")
            for r in rows]
    return spark.createDataFrame(full, DOCS)


EDGE = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one two"), (6, "a b c d e f g h"), (7, "a b c d e f g h"),
        (7, "a b c d e f g h"), (None, "a b c d e f g h"), (None, None), (8, "été café naïve " * 3000),
        (9, "x" * 50_000), (10, "   q \x1c w")]


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


# -- helpers -----------------------------------------------------------------------


def test_connected_components(spark):
    rng = np.random.default_rng(3)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 120, (70, 2))] + [(500 + i, 501 + i) for i in range(40)]
    pairs += [(1000, 1001 + i) for i in range(200)]
    low = {x: x for p in pairs for x in p}
    for _ in range(200):
        for a, b in pairs:
            low[a] = low[b] = min(low[a], low[b])
    got = common.connected_components(spark.createDataFrame(pairs, "a long, b long"))
    want = {x: c for x, c in low.items() if any(a != b and x in (a, b) for a, b in pairs)}
    assert {r["id"]: r["component"] for r in got.collect()} == want
    assert common.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_split_hot_meets_every_pair_once(spark):
    rows = spark.range(0, 300).withColumn("key", F.when(F.col("id") < 200, 1).otherwise(F.col("id") % 7 + 2))
    units = common.split_hot(rows, "key", "id", 16).toPandas()
    met = {}
    for (key, unit), g in units.groupby(["key", "__unit"]):
        cross = unit % (1 << 31) != unit >> 31
        assert len(g) <= 2 * 16 + 24
        v = list(zip(g["id"], g["__block"]))
        for i, (a, x) in enumerate(v):
            for b, y in v[i + 1:]:
                if not cross or x != y:
                    met[min(a, b), max(a, b)] = met.get((min(a, b), max(a, b)), 0) + 1
    same = rows.toPandas().groupby("key")["id"].apply(list)
    want = {(a, b) for v in same for i, a in enumerate(v) for b in v[i + 1:]}
    assert set(met) == want and set(met.values()) == {1}


# -- 1 embedding near-dedup ---------------------------------------------------------


def links_by_force(rows):
    def unit(v):
        if not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        x = np.array(v, dtype=np.float64) / max(map(abs, v))
        return x / np.linalg.norm(x)

    u = [(i, None if i is None else unit(v)) for i, v in rows]
    n, low = [0] * len(u), [i for i, _ in u]
    pairs = [(a, b) for a in range(len(u)) for b in range(len(u)) if a != b and u[a][1] is not None
             and u[b][1] is not None and len(u[a][1]) == len(u[b][1]) and u[a][1] @ u[b][1] >= 0.95]
    for a, _ in pairs:
        n[a] += 1
    for _ in range(len(u)):
        before = list(low)
        for a, b in pairs:
            low[a] = min(low[a], low[b])
        if low == before:
            break
    return sorted((i, k, c, i is not None and i == c) for (i, _), k, c in zip(u, n, low) if i is not None)


@pytest.mark.parametrize("block", [2048, 24])
def test_embedding_links(spark, monkeypatch, block):
    monkeypatch.setattr(crosspolytope, "BLOCK_ROWS", block)
    rng = np.random.default_rng(0)
    centre = rng.normal(size=(20, 24))
    rows = [(i, (centre[i % 20] + 0.12 * rng.normal(size=24)).tolist()) for i in range(160)]
    rows += [(200 + i, (centre[0] + 0.05 * rng.normal(size=24)).tolist()) for i in range(90)]
    rows += [(400 + i, [1.0] * 24) for i in range(30)] + [(450, [2.0] * 24), (451, [1.0] * 24), (451, [1.0] * 24)]
    rows += [(500, None), (501, []), (502, [0.0] * 24), (503, [None] + [1.0] * 23), (504, [float("nan")] * 24),
             (505, [float("inf")] * 24), (506, [1.0, 1.0]), (507, [1.0, 1.01]), (None, [1.0] * 24), (508, [1e300] * 24),
             (509, [1e-200] * 24), (510, [3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("id", F.lit("clash"))
    got = crosspolytope.near_duplicates(df, recall=0.999999)
    found = sorted(tuple(r)[:4] for r in got.collect() if r["id"] is not None)
    assert found == links_by_force(rows)
    assert got.count() == len(rows)


def test_embedding_empty(spark):
    assert crosspolytope.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_hadamard_is_orthogonal():
    h = crosspolytope.hadamard(np.eye(16))
    assert np.allclose(h @ h.T, np.eye(16)) and np.allclose(np.abs(h), 0.25)


def test_embedding_recall_at_the_threshold():
    rng = np.random.default_rng(9)
    p = crosspolytope.plan(50_000, 64, 0.95)
    a, b = rng.normal(size=(2, 800, 64))
    a = crosspolytope.unit(a)
    b = crosspolytope.unit(b - (a * b).sum(axis=1, keepdims=True) * a)
    b = 0.95 * a + np.sqrt(1 - 0.95 ** 2) * b
    ca, cb = crosspolytope.codes(a, p), crosspolytope.codes(b, p)
    met = ((ca[:, :, :1] == cb).any(axis=2) | (cb[:, :, :1] == ca).any(axis=2)).any(axis=1)
    assert met.mean() >= 0.99


# -- 2 SimHash ----------------------------------------------------------------------


def fingerprint(text, length=3):
    w = [x.lower() for x in words(text)]
    s = [b" ".join(w[i:i + length]) for i in range(len(w) - length + 1)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << j for j in range(64) if 2 * sum(x >> j & 1 for x in h) > len(h))


def groups_by_force(rows, radius=3):
    fp = [fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i in range(len(rows)):
        for j in range(i):
            if (fp[i] ^ fp[j]).bit_count() <= radius:
                parent[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[root(i)] = min(low.get(root(i), d), d)
    return [(d, fp[i], low.get(root(i))) for i, (d, _) in enumerate(rows)]


def test_simhash_edge_rows(spark):
    got = simhash.simhash_groups(docs_of(spark, EDGE)).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r["id"], r["fp"] % (1 << 64), r["component_id"]) for r in got), key=key) == sorted(groups_by_force(EDGE), key=key)
    kept = simhash.drop_near_copies(docs_of(spark, EDGE))
    assert kept.columns == docs_of(spark, EDGE).columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, _, c in groups_by_force(EDGE)})
    assert simhash.simhash_groups(docs_of(spark, EDGE).limit(0)).count() == 0


def test_simhash_on_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in queries.table(spark, SF, "documents").select("doc_id", "text").collect()]
    got = {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in queries.op2_simhash(spark, SF).collect()}
    assert got == {(d, f"{f:016x}", c) for d, f, c in groups_by_force(rows)}


@pytest.mark.parametrize("radius,n,block", [(3, 700, 64), (1, 300, 4096), (5, 400, 32)])
def test_simhash_groups_of_fingerprints(spark, radius, n, block):
    rng = np.random.default_rng(radius)
    fp = rng.integers(0, 2 ** 63, 40, dtype=np.int64)[rng.integers(0, 40, n)].astype(np.uint64)
    for _ in range(radius):
        fp ^= np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64) * (rng.random(n) < 0.7).astype(np.uint64)
    fp = np.unique(fp)
    got = simhash.groups(spark.createDataFrame([(int(x),) for x in fp.view(np.int64)], "fp long"), radius, block).collect()
    near = np.bitwise_count(fp[:, None] ^ fp[None]) <= radius
    label = np.arange(len(fp))
    while True:
        new = np.array([label[near[i]].min() for i in range(len(fp))])
        if (new == label).all():
            break
        label = new
    at = {int(x): i for i, x in enumerate(fp.view(np.int64))}
    pairs = {(label[at[r["fp"]]], r["root"]) for r in got}
    assert len(got) == len(fp) and len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


def test_bit_sliced_distances():
    rng = np.random.default_rng(1)
    fp = rng.integers(0, 2 ** 63, 4, dtype=np.int64).astype(np.uint64)[rng.integers(0, 4, 333)]
    fp ^= np.uint64(1) << rng.integers(0, 64, 333).astype(np.uint64)
    group = np.repeat([0, 1, 2], [200, 30, 103])
    for radius in (0, 1, 2, 3, 7):
        got = {(int(a), int(b)) for i, j in simhash.close_pairs(fp, group, radius) for a, b in zip(i, j)}
        want = {(i, j) for i in range(333) for j in range(i + 1, 333)
                if group[i] == group[j] and int(fp[i] ^ fp[j]).bit_count() <= radius}
        assert got == want


# -- 3 language identification ------------------------------------------------------


def test_language_held_out_accuracy(spark):
    lang = {r["doc_id"]: r["lang"] for r in queries.table(spark, SF, "documents").collect()}
    got = queries.op3_language_id(spark, SF).toPandas()
    out = got[got.held_out & got.doc_id.map(lang).notna()]
    assert len(got) == len(lang) and got.score.between(0, 1).all()
    assert (out.lang_pred == out.doc_id.map(lang)).mean() >= 0.95


def test_language_edge_rows(spark):
    rows = [(1, "the cat sat on the mat and the dog ran " * 5, "en"), (2, "der hund und die katze sind nicht hier " * 5, "de"),
            (11, "the house and the garden of the king " * 5, "en"), (12, "das haus und der garten von dem mann " * 5, "de"),
            (3, None, "en"), (4, "", "de"), (5, "123 !? ½ ²", "en"), (None, "the dog and the house of the cat", None)]
    docs = docs_of(spark, rows)
    model = langid.train(docs, F.lit(True))
    got = {r["text2"]: r for r in langid.identify(docs.withColumn("text2", F.col("text")), model).collect()}
    assert got["the dog and the house of the cat"]["lang_pred"] == "en"
    assert all(got[t]["lang_pred"] == "und" and got[t]["score"] == 0 for t in (None, "", "123 !? ½ ²"))
    none = langid.train(docs, F.lit(False))
    assert {r["lang_pred"] for r in langid.identify(docs, none).collect()} == {"und"}
    one = langid.train(docs.where("lang = 'en'"), F.lit(True))
    assert {r["lang_pred"] for r in langid.identify(docs.where("doc_id <= 2"), one).collect()} == {"en"}
    assert langid.identify(docs.limit(0), model).count() == 0


def test_language_model_keeps_every_language(spark):
    rows = [(20 * k + i, f"{chr(97 + k) * 4} {chr(98 + k) * 5} words {i} " * 5, f"l{k:02}") for k in range(12) for i in range(8)]
    docs = docs_of(spark, rows)
    assert langid.train(docs, F.lit(True), max_rows=5).langs == [f"l{k:02}" for k in range(12)]


def test_language_sample_is_bounded_and_loses_no_language(spark, monkeypatch):
    monkeypatch.setattr(langid, "MOST_ROWS", 100)
    name = lambda k: f"{chr(97 + k % 26)}{chr(97 + k // 26)}"
    rows = [(9 * k + i, f"{name(k) * 3} {name(k)} word{i} " * 4, f"l{k:03}") for k in range(150) for i in range(9)]
    seen = {}
    real = langid.fit
    monkeypatch.setattr(langid, "fit", lambda x, lang: seen.update(rows=len(x)) or real(x, lang))
    model = langid.train(docs_of(spark, rows), F.lit(True), max_rows=20)
    assert len(model.langs) == 150 and 150 <= seen["rows"] < 300
    got = langid.identify(docs_of(spark, rows[::9]), model).toPandas()
    assert (got.lang_pred == [r[2] for r in rows[::9]]).mean() > 0.9


def test_decoding_by_enumeration():
    rng = np.random.default_rng(1)
    for n in (2, 5, 30, 700):
        code = langid.codewords(n)
        bits = code.shape[1]
        model = langid.Model([str(i) for i in range(n)], code, rng.normal(size=(langid.DIM, bits)).astype(np.float32) / 4,
                             rng.normal(size=bits), rng.random(bits))
        counts = rng.integers(0, 3, (4, langid.DIM))
        margin = langid.features(counts) @ model.w + model.b
        for row, m in zip(model.losses(counts), margin):
            want = [sum(w * max(0.0, 1.0 - x * c) ** 2 for w, x, c in zip(model.bit_weight, m, word)) for word in code]
            assert np.allclose(row, want, rtol=1e-5)


def test_language_ties_repeats_and_long_texts(spark):
    rows = [(1, "aa bb cc " * 9, "x"), (2, "aa bb cc " * 9, "y"), (1, "aa bb cc " * 9, "x"), (3, "dd ee ff " * 9, "z"), (4, "dd gg hh " * 9, "z")]
    model = langid.train(docs_of(spark, rows), F.lit(True))
    long = "dd ee ff gg " * 200_000
    got = langid.identify(docs_of(spark, [*rows, (9, long), (9, long)]), model).collect()
    assert len({(r["lang_pred"], r["score"]) for r in got[-2:]}) == 1 and got[-1]["lang_pred"] == "z"
    assert len(long) > 2 * langid.PIECE
    same = langid.Model(["a", "b"], langid.codewords(2), np.zeros((langid.DIM, 1), np.float32), np.zeros(1), np.ones(1))
    assert same.predict(["text"]) [0] == ["a"] and same.predict(["text"])[2].all()


@pytest.mark.parametrize("n", [2, 3, 4, 6, 9, 40])
def test_codewords_are_apart(n):
    code = langid.codewords(n)
    apart = (code.shape[1] - code @ code.T) / 2
    assert apart[~np.eye(n, dtype=bool)].min() >= (1 if n < 3 else 2) and (np.abs(code.sum(axis=0)) < n).all()


# -- 4 WARC -------------------------------------------------------------------------


def archive(spark):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/t-{uuid.uuid4().hex}"


def test_warc_pages(spark):
    got = sorted(tuple(r) for r in queries.op4_warc(spark, SF).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect())
    pages = pq.read_table(f"{SF}/pages.parquet").to_pylist()
    first = {}
    for p in sorted(pages, key=lambda p: p["page_id"]):
        first.setdefault(p["html"] or "", p["page_id"])
    want = []
    for p in pages:
        b = (p["html"] or "").encode()
        f = first[p["html"] or ""]
        again = len(b) >= 100 and f != p["page_id"]
        want.append((p["page_id"], len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", f if again else None))
    assert got == sorted(want)


def test_warc_edge_rows(spark):
    body = "<p>été" + "x" * 200
    rows = [(5, "http://a/\r\nWARC-Type: evil", body, 1), (3, None, body, 2), (9, "http://b", body, 3), (4, "u", None, 4),
            (6, "u", "", 5), (7, "u", "short", 6), (8, "u", "short", 7), (None, "u", body, 8), (None, "v", "z" * 300, 9),
            (10, "u", "WARC/1.1\r\n\r\n" + "\r\n\r\n" * 40 + "\x1f\x8b\x08", 10), (11, "u", "y" * 3_000_000, 11)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, sha long").repartition(3)
    folder = archive(spark)
    warc.write_archive(pages, folder)
    got = {(r["id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.read_archive(spark, folder).collect()}
    n = len(body.encode())
    assert got == {(3, n, "response", None), (5, n, "revisit", 3), (9, n, "revisit", 3), (4, 0, "response", None),
                   (6, 0, "response", None), (7, 5, "response", None), (8, 5, "response", None), (None, n, "revisit", 3),
                   (None, 300, "response", None), (10, 176, "response", None), (11, 3_000_000, "response", None)}
    before = spark.conf.get(warc.PUSHDOWN, None)
    for within in (warc.filter_pushdown, lambda _: contextlib.nullcontext()):  # filtered by the reader, or by Spark
        with within(spark):
            assert warc.open_archive(spark, folder).where("uri like 'http://a%'").first()["type"] == "revisit"
            assert warc.open_archive(spark, folder).where("type = 'revisit'").count() == 3
    assert spark.conf.get(warc.PUSHDOWN, None) == before
    assert spark.read.format("warc").option("types", "revisit").load(folder).count() == 3
    empty = archive(spark)
    warc.write_archive(pages.limit(0), empty)
    assert warc.read_archive(spark, empty).count() == 0


def test_warc_pushdown_skips_payloads(spark, tmp_path):
    rows = [{"record_id": f"<urn:{i}>", "type": "response" if i % 10 == 0 else "resource", "uri": None, "date": None,
             "refers_to": None, "digest": None, "content_type": "text/plain", "payload": bytes([65 + i % 26]) * 50_000}
            for i in range(40)]
    plain, packed, foreign = tmp_path / "a.warc", tmp_path / "b.warc.gz", tmp_path / "c.warc.gz"
    data = [h + b + b"\r\n\r\n" for h, b in map(warc.record_bytes, rows)]
    import gzip
    plain.write_bytes(b"".join(data))
    packed.write_bytes(b"".join(map(warc.gzip_member, data)))
    foreign.write_bytes(b"".join(map(gzip.compress, data)))
    for path in (plain, packed, foreign):
        reader = warc.WarcReader({"path": str(tmp_path), "types": "response"}, ["record_id", "payload"])
        got = [r for b in reader.read(warc.Files([str(path)])) for r in b.to_pylist()]
        assert [r["record_id"] for r in got] == ["<urn:0>", "<urn:10>", "<urn:20>", "<urn:30>"]
        assert all(len(r["payload"]) == 50_000 and len(set(r["payload"])) == 1 for r in got)
    import pyarrow.fs as pafs
    with pafs.LocalFileSystem().open_input_file(str(packed)) as f:
        records = warc.Records(f)
        assert sum(1 for _ in records) == 40 and records.inflated == 0
    left = warc.PushdownReader({"path": str(tmp_path)}, ["type"])
    from pyspark.sql.datasource import EqualTo, GreaterThan
    assert list(left.pushFilters([EqualTo(("type",), "response"), GreaterThan(("uri",), "a")])) == [GreaterThan(("uri",), "a")]
    assert left.accepted == {"type": {"response"}}
    with warc.filter_pushdown(spark):
        df = warc.open_archive(spark, str(tmp_path)).where("type = 'response'")
        assert df.count() == 12
        plan = df._jdf.queryExecution().executedPlan().toString()
    assert "= response" not in plan  # the reader has taken the predicate over


def test_warc_repeated_ids_and_clashing_columns(spark):
    body = "b" * 150
    rows = [(1, "u", body), (1, "u", body), (2, "v", body), (2, "v", "other " * 50), (3, "w", "short")]
    pages = spark.createDataFrame([(*r, "x", "y", b"z") for r in rows],
                                  "page_id long, url string, html string, sha string, type string, payload binary")
    folder = archive(spark)
    warc.write_archive(pages, folder)
    got = sorted((r["id"], r["payload_bytes"], r["record_type"], r["refers_to"] or 0) for r in warc.read_archive(spark, folder).collect())
    assert got == [(1, 150, "response", 0), (1, 150, "response", 0), (2, 150, "revisit", 1), (2, 300, "response", 0),
                   (3, 5, "response", 0)]


def test_queries_leave_the_session_as_it_was(spark):
    def state():
        conf = {r["key"]: r["value"] for r in spark.sql("SET").collect() if r["key"] != "spark.checkpoint.dir"}
        return conf, {(t.name, t.isTemporary) for t in spark.catalog.listTables()}

    before = state()
    for name in ("op4_warc", "op10_mixing", "op11_best_fit_packing", "op13_periodic_runs"):
        queries.QUERIES[name](spark, SF).count()
    assert state() == before


# -- 5 language-model scores --------------------------------------------------------


def test_lm_base_figures_by_force(spark):
    docs = [(r["doc_id"], r["text"], r["held"]) for r in queries.table(spark, SF, "documents").withColumn(
        "held", common.held_out("doc_id", 7, 2)).collect()]
    count = {}
    for _, t, held in docs:
        if not held:
            for w in [x.lower() for x in words(t)] + ["end"]:
                count[w] = count.get(w, 0) + 1
    n, v = sum(count.values()), len(count)
    got = {r["doc_id"]: r for r in queries.op5_lm_score(spark, SF).collect()}
    assert len(got) == len(docs)
    for d, t, held in docs:
        tok = [x.lower() for x in words(t)] + ["end"]
        r = got[d]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held, len(tok), n)
        assert r["n_known"] == sum(1 for w in tok if count.get(w))
        assert r["base_score"] == pytest.approx(sum(np.log10((count.get(w, 0) + 1) / (n + v + 1)) for w in tok), rel=1e-9)
        assert np.isfinite(r["score"]) and r["score"] < 0


def small_net(texts, epochs=2):
    sub = lm.subwords(queries.vocab_path("byte_bpe_50k.tiktoken"), bpe.PATTERN)
    ids = []
    for t in texts:
        w = lm.words_of(t.encode())
        sub.learn(w)
        ids.append(sub.ids(w))
    counts = np.bincount(np.concatenate(ids), minlength=sub.size).astype(float)
    vocab = lm.make_vocab(counts, sub.end, sub.opens, ids)
    return lm.fit(ids, vocab, sub.end, epochs), vocab, ids, sub.end


def test_lm_scores_every_token_once_and_sums_to_one():
    texts = [t for t in pq.read_table(f"{SF}/documents.parquet")["text"].to_pylist()[:60]]
    net, vocab, ids, end = small_net(texts)
    # the shares of the ids of a class, and hence all ids, sum to one after every class
    for row in vocab.log_follow:
        assert np.allclose(np.bincount(vocab.cls, weights=np.exp(row.astype(float)), minlength=vocab.classes)[np.unique(vocab.cls)], 1, atol=1e-4)
    got = lm.log10_probs(net, vocab, ids[:12], end)
    for t, s in zip(ids[:12], got):
        # token by token, by the plain forward pass over its own window
        total = 0.0
        inputs = np.concatenate(([end], t[:-1]))
        for p in range(len(t)):
            b = p // lm.BLOCK
            window = inputs[max(0, (b - 1) * lm.BLOCK):p + 1]
            x = net.p["emb"][vocab.row[window]].astype(np.float64)
            q, k, v = x[-1] @ net.p["q"] / np.sqrt(lm.WIDTH), x @ net.p["k"], x @ net.p["v"]
            a = np.exp(k @ q + net.p["dist"][len(window) - 1 - np.arange(len(window))])
            h = x[-1] + (a / a.sum()) @ v @ net.p["o"]
            z = h @ net.p["out"] + net.p["bias"]
            total += z[vocab.cls[t[p]]] - np.log(np.exp(z).sum()) + vocab.log_follow[vocab.cls[inputs[p]], t[p]]
        assert s == pytest.approx(total / np.log(10), rel=1e-4)


def test_lm_reads_context():
    texts = [t for t in pq.read_table(f"{SF}/documents.parquet")["text"].to_pylist()]
    net, vocab, ids, end = small_net(texts[:120], epochs=4)
    rng = np.random.default_rng(0)
    out = ids[-60:]
    mixed = [np.append(rng.permutation(t[:-1]), t[-1]).astype(t.dtype) for t in out]
    n = sum(map(len, out))
    assert lm.log10_probs(net, vocab, out, end).sum() / n > lm.log10_probs(net, vocab, mixed, end).sum() / n + 0.1


def test_lm_window_and_classes():
    # texts of period 20: only a window of 16 or more ids before the position tells the next one
    rng = np.random.default_rng(4)
    end, size = 300, 301
    texts = [np.append(np.tile(rng.integers(0, 6, 20), 12), end) for _ in range(420)]
    counts = np.bincount(np.concatenate(texts), minlength=size).astype(float)
    vocab = lm.make_vocab(counts, end, np.arange(size) % 2 == 0, texts)
    net = lm.fit(texts[:400], vocab, end, epochs=8)
    assert lm.log10_probs(net, vocab, texts[400:], end).sum() / 20 / 241 > 0.9 * np.log10(1 / 6)
    # the 150 most frequent ids are told apart by the model itself
    vocab = lm.make_classes(np.arange(50_000, 0, -1).astype(float), 49_999, np.arange(50_000) % 2 == 0)
    assert len(set(vocab.cls[:150].tolist())) == 150 and not set(vocab.cls[:150]) & set(vocab.cls[150:])


def test_lm_gradients():
    rng = np.random.default_rng(0)
    net = lm.Attention(30, 7)
    net.p = {k: v.astype(np.float64) + 0.01 * rng.normal(size=v.shape) for k, v in net.p.items()}
    rows, first = rng.integers(0, 30, (4, lm.BLOCK)), np.array([True, False, True])
    target, weight = rng.integers(0, 7, (3, lm.BLOCK)), np.ones((3, lm.BLOCK))
    weight[1, 9:] = 0
    _, g = net.gradients(rows, first, target, weight)
    for name, v in net.p.items():
        at = (rows[1, 2], 3) if name == "emb" else tuple(rng.integers(0, s) for s in v.shape)
        old = v[at]
        v[at] = old + 1e-5
        up = net.gradients(rows, first, target, weight)[0]
        v[at] = old - 1e-5
        down = net.gradients(rows, first, target, weight)[0]
        v[at] = old
        assert (up - down) / 2e-5 == pytest.approx(g[name][at], rel=1e-2, abs=1e-7)


def test_lm_edge_rows(spark):
    got = lm.score(docs_of(spark, EDGE), F.col("doc_id") == 6, queries.vocab_path("byte_bpe_50k.tiktoken"), bpe.PATTERN).collect()
    assert len(got) == len(EDGE) and sum(r["held_out"] for r in got) == 1
    assert {r["n_tokens"] for r in got if r["id"] in (1, 2, 3)} == {1}
    none = lm.score(docs_of(spark, EDGE), F.lit(True), queries.vocab_path("byte_bpe_50k.tiktoken"), bpe.PATTERN).collect()
    assert {(r["n_known"], r["train_tokens"]) for r in none} == {(0, 0)} and all(np.isfinite(r["score"]) for r in none)
    assert lm.score(docs_of(spark, EDGE).limit(0), F.lit(False), queries.vocab_path("byte_bpe_50k.tiktoken"), bpe.PATTERN).count() == 0


def test_lm_learns_from_all_training_texts(spark, monkeypatch):
    path = queries.vocab_path("byte_bpe_50k.tiktoken")
    sub = lm.subwords(path, bpe.PATTERN)
    long = "alpha beta gamma " * 40_000
    assert len(long) > 2 * (1 << 18)  # longer texts were left out once
    rows = [(1, long), (2, long[6:]), (3, "alpha beta gamma " * 60), (4, "gamma beta alpha " * 60), (5, None), (6, "")]
    # texts over TRAIN_BYTES teach the order of words: the same words in reverse score far lower
    got = {r["id"]: r["score"] / r["n_tokens"] for r in lm.score(docs_of(spark, rows), F.col("doc_id").isin(3, 4), path, bpe.PATTERN).collect()}
    assert got[3] > got[4] + 1
    # the pairs are those of all texts; the picked windows lie in all of a text, and grow with the texts
    ids = {}
    for i, t in rows:
        words = lm.words_of((t or "").encode())
        sub.learn(words)
        ids[i] = sub.ids(words)
    vocab = lm.make_classes(np.bincount(np.concatenate(list(ids.values())), minlength=sub.size).astype(float), sub.end, sub.opens)
    (cells, n), windows = lm._read_corpus(docs_of(spark, rows).select(F.col("doc_id").alias("h"), "text"), vocab, 8, path, bpe.PATTERN)
    want = {}
    for t in ids.values():
        for a, b in zip([sub.end, *t[:-1].tolist()], t.tolist()):
            cell = int(vocab.cls[a]) * sub.size + b
            want[cell] = want.get(cell, 0) + 1
    assert dict(zip(cells.tolist(), n.tolist())) == want
    tokens = {r["h"]: r["n"] for r in windows.groupBy("h").agg(F.sum("tokens").alias("n")).collect()}
    monkeypatch.setattr(lm, "START_TOKENS", 1 << 13)  # the rest is trained on by Spark's tasks
    monkeypatch.setattr(lm, "TASK_TOKENS", 1 << 13)
    net, vocab = lm._train_on_spark(windows, vocab), lm.with_shares(vocab, cells, n)
    right, wrong = lm.log10_probs(net, vocab, [ids[3], ids[4]], sub.end)
    assert right > wrong + 10
    for i in (1, 2):
        assert tokens[i] == pytest.approx(len(ids[i]) / 8, rel=0.3)


def test_lm_stretches_keep_their_context():
    text = np.append(np.arange(1000, 1000 + 3 * lm.BLOCK * lm.STRETCH + 5), 7)
    inputs, targets, weight, first = lm.blocks([text], 7)
    seen = 0
    for k, (i, t, w, f) in enumerate(lm.stretches(text, -3, 1, 7)):
        low = k * lm.STRETCH - (k > 0)
        assert np.array_equal(i, inputs[low:low + len(i)]) and np.array_equal(t, targets[low:low + len(i)])
        assert f.tolist() == [True] + [False] * (len(f) - 1) and (k == 0 or not w[0].any())
        seen += int(w.sum())
    assert seen == len(text)


def test_lm_trains_on_every_token(spark, monkeypatch):
    path, seen, train = queries.vocab_path("byte_bpe_50k.tiktoken"), [], lm._train_on_spark
    sub = lm.subwords(path, bpe.PATTERN)
    rows = [(i, f"alpha beta gamma delta{i} " * (10 * i)) for i in range(1, 31)]

    def spy(windows, vocab):
        seen.append(windows.agg(F.sum("tokens")).first()[0])
        return train(windows, vocab)

    monkeypatch.setattr(lm, "START_TOKENS", 1 << 10)
    monkeypatch.setattr(lm, "TASK_TOKENS", 1 << 10)
    monkeypatch.setattr(lm, "_train_on_spark", spy)
    assert lm.score(docs_of(spark, rows), F.col("doc_id") == 3, path, bpe.PATTERN).count() == 30
    total = 0
    for i, t in rows:
        words = lm.words_of(t.encode())
        sub.learn(words)
        total += len(sub.ids(words)) * (i != 3)
    assert total > 10 * lm.START_TOKENS and seen == [total]


def test_lm_packed_stretches_are_the_same_blocks():
    for end in (7, 100_000):
        text = np.append(np.arange(1000, 1000 + 3 * lm.BLOCK * lm.STRETCH + 5), end)
        packed = list(lm.packed_stretches(text, -3, 1, end))
        got = lm._windows([x for _, _, x in packed], [k for k, _, _ in packed], end)
        want = [np.concatenate(x) for x in zip(*lm.stretches(text, -3, 1, end))]
        assert all(np.array_equal(a, b) for a, b in zip(got, want))
        assert [n for _, n, _ in packed] == [int(w.sum()) for _, _, w, _ in lm.stretches(text, -3, 1, end)]


# -- 6 exact top-k ------------------------------------------------------------------


def best_by_force(rows, k, query):
    usable = {(i, tuple(int(np.floor(256 * float(x))) for x in v)) for i, v in rows
              if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    out = []
    for i, q in usable:
        if query(i):
            s = sorted((-sum(a * b for a, b in zip(q, w)), j) for j, w in usable if j != i and len(w) == len(q))
            out += [(i, r + 1, j, -x) for r, (x, j) in enumerate(s[:k])]
    return sorted(out)


@pytest.mark.parametrize("shard,block", [(4096, 1024), (37, 3)])
def test_top_k_by_force(spark, monkeypatch, shard, block):
    monkeypatch.setattr(maxscore, "SHARD_ROWS", shard)
    monkeypatch.setattr(maxscore, "LANE_ROWS", 4 * shard)
    monkeypatch.setattr(maxscore, "MANY_LANES", 2)
    monkeypatch.setattr(maxscore, "BLOCK_QUERIES", block)
    monkeypatch.setattr(maxscore, "DEPTHS", (2, 8))
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=12).round(1).tolist()) for i in range(300)]
    rows += [(300 + i, [0.5] * 12) for i in range(40)] + [(350, None), (400, [None] * 12), (450, [float("nan")] * 12),
                                                          (500, [0.1, 0.2]), (550, [0.3, -0.2]), (550, [0.3, -0.2]), (None, [1.0] * 12),
                                                          (600, [-1.0] * 12), (650, [0.0] * 12), (700, []), (701, [])]
    rows += [(1000 + i, (np.eye(12)[i % 12] * 9 + rng.normal(size=12) / 50).tolist()) for i in range(200)]  # postings end early
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("id", F.lit("clash"))
    got = sorted(tuple(r) for r in maxscore.top_k(df, F.col("id") % 50 == 0, k=5).collect())
    assert got == best_by_force(rows, 5, lambda i: i % 50 == 0)
    assert maxscore.top_k(df.limit(0), F.col("id") % 50 == 0).count() == 0


def test_top_k_of_large_components(spark):
    from fractions import Fraction
    rng = np.random.default_rng(8)
    rows = [(i, (rng.normal(size=4) * 10.0 ** rng.integers(-2, 15, 4)).tolist()) for i in range(120)]
    rows += [(400, [1e14, 1.0, 0.0, 0.0]), (151, [1e12] * 4), (152, [1e12] * 4), (153, [-1e12] * 4), (200, [1e12] * 4),
             (250, [1.7e308, 0.1, -1.0, 3.0]), (251, [1.7e308, -5e-324, 0.0, 1e300]), (252, [-1.7e308, 0.1, 0.0, 0.0]),
             (300, [float("inf"), 0.0, 0.0, 0.0]), (350, [2.0 ** 45, 2.0 ** 45 + 1, 0.5, -0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = {(i, tuple(int(Fraction(x) * 256 // 1) for x in v)) for i, v in rows if all(np.isfinite(x) for x in v)}
    want = []
    for i, q in whole:
        if i % 50 == 0:
            s = sorted((-sum(a * b for a, b in zip(q, w)), j) for j, w in whole if j != i)[:5]
            want += [(i, r + 1, j, max(-(1 << 63), min((1 << 63) - 1, -x))) for r, (x, j) in enumerate(s)]
    assert sorted(map(tuple, maxscore.top_k(df, F.col("id") % 50 == 0, k=5).collect())) == sorted(want)
    assert any(abs(x[3]) >= (1 << 63) - 1 for x in want)
    numbers = sorted([0, 1, -1, 255, 256, -256, 1 << 70, -(1 << 70), (1 << 900) + 1, 1 << 900])
    assert sorted(numbers, key=maxscore.order_key) == numbers


def test_top_k_reads_postings_in_part():
    rng = np.random.default_rng(3)
    x = np.floor(256 * (np.eye(16)[rng.integers(0, 16, 4000)] + rng.normal(size=(4000, 16)) / 40))
    shard = maxscore.Shard(x, np.arange(4000))
    q = x[7]
    exact = x @ q
    threshold = float(np.sort(exact)[-5])
    order = np.argsort(-shard.bounds(q))[:1]
    met = shard.met(q, order, float(np.sort(shard.bounds(q))[:-1].sum()), threshold)
    rows, scores = shard.search(q, threshold, 7)
    assert (met is None or len(met) < 4000) and len(rows) < 200 and (exact[rows] == scores).all()
    assert set(np.flatnonzero(exact >= threshold).tolist()) - {7} <= set(rows.tolist())


# -- 7 secrets ----------------------------------------------------------------------


def base_by_force(text):
    text = text or ""
    found = []
    for kind, (name, pattern, group, least) in enumerate((
            ("assign", r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|"
                       r"[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
            ("access", r"AKIA[A-Z0-9]+", 0, 20), ("hex", r"[0-9a-f]+", 0, 24))):
        found += [(m.start(), kind, m.end(), name) for m in re.finditer(pattern, text) if len(m.group(group)) >= least]
    return ",".join(f"{n}:{s}:{e}" for s, _, e, n in sorted(found))


KEY, LONG = "AKIA" + "Q7X2" * 4, "wJalrXUtnFEMI4K7MDENGbPxRfiCYz9q8Lk3Vt5s"


def test_secrets_base_by_force(spark):
    texts = [None, "", "Password = hunter22 passwd:abc token: 'abcdef' API_KEY=\"x.y-z/1\" apikey  :  abcdef",
             "ſecret=abcdef secret=abcdef Kтoken=abcdef", f"{KEY} AKIA123 {KEY}{KEY}", "0123456789abcdef" * 2 + "g" + "a" * 23,
             "é" * 40 + "token=ffffffffffffffffffffffffffffff", "token=token=abcdefg secret: : x", "password=\nabcdef", "x" * 100_000]
    docs = docs_of(spark, list(enumerate(texts)))
    for r in secret_scan.scan(docs).collect():
        assert r["base_sha256"] == hashlib.sha256(base_by_force(texts[r["id"]]).encode()).hexdigest()
        for part in base_by_force(texts[r["id"]]).split(","):
            assert part in r["spans"]
    every = {r["doc_id"]: r["text"] for r in queries.table(spark, SF, "documents").collect()}
    for r in queries.op7_secret_scan(spark, SF).collect():
        assert r["base_sha256"] == hashlib.sha256(base_by_force(every[r["doc_id"]]).encode()).hexdigest()


def kinds(text):
    return sorted(k for k in (x.split(":")[0] for x in secret_scan.listing(secret_scan.find(text)[1]).split(",")) if k)


def test_secrets_link_only_complementary_parts():
    assert kinds(f"note {LONG} end") == []                                     # a lone random string
    assert kinds(f"{KEY} and {LONG}") == ["access", "secret"]                   # id with its secret
    assert kinds(f"user: alice {LONG}") == []                                   # no endpoint
    assert kinds(f"user: alice {LONG} https://db.example.net/x") == ["endpoint", "identifier", "secret"]
    assert kinds("user: alice https://db.example.net/x") == []                  # no secret
    assert kinds(f"{KEY}\n\n{LONG}") == ["access"]                              # another scope
    assert kinds(f"{KEY}{' x' * 15000}{LONG}") == ["access", "secret"]          # anywhere in the scope
    assert kinds(f"{KEY} {'q7x2m9k4wz8r5t1v' * 2}") == ["access", "secret"]       # one letter case
    assert kinds(f"{KEY} some-long-file-name-2024 ABCDEFGHIJKLMNOPQRST") == ["access"]
    assert kinds(f"{KEY} password=abcdef1 https://h.example") == ["access", "assign", "endpoint"]


def linked_by_force(text):
    """All spans: every weak part is tried against all other parts of its scope, one by one."""
    base = [(int(s), int(e), k) for k, s, e in (x.split(":") for x in base_by_force(text).split(",") if x)]
    cuts = [m.end() for m in re.finditer(r"\n[ \t\r]*\n", text)]
    scope = lambda x: sum(c <= x[0] for c in cuts)
    hits = lambda x: any(x[0] < e and s < x[1] for s, e, _ in base)
    names = [m.span() for m in secret_scan.IDENTIFIER.finditer(text) if not hits(m.span())]
    loose = [m.span() for m in secret_scan.SECRET.finditer(text) if secret_scan.looks_random(m.group()) and not hits(m.span())]
    places = [m.span() for m in secret_scan.ENDPOINT.finditer(text)]
    access, strong = [x for x in base if x[2] == "access"], [x for x in base if x[2] != "access"]
    out = [(s, e, k) for s, e, k in base]

    def mates(x, others):
        return any(scope(x) == scope(y) for y in others)

    whole = [n for n in names if mates(n, loose + strong) and mates(n, places)]
    out += [(*n, "identifier") for n in whole]
    out += [(*q, "secret") for q in loose if mates(q, access) or mates(q, whole)]
    out += [(*p, "endpoint") for p in places
            if mates(p, whole) or any(scope(a) == scope(p) and mates(a, loose + strong) for a in access)]
    order = {k: i for i, k in enumerate(secret_scan.KINDS)}
    return ",".join(f"{k}:{s}:{e}" for s, e, k in sorted(out, key=lambda x: (x[0], order[x[2]], x[1])))


def test_secrets_links_by_force(spark):
    rng = np.random.default_rng(12)
    parts = [KEY, LONG, "q7x2m9k4wz8r5t1v", "user: alice", "login=bob.b", "account_id = 77123", "https://db.example.net/x?y=1",
             "postgres://h:5432/d", "password=abcdef1", "deadbeef" * 4, "plain words here", "é ü", "\n", "\n\n", "\n \t\n", "x " * 700,
             f"secret: {LONG}", f"client_id:{LONG}", f"s3://{KEY}/b", "AKIASHORT", "Token=", "a" * 30]
    texts = [" ".join(rng.choice(parts, rng.integers(1, 14))) for _ in range(600)]
    texts += ["\n\n".join(rng.choice(parts, rng.integers(2, 30))) for _ in range(100)]
    linked = 0
    for r in secret_scan.scan(docs_of(spark, list(enumerate(texts)))).collect():
        assert r["spans"] == linked_by_force(texts[r["id"]]), texts[r["id"]]
        linked += r["n_weak"] > 0
    assert linked > 150


def test_secrets_redaction(spark):
    rows = [(1, f"a {KEY} b {LONG} c"), (2, "nothing here"), (3, None), (4, "password=abcdef")]
    docs = docs_of(spark, rows)
    got = {r["doc_id"]: r["text"] for r in secret_scan.redacted(docs).collect()}
    assert got == {1: "a <access> b <secret> c", 2: "nothing here", 3: None, 4: "<assign>"}
    assert secret_scan.redacted(docs).columns == docs.columns and secret_scan.scan(docs.limit(0)).count() == 0


# -- 8 BPE --------------------------------------------------------------------------


def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(queries.vocab_path())
    rng = np.random.default_rng(0)
    extra = ["", "a" * 997, "<|endoftext|>x <|endoftext|>", "\0\0<|endoftext|> \0\0", " " * 90 + "\n\n\t x", "don't I'LL we've",
             "日本語テキスト😀😀", "ab" * 300, "½ ² ٣ ⅷ \x85 ", "====----" * 20]
    extra += ["".join(chr(c) for c in rng.choice([*range(32, 127), *range(160, 900), 10, 0x4E00, 0x1F600], 60)) for _ in range(60)]
    rows = list(enumerate(extra + pq.read_table(f"{SF}/documents.parquet")["text"].to_pylist())) + [(None, None)]
    docs = docs_of(spark, rows)
    ids = bpe.encode(docs, queries.vocab_path())
    texts = dict(rows)
    for r in ids.collect():
        want = tok.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["token_ids"] == want
    back = {r["doc_id"]: r["text"] for r in bpe.decode(ids, queries.vocab_path()).collect()}
    assert back == {k: v or "" for k, v in texts.items()}
    for r in bpe.digest(docs, queries.vocab_path()).collect():
        want = tok.encode(texts[r["id"]] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(want)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(tok.decode(want, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.digest(docs.limit(0), queries.vocab_path()).count() == 0


def test_bpe_last_token_is_unique():
    voc = bpe.vocabulary(queries.vocab_path())
    for piece in (b" unbelievable", b"anthly", "größte".encode(), b"aaaaaaaaaaaaa"):
        last = [None] * (len(piece) + 1)
        for i in range(1, len(piece) + 1):
            fits = [t for a in range(i) if (t := voc.id_of.get(piece[a:i])) is not None
                    and (a == 0 or (last[a] is not None and voc.compatible(last[a], t)))]
            assert len(fits) == 1
            last[i] = fits[0]
        assert voc.encode_long(piece).tolist() == voc.encode_wide([piece])[0].tolist()
    assert voc.decode(np.array([255, 254])) == bytes(voc.bytes[255] + voc.bytes[254]).decode("utf-8", "replace")


# -- 1 parameters of the vector tables -------------------------------------------


def test_vector_plan_keeps_its_recall_at_low_thresholds():
    wide = crosspolytope.plan(10 ** 9, 64, 0.6)
    assert wide.hashes < crosspolytope.plan(10 ** 9, 64, 0.95).hashes
    assert crosspolytope.plan(10 ** 9, 64, 0.95).tables < 342
    with pytest.raises(ValueError):
        crosspolytope.plan(10 ** 9, 64, -0.9)


# -- 9 toxicity ---------------------------------------------------------------------


def test_toxicity_held_out_accuracy(spark):
    docs = queries.table(spark, "/root/testdata/sf0.1", "documents")
    labels = queries.table(spark, "/root/testdata/sf0.1", "labels")
    chain = toxicity.train(docs, labels.where("doc_id % 4 <> 0"))
    got = toxicity.score(docs.join(labels.where("doc_id % 4 = 0"), "doc_id").withColumnRenamed("toxic", "truth"), chain).toPandas()
    clean = got[(got.truth == 0)]
    assert clean.toxic.mean() <= 0.005
    assert got[got.truth == 1].toxic.mean() >= 0.9


def test_toxicity_sample_keeps_rare_labels(spark):
    name = lambda i: chr(97 + i % 26) + "q" + chr(97 + i // 26 % 26) + chr(97 + i // 676)
    rows = [(i, f"vequa lowei {name(i)}" if i % 100 == 0 else f"a kind word {name(i)}" + " vequa" * (i % 50 == 7)) for i in range(4000)]
    docs = docs_of(spark, rows + [(0, f"other text {i}") for i in range(500)] + [(100, "vequa lowei again")] * 300)
    labels = spark.createDataFrame([(i, 1 if i % 100 == 0 else 0) for i, _ in rows] * 2, "doc_id long, toxic int")
    chain = toxicity.train(docs, labels, max_rows=300)
    assert {b"lowei"} <= chain.vocab.keys()
    got = {r["doc_id"]: r["toxic"] for r in toxicity.score(docs.where("doc_id > 0"), chain).collect()}
    assert all(got[i] == (i % 100 == 0) for i, _ in rows if i)


def test_chain_by_plain_fit():
    """The links equal Newton fits of every row by itself, later ones on out-of-fold probabilities."""
    rng = np.random.default_rng(2)
    x = (rng.random((200, 5)) < 0.4).astype(float)
    y = np.stack([x[:, 0] * (rng.random(200) < 0.8), np.maximum(x[:, 1], x[:, 0] * (rng.random(200) < 0.5))], axis=1)
    folds, weights = np.arange(200) % toxicity.FOLDS, rng.integers(1, 4, 200).astype(float)
    chain = toxicity.fit_chain(x, y, {}, ["a", "toxic"], folds, weights)
    every = np.repeat(np.arange(200), weights.astype(int))
    one = np.ones(len(every))
    assert np.allclose(chain.weights[0], toxicity.fit_logistic(x[every], y[every, 0], one), atol=1e-6)
    rated = np.zeros(200)
    for f in range(toxicity.FOLDS):
        rest = every[folds[every] != f]
        w = toxicity.fit_logistic(x[rest], y[rest, 0], np.ones(len(rest)))
        rated[folds == f] = toxicity.sigmoid(x[folds == f] @ w[:-1] + w[-1])
    both = np.hstack([x, rated[:, None]])
    assert np.allclose(chain.weights[1], toxicity.fit_logistic(both[every], y[every, 1], one), atol=1e-5)


def test_toxicity_chain_and_edges(spark):
    bad = ["you idiot moron", "pathetic loser clown", "scum and trash", "vequa veju lowei"]
    name = lambda i: chr(97 + i % 26) + "q" + chr(97 + i // 26)
    rows = [(i, f"{bad[i % 4]} {name(i)}") for i in range(60)] + [(100 + i, f"a kind word {name(i)}") for i in range(100)]
    labels = spark.createDataFrame([(i, 1 if i < 60 else 0) for i, _ in rows] + [(None, 1), (3, None)], "doc_id long, toxic int")
    docs = docs_of(spark, rows + [(None, "you idiot moron"), (300, None), (301, ""), (302, "a kind word " * 5000)])
    chain = toxicity.train(docs, labels)
    got = {(r["doc_id"], r["text"]): r for r in toxicity.score(docs, chain).collect()}
    assert all(got[i, t]["toxic"] == (i < 60) for i, t in rows)
    assert got[None, "you idiot moron"]["toxic"] and not got[300, None]["toxic"] and not got[301, ""]["toxic"]
    assert got[0, rows[0][1]]["p_insult"] > 0.5 > got[3, rows[3][1]]["p_insult"]
    # later links read earlier probabilities: one more weight each
    assert [len(w) for w in chain.weights] == [len(chain.vocab) + k + 1 for k in range(len(chain.names))]
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 103
    none = toxicity.train(docs, labels.where("toxic = 0"))
    assert toxicity.score(docs, none).where("toxic").count() == 0
    assert toxicity.drop_toxic(docs.limit(0), labels.limit(0)).count() == 0


# -- 10 mixing ----------------------------------------------------------------------


def mix_by_force(rows, weights=(1, 2, 3), epochs=3):
    size = [len(words(t)) for _, t, _ in rows]
    names = sorted({s for *_, s in rows if s is not None}) + ([None] if any(s is None for *_, s in rows) else [])
    total = {s: sum(n for n, r in zip(size, rows) if r[2] == s) for s in names}
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, free, left = {}, list(names), sum(size)
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        full = [s for s in free if share[s] >= epochs * total[s]]
        if not full:
            target |= share
            break
        for s in full:
            target[s] = epochs * total[s]
            left -= target[s]
            free.remove(s)
    return size, total, target


def test_mixing(spark):
    rng = np.random.default_rng(2)
    rows = [(i, " ".join("w" for _ in range(int(rng.integers(1, 40)))), "s1" if rng.random() < 0.4 else f"s{rng.integers(2, 8)}")
            for i in range(3000)]
    rows += [(4000 + i, "a b c", None) for i in range(30)] + [(5000, None, "s1"), (5001, "", "zero"), (None, "q q", "s2"),
                                                             (6000, "x y", "Äs")]
    docs = docs_of(spark, [(i, t, "en", s) for i, t, s in rows])
    got = mixing.mix(docs).toPandas()
    size, total, target = mix_by_force([(i, t, s) for i, t, s in rows])
    assert sorted(got["size"]) == sorted(size)
    for s, g in got.groupby(got["source"].fillna("\0none")):
        s = None if s == "\0none" else s
        assert set(g.source_size) == {total[s]} and g.target.iloc[0] == pytest.approx(target[s])
        assert (g.taken <= 3 * g["size"]).all() and ((g["size"] == 0) | (g.taken % g["size"].clip(lower=1) == 0)).all()
        assert abs(g.taken.sum() - target[s]) <= 80
    assert got.taken.sum() <= sum(size)
    again = mixing.mix(docs.repartition(5)).toPandas()
    order = ["id", "source", "size", "taken"]
    assert got[order].sort_values(order).reset_index(drop=True).equals(again[order].sort_values(order).reset_index(drop=True))
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    n = mixed.groupBy("doc_id").count().toPandas().set_index("doc_id")["count"]
    one = got[got.id.notna() & (got.taken > 0)]
    assert ((one.taken // one["size"]).to_numpy() == n.reindex(one.id).to_numpy()).all()


def test_mixed_documents_are_in_the_order_of_the_queue(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BIN_ROWS", 50)
    monkeypatch.setattr(mixing, "EDGE_ROWS", 2)
    rng = np.random.default_rng(5)
    rows = [(i, "w " * int(rng.integers(1, 30)), "en", "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(1500)]
    docs = docs_of(spark, rows)
    got = mixing.mix(docs).toPandas().set_index("id")
    mixed = [r["doc_id"] for r in mixing.mixed_documents(docs).collect()]
    assert len(mixed) == (got.taken // got["size"]).sum()
    read, finish = {}, []
    for i in mixed:
        s = got.source[i]
        read[s] = read.get(s, 0) + got["size"][i]
        finish.append(read[s] / got.target[i])
    assert all(a <= b + 1e-9 for a, b in zip(finish, finish[1:]))        # one global order
    assert sum(a != b for a, b in zip(mixed, mixed[1:])) > 0.95 * len(mixed)  # copies do not lie side by side
    plain = mixing.EDGE_ROWS
    monkeypatch.setattr(mixing, "EDGE_ROWS", 1 << 16)
    assert plain == 2 and mixing.mix(docs).toPandas().set_index("id").taken.sort_index().equals(got.taken.sort_index())


def test_mixing_many_sources(spark):
    rows = [(i, "w " * (1 + i % 5), "en", f"{i % 997:x}" if i % 13 else None) for i in range(3000)]
    got = mixing.mix(docs_of(spark, rows)).toPandas()
    _, total, target = mix_by_force([(i, t, s) for i, t, _, s in rows])
    assert len(total) > 900
    for s, g in got.groupby(got["source"].fillna("\0none")):
        s = None if s == "\0none" else s
        assert set(g.source_size) == {total[s]} and g.target.iloc[0] == pytest.approx(target[s])


def test_mixing_edges(spark):
    assert mixing.mix(docs_of(spark, EDGE).limit(0)).count() == 0
    assert mixing.mixed_documents(docs_of(spark, EDGE).limit(0)).count() == 0
    nothing = docs_of(spark, [(1, None), (2, "")])
    assert {(r["size"], r["taken"], r["target"]) for r in mixing.mix(nothing).collect()} == {(0, 0, 0.0)}
    same = docs_of(spark, [(1, "a b c", "en", "x")] * 9 + [(2, "a b c d", "en", "y")])
    got = mixing.mix(same).toPandas()
    assert len(got) == 10 and got.taken.sum() <= got["size"].sum()


# -- queries and pipeline -----------------------------------------------------------


def test_queries_equal_their_sql(spark):
    from oracles.compare import compare, duck
    con = duck(SF)
    for name, sql in queries.ORACLES.items():
        got = queries.QUERIES[name](spark, SF)
        cols = [c[0] for c in con.execute(sql).description]
        r = compare(got.select(*cols), con, sql)
        assert r["cols_match"] and r["match"], (name, r)


def test_pipeline_stage_by_stage(spark):
    folder = archive(spark)
    docs = queries.table(spark, SF, "documents")
    columns = docs.columns
    before = docs.toPandas()
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        after = docs.toPandas()
        if name == "toxicity":
            flagged = toxicity.score(queries.table(spark, SF, "documents"), toxicity.train(
                queries.table(spark, SF, "documents"), queries.table(spark, SF, "labels"))).where("toxic").select("doc_id").toPandas()
            assert set(after.doc_id) == set(before.doc_id) - set(flagged.doc_id)
        if name == "simhash":
            want = groups_by_force(list(zip(before.doc_id, before.text)))
            assert sorted(after.doc_id) == sorted({c for _, _, c in want})
        if name == "secrets":
            assert dict(zip(after.doc_id, after.text)) == {i: secret_scan.redact(t) for i, t in zip(before.doc_id, before.text)}
        if name == "mixing":
            size = {i: len(words(t)) for i, t in zip(before.doc_id, before.text)}
            times = after.doc_id.value_counts()
            assert times.max() <= 3 and set(after.doc_id) <= set(before.doc_id)
            assert sum(size[i] * n for i, n in times.items()) <= sum(size.values())
        if name == "bpe":
            enc = bpe.Encoder(bpe.vocabulary(queries.vocab_path()))
            want = dict(zip(before.doc_id, (x.tolist() for x in enc.encode(before.text.tolist()))))
            assert len(after) == len(before) and all(list(x) == want[i] for i, x in zip(after.doc_id, after.token_ids))
        else:
            assert docs.columns == columns
        before = after
    run = corpus_pipeline.run(spark, SF)
    assert run.count() == len(before)


def test_spark_entry_registers_all():
    import __spark_entry__ as entry
    names = set(entry.queries())
    assert {"pipeline", *queries.QUERIES} <= names and set(queries.ORACLES) <= set(entry.oracle_sql())
    for n in range(1, 11):
        assert sum(re.match(rf"op{n}_", x) is not None for x in names) == 1


def test_pipeline_on_edge_rows_and_an_empty_table(spark):
    """Stages neither fail on NULLs, empty and long texts, repeats and clashing columns nor lose other columns."""
    rows = [*EDGE, (40, f"{KEY} and {LONG} here " + "w " * 50), (41, f"{KEY} and {LONG} here " + "w " * 50)]
    for given in (docs_of(spark, rows), docs_of(spark, rows).limit(0)):
        docs, folder = given, archive(spark)
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, docs, SF).write.parquet(f"{folder}/{name}")
            docs = spark.read.parquet(f"{folder}/{name}")
            if name != "bpe":
                assert docs.columns == given.columns
            if name == "secrets" and docs.count():
                assert not any(LONG in (r["text"] or "") for r in docs.collect())
                assert {r["text"] for r in docs.collect()} >= {None} or docs.where("text IS NULL").count() == 0
        assert "token_ids" in docs.columns and (docs.count() > 0) == (given.count() > 0)
