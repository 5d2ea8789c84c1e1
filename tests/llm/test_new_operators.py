"""Whitening, token-id planes and periodic runs against literal versions."""

from __future__ import annotations

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fieldloom.llm import idplanes, oracle, periodic, queries, whitening

BYTES, WORDS = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/word_bpe_49k.json"
CLASH = "doc_id bigint, text string, key string, runs int, kept int, ids int, h int, v int, n int, component int"


def clash(rows):
    return [(*r, "k", 1, 2, 3, 4, 5, 6, 7) for r in rows]


# periodic runs


def literal_runs(w, least=12):
    """All lags, place by place; the smallest period of each stretch."""
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            if w[i] == w[i + q]:
                j = i
                while j + q < len(w) and w[j] == w[j + q]:
                    j += 1
                if j - i + q >= max(least, 2 * q):
                    found.setdefault((i, j - i + q), q)
                i = j
            i += 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def repeated(rng):
    n, v, kind = rng.randint(0, 220), rng.choice([1, 2, 2, 3, 5, 30]), rng.randrange(6)
    w = [rng.randrange(v) for _ in range(n)]
    if kind == 0 and n:
        a = rng.randrange(n)
        p = 1 + (n - a) // rng.randint(2, 10)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    elif kind == 1:
        u = [rng.randrange(2) for _ in range(rng.randint(1, 5))]
        w = (u * 60)[: rng.randint(0, 110)] + (u[::-1] * 60)[rng.randrange(3) : rng.randint(3, 110)]
    elif kind == 2:
        a, w = [0], [0, 1]
        while len(w) < n:
            a, w = w, w + a
    elif kind == 3:
        u = [0, 1] * rng.randint(1, 50) + [0] * rng.randint(0, 2)
        w = u + [rng.randrange(3)] * rng.randint(0, 2) + u + u[: rng.randint(0, len(u))]
    elif kind == 4:
        w = [0]
        while len(w) < n:
            w += [1 - x for x in w]
    return w


@pytest.mark.parametrize("least", [12, 4, 30])
def test_runs_of_many_documents_at_once(least):
    rng = random.Random(least)
    for _ in range(150):
        docs = [repeated(rng) for _ in range(rng.randint(1, 4))]
        w, hi = np.array([x for d in docs for x in d], np.int64), np.cumsum([len(d) for d in docs])
        lo = hi - [len(d) for d in docs]
        if len(w):
            got = [tuple(map(int, r)) for r in periodic.find_runs(w, lo, hi, least)]
            assert sorted(got) == sorted((s + int(a), n, q) for d, a in zip(docs, lo, strict=True) for s, n, q in literal_runs(d, least))


def test_rare_words_split_until_nothing_changes():
    w = np.array([1, 2, 1, 2, 9, 1, 2, 3, 3, 2, 1, 8, 5, 5, 5, 5])
    lo, hi = periodic.split_rare(w, np.array([0]), np.array([16]), 2)
    # 9 and 8 occur once; in 1 2 3 3 2 1 every word occurs twice
    assert sorted(zip(lo.tolist(), hi.tolist(), strict=True)) == [(0, 4), (5, 11), (12, 16)]
    lo, hi = periodic.split_rare(np.array([1, 2, 3, 9, 3, 2, 4, 4]), np.array([0]), np.array([8]), 2)
    assert sorted(zip(lo.tolist(), hi.tolist(), strict=True)) == [(6, 8)]


def test_collapse_edge_cases(spark):
    words = [f"w{i}" for i in range(40)]
    tail = " ".join(words * 500)
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "a " * 30), (5, "a b  a b "), (6, "x y z " * 4 + "x"), (None, "a " * 12), (4, "a " * 30), (7, tail), (8, "é\x1c é\x1c " * 7), (9, "A a " * 12)]
    got = periodic.collapse_runs(spark.createDataFrame(clash(rows), CLASH).repartition(3)).collect()
    assert len(got) == len(rows)
    of = {r.key: r for r in got}
    assert [(r.start, r.length, r.period) for r in of[4].runs] == [(0, 30, 1)] and of[4].kept == "a" and of[None].kept == "a"
    assert all(of[k].n_words == 0 and of[k].runs == [] and of[k].kept == "" for k in (1, 2, 3))
    assert [tuple(r) for r in of[7].runs] == [(0, 20_000, 40)] and of[7].kept == " ".join(words)
    assert [tuple(r) for r in of[6].runs] == [(0, 13, 3)] and of[6].kept == "x y z"
    assert of[5].runs == [] and of[5].n_words == 4 and of[8].kept == "é\x1c" and of[9].kept == "A a"
    assert periodic.collapse_runs(spark.createDataFrame([], CLASH)).count() == 0


def planted(key, text):
    w = (text or "").encode().split()
    n, h = len(w), zlib.crc32(str(key).encode())
    if h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def test_op13_is_its_sql_and_the_loop(spark, data):
    got = sorted(tuple(r) for r in queries.op13_periodic_runs(spark, data).collect())
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{data}/documents.parquet'")
    assert got == sorted(con.sql(oracle.OP13).fetchall())
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()}
    found = 0
    for key, n_runs, start, length, period, milli, runs, kept in got:
        w = planted(key, texts[key])
        if len(w) > 1500:
            continue
        want = literal_runs(w)
        drop = {i for s, n, q in want for i in range(s + q, s + n)}
        best = max(want, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
        assert (n_runs, start, length, period) == (len(want), *best) and milli == (1000 * best[1] // best[2] if want else None)
        assert runs == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in want).encode()).hexdigest()
        assert kept == hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in drop)).hexdigest()
        found += len(want)
    assert found > 10


# token-id planes


@pytest.mark.parametrize("planes", [4, 32])
def test_planes_are_reversible(planes):
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 8, 9, 1000):
        ids = rng.integers(0, 1 << 32, n, dtype=np.uint64).astype("<u4")
        got = idplanes.to_planes(ids, planes)
        assert len(got) == planes and (idplanes.from_planes(got, n) == ids).all()
    ids = np.array([1, 2, 0x01020304], "<u4")
    assert idplanes.to_planes(ids, 4) == [bytes([1, 2, 4]), bytes([0, 0, 3]), bytes([0, 0, 2]), bytes([0, 0, 1])]
    assert idplanes.to_planes(ids, 32)[0] == bytes([0b001]) and idplanes.to_planes(ids, 32)[1] == bytes([0b010])


def test_chunks_are_what_the_tokenizer_says():
    rng, encoder = random.Random(5), idplanes.Encoder(BYTES, limit=50)
    assert encoder.chunks and not idplanes.Encoder(WORDS).chunks
    signs = [*"ab'sé.1 \n\t \r\x0b\x0c\x1c\x1f\x85   　​᠎ 漢́ſ-ªµºÿĀɏɐ", "'ll", "<|endoftext|>", "  ", "n't", " the", "\n\n", "Éçß", "ñ.", "***", "!!", " and,", " Straße"]
    for _ in range(4000):
        text = "".join(rng.choice(signs) for _ in range(rng.randint(0, 14)))
        assert encoder.encode(text).tolist() == encoder.tok.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("planes,tokenizer", [("byte", BYTES), ("bit", BYTES), ("byte", WORDS)])
def test_id_files_give_back_every_document(spark, tmp_path, planes, tokenizer):
    rng = random.Random(2)
    texts = [None, "", " ", "<|endoftext|> x", "é漢\n\n" * 3, *[" ".join(rng.choice(["tok", "en", "Straße,", "x\ny"]) for _ in range(rng.randint(0, 60))) for _ in range(120)], "long " * 5000]
    rows = [(rng.choice([None, 5, 5, 5, rng.randrange(-50, 50)]), t) for t in texts] + [(5, "same")] * 3
    docs = spark.createDataFrame(clash(rows), CLASH)
    files = idplanes.write_ids(docs, "doc_id", "text", tokenizer, f"file://{tmp_path}/ids", end_id=2, planes=planes, block=64, file_ids=1500)
    files.write.parquet(f"{tmp_path}/list")
    files = spark.read.parquet(f"{tmp_path}/list")
    assert files.count() > 3
    got = sorted(idplanes.read_ids(files, slice_ids=300).collect(), key=lambda r: r.start)
    tok = Tokenizer.from_file(tokenizer)
    want = sorted((k is not None, k or 0, tuple(tok.encode(t or "", add_special_tokens=False).ids + [2])) for k, t in rows)
    assert sorted((r.key is not None, r.key or 0, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in got) == want
    # in order, end to end
    keys = [(r.key is not None, r.key or 0) for r in got]
    assert keys == sorted(keys)
    assert [r.start for r in got] == [0, *np.cumsum([r.n_ids for r in got])[:-1].tolist()]
    assert all(len(r.ids) == 4 * r.n_ids for r in got)


def test_a_file_tells_its_chunks(spark, tmp_path):
    path = f"file://{tmp_path}/x.ids"
    from fieldloom.llm.files import open_write

    out = idplanes.Writer(open_write(path), 8, 4)
    out.add(7, np.arange(20, dtype="<u4"))
    out.add(None, np.array([3], "<u4"))
    out.close()
    read = idplanes.Reader(path)
    assert read.index["ids"].tolist() == [8, 8, 5] and read.docs["ids"].tolist() == [20, 1] and read.docs["null"].tolist() == [0, 1]
    raw = open(f"{tmp_path}/x.ids", "rb").read()
    first = read.index[1]
    assert zstandard.ZstdDecompressor().decompress(raw[int(first["offset"]) : int(first["offset"]) + int(first["sizes"][0])]) == bytes(range(8, 16))
    assert read.ids(5, 18).tolist() == list(range(5, 18)) and read.ids(20, 21).tolist() == [3] and read.ids(4, 4).tolist() == []
    (tmp_path / "no.ids").write_bytes(b"x" * 100)
    with pytest.raises(ValueError):
        idplanes.Reader(f"file://{tmp_path}/no.ids")


def test_id_files_of_nothing(spark):
    assert idplanes.round_trip(spark.createDataFrame([], CLASH), BYTES).count() == 0


def test_op12_is_the_tokenizer(spark, data):
    got = {r.doc_id: tuple(r)[1:] for r in queries.op12_id_planes(spark, data).collect()}
    tok, at = Tokenizer.from_file(BYTES), 0
    for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect():
        ids = tok.encode(r.text or "", add_special_tokens=False).ids + [2]
        assert got[r.doc_id] == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


# whitening


@pytest.mark.parametrize("kind", ["noise", "equal", "blocks", "few", "diagonal", "one"])
def test_leading_components(kind):
    rng = np.random.default_rng(3)
    a = rng.standard_normal((400, 40)) * np.exp(rng.standard_normal(40))
    q = np.linalg.qr(rng.standard_normal((40, 40)))[0]
    v = {
        "noise": a.T @ a / 400, "equal": np.eye(40) * 3, "blocks": q @ np.diag([5.0] * 10 + [3.0] * 10 + [1.0] * 20) @ q.T, "few": a[:5].T @ a[:5] * 1e6, "diagonal": np.diag(np.arange(40.0)), "one": np.array([[2.5]]),
    }[kind]
    v = (v + v.T) / 2
    e, x = whitening.leading_components(v, 32)
    assert len(e) == {"few": 5, "one": 1}.get(kind, 32)
    want = np.linalg.eigvalsh(v)[::-1][: len(e)]
    assert np.abs(e - want).max() < 1e-13 * want[0] * 40
    assert np.abs(x.T @ x - np.eye(len(e))).max() < 1e-12 and np.abs(v @ x - x * e).max() < 1e-12 * want[0]


def test_count_below_is_the_number_of_eigenvalues():
    rng = np.random.default_rng(4)
    diag, off = rng.standard_normal(30), rng.standard_normal(29)
    off[7] = 0
    values = np.linalg.eigvalsh(np.diag(diag) + np.diag(off, 1) + np.diag(off, -1))
    at = np.concatenate((values[:-1] + np.diff(values) / 2, [values[0] - 1, values[-1] + 1]))
    assert whitening.count_below(diag, off, at).tolist() == [int((values < x).sum()) for x in at]


SCHEMA = "vec_id bigint, v array<float>, key string, component int, n int, whitened int, deviation string, pos int, total int"


def vectors(rows):
    return [(k, v, "k", 1, 2, 3, "d", 4, 5) for k, v in rows]


def literal_whiten(x, k):
    n, s = len(x), x.sum(axis=0)
    c = x - s / n
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    return [sum(int(n * a - b) ** 2 for a, b in zip(r.tolist(), s.tolist(), strict=True)) for r in x], c @ u / np.sqrt(e), e


def check(got, x, keys, k):
    dev, white, e = literal_whiten(x, k)
    rows = sorted((tuple(r) for r in got), key=lambda r: (r[0], r[1]))
    order = np.argsort(keys, kind="stable")
    assert [(r[0], r[1]) for r in rows] == [(keys[i], c + 1) for i in order for c in range(k)]
    assert [r[3] for r in rows] == [dev[i] for i in order for _ in range(k)] and {r[2] for r in rows} == {len(x)}
    mine = np.array([r[4] for r in rows]).reshape(-1, k)
    sign = np.sign((mine * white[order]).sum(axis=0))
    assert np.abs(mine - white[order] * sign).max() < 1e-6
    c = x - x.mean(axis=0)
    trace = (c * c).sum() / len(x)
    assert max(abs(r[5] - e[r[1] - 1] / trace) for r in rows) < 1e-9 and len({r[6] for r in rows}) == 1 and 0 <= rows[0][6] < 1e-6


def test_whiten_is_the_eigenvectors(spark):
    rng = np.random.default_rng(8)
    v = (rng.standard_normal((300, 6)) * [5, 3, 2, 1.5, 1, 0.7] + rng.standard_normal(6)).astype(np.float32)
    rows = [(i * 7 % 300, v[i].tolist()) for i in range(300)]
    bad = [(901, None), (902, [1.0, None, 0, 0, 0, 0]), (903, [float("nan")] * 6), (904, [float("inf"), 0, 0, 0, 0, 0]), (905, [float("-inf"), 0, 0, 0, 0, 0])]
    df = spark.createDataFrame(vectors([(k, None if r is None else [None if a is None else float(a) for a in r]) for k, r in rows + bad]), SCHEMA)
    x = np.floor(64 * v.astype(float)).astype(np.int64) + 1_000_000
    keys = [i * 7 % 300 for i in range(300)]
    for parts, k in ((1, 6), (7, 4)):
        check(whitening.whiten(df.repartition(parts), vector="v", k=k).collect(), x, keys, k)
    assert sorted(c for c, in whitening.whiten(df, vector="v", k=99).select("component").distinct().collect()) == list(range(1, 7))


def test_whiten_edge_cases(spark):
    make = lambda rows: whitening.whiten(spark.createDataFrame(vectors(rows), SCHEMA), vector="v")
    assert make([]).count() == 0 and make([(1, None)]).count() == 0 and make([(1, [])]).count() == 0
    # no variance, no component
    assert make([(1, [1.0, 2.0])]).count() == 0 and make([(k, [1.0, 2.0]) for k in range(50)]).count() == 0
    # a direction without any is left out; repeated rows and null keys stay
    got = make([(None, [0.0, 5.0]), (1, [1.0, 5.0]), (1, [1.0, 5.0]), (2, [3.0, 5.0])]).collect()
    assert sorted(str(r.key) for r in got) == ["1", "1", "2", "None"] and {r.component for r in got} == {1} and {r.explained for r in got} == {1.0}
    # shorter ones are filled with zeros
    a = sorted(round(abs(r.whitened), 9) for r in make([(1, [1.0]), (2, [1.0, 4.0]), (3, [])]).collect())
    assert a == sorted(round(abs(r.whitened), 9) for r in make([(1, [1.0, 0.0]), (2, [1.0, 4.0]), (3, [0.0, 0.0])]).collect())
    # very large entries are held; what does not fit is null
    big = make([(1, [3e38]), (2, [-3e38]), (3, [0.0])]).collect()
    assert all(r.deviation is None or r.deviation >= 0 for r in big) and max(abs(r.identity_error) for r in big) < 1e-9


def test_a_hot_vector_and_keys_of_text(spark):
    rng = np.random.default_rng(1)
    v = np.concatenate((np.tile([[2.0, -1.0, 0.5]], (2000, 1)), rng.standard_normal((40, 3)))).astype(np.float32)
    df = spark.createDataFrame([(f"id{i:05d}", r.tolist()) for i, r in enumerate(v)], "vec_id string, embedding array<float>").repartition(9)
    x = np.floor(64 * v.astype(float)).astype(np.int64) + 1_000_000
    check(whitening.whiten(df, k=3).collect(), x, [f"id{i:05d}" for i in range(len(v))], 3)


def test_op11_is_numpy(spark, data):
    e = spark.read.parquet(f"{data}/embeddings.parquet").select("vec_id", F.col("embedding").cast("array<double>").alias("v")).collect()
    x = np.floor(64 * np.array([r.v for r in e])).astype(np.int64) + 1_000_000
    got = queries.op11_whiten_embeddings(spark, data)
    assert got.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    rank = min(32, np.linalg.matrix_rank((x - x.mean(axis=0)).astype(float)))
    check(got.collect(), x, [r.vec_id for r in e], int(rank))
