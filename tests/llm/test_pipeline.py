"""The pipeline's stages on a small corpus with planted cases, and on odd tables."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline as P

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def write(spark, rows, path, schema=SCHEMA):
    spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(path)


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    rng = random.Random(3)
    vocab = ["".join(rng.choice(["ba", "re", "ti", "on", "us", "el", "mi", "qua"]) for _ in range(rng.randint(1, 4))) for _ in range(400)]
    line = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    rows = [(i, "\n".join(line(rng.randint(9, 30)) for _ in range(8)), "en", f"s{i % 4}", 0) for i in range(260)]
    item = line(25)

    def changed(text: str, at: int) -> str:
        """A near copy: all in one line, so no line is equal, and one word in the middle differs."""
        w = text.split()
        w[len(w) // 2] = f"other{at}"
        return " ".join(w)

    near = rows[5][1].split(" ")
    near[len(near) // 2] = "changed"
    rows += [
        (1000, rows[7][1].split("\n")[0] + "\n" + "\n".join(line(20) for _ in range(6)), "en", "s1", 0),
        (1001, " ".join(near).replace("\n", " \n x "), "en", "s1", 0),
        (1002, line(60) + " " + item + " " + line(60), "en", "s2", 0),
        (1010, rows[20][1], "en", "s0", 0), (1011, rows[21][1].upper(), "en", "s1", 0), (1012, changed(rows[22][1], 3), "en", "s2", 0), (1013, changed(rows[23][1], 4), "en", "s3", 0),
        (1003, "spam " * 200, "en", "s2", 0), (1004, None, "en", "s2", 0), (None, line(80), None, None, 0), (1005, "", "en", "s3", 0), (1006, line(5000), "en", "s3", 0), rows[9], rows[9],
    ]
    d = str(tmp_path_factory.mktemp("sf"))
    write(spark, rows, f"{d}/documents.parquet")
    write(spark, [(1, item), (2, None)], f"{d}/benchmark.parquet", "item_id bigint, text string")
    return d, rows


def test_stages_take_effect(spark, planted):
    d, rows = planted
    docs, seen = spark.read.parquet(f"{d}/documents.parquet"), []
    for k, (_, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, d)
        if k < len(P.STAGES) - 1:
            assert out.columns == docs.columns
        out.write.parquet(f"{d}/stage{k}")
        docs = spark.read.parquet(f"{d}/stage{k}")
        seen.append({r.doc_id: r.text for r in docs.collect()})
    rejected, deduped, alone, clean, _ = seen
    assert not {1003, 1004, 1005} & set(rejected) and {i for i in range(260)} <= set(rejected) and {1000, 1001, 1002, 1006, None} <= set(rejected)
    assert rows[7][1].split("\n")[0] not in deduped[1000] and deduped[7] == rows[7][1]
    # exact copies lose all lines and go with them; copies with other lines go as near duplicates; no text without words is left
    assert not {1010, 1011} & set(deduped) and {1012, 1013} <= set(deduped)
    assert all((x or "").split() for x in deduped.values())
    assert 5 in alone and set(range(260)) <= set(alone) and not {1012, 1013} & set(alone)
    assert 1002 not in clean and set(alone) - set(clean) == {1002}
    got = P.run(spark, d)
    assert not {1003, 1004, 1005, 1010, 1011, 1012, 1013, 1002} & {r.doc_id for r in got.collect()} and got.filter("trim(text) = ''").isEmpty()
    assert {"doc_id", "text", "copies", "taken", "target"} <= set(got.columns) and got.filter("copies < 1 or taken > 3 * 5200").count() == 0
    total = sum(len((x or "").split()) for x in clean.values())
    assert abs(got.agg({"taken": "sum"}).first()[0] - total) < 0.15 * total + 5000


def test_odd_tables(spark, tmp_path):
    d = str(tmp_path)
    write(spark, [(1, "a b c", "en", "s", 0)], f"{d}/documents.parquet")
    write(spark, [(1, "x")], f"{d}/benchmark.parquet", "item_id bigint, text string")
    schema = SCHEMA + ", d string, t string, k int, key string, copies int, taken string, target int, gone int, n_lines int, h int"
    given = [(1, "w " * 80, "en", "s", 0, "d", "t", 1, "k", 5, "x", 6, 7, 8, 9), (None, None, None, None, None, None, None, None, None, None, None, None, None, None, None)]
    for docs in (spark.createDataFrame(given, schema), spark.createDataFrame([], SCHEMA), spark.createDataFrame(given, schema).limit(0)):
        for k, (_, stage) in enumerate(P.STAGES):
            out = stage(spark, docs, d)
            if k < len(P.STAGES) - 1:
                assert out.columns == docs.columns
            out.write.mode("overwrite").parquet(f"{d}/out")
            assert spark.read.parquet(f"{d}/out").count() <= docs.count()


def test_rows_that_share_a_key(spark, tmp_path):
    """A leaked or copied row takes no other row of its key along, and of equal rows one stays."""
    rng = random.Random(9)
    line = lambda n: " ".join(f"w{rng.randint(0, 4000)}" for _ in range(n))
    item, a, b = line(45), line(90), line(90)
    rows = [(1, a + " " + item, "en", "s", 0), (1, b, "en", "s", 0), (None, a + " x", "en", "s", 0), (None, a + " y", "en", "s", 0), (2, b, "en", "s", 0), (2, b, "en", "s", 0), (3, None, "en", "s", 0), (3, None, "en", "s", 0)]
    d = str(tmp_path)
    write(spark, [(1, item), (2, "one two")], f"{d}/benchmark.parquet", "item_id bigint, text string")
    docs = spark.createDataFrame(rows, SCHEMA)
    left = P.decontaminate(spark, docs, d).collect()
    assert sorted(map(repr, ((r.doc_id, r.text) for r in left))) == sorted(map(repr, ((r[0], r[1]) for r in rows[1:])))
    alone = P.near_duplicates(spark, docs, d).collect()
    assert len([r for r in alone if r.text and r.text.startswith(b[:40])]) == 1 and len([r for r in alone if r.text is None]) == 2
    assert len([r for r in alone if r.text and r.text.startswith(a[:40])]) == 2  # the two without a key are one group, the one with the item is another
