import random
import zlib

import numpy as np
import pyspark.sql.functions as F

from panelcast.llm import language_id as L

SYLLABLES = {"aa": "the an ing er of to".split(), "bb": "ßer und ich ein ge sch".split(), "cc": "é la que ou les è".split()}


def texts_of(lang, n, seed):
    r = random.Random(seed)
    return " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randint(1, 3))) for _ in range(n))


def rows_of(n):
    return [(i, texts_of("aabbcc"[2 * (i % 3):2 * (i % 3) + 2], 5 + i % 60, i), "aabbcc"[2 * (i % 3):2 * (i % 3) + 2]) for i in range(n)]


def test_held_out_accuracy_and_rules(spark):
    rows = rows_of(450)
    rows += [(1000, None, "aa"), (1001, "", "aa"), (1002, "123 !? ²", "bb"), (1003, "é", None), (None, texts_of("bb", 30, 7), "cc"), (5, rows[5][1], "cc"), (1004, texts_of("cc", 20000, 8), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3).withColumn("lang_pred", F.lit(1)).withColumn("x", F.lit(2))
    got = L.language_report(docs).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1
        by.setdefault(r["doc_id"], []).append(r)
    held = [i for i in range(450) if by[i][0]["held_out"]]
    assert sum(by[i][0]["lang_pred"] == rows[i][2] for i in held) >= 0.98 * len(held)
    assert [by[i][0]["lang_pred"] for i in (1000, 1001, 1002)] == ["und"] * 3 and by[1004][0]["lang_pred"] == "cc" and by[None][0]["lang_pred"] == "bb"


def test_prediction_ignores_lang_and_id(spark):
    net = L.train(spark.createDataFrame(rows_of(200), "doc_id long, text string, lang string"))
    t = texts_of("aa", 40, 5)
    a = L.predict(spark.createDataFrame([(1, t), (2, t)], "doc_id long, text string"), net).collect()
    assert a[0]["lang_pred"] == a[1]["lang_pred"] == "aa" and a[0]["score"] == a[1]["score"]


def test_nothing_or_one_language_learned(spark):
    schema = "doc_id long, text string, lang string"
    assert L.language_report(spark.createDataFrame([], schema)).collect() == []
    assert [tuple(r)[2:] for r in L.language_report(spark.createDataFrame([(2, "abc", None)], schema)).collect()] == [("und", 0.0)]
    one = L.language_report(spark.createDataFrame([(i, "some text", "aa") for i in range(6)], schema)).collect()
    assert {r["lang_pred"] for r in one} == {"aa"}


def test_a_repeated_id_is_one_training_document(spark):
    rows = [(i, texts_of("aa", 9, i), "aa") for i in range(60)] + [(2, texts_of("bb", 9, 100 + i), "bb") for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    chosen = [r["doc_id"] for r in L.training_rows(docs, 20).collect()]
    assert len(chosen) == len(set(chosen)) == 20
    assert L.training_rows(docs, 600).count() == len({i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 3 != 1})


def test_windows_cover_the_text():
    for t in ("", "a", "a" * 128, "b" * 129, "É" * 300):
        raw = t.encode()
        w = L.windows(t)
        assert w.tobytes()[:len(raw)] == raw and w.size - len(raw) < L.LENGTH + (not raw)


def test_gradient_learns_a_single_byte_pattern():
    rng = np.random.default_rng(0)
    x = rng.integers(97, 110, (400, L.LENGTH)).astype(np.uint8)
    y = rng.integers(0, 2, 400)
    x[y == 1, 50] = 122
    net = L.fit(x, y, ["n", "y"], epochs=40)
    assert (net.probabilities(x).argmax(axis=1) == y).mean() > 0.9
