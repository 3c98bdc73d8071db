import hashlib
import random
import re

import pyspark.sql.functions as F
import pytest

from panelcast.llm import decontaminate as D

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items, k=10):
    windows = {}
    for i, t in items:
        w = split(t)
        n = min(k, len(w))
        for s in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[s:s + n]), set()).add(str(i) if i is not None else "null")
    sizes = {len(q) for q in windows}
    out = []
    for i, t in docs:
        w, hit, names = split(t), set(), set()
        for n in sizes:
            for s in range(len(w) - n + 1):
                if found := windows.get(tuple(w[s:s + n])):
                    hit.update(range(s, s + n))
                    names |= found
        out.append((i, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return out


def fixture(words):
    items = [(j, " ".join(words(25, j))) for j in range(12)]
    items += [(20, "Short, ITEM here"), (21, "item here"), (22, "here"), (23, ""), (24, None), (25, "!!"), (None, " ".join(words(11, 50))),
              (1, " ".join(words(12, 51))), (26, "a a a a a a a a a a a a"), (27, " ".join(words(25, 3)))]
    docs = [(None, None), (1, ""), (2, " \n"), (3, "short-item: HERE"), (4, "a " * 30), (5, "a " * 9), (6, "É short item here é"), (7, "here"), (7, "here"), (None, "x here")]
    for j in range(40):
        w = words(40, 900 + j)
        q = words(25, j % 12)
        a = j % 15
        docs.append((100 + j, " ".join(w[:20] + q[a:a + 8 + j % 6] + w[20:]).upper() if j % 2 else ", ".join(w[:20] + q[a:a + 8 + j % 6] + w[20:])))
    docs.append((500, " ".join(words(20000, 77) + words(25, 4))))
    return docs, items


def test_equals_brute_force(spark, make_docs, words):
    docs, items = fixture(words)
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    want = sorted(map(str, brute(docs, items)))
    for shard in (D.SHARD_WORDS, 60):
        got = D.leak_report(make_docs(docs).withColumn("n_words", F.lit(0)), bench, shard_words=shard).collect()
        assert sorted(str(tuple(r)) for r in got) == want


@pytest.mark.parametrize("seed", range(30))
def test_automaton_on_small_alphabets(seed):
    rng = random.Random(seed)
    draw = lambda n: [rng.choice([b"x", b"y", b"z"][:rng.randint(2, 3)]) for _ in range(n)]
    items = [(str(i), draw(rng.randint(0, 9))) for i in range(6)]
    k = rng.randint(1, 5)
    a = D.Automaton(items, k)
    for _ in range(20):
        doc = draw(rng.randint(0, 25))
        spans, names = a.match(doc)
        hit, want = set(), set()
        for i, w in items:
            n = min(k, len(w))
            for s in range(len(w) - n + 1 if n else 0):
                for p in range(len(doc) - n + 1):
                    if doc[p:p + n] == w[s:s + n]:
                        hit.update(range(p, p + n))
                        want.add(i)
        assert {x for s, e in spans for x in range(s, e)} == hit and names == want


def test_remove_leaks(spark, make_docs, words):
    docs, items = fixture(words)
    bench = spark.createDataFrame(items, "item_id long, text string")
    given = make_docs(docs).withColumn("n_chars", F.length("text")).withColumn("_x", F.lit(1))
    out = D.remove_leaks(given, bench)
    assert out.columns == given.columns
    got = {r["doc_id"]: r for r in out.collect()}
    hits = {r[0]: r for r in brute(docs, items)}
    left = brute([(r["doc_id"], r["text"]) for r in got.values()], items)
    for i, n, hit, *_ in left:
        assert n == hits[i][1] - hits[i][2] or hits[i][0] in (None, 7)
    for i, t in docs:
        if i is not None and not hits[i][2]:
            assert got[i]["text"] == t
    assert 4 not in got and 3 not in got  # all words hit


def test_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.leak_report(make_docs([]), none).collect() == []
    assert [tuple(r)[1:4] for r in D.leak_report(make_docs([(1, "a b")]), none).collect()] == [(2, 0, 0)]
