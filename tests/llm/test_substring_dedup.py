import hashlib

import pyspark.sql.functions as F

from panelcast.llm import substring_dedup as S


def brute(rows, k=20):
    docs = [(float("-inf") if i is None else i, [] if t is None else t.encode().split()) for i, t in rows]
    first = {}
    for i, w in docs:
        for s in range(len(w) - k + 1):
            q = tuple(w[s:s + k])
            first[q] = min(first.get(q, (i, s)), (i, s))
    out = []
    for (i, w), (raw, _) in zip(docs, rows):
        gone = set()
        for s in range(len(w) - k + 1):
            if first[tuple(w[s:s + k])] < (i, s):
                gone.update(range(s, s + k))
        kept = [x for p, x in enumerate(w) if p not in gone]
        out.append((raw, len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


def key(rows):
    return sorted(map(str, rows))


def fixture(words):
    passage = words(60, 1)
    line = words(9, 2)
    rows = [(None, None), (None, " ".join(words(30, 3))), (1, ""), (2, " \t\n\x0b"), (3, "a " * 19), (4, "a " * 20),
            (5, "a " * 50), (6, "x y " * 40), (7, "\u00a0".join(words(30, 3))), (8, " ".join(words(30, 3)))]
    rows += [(10 + j, " ".join(words(15 + j, 100 + j) + passage[j % 7:60 - j % 5] + words(10, 200 + j))) for j in range(40)]
    rows += [(60 + j, " ".join(words(12, 300 + j) + line + words(12, 400 + j))) for j in range(60)]
    rows += [(200 + j, " ".join(passage)) for j in range(30)]
    rows += [rows[20], rows[20], (20, "other text of the same id " + " ".join(passage))]
    rows += [(900, " ".join(words(4000, 9) + words(300, 10) + words(4000, 11) + words(300, 10)))]
    return rows


def test_equals_brute_force(make_docs, words):
    rows = fixture(words)
    got = S.dedup_report(make_docs(rows)).collect()
    assert key(tuple(r) for r in got) == key(brute(rows))


def test_frequent_pieces_only_set_an_order(words):
    docs = [t.encode().split() for _, t in fixture(words) if t]
    import numpy as np
    none = S.super_kmers(docs, 20, 4, np.zeros(0, dtype=np.uint64))
    some = np.unique(none[4] & np.uint64(2 ** 63 - 1))[::3]
    other = S.super_kmers(docs, 20, 4, some)
    windows = [int((f[3] - f[2] + 1).sum()) for f in (none, other)]
    assert windows[0] == windows[1] == sum(max(0, len(d) - 19) for d in docs)


def test_remove_repeats_keeps_columns(make_docs, words):
    rows = fixture(words)
    docs = make_docs(rows).withColumn("n_chars", F.length("text")).withColumn("spans", F.lit(1)).withColumn("d", F.lit("x"))
    out = S.remove_repeats(docs)
    assert out.columns == docs.columns
    by = {}
    for r in out.collect():
        by.setdefault(r["doc_id"], []).append(r)
    assert sorted({210, 8, 5} & set(by)) == []  # copies of earlier texts lose every word
    assert by[1][0]["text"] == "" and by[2][0]["text"] == " \t\n\x0b" and by[7][0]["text"] == rows[8][1]
    first = dict(rows[:20])[10]
    assert by[10][0]["text"] == first and by[10][0]["n_chars"] == len(first)


def test_empty_table(make_docs):
    assert S.dedup_report(make_docs([])).collect() == []


def test_frequent_minimisers_meet_in_two_rounds(make_docs, words, monkeypatch):
    rows = fixture(words)
    passage = [w.encode() for w in words(60, 1)]
    frequent = S.np.unique(S.ranks(S.word_hashes(passage), S.PIECE))
    monkeypatch.setattr(S, "frequent_pieces", lambda docs: frequent)
    got = S.dedup_report(make_docs(rows, 12)).collect()
    assert key(tuple(r) for r in got) == key(brute(rows))


def test_buckets_in_parts_lose_no_repeat(spark, make_docs, words, monkeypatch):
    import functools
    rows = fixture(words)
    small = functools.partial(S.repeated_spans, part_bytes=500)
    monkeypatch.setattr(S, "repeated_spans", small)
    got = S.dedup_report(make_docs(rows, 12)).collect()
    assert key(tuple(r) for r in got) == key(brute(rows))


def test_a_part_holds_no_more_than_its_bytes(words):
    import struct
    rows = [(" ".join(words(25, i)).encode(), struct.pack(S._PLACE, i, 1, 0)) for i in range(200)]
    rows += rows[:50]
    batch = S.pa.RecordBatch.from_arrays(
        [S.pa.array([7] * 250, S.pa.int64()), S.pa.array([0] * 250, S.pa.int32()), S.pa.array([r[0] for r in rows], S.pa.binary()),
         S.pa.array([r[1] for r in rows], S.pa.binary())], ["mini", "salt", "packed", "places"])
    seen = []
    own = S._spans_of_bucket

    def watch(part, *rest):
        seen.append(sum(len(a) + len(b) for a, b in part))
        return own(part, *rest)
    S._spans_of_bucket = watch
    try:
        out = list(S._find_spans(20, 3000)(iter([batch.slice(0, 90), batch.slice(90)])))
    finally:
        S._spans_of_bucket = own
    assert len(seen) > 5 and max(seen) < 3000 + 300
    places = [tuple(r.values()) for b in out for r in b.to_pylist() if r["packed"] is not None]
    assert {p[4] for p in places} == {b" ".join(w.split()[j:j + 20]) for w, _ in rows for j in range(6)}


def test_frequent_pieces_are_those_of_common_passages(make_docs, words):
    rows = [(j, " ".join([f"{j}x{i}" for i in range(50)] + words(30, 1))) for j in range(40)]
    got = S.frequent_pieces(make_docs(rows), 1.0, 1 / 200)
    assert set(got.tolist()) == set(S.ranks(S.word_hashes([w.encode() for w in words(30, 1)]), S.PIECE).tolist())


def test_earliest_place_and_spans():
    spans = []
    assert len(S._earliest([(5, 1, 0), (4, 2, 7), (4, 3, 7), (4, 2, 7), (4, 2, 9)], 22, spans)) == 2 * 16
    raw = S.np.frombuffer(S._pack_spans(spans + [(5, 1, 20, 45)]), dtype=S._SPAN)
    assert raw.tolist() == [(4, 2, 9, 31), (5, 1, 0, 45)]
