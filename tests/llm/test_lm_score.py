import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import pyspark.sql.functions as F

from panelcast.llm import lm_score as M


def binned(p):
    return 10 ** (round(20 * math.log10(p)) / 20) if p > 0 else 0.0


def plain_em(events, v):
    """Weights by bucket from (bucket, pair's estimate, word's estimate, occurrences)."""
    def fit(some):
        w, n = [1 / 3] * 3, sum(e[3] for e in some)
        for _ in range(60):
            share = [0.0, 0.0, 1e-3]
            for _, two, one, k in some:
                parts = [w[0] * two, w[1] * one, w[2] / (v + 1)]
                for j in range(3):
                    share[j] += k * parts[j] / sum(parts)
            w = [x / (n + 1e-3) for x in share]
        return w
    whole = fit(events) if events else [.4, .4, .2]
    by = {}
    for e in events:
        by.setdefault(e[0], []).append(e)
    found = {b: fit(some) for b, some in by.items()}
    return lambda b: found.get(b, whole)


def brute(rows, contexts, exact=False):
    """Scores by plain counting and plain expectation maximisation on estimates in bins of 0.05."""
    tok = [[*(M.words_of(t)), M.END] for _, t in rows]
    fold = [-1 if i is None else zlib.crc32(str(i).encode()) % 5 for i, _ in rows]
    c, pair, before = Counter(), Counter(), Counter()
    ca, paira, beforea, heldout = Counter(), Counter(), Counter(), Counter()
    for ws, f in zip(tok, fold):
        if f not in (-1, 1):
            c.update(ws)
            if f != 4:
                ca.update(ws)
    top = set(sorted((w for w in c if w != M.END), key=lambda w: (-c[w], w))[:contexts])

    def ctx(ws):
        return ["<s>", *(w if w in top or contexts >= 10 ** 9 else "<rare>" for w in ws[:-1])]
    for ws, f in zip(tok, fold):
        if f not in (-1, 1):
            pair.update(zip(ctx(ws), ws))
            before.update(ctx(ws))
            if f != 4:
                paira.update(zip(ctx(ws), ws))
                beforea.update(ctx(ws))
            else:
                heldout.update(zip(ctx(ws), ws))
    n, na, v = sum(c.values()), sum(ca.values()), len(c)

    def bucket(h, count):
        return 42 if h == "<s>" else 41 if h == "<rare>" else int(math.log2(count[h] + 1))
    ev = Counter()
    for (h, w), k in heldout.items():
        one = ca[w] / max(na, 1)
        two = paira[h, w] / beforea[h] if beforea[h] else one
        ev[bucket(h, beforea), two if exact else binned(two), one if exact else binned(one)] += k
    weights = plain_em([(*e, k) for e, k in ev.items()], v)
    out = []
    for (i, _), ws, f in zip(rows, tok, fold):
        base = sum(math.log10((c[w] + .5) / (n + .5 * (v + 1))) for w in ws)
        score = 0.0
        for h, w in zip(ctx(ws), ws):
            if not n:
                score -= math.log10(v + 1)
                continue
            one = c[w] / n
            two = pair[h, w] / before[h] if before[h] else one
            l2, l1, l0 = weights(bucket(h, before))
            score += math.log10(l2 * two + l1 * one + l0 / (v + 1))
        out.append((i, f == 1, len(ws), sum(c[w] > 0 for w in ws), n, base, score))
    return out


def check(got, want):
    order = lambda r: tuple(str(x) for x in r[:4]) + (round(r[5], 6),)
    got, want = sorted(map(tuple, got), key=order), sorted(want, key=order)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-9)


@pytest.mark.parametrize("contexts,pairs", [(65000, 1_000_000), (20, 1_000_000), (50, 200)])
def test_equals_plain_counting(make_docs, words, contexts, pairs, monkeypatch):
    rows = [(i, " ".join(words(5 + i % 40, i))) for i in range(120)]
    rows += [(None, None), (None, "the of and"), (200, ""), (201, "É é É"), (5, rows[5][1]), (5, "unseen wordz here"), (300, "the " * 20000), (301, " ".join(words(8000, 4)))]
    docs = make_docs(rows).withColumn("score", F.lit(1)).withColumn("w", F.lit(1))
    check(M.score_report(docs, contexts, pairs).collect(), brute(rows, contexts))
    if contexts == 20:  # more tokens make more parts
        check(M.score_report(docs, contexts, pairs, part_tokens=500).collect(), brute(rows, contexts))


@pytest.mark.parametrize("numbered,pairs", [(20, 1_000_000), (50, 200), (0, 1_000_000)])
def test_every_word_is_a_context(make_docs, words, numbered, pairs):
    """However few words have numbers: the scores of the plain model without pooling."""
    rare = ["q%d" % (i % 37) for i in range(400)]
    rows = [(i, " ".join(words(5 + i % 40, i) + rare[i:i + 9])) for i in range(120)]
    rows += [(None, "the of q1 q2 never seen"), (200, ""), (5, "unseen wordz q3 q4"), (301, " ".join(words(4000, 4)))]
    check(M.score_report(make_docs(rows), pairs=pairs, numbered=numbered).collect(), brute(rows, 10 ** 9))
    if numbered == 20:
        check(M.score_report(make_docs(rows), part_tokens=500, numbered=numbered).collect(), brute(rows, 10 ** 9))


def test_bins_change_little_and_unseen_contexts_back_off(make_docs, words):
    """Against estimates that are not binned; some contexts occur in the deleted part only."""
    rows = [(i, " ".join(words(60, i) + [f"own{i}", "the", "of"])) for i in range(150)]
    got = M.score_report(make_docs(rows)).collect()
    want = brute(rows, 10 ** 9, exact=True)
    score = {r["doc_id"]: r["score"] for r in got}
    assert all(abs(score[w[0]] - w[6]) <= 0.005 * abs(w[6]) for w in want)


def test_many_chunks_in_a_task(spark, words):
    rows = [(i, " ".join(words(30, i))) for i in range(40)]
    number = {w.encode(): i for i, w in enumerate(sorted({w for _, t in rows for w in t.split()})[:10], 3)} | {M.END: 2}
    word, context, doc = M.encode([M.words_of(t) for _, t in rows], number)
    assert len(word) == 40 * 31 and context[0] == M.START and (np.bincount(doc) == 31).all() and ((word < 1 << 16) | (word >= np.uint64(1 << 63))).all()


def test_chunks_hold_less_texts_than_their_numbers_reach():
    batch = pa.RecordBatch.from_arrays([pa.array(range(150_000), pa.int64()), pa.array(["a"] * 150_000)], ["doc_id", "text"])
    found = list(M.chunks(iter([batch])))
    assert max(len(ids) for ids, _ in found) <= 2 * M.CHUNK_DOCS < 1 << 16 and sum(len(ids) for ids, _ in found) == 150_000


def test_probabilities_sum_to_one():
    v = M.Vocabulary({}, *(np.array([0, 0, 3, 10, 7]) for _ in range(2)), *(np.array([0, 3, 0, 10, 7]) for _ in range(2)), 20, 20, 3)
    w = np.tile([0.5, 0.3, 0.2], (M.BUCKETS, 1))
    # three seen words and one unseen one
    p = 10 ** v.log10(w, np.array([3] * 4), np.array([2, 5, 3, 0]), np.array([3, 10, 7, 0]))
    assert abs(p.sum() - 1) < 1e-12


def test_em_recovers_mixture_weights():
    rng = np.random.default_rng(0)
    y = rng.integers(-60, -1, 4000)
    z = rng.integers(-80, -20, 4000)
    w = M.maximise(np.zeros(4000, dtype=int), y, z, np.ones(4000), 10 ** 6)
    p = np.stack([10.0 ** (y / 20), 10.0 ** (z / 20), np.full(4000, 1e-6)], axis=1)
    best = np.log(p @ w[0]).sum()
    for d in ([.02, -.02, 0], [-.02, .02, 0], [.01, 0, -.01]):
        other = np.clip(w[0] + d, 1e-9, 1)
        assert np.log(p @ (other / other.sum())).sum() <= best + 1e-6


def test_empty(make_docs):
    assert M.score_report(make_docs([])).collect() == []
    only = M.score_report(make_docs([(None, "a b")])).collect()
    assert [tuple(r)[1:5] for r in only] == [(False, 3, 0, 0)]
