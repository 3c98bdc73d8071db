"""Conversation repair against a plain-Python version that searches edits backwards."""

import hashlib
import random
import re
import zlib
from functools import cache

import pytest

from panelcast.llm import conversation_repair as cr

SCHEMA = "conv_id long, turn long, role string, text string, ck string, fault int"
ORDER = {"D": 0, "I": 1, "K": 2, "R": 3}


def brute_edits(turns):
    """turns: (initial, must delete, truncated) -> (cost, audit) by least cost from the end, then
    the smallest edit letter at each place that keeps the cost."""
    n = len(turns)
    inf = 10 ** 9

    def after(state, edit, i):
        """(cost, state) of an edit at turn i, None if it isn't allowed; a state is what was said last."""
        want = "a" if state == "u" else "u"
        if edit == "I":
            return 3, want
        initial, gone, cut = turns[i]
        if edit == "D":
            return 4, state
        if gone:
            return None
        if edit == "K":
            return (3 * cut, initial) if initial == want or initial == "s" and state == "" else None
        return 3 + 3 * cut, want

    @cache
    def cost(i, state, room):
        """Least cost from turn i on with at most ``room`` inserts."""
        best = 0 if i == n and state in ("", "a") else inf
        for e in "DIKR":
            if e == "I":
                if room:
                    c, s = after(state, e, i)
                    best = min(best, c + cost(i, s, room - 1))
            elif i < n and (x := after(state, e, i)):
                best = min(best, x[0] + cost(i + 1, x[1], 3))
        return best

    i, state, room, audit, left = 0, "", 3, "", None
    left = total = cost(0, "", 3)
    while not (i == n and state in ("", "a") and left == 0):
        for e in "DIKR":
            if e == "I":
                c, s = after(state, e, i)
                if room and c + cost(i, s, room - 1) == left:
                    state, room, left, audit = s, room - 1, left - c, audit + e
                    break
            elif i < n and (x := after(state, e, i)) and x[0] + cost(i + 1, x[1], 3) == left:
                i, state, room, left, audit = i + 1, x[1], 3, left - x[0], audit + e
                break
    return total, audit


def brute_report(rows, every=None):
    by = {c: [] for c in (every or [r[0] for r in rows])}
    for c, t, r, x in rows:
        by[c].append((t, " " if r is None else r, " " if x is None else x))
    out = []
    for c, turns in by.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), hashlib.md5(t[2].encode()).hexdigest()))
        seen, symbols, count = set(), [], [0, 0, 0]
        for _, role, text in turns:
            white = text.strip(" \t\n\x0b\x0c\r")
            fault = 0 if not white else 1 if (role, text) in seen else 2 if white[-1] not in ".!?" else 3
            if fault < 3:
                count[fault] += 1
            if white:
                seen.add((role, text))
            symbols.append((role[:1], fault < 2, fault == 2))
        numbers = [t for t, _, _ in turns if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        cost, audit = brute_edits(symbols)
        lines, i, said = [], 0, ""
        for e in audit:
            want = "assistant" if said == "u" else "user"
            if e == "I":
                lines.append(want + ":")
                said = want[0]
                continue
            _, role, text = turns[i]
            i += 1
            if e != "D":
                role = role if e == "K" else want
                lines.append(f"{role}:{text}")
                said = role[0]
        assert i == len(turns)
        out.append((c, gaps, *count, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def brute_damage(rows):
    out = []
    for c, t, r, x in rows:
        r, x = " " if r is None else r, " " if x is None else x
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        x = "" if k == 1 else re.sub("[.!?]", "", x) if k == 2 else x
        out += [(c, t, "user" if k == 4 else r, x)] * (0 if k == 0 else 2 if k == 3 else 1)
    return out


def some_rows(n=120, seed=3):
    r = random.Random(seed)
    texts = ["", " ", "\n\t", "Yes.", "No!", "Why?", "cut", "cut off ", "é. \n", "Same again.", "a.b", ".", "long " * 300 + "."]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "Sys"]
    rows = []
    for c in range(n):
        for t in range(r.choice([1, 2, 3, 5, 8, 30])):
            rows.append((c, r.choice([t, t, t, t + 3, None]), r.choice(roles[:5] if c % 2 else roles), r.choice(texts) if c % 3 else f"Turn {t}."))
    return rows + [(None, 1, "user", "no id"), (None, None, "assistant", "no id."), (500, 0, "user", None)] + [(600, t % 2, "user" if t % 2 else "assistant", f"{t}.") for t in range(40)]


def made(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(parts)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def test_report_as_brute_force(spark):
    rows = some_rows()
    assert found(cr.repair_report(made(spark, rows)).select(*COLUMNS)) == brute_report(rows)


def test_segments_and_partitions_change_nothing(spark, monkeypatch):
    r = random.Random(8)
    rows = [(1, t, r.choice(["user", "assistant", "system"]), r.choice(["One.", "two", " ", f"Turn {t}."])) for t in range(900)] + some_rows(20, 4)
    monkeypatch.setattr(cr, "SEGMENT", 7)
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        assert found(cr.repair_report(made(spark, rows, 6)).select(*COLUMNS)) == brute_report(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_damaged_rows(spark):
    rows = some_rows(150, 5)
    want = brute_report(brute_damage(rows), [r[0] for r in rows])
    data = made(spark, rows)
    assert found(cr.repair_report(cr.damage(data), data).select(*COLUMNS)) == want
    assert any(w[7] == "" and w[6] == 0 for w in want)  # a conversation that lost all its turns


def test_repaired_rows_follow_the_order(spark):
    by = {}
    for r in cr.repair(made(spark, some_rows(60, 6))).collect():
        by.setdefault(r.conv_id, []).append((r.turn, r.role[:1]))
    for turns in by.values():
        assert [t for t, _ in sorted(turns)] == list(range(len(turns)))
        assert re.fullmatch("(s?(ua)+)?", "".join(r for _, r in sorted(turns)))


def test_grammar_changes_no_matrix(spark):
    r = random.Random(2)
    words = ["".join(cr.code_of(r.choice("suao"), r.choice([0, 0, 0, 1, 2])) for _ in range(r.randint(1, 40))) for _ in range(60)] + [cr.code_of("u", 0) * 700]
    grammar = cr.learn_grammar(spark.createDataFrame([(w,) for w in words], "symbols string"), 40, 5)
    plain = cr.Grammar([])
    assert len(grammar.rules) == 40
    text = lambda m: [[e and (e[0], cr.flat(e[1])) for e in row] for row in m]
    for w in words:
        assert len(grammar.compress(w)) <= len(w) and text(grammar.of(w)) == text(plain.of(w))


def test_ropes():
    r = random.Random(1)
    ropes = ["", "a", "b" * 70, ("a", "b")]
    for _ in range(300):
        ropes.append(cr.join(r.choice(ropes[-40:]), r.choice(ropes[-40:])))
    ropes = [x for x in ropes if sum(map(len, cr.pieces_of(x))) < 5000]
    for _ in range(2000):
        a, b = r.choice(ropes), r.choice(ropes)
        assert cr.less(a, b) == (cr.flat(a) < cr.flat(b))


@pytest.mark.parametrize("rows", [[], [(1, 0, "user", "")], [(1, None, None, None)], [(None, 0, "system", "S."), (None, 1, "user", "Q?")]])
def test_small_tables(spark, rows):
    assert found(cr.repair_report(made(spark, rows, 1)).select(*COLUMNS)) == brute_report(rows)
