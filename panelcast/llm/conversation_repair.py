"""Conversation repair by dynamic programming over grammar-compressed role/fault sequences.

A turn is one symbol: its role's initial (system, user, assistant, other) and its fault (none,
truncated, or to be deleted).  Symbols map the four states of the wanted role order
``(s?(ua)+)?`` (nothing yet, system, user, assistant said last) to each other at a cost, so a
symbol is a 4 x 4 min-plus matrix whose entries carry the edits as a rope; equal costs are
decided by the ASCII-least edits.  Pairs of symbols that are frequent over all conversations
are replaced by new symbols (Re-Pair, pair counts by Spark, ``RULES`` at most); each rule's
matrix is the product of its two parts, made once, bottom-up.  Each distinct sequence is
multiplied once over the compressed symbols, and conversations share it.  The grammar only saves work:
any set of rules gives the same edits.

A conversation is no unit of work until its result is written: turns are range-sorted by
(conversation, turn), a partition's part of a conversation is cut into segments of
``SEGMENT`` turns, and segments are multiplied in order (matrix products are
associative).  Faults of whole conversations (a role and text seen earlier) come
from an aggregate with map-side minima.  Texts are shuffled once, to be hashed or written in order;
that pass streams, holding a batch of turns and one conversation's edits.  A hash over a
conversation's text is a chain, so one task reads a conversation to its end, as it does to write
the audit, one value.

Order: by turn, nulls first; turns of equal number by role, then by the MD5 of the text.
Equal edits from one state have equal costs, so edits of equal cost are never prefixes of each
other, and choosing the least of each part is exact.

Defined results: a null role or text is one space (so the text is blank), a null conv_id is a
conversation of its own, repeated rows are turns like others (the later one is a duplicate), an
empty role is neither system, user nor assistant; very long texts are streamed whole; a conversation without turns
gives zeros, an empty audit and the hash of the empty string; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.common import arrow_map, column_of, docs_table, materialize

DELETE, INSERT, REROLE, CUT = 4, 3, 3, 3
#: Turns of one segment.
SEGMENT = 4096
#: Rules of the grammar at most, and new rules of one counting round.
RULES, ROUND_RULES = 192, 32
#: Symbols: role class x fault, fault 0 none, 1 truncated, 2 to be deleted.
CLASSES, FAULTS = "suao", 3
FIRST_RULE = 0x100
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
SAID = r"[^\x20\x09-\x0D]"
LEGAL = ("su", "ua", "au")


# ---- ropes and min-plus matrices ------------------------------------------------------

def join(a, b):
    """Rope of two ropes: short strings are joined, others become a pair."""
    if not a or not b:
        return a or b
    if isinstance(a, str) and isinstance(b, str) and len(a) + len(b) <= 64:
        return a + b
    return (a, b)


def pieces_of(rope) -> Iterator[str]:
    stack = [rope]
    while stack:
        top = stack.pop()
        if isinstance(top, tuple):
            stack += (top[1], top[0])
        elif top:
            yield top


def flat(rope) -> str:
    return "".join(pieces_of(rope))


def less(a, b) -> bool:
    """Whether rope a's string comes before b's; parts that both share are skipped unread."""
    left, right, x, y = [a], [b], "", ""
    while True:
        if not x and not y:
            while left and right and left[-1] is right[-1]:
                left.pop(), right.pop()
        if not x:
            if not left:
                return bool(y) or any(True for rope in right for _ in pieces_of(rope))
            x = left.pop()
            if isinstance(x, tuple):
                left += (x[1], x[0])
                x = ""
            continue
        if not y:
            if not right:
                return False
            y = right.pop()
            if isinstance(y, tuple):
                right += (y[1], y[0])
                y = ""
            continue
        n = min(len(x), len(y))
        if x[:n] != y[:n]:
            return x[:n] < y[:n]
        x, y = x[n:], y[n:]


def better(new, old) -> bool:
    return old is None or new[0] < old[0] or new[0] == old[0] and less(new[1], old[1])


def product(a, b):
    """Min-plus product; entries are (cost, rope) or None."""
    out = [[None] * 4 for _ in range(4)]
    for i in range(4):
        for k in range(4):
            if a[i][k] is None:
                continue
            cost, edits = a[i][k]
            for j in range(4):
                if b[k][j] is not None:
                    new = (cost + b[k][j][0], join(edits, b[k][j][1]))
                    if better(new, out[i][j]):
                        out[i][j] = new
    return out


def product_of(matrices):
    """Product of a list by halves, so that ropes stay shallow."""
    if len(matrices) == 1:
        return matrices[0]
    half = len(matrices) // 2
    return product(product_of(matrices[:half]), product_of(matrices[half:]))


def _inserts():
    m = [[(0, "") if i == j else None for j in range(4)] for i in range(4)]
    for start in (NOTHING, SYSTEM, ASSISTANT):
        m[start][USER] = (INSERT, "I")
    m[USER][ASSISTANT] = (INSERT, "I")
    for start in (NOTHING, SYSTEM):
        m[start][ASSISTANT] = (2 * INSERT, "II")
    return m


INSERTS = _inserts()


def _symbol(code: int):
    """Inserts in front of a turn, then the turn's own edit."""
    role, fault = CLASSES[code // FAULTS], code % FAULTS
    m = [[None] * 4 for _ in range(4)]
    for state in range(4):
        m[state][state] = (DELETE, "D")
        if fault < 2:
            to = ASSISTANT if state == USER else USER
            extra = CUT * fault
            if role == CLASSES[to - 1]:
                m[state][to] = (extra, "K")
            else:
                m[state][to] = (REROLE + extra, "R")
    if role == "s" and fault < 2:
        m[NOTHING][SYSTEM] = (CUT * fault, "K")
    return product(INSERTS, m)


def code_of(role: str, fault: int) -> str:
    at = CLASSES.find(role) if role else -1
    return chr((at if at >= 0 else len(CLASSES) - 1) * FAULTS + fault + 1)


class Grammar:
    """Rules (pair of symbols) in the order they were made, with their matrices."""

    def __init__(self, rules: list[str]):
        self.rules = rules
        self.matrix = {chr(c + 1): _symbol(c) for c in range(len(CLASSES) * FAULTS)}
        for n, pair in enumerate(rules):
            self.matrix[chr(FIRST_RULE + n)] = product(self.matrix[pair[0]], self.matrix[pair[1]])

    def compress(self, symbols: str) -> str:
        for n, pair in enumerate(self.rules):
            if len(symbols) > 1:
                symbols = symbols.replace(pair, chr(FIRST_RULE + n))
        return symbols

    def of(self, symbols: str):
        return product_of([self.matrix[c] for c in self.compress(symbols)])


def learn_grammar(sequences: DataFrame, rules: int = RULES, a_round: int = ROUND_RULES) -> Grammar:
    """Re-Pair over the column ``symbols``: rounds of the most frequent pairs."""
    found: list[str] = []
    while len(found) < rules:
        grammar = Grammar(found)

        def count(batches, grammar=grammar):
            for batch in batches:
                pairs: Counter = Counter()
                for s in column_of(batch, "symbols").to_pylist():
                    s = grammar.compress(s)
                    pairs.update(map(str.__add__, s, s[1:]))
                yield pa.RecordBatch.from_arrays([pa.array(list(pairs), pa.string()), pa.array(list(pairs.values()), pa.int64())], ["pair", "n"])
        best = (arrow_map(sequences.select("symbols"), count, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n"))
                .filter("n > 1").orderBy(F.desc("n"), "pair").limit(min(a_round, rules - len(found))).collect())
        if not best:
            break
        found += [r["pair"] for r in best]
    return Grammar(found)


# ---- turns, segments, edits -----------------------------------------------------------

def _turns(rows: DataFrame) -> DataFrame:
    """conv_id, ck (key of the conversation, a letter in front tells null), turn, role, text, digest."""
    conv = F.col("conv_id").cast("bigint")
    return (rows.select(conv.alias("conv_id"), F.when(conv.isNull(), F.lit("n")).otherwise(F.concat(F.lit("c"), conv.cast("string"))).alias("ck"),
                        F.col("turn").cast("bigint").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))
            .withColumn("digest", F.md5("text")))


#: Order of turns (ascending order puts nulls first).
PLACE = ["ck", "turn", "role", "digest"]


def _faults(turns: DataFrame) -> DataFrame:
    """Turns without text in order (pid, mid), fault 0 none, 1 truncated, 2 blank, 3 duplicate."""
    blank = ~F.col("text").rlike(SAID)
    cut = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    slim = turns.select("conv_id", "ck", "turn", "role", "digest", F.when(blank, 2).when(cut, 1).otherwise(0).alias("fault"))
    # equal turns are told apart by chance, so that even they spread over partitions
    slim = materialize(slim.withColumn("_s", F.rand(7)).orderBy(*PLACE, "_s").drop("_s").withColumn("pid", F.spark_partition_id())
                       .withColumn("mid", F.monotonically_increasing_id()), "turns")
    said = slim.filter("fault <> 2")
    firsts = (said.groupBy("ck", "role", "digest").agg(F.min(F.struct("pid", "mid")).alias("first"), F.count(F.lit(1)).alias("n"))
              .filter("n > 1").drop("n"))
    marked = said.join(firsts, ["ck", "role", "digest"], "left")
    later = F.col("first").isNotNull() & (F.struct("pid", "mid") != F.col("first"))
    marked = marked.withColumn("fault", F.when(later, 3).otherwise(F.col("fault"))).drop("first")
    return marked.unionByName(slim.filter("fault = 2"))


SEGMENTS = ("conv_id long, ck string, turn long, role string, digest string, pid int, seq int, symbols string, blank long, duplicate long, "
            "truncated long, illegal long, first_i string, last_i string, low long, high long, turns long")


def _cut_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted turns -> segments; a segment never crosses a partition or a conversation."""
    names = [c.split()[0] for c in SEGMENTS.split(", ")]
    done: list[tuple] = []
    now = None
    seq = 0

    def close():
        done.append((*now["head"], seq, "".join(now["symbols"]), now["count"][2], now["count"][3], now["count"][1], now["illegal"],
                     now["first"], now["last"], now["low"], now["high"], now["turns"]))

    for batch in batches:
        for conv, ck, turn, role, digest, fault, pid in zip(*[column_of(batch, c).to_pylist() for c in ("conv_id", "ck", "turn", "role", "digest", "fault", "pid")]):
            same = now is not None and now["head"][1] == ck and now["head"][5] == pid
            if not same or len(now["symbols"]) >= SEGMENT:
                if now is not None:
                    close()
                seq = seq + 1 if same else 0
                now = {"head": (conv, ck, turn, role, digest, pid), "symbols": [], "count": [0] * 4, "illegal": 0, "first": role[:1],
                       "last": None, "low": None, "high": None, "turns": 0}
            initial = role[:1]
            now["illegal"] += now["last"] is not None and now["last"] + initial not in LEGAL
            now["last"] = initial
            now["symbols"].append(code_of(initial, min(fault, 2)))
            now["count"][fault] += 1
            if turn is not None:
                now["turns"] += turn != now["high"]
                now["low"] = turn if now["low"] is None else now["low"]
                now["high"] = turn
        if len(done) >= 1000:
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in done], _arrow(SEGMENTS))
            done = []
    if now is not None:
        close()
    if done:
        yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in done], _arrow(SEGMENTS))


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in ddl.split(", ")])


REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
PLAN = f"conv_id long, ck string, turn long, role string, digest string, pid int, seq int, edits string, {REPORT}"


def _conversation(segments: list[dict]) -> list[dict]:
    """Segments of one conversation in order -> their edits; the report is on the first one."""
    ways = [(0, "") if s == NOTHING else None for s in range(4)]
    steps = []
    for n, seg in enumerate(segments):
        new, came = [None] * 4, [None] * 4
        for i in range(4):
            for j in range(4):
                cost = seg["costs"][4 * i + j]
                if ways[i] is not None and cost is not None:
                    way = (ways[i][0] + cost, join(ways[i][1], seg["audits"][4 * i + j]))
                    if better(way, new[j]):
                        new[j], came[j] = way, i
        ways = new
        steps.append(came)
    best = None
    for j in range(4):
        for to in (NOTHING, ASSISTANT):
            if ways[j] is not None and INSERTS[j][to] is not None:
                way = (ways[j][0] + INSERTS[j][to][0], join(ways[j][1], INSERTS[j][to][1]))
                if better(way, best and best[:2]):
                    best = (*way, j, INSERTS[j][to][1])
    cost, audit, state, tail = best
    edits = [tail]
    for seg, came in zip(segments[::-1], steps[::-1]):
        edits.append(seg["audits"][4 * came[state] + state])
        state = came[state]
    edits = edits[::-1]
    edits[-2:] = [edits[-2] + edits[-1]]
    turned = [s for s in segments if s["low"] is not None]
    distinct = sum(s["turns"] for s in turned) - sum(a["high"] == b["low"] for a, b in zip(turned, turned[1:]))
    sums = {k: sum(s[k] for s in segments) for k in ("blank", "duplicate", "truncated", "illegal")}
    sums["illegal"] += sum(a["last_i"] + b["first_i"] not in LEGAL for a, b in zip(segments, segments[1:]))
    report = sums | {"gaps": turned[-1]["high"] - turned[0]["low"] + 1 - distinct if turned else 0, "cost": cost, "audit": flat(audit)}
    place = ("conv_id", "ck", "turn", "role", "digest", "pid", "seq")
    return [{k: s[k] for k in place} | {"edits": e} | (report if n == 0 else {}) for n, (s, e) in enumerate(zip(segments, edits))]


def _choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments with matrices, sorted by conversation and place -> their edits."""
    schema, done, held = _arrow(PLAN), [], []
    for batch in batches:
        for row in batch.to_pylist():
            if held and held[0]["ck"] != row["ck"]:
                done += _conversation(held)
                held = []
            held.append(row)
        if len(done) >= 1000:
            yield pa.RecordBatch.from_pylist(done, schema)
            done = []
    if held:
        done += _conversation(held)
    if done:
        yield pa.RecordBatch.from_pylist(done, schema)


def plan_edits(turns: DataFrame) -> DataFrame:
    """Edits of every segment (PLAN), the report of a conversation on its first segment."""
    ordered = _faults(turns).repartition("pid").sortWithinPartitions("pid", "mid")
    segments = materialize(arrow_map(ordered.select("conv_id", "ck", "turn", "role", "digest", "fault", "pid"), _cut_segments, SEGMENTS), "segments")
    sequences = materialize(segments.select("symbols").distinct(), "sequences")
    grammar = learn_grammar(sequences)

    def evaluate(batches):
        for batch in batches:
            for s in range(0, batch.num_rows, 64):
                symbols = column_of(batch, "symbols").slice(s, 64).to_pylist()
                each = [[e for row in grammar.of(x) for e in row] for x in symbols]
                yield pa.RecordBatch.from_arrays([pa.array(symbols, pa.string()), pa.array([[e and e[0] for e in m] for m in each], pa.list_(pa.int64())),
                                                  pa.array([[e and flat(e[1]) for e in m] for m in each], pa.list_(pa.string()))], ["symbols", "costs", "audits"])
    matrices = materialize(arrow_map(sequences, evaluate, "symbols string, costs array<long>, audits array<string>"), "matrices")
    valued = segments.join(matrices, "symbols").drop("symbols").repartition("ck").sortWithinPartitions("ck", "pid", "seq")
    return materialize(arrow_map(valued, _choose, PLAN), "edits")


def _stream(turns: DataFrame, conversations: DataFrame, emit, schema: str) -> DataFrame:
    """Applies the edits to the turns in order; emit(conversation's row source) makes the rows."""
    plan = plan_edits(turns).withColumns({"kind": F.lit(0), "text": F.lit(None).cast("string")})
    names = plan.columns
    rest = lambda df, kind: df.withColumn("kind", F.lit(kind)).select(
        *[F.col(c) if c in [*df.columns, "kind"] else F.lit(None).cast(plan.schema[c].dataType).alias(c) for c in names])
    everything = plan.unionByName(rest(turns, 1)).unionByName(rest(conversations, 2))
    ordered = everything.repartition("ck").sortWithinPartitions(*PLACE, "kind", "pid", "seq")
    return arrow_map(ordered, emit, schema)


class _Editor:
    """Edits of one conversation, applied to its turns as they come."""

    def __init__(self, conv_id, put):
        self.conv_id, self.put = conv_id, put
        self.parts: list[str] = []
        self.at, self.state, self.report = 0, NOTHING, None

    def told(self, row) -> None:
        self.parts.append(row["edits"])
        if row["cost"] is not None:
            self.report = row

    def _next(self) -> str | None:
        while self.parts and self.at >= len(self.parts[0]):
            self.parts.pop(0)
            self.at = 0
        return self.parts[0][self.at] if self.parts else None

    def _say(self, role, text) -> None:
        if role is None:
            role = "assistant" if self.state == USER else "user"
            self.state = ASSISTANT if self.state == USER else USER
        else:
            self.state = {"s": SYSTEM, "u": USER}.get(role[:1], ASSISTANT)
        self.put(self.conv_id, role, text)

    def inserts(self) -> None:
        while self._next() == "I":
            self.at += 1
            self._say(None, "")

    def turn(self, role: str, text: str) -> None:
        self.inserts()
        edit = self._next()
        self.at += 1
        if edit != "D":
            self._say(role if edit == "K" else None, text)


def _rows(batches, begin, end, put) -> Iterator[list]:
    """Runs editors over the ordered rows; yields after every batch."""
    now = None
    for batch in batches:
        for row in batch.to_pylist():
            if now is None or now.ck != row["ck"]:
                if now is not None:
                    now.inserts()
                    end(now)
                now = _Editor(row["conv_id"], put)
                now.ck = row["ck"]
                begin(now)
            if row["kind"] == 0:
                now.told(row)
            elif row["kind"] == 1:
                now.turn(row["role"], row["text"])
        yield
    if now is not None:
        now.inserts()
        end(now)
        yield


def _conversations(rows: DataFrame) -> DataFrame:
    conv = F.col("conv_id").cast("bigint")
    return (rows.select(conv.alias("conv_id")).distinct()
            .withColumn("ck", F.when(F.col("conv_id").isNull(), F.lit("n")).otherwise(F.concat(F.lit("c"), F.col("conv_id").cast("string")))))


def repair_report(rows: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of
    every conv_id of ``conversations`` (of ``rows`` if not given)."""
    schema = f"conv_id long, {REPORT}, repaired_sha256 string"
    fields = [c.split()[0] for c in REPORT.split(", ")]

    def emit(batches):
        done: list[dict] = []
        chain = {}

        def begin(editor):
            chain["sha"], chain["any"] = hashlib.sha256(), False

        def put(conv_id, role, text):
            line = f"{role}:{text}".encode("utf-8", "surrogatepass")
            chain["sha"].update(b"\n" + line if chain["any"] else line)
            chain["any"] = True

        def end(editor):
            report = editor.report or {"audit": ""}
            done.append({"conv_id": editor.conv_id, "repaired_sha256": chain["sha"].hexdigest()}
                        | {k: report.get(k, 0) for k in fields})
        for _ in _rows(batches, begin, end, put):
            if done:
                yield pa.RecordBatch.from_pylist(done, _arrow(schema))
                done.clear()
    return _stream(_turns(rows), _conversations(rows if conversations is None else conversations), emit, schema)


def repair(rows: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, turn (from 0), role, text."""
    schema = "conv_id long, turn long, role string, text string"

    def emit(batches):
        done: list[dict] = []
        place = {}

        def put(conv_id, role, text):
            done.append({"conv_id": conv_id, "turn": place["n"], "role": role, "text": text})
            place["n"] += 1
        for _ in _rows(batches, lambda e: place.update(n=0), lambda e: None, put):
            if done:
                yield pa.RecordBatch.from_pylist(done, _arrow(schema))
                done.clear()
    return _stream(_turns(rows), _conversations(rows), emit, schema)


def damage(rows: DataFrame) -> DataFrame:
    """The query's faults by crc32 of ``conv_id:turn`` modulo 20."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = rows.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"),
                       (F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))) % 20).alias("c"))
    text: Column = F.when(F.col("c") == 1, F.lit("")).when(F.col("c") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.explode(F.when(F.col("c") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return (rows.filter("c <> 0").withColumns({"text": text, "role": F.when(F.col("c") == 4, F.lit("user")).otherwise(F.col("role"))})
            .select("conv_id", "turn", "role", "text", times.alias("time")).drop("time"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = docs_table(spark, sf_dir, "conversations")
    return repair_report(damage(rows), rows)


#: The same edits forwards, one state vector a turn; crc32 by its table.
SQL = {
    "op12_conversation_repair": r"""
WITH RECURSIVE crc_table AS (
  SELECT list(v ORDER BY i) AS tab FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v
    FROM (SELECT unnest(range(256)) AS i))
), kinds AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce([4294967295] || list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
             lambda x: CAST(ascii(x) AS BIGINT)), lambda c, b: xor(c // 256, tab[xor(c, b) % 256 + 1])), 4294967295) % 20 AS k
  FROM conversations, crc_table
), damaged AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN k = 1 THEN '' WHEN k = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN k = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM kinds WHERE k <> 0
), turns AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
         trim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS said
  FROM damaged
), faulty AS (
  SELECT *, CASE WHEN said = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN right(said, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         left(role, 1) AS ini, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM turns
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM faulty GROUP BY conv_id
), ways AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, {'c': 0, 'a': ''} AS w0, {'c': 999999, 'a': ''} AS ws, {'c': 3, 'a': 'I'} AS wu, {'c': 6, 'a': 'II'} AS wa FROM counts
  UNION ALL
  SELECT conv_id, i, v0, vs, vu, list_min([va, {'c': vu.c + 3, 'a': vu.a || 'I'}]) FROM (
    SELECT conv_id, i, v0, vs, va, list_min([vu, {'c': v0.c + 3, 'a': v0.a || 'I'}, {'c': vs.c + 3, 'a': vs.a || 'I'}, {'c': va.c + 3, 'a': va.a || 'I'}]) AS vu
    FROM (
      SELECT w.conv_id, t.i, {'c': w0.c + 4, 'a': w0.a || 'D'} AS v0,
             list_min([{'c': ws.c + 4, 'a': ws.a || 'D'}, {'c': w0.c + ok + CASE WHEN ini = 's' THEN 0 ELSE 999999 END, 'a': w0.a || 'K'}]) AS vs,
             list_min([{'c': wu.c + 4, 'a': wu.a || 'D'}, {'c': w0.c + ok + u.c, 'a': w0.a || u.a}, {'c': ws.c + ok + u.c, 'a': ws.a || u.a},
                       {'c': wa.c + ok + u.c, 'a': wa.a || u.a}]) AS vu,
             list_min([{'c': wa.c + 4, 'a': wa.a || 'D'}, {'c': wu.c + ok + s.c, 'a': wu.a || s.a}]) AS va
      FROM ways w JOIN (
        SELECT conv_id, i, ini, CASE WHEN fault IN ('blank', 'duplicate') THEN 999999 WHEN fault = 'truncated' THEN 3 ELSE 0 END AS ok,
               CASE WHEN ini = 'u' THEN {'c': 0, 'a': 'K'} ELSE {'c': 3, 'a': 'R'} END AS u,
               CASE WHEN ini = 'a' THEN {'c': 0, 'a': 'K'} ELSE {'c': 3, 'a': 'R'} END AS s FROM faulty
      ) t ON w.conv_id IS NOT DISTINCT FROM t.conv_id AND t.i = w.i + 1))
), best AS (
  SELECT w.conv_id, list_min([w0, wa]) AS b FROM ways w JOIN counts c ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND w.i = c.n
), edits AS (
  SELECT conv_id, p, substr(b.a, p, 1) AS e FROM (SELECT conv_id, b, unnest(range(1, length(b.a) + 1)) AS p FROM best)
), placed AS (
  SELECT e.*, t.role, t.text, row_number() OVER (PARTITION BY e.conv_id ORDER BY p) AS m
  FROM (SELECT *, count(*) FILTER (e <> 'I') OVER (PARTITION BY conv_id ORDER BY p) AS i FROM edits) e
  LEFT JOIN faulty t ON e.conv_id IS NOT DISTINCT FROM t.conv_id AND e.i = t.i AND e.e <> 'I'
  WHERE e.e <> 'D'
), told AS (
  SELECT *, max(CASE WHEN m = 1 AND e = 'K' AND left(role, 1) = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS off FROM placed
), written AS (
  SELECT conv_id, sha256(string_agg((CASE WHEN e = 'K' THEN role WHEN (m - off) % 2 = 1 THEN 'user' ELSE 'assistant' END) || ':' || coalesce(text, ''), chr(10) ORDER BY p)) AS sha
  FROM told GROUP BY conv_id
)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(b.b.c, 0) AS BIGINT) AS cost, coalesce(b.b.a, '') AS audit,
       coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON o.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN best b ON o.conv_id IS NOT DISTINCT FROM b.conv_id
LEFT JOIN written w ON o.conv_id IS NOT DISTINCT FROM w.conv_id""",
}
QUERIES = {"op12_conversation_repair": op12_conversation_repair}
