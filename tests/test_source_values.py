"""JSON of any shape, file order and source profiles against plain Python."""

import json
import random

from pyspark.sql import functions as F

from panelcast.sources import files as fs
from panelcast.sources import json_values as jv
from panelcast.sources import profile as pf


def python_paths(doc, path="$"):
    kind = ("object" if isinstance(doc, dict) else "array" if isinstance(doc, list) else "null" if doc is None else
            "boolean" if isinstance(doc, bool) else "string" if isinstance(doc, str) else "number")
    yield path, kind
    for k, v in doc.items() if isinstance(doc, dict) else ((None, x) for x in doc) if isinstance(doc, list) else ():
        yield from python_paths(v, f"{path}[]" if k is None else f"{path}.{k}")


def test_paths_at_any_depth(spark, tmp_path):
    r = random.Random(1)

    def value(depth):
        pick = r.randrange(9 if depth else 6)
        if pick > 7:
            return [value(depth - 1) for _ in range(r.randrange(3))]
        if pick > 5:
            return {r.choice("abcd"): value(depth - 1) for _ in range(r.randrange(3))}
        return [None, True, 3, 2.5, "x", 10 ** 12][pick]
    docs = [{"id": i, "geometry": {"type": "Point", "coordinates": [i, 0.5]}, "more": value(5)} for i in range(60)] + [7, [], "text", None]
    (tmp_path / "a.jsonl").write_text("\n".join(json.dumps(d) for d in docs) + '\n{"broken": \n\n  \nnot json\n')
    good, bad = jv.read_json_values(spark, str(tmp_path))
    want = {}
    for d in docs:
        for p in python_paths(d):
            want[p] = want.get(p, 0) + 1
    assert {(x.path, x.kind): x.n for x in jv.list_paths(good).collect()} == want
    assert sorted(x.line for x in bad.collect()) == ["not json", '{"broken": ']
    lon = good.select(jv.field("$.geometry.coordinates[0]", "double").alias("x")).where("x is not null").agg(F.sum("x")).first()[0]
    assert lon == sum(range(60))
    empty, none = jv.read_json_values(spark, str(tmp_path / "absent"))
    assert empty.isEmpty() and none.isEmpty() and jv.list_paths(empty).isEmpty()


def test_last_row_in_file_order_as_a_plain_reader(spark, tmp_path):
    r = random.Random(2)
    want = {}
    for f in range(4):
        lines = [f"k{r.randrange(40)},{f * 10_000 + i}" for i in range(3000)]
        (tmp_path / f"part-{f:02d}.csv").write_text("\n".join(lines) + "\n")
        want |= dict(line.split(",") for line in lines)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")  # several blocks a file
    try:
        df = fs.with_file_order(spark.read.schema("k string, v string").csv(str(tmp_path)))
        assert df.rdd.getNumPartitions() > 8
        got = {x.k: x.v for x in fs.last_by_file_order(df, ["k"]).collect()}
        order = [x.v for x in df.orderBy("file_seq").select("v").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == want and [int(v) for v in order] == sorted(int(v) for v in order)


def test_profile_of_batches_is_that_of_the_whole(spark):
    n = 30_000
    df = spark.range(n).select("id", (F.col("id") % 7000).alias("few"), F.when(F.col("id") % 4 > 0, (F.col("id") % 3).cast("string")).alias("word"),
                               F.when(F.col("id") % 10 > 0, F.sin(F.col("id").cast("double"))).alias("wave"), F.lit(None).cast("double").alias("none"))
    batches = [pf.sketch(df.where(F.col("id") % 3 == k)) for k in range(3)]
    got = {x["column"]: x for x in pf.read_profile(pf.merge(batches[0].unionByName(batches[1]).unionByName(batches[2]))).collect()}
    assert {c: (x.n_rows, x.n_nulls) for c, x in got.items()} == {"id": (n, 0), "few": (n, 0), "word": (n, n // 4), "wave": (n, n // 10), "none": (n, n)}
    # measured sketch errors: distinct counts within 5 %, medians within 2 % of the ranks
    for c, exact in {"id": n, "few": 7000, "word": 3, "wave": n - n // 10, "none": 0}.items():
        assert abs(got[c].n_distinct - exact) <= 0.05 * exact, c
    below = df.where(F.col("wave") < got["wave"].median).count() / (n - n // 10)
    assert abs(below - 0.5) < 0.02 and abs(got["id"].median - n / 2) < 0.02 * n
    assert {f["item"]: f["count"] for f in got["word"].frequent} == {str(k): df.where(F.col("word") == str(k)).count() for k in range(3)}
    assert float(got["id"].most) == n - 1 and got["word"].least == "0" and got["none"].least is None
