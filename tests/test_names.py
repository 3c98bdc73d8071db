"""Containment by automata against Python's ``in``."""

import random

import pytest

from panelcast.operators import names as nm


def pairs(spark, texts, cands, **how):
    t = spark.createDataFrame([(x,) for x in texts], "t string").repartition(3)
    c = spark.createDataFrame([(x, 1) for x in cands], "name string, extra int")
    return sorted((r.t, r.name) for r in nm.contains_pairs(t, "t", c, "name", **how).collect())


@pytest.mark.parametrize("shard_chars", [400_000, 30])
def test_as_python_in(spark, shard_chars):
    r = random.Random(3)
    some = ["".join(r.choice("abé ") for _ in range(r.randint(0, 5))) for _ in range(60)]
    texts = [*{"".join(r.choice("abé ") for _ in range(r.randint(0, 30))) for _ in range(80)}, None]
    cands = [*some, *some[:5], "", None, "a.b*", "nowhere"]
    want = sorted({(t, c) for t in texts if t is not None for c in cands if c is not None and c in t})
    assert pairs(spark, texts, cands, shard_chars=shard_chars) == want


def test_rows_are_matches_only(spark):
    assert pairs(spark, ["x" * 5000, "needle in hay"], ["needle", "absent", "x" * 10]) == [("needle in hay", "needle"), ("x" * 5000, "x" * 10)]


@pytest.mark.parametrize("texts, cands", [([], ["a"]), (["a"], []), ([None], [None]), ([""], ["a"])])
def test_empty_sides(spark, texts, cands):
    assert pairs(spark, texts, cands) == []
