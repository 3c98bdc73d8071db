import os

import pyspark.sql.functions as F
import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def test_stages_against_the_operators(spark):
    """Each stage's rows follow from its operator's own report on that stage's input."""
    import corpus_pipeline as C
    from panelcast.llm import decontaminate, pieces, simhash, substring_dedup, toxicity
    from panelcast.llm.common import docs_table, materialize
    docs = docs_table(spark, SF)
    columns = docs.columns
    for k, (name, stage) in enumerate(C.STAGES):
        out = materialize(stage(spark, docs, SF), "t")
        before = {r["doc_id"]: r for r in docs.collect()}
        after = {r["doc_id"]: r for r in out.collect()}
        assert set(after) <= set(before) and (k == 4 or out.columns == columns)
        if name == "toxicity":
            report = {r["doc_id"]: r["rejected"] for r in toxicity.severity_report(docs, docs_table(spark, SF, "labels")).collect()}
            assert set(after) == {i for i in before if not report[i]}
        elif name == "simhash_near_dedup":
            assert set(after) == {r["doc_id"] for r in simhash.near_duplicates(docs).collect() if r["doc_id"] == r["component_id"]}
        elif name == "substring_dedup":
            for r in substring_dedup.dedup_report(docs).collect():
                left = len((after[r["doc_id"]]["text"] if r["doc_id"] in after else "").encode().split())
                assert left == r["n_words"] - r["n_removed"]
        elif name == "benchmark_decontamination":
            hit = {r["doc_id"]: r["n_hit"] for r in decontaminate.leak_report(docs, docs_table(spark, SF, "benchmark")).collect()}
            assert all(i in after and after[i]["text"] == before[i]["text"] for i in before if not hit[i])
            # no benchmark window that the input had is left: brute force over the kept words in their places
            items = [decontaminate.words_of(r["text"]) for r in docs_table(spark, SF, "benchmark").collect()]
            windows = {tuple(w[i:i + 10]) for w in items for i in range(max(len(w) - 9, min(len(w), 1)))}
            sizes = {len(w) for w in windows}
            assert sum(hit.values()) > 0
            for i, r in before.items():
                had = decontaminate.words_of(r["text"])
                leaks = {p for n in sizes for s in range(len(had) - n + 1) if tuple(had[s:s + n]) in windows for p in range(s, s + n)}
                assert len(leaks) == hit[i]
                if i in after:
                    assert decontaminate.words_of(after[i]["text"]) == [w for p, w in enumerate(had) if p not in leaks]
                else:
                    assert leaks
        else:
            enc = pieces.Encoder(pieces.model_file())
            assert set(after) == set(before)
            assert all(list(after[i]["ids"]) == enc.sp.encode(before[i]["text"]) and after[i]["decoded"] == before[i]["text"] for i in before)
        docs = out
