"""Mixing sources to target weights by Efraimidis-Spirakis sampling, DataFrame operations only.

Every document gets an exponential key ``-ln(u) / quality``: ``u`` in (0, 1) from the MD5 digest
of its id and text (so reruns agree), ``quality`` its weight.  Ascending keys are a weighted
sample without replacement at every length, so a source's documents are sorted by key once and
running sums of their sizes are cut at the source's budget of words.

A source's target is its share of all words by weight, at most ``max_epochs`` times its own
words; what is above goes to the other sources by weight until none is above.  Complete epochs
(the whole source) come first, the rest of the budget is the fractional selection.  The
document at which it ends gives the words that are still missing (``cut=True``, at most one
document of a source), or is taken whole if that is nearer (``cut=False``).

Nothing is held by source: rows are range-sorted on (source, key), running sums are made inside
the partitions and offset by the partitions' totals, so that a source with a third of all rows
is spread over as many tasks as its rows need.  The fill of the targets works on one row a source.

Defined results: a null text has no words (size 0, taken 0, no row in the mix); null sources are one source that
comes last; a null doc_id is an id like others; repeated rows are drawn one by one (which of
two equal rows comes first can't be seen); ties of keys go by digest; a source without words
has target 0; an empty table gives an empty result; sizes of very long texts are counted
like others; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.common import docs_table, materialize
from panelcast.operators.splits import global_row_index, grouped_prefix_sums

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in the order of their names, repeating.
WEIGHTS = (1, 2, 3)
#: A source is repeated at most so often.
MAX_EPOCHS = 3
#: Characters that running text has few of; their share lowers a document's quality weight.
ODD_CHARS = "0123456789#$%&*+<=>@[]^_{|}~"
QUALITY_LEAST = 0.0625
#: Hex digits of the digest that make u.
U_DIGITS = 13


def text_quality(text: Column) -> Column:
    """1 for running text, less by four times the share of odd characters, 0.0625 at least."""
    plain = F.length(F.translate(text, ODD_CHARS, ""))
    share = 1.0 - plain / F.length(text)
    return F.coalesce(F.when(F.length(text) > 0, F.greatest(F.lit(QUALITY_LEAST), 1.0 - 4.0 * share)), F.lit(QUALITY_LEAST))


def _digest(doc_id: Column, text: Column) -> Column:
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit(""))))


def _rows(docs: DataFrame, quality: Column | None) -> DataFrame:
    """doc_id, grp (the source; a letter in front tells null), size, digest and key."""
    text = F.col("text").cast("string")
    source = F.col("source").cast("string")
    weight = F.greatest((text_quality(text) if quality is None else quality).cast("double"), F.lit(1e-9))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("a"), source)).alias("grp"),
                       F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
                       weight.alias("weight"), _digest(F.col("doc_id"), text).alias("digest"))
    u = (F.conv(F.substring("digest", 1, U_DIGITS), 16, 10).cast("double") + 0.5) / float(16 ** U_DIGITS)
    return rows.select("doc_id", "grp", "size", "digest", F.struct((-F.log(u) / F.col("weight")).alias("k"), "digest").alias("key"))


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """grp, size of each source -> grp, source_size, target.

    In the order of size by weight, a source is full if its limit is at most its share of what
    the sources before it leave; the others share the rest by weight."""
    ranked = global_row_index(sizes, ["grp"], "rank")
    step = math.lcm(*weights)
    weight = F.element_at(F.array(*[F.lit(w).cast("bigint") for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = (ranked.withColumn("w", weight).withColumn("limit", F.col("size") * max_epochs).withColumn("all", F.lit(0))
              .withColumn("by", F.struct((F.col("size").cast("decimal(38,0)") * F.lit(step) / F.col("w")).alias("r"), "rank")))
    run = materialize(grouped_prefix_sums(ranked.select("grp", "size", "w", "limit", "all", "by"), "all", "by", ["limit", "w"], exclusive=True)
                      .select("grp", "size", "w", "limit", "cum_limit", "cum_w"), "targets")
    total, weight_sum = run.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.sum("w"), F.lit(0))).first()
    exact = lambda c: F.col(c).cast("decimal(38,0)")
    run = run.withColumn("full", exact("limit") * (F.lit(weight_sum) - F.col("cum_w")) <= exact("w") * (F.lit(total) - F.col("cum_limit")))
    fulls, full_w = run.filter("full").agg(F.coalesce(F.sum("limit"), F.lit(0)), F.coalesce(F.sum("w"), F.lit(0))).first()
    share = F.col("w").cast("double") * float(total - fulls) / float(max(weight_sum - full_w, 1))
    return run.select("grp", F.col("size").alias("source_size"), F.when(F.col("full"), F.col("limit").cast("double")).otherwise(share).alias("target"))


def selection(docs: DataFrame, quality: Column | None = None, weights: Sequence[int] = WEIGHTS,
              max_epochs: int = MAX_EPOCHS, cut: bool = True) -> DataFrame:
    """doc_id, size, source_size, target, epochs (times the document is taken whole),
    part_words (words taken of it once more, fewer than its size), taken, digest."""
    rows = materialize(_rows(docs, quality), "mix-rows")
    targets = materialize(source_targets(rows.groupBy("grp").agg(F.sum("size").alias("size")), weights, max_epochs), "mix-targets")
    run = grouped_prefix_sums(rows, "grp", "key", ["size"]).join(targets, "grp")
    budget = F.floor(F.col("target") + 0.5)
    once = F.when(F.col("source_size") > 0, F.expr("_budget div source_size")).otherwise(F.lit(0))
    rest, before = F.col("_budget") - F.col("_whole") * F.col("source_size"), F.col("cum_size") - F.col("size")
    if cut:
        more = F.greatest(F.lit(0), F.least(F.col("size"), rest - before))
    else:
        more = F.when(F.col("cum_size") + before <= 2 * rest, F.col("size")).otherwise(F.lit(0))
    run = run.withColumn("_budget", budget.cast("bigint")).withColumn("_whole", once.cast("bigint")).withColumn("_more", more.cast("bigint"))
    all_of = (F.col("_more") == F.col("size")) & (F.col("size") > 0)
    return run.select("doc_id", "size", "source_size", "target", F.when(F.col("size") > 0, F.col("_whole") + all_of.cast("bigint")).otherwise(F.lit(0)).alias("epochs"),
                      F.when(all_of, F.lit(0).cast("bigint")).otherwise(F.col("_more")).alias("part_words"),
                      (F.col("_whole") * F.col("size") + F.col("_more")).alias("taken"), "digest")


def mixed(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: doc_id, source, text, epoch; a document that is taken n times has n rows,
    one taken in part has its first words, joined by one space, in its last row."""
    picks = selection(docs, **how).groupBy("digest").agg(F.sum("epochs").alias("epochs"), F.max("part_words").alias("part"))
    # equal rows (one digest) are one text here, their epochs add up
    texts = (docs.select("doc_id", F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"))
             .withColumn("digest", _digest(F.col("doc_id"), F.col("text"))))
    texts = texts.groupBy("digest", "source").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"))
    head = F.array_join(F.expr(rf"slice(regexp_extract_all(text, '{WORD}', 0), 1, part)".replace("\\", "\\\\")), " ")
    rounds = F.when(F.col("epochs") + (F.col("part") > 0).cast("bigint") > 0, F.sequence(F.lit(1).cast("bigint"), F.col("epochs") + (F.col("part") > 0).cast("bigint")))
    return (texts.join(picks.filter("epochs + part > 0"), "digest").withColumn("epoch", F.explode(rounds))
            .select("doc_id", "source", F.when(F.col("epoch") > F.col("epochs"), head).otherwise(F.col("text")).alias("text"), "epoch"))


def op11_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection(docs_table(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


SQL = {
    "op11_source_mixing": rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS digest,
         CASE WHEN length(text) > 0
              THEN greatest({QUALITY_LEAST}, 1.0::DOUBLE - 4.0::DOUBLE * (1.0::DOUBLE - length(translate(text, '{ODD_CHARS}', ''))::DOUBLE / length(text)::DOUBLE))
              ELSE {QUALITY_LEAST} END AS quality
  FROM documents
), s AS (
  SELECT source, sum(size) AS total, (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS w FROM d GROUP BY source
), r AS (
  SELECT *, coalesce(sum(3 * total) OVER o, 0) AS limit_before, coalesce(sum(w) OVER o, 0) AS w_before,
         sum(total) OVER () AS everything, sum(w) OVER () AS w_all
  FROM s WINDOW o AS (ORDER BY total * 6 // w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), f AS (
  SELECT *, 3 * total * (w_all - w_before) <= w * (everything - limit_before) AS full_up FROM r
), t AS (
  SELECT source, total AS source_size, CASE WHEN full_up THEN CAST(3 * total AS DOUBLE)
         ELSE CAST(w AS DOUBLE) * CAST(everything - sum(CASE WHEN full_up THEN 3 * total ELSE 0 END) OVER () AS DOUBLE)
              / CAST(w_all - sum(CASE WHEN full_up THEN w ELSE 0 END) OVER () AS DOUBLE) END AS target FROM f
), k AS (
  SELECT d.doc_id, d.size, CAST(t.source_size AS BIGINT) AS source_size, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS budget,
         CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY -ln((CAST('0x' || substr(digest, 1, {U_DIGITS}) AS BIGINT)::DOUBLE + 0.5) / {16 ** U_DIGITS}::DOUBLE) / quality, digest
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0 ELSE budget // source_size * size
            + greatest(0, least(size, budget % source_size - (cum - size))) END AS BIGINT) AS taken
FROM k""",
}
QUERIES = {"op11_source_mixing": op11_source_mixing}
