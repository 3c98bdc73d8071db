"""Place-name handling: canonical names, domain membership and substring matching.

Substring ("either name contains the other") matching is a theta join.  Instead of a
nested-loop join, distinct candidates go into Aho-Corasick automata and the texts stream past
them: a text is read once for all candidates of an automaton, and rows are made for matches
only.  An automaton holds ``SHARD_CHARS`` characters of candidates at most (its broadcast is
bounded by that, however many candidates there are); more candidates make more passes over
the texts, one automaton after another.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.functions.text import strip, title_case
from panelcast.session import materialize

#: Characters of candidates in one automaton.
SHARD_CHARS = 400_000


def canonical_name(c: str | Column, alias: dict[str, str]) -> Column:
    """strip -> title case -> alias lookup with fallback to the name itself."""
    t = title_case(strip(F.col(c) if isinstance(c, str) else c))
    if not alias:
        return t
    m = F.create_map(*[F.lit(x) for kv in alias.items() for x in kv])
    return F.coalesce(F.try_element_at(m, t), t)


def entity_domain(raw_names: DataFrame, name_col: str, alias: dict[str, str],
                  entity_col: str = "entity") -> DataFrame:
    """Distinct canonical names of an entity dimension."""
    return (raw_names.select(canonical_name(name_col, alias).alias(entity_col))
            .where(F.col(entity_col).isNotNull()).distinct())


def in_domain(df: DataFrame, domain: DataFrame, entity_col: str = "entity") -> DataFrame:
    """Membership as a semi join (the domain side is chosen for broadcast by size)."""
    return df.join(domain.select(entity_col), entity_col, "left_semi")


def _containing(batches, automaton, has_empty: bool):
    """(text, candidate) of every candidate that occurs in a text, once a pair."""
    for batch in batches:
        texts, found = [], []
        for t in batch.column(0).to_pylist():
            hits = {c for _, c in automaton.iter(t)} if len(automaton) and t else set()
            if has_empty:
                hits.add("")
            texts += [t] * len(hits)
            found += sorted(hits)
        yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(found, pa.string())], ["text", "cand"])


def contains_pairs(texts: DataFrame, text_col: str, cands: DataFrame, cand_col: str, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """All (text, candidate) pairs where the text contains the candidate (exact, distinct pairs
    of each text row; nulls match nothing, the empty candidate every text)."""
    import ahocorasick
    spark = texts.sparkSession
    names = cands.select(F.col(cand_col).alias("c")).where(F.col("c").isNotNull()).distinct()
    total = names.agg(F.sum(F.length("c") + 1)).first()[0] or 0
    shards = -(-total // shard_chars)
    rows = texts.select(F.col(text_col).cast("string").alias("t")).where(F.col("t").isNotNull())
    if shards > 1:
        names, rows = materialize(names, "names"), materialize(rows, "texts")
    out = spark.createDataFrame([], "text string, cand string")
    for k in range(shards):
        own = names if shards == 1 else names.where(F.pmod(F.xxhash64("c"), F.lit(shards)) == k)
        automaton = ahocorasick.Automaton()
        words = own.toArrow()["c"].to_pylist()
        for w in words:
            if w:
                automaton.add_word(w, w)
        if len(automaton):
            automaton.make_automaton()
        shared = spark.sparkContext.broadcast(automaton)
        found = rows.mapInArrow(lambda batches, s=shared, e="" in words: _containing(batches, s.value, e), "text string, cand string")
        out = found if shards == 1 else out.unionByName(found)
    return out.select(F.col("text").alias(text_col), F.col("cand").alias(cand_col))


def theta_match_counts(parts: DataFrame, part_col: str, domain: DataFrame,
                       entity_col: str = "entity") -> DataFrame:
    """For each domain name, how many part occurrences match it case-insensitively in
    either direction (part contains name, or name contains part)."""
    occ = (parts.select(F.lower(part_col).alias("p"))
           .groupBy("p").agg(F.count(F.lit(1)).alias("occurrences")))
    dom = domain.select(entity_col, F.lower(entity_col).alias("d"))
    distinct_p = occ.select("p")
    d_names = dom.select("d").distinct()
    a = contains_pairs(distinct_p, "p", d_names, "d")
    b = contains_pairs(d_names, "d", distinct_p, "p")
    pairs = a.unionByName(b).distinct()
    hits = pairs.join(occ, "p").groupBy("d").agg(F.sum("occurrences").alias("n_matches"))
    return (dom.join(hits, "d", "left")
            .select(entity_col, F.coalesce("n_matches", F.lit(0)).cast("bigint").alias("n_matches")))


def text_hit_counts(texts: DataFrame, text_col: str, id_col: str, cands: DataFrame,
                    cand_col: str) -> DataFrame:
    """For each candidate, the number of distinct texts that contain it (case-insensitive)."""
    t = texts.select(id_col, F.lower(text_col).alias("_t")).where(F.col("_t").isNotNull())
    c = cands.select(cand_col, F.lower(cand_col).alias("_c"))
    pairs = contains_pairs(t.select("_t").distinct(), "_t", c.select("_c").distinct(), "_c")
    per_text = t.groupBy("_t").agg(F.count(F.lit(1)).alias("_n"))
    hits = pairs.join(per_text, "_t").groupBy("_c").agg(F.sum("_n").alias("n_texts"))
    return (c.join(hits, "_c", "left")
            .select(cand_col, F.coalesce("n_texts", F.lit(0)).cast("bigint").alias("n_texts")))


def alternate_lookup(targets: DataFrame, entity_col: str, alias: dict[str, str],
                     source: DataFrame, source_name_col: str) -> DataFrame:
    """First-match lookup: the entity name itself, then its alternate spellings in
    order; the first probe contained in any source name wins, else ``NOT FOUND``."""
    alts = [(canon, alt, i + 1) for i, (alt, canon) in enumerate(alias.items())]
    spark = targets.sparkSession
    alt_df = spark.createDataFrame(alts, f"{entity_col} string, probe string, priority int")
    probes = (targets.select(entity_col, F.col(entity_col).alias("probe"), F.lit(0).alias("priority"))
              .unionByName(alt_df.join(targets.select(entity_col), entity_col, "left_semi")))
    names = source.select(F.lower(source_name_col).alias("_t")).where(F.col("_t").isNotNull()).distinct()
    lowered = probes.select(F.lower("probe").alias("_c")).distinct()
    hit = contains_pairs(names, "_t", lowered, "_c").select("_c").distinct()
    found = (probes.join(hit, F.lower(probes["probe"]) == hit["_c"])
             .groupBy(entity_col).agg(F.min_by("probe", "priority").alias("found_as")))
    return (targets.select(entity_col).join(found, entity_col, "left")
            .select(entity_col, F.coalesce("found_as", F.lit("NOT FOUND")).alias("found_as")))
