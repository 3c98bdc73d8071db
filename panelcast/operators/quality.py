"""Data-quality reports: source profiles, year distribution, name coverage,
variant families and single-event traces."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions.text import split_list, title_case
from panelcast.operators.names import canonical_name, contains_pairs


def year_distribution(events: DataFrame, date_col: str, cutoff_year: int, list_col: str) -> DataFrame:
    """Events per year with a pre-cutoff marker and decade, plus the conditional
    totals (valid year, before/after cutoff, list present) on every row."""
    y = F.year(date_col)
    per_year = (events.where(F.col(date_col).isNotNull()).groupBy(y.alias("year"))
                .agg(F.count(F.lit(1)).alias("n_events"))
                .withColumn("pre_cutoff", F.col("year") < cutoff_year)
                .withColumn("decade", (F.floor(F.col("year") / 10) * 10).cast("int")))
    totals = events.agg(F.count_if(y.isNotNull()).alias("n_valid_year"),
                        F.count_if(y < cutoff_year).alias("n_pre_cutoff"),
                        F.count_if(y >= cutoff_year).alias("n_post_cutoff"),
                        F.count_if(F.col(list_col).isNotNull()).alias("n_with_list")).first()
    return per_year.select("*", *[F.lit(v).cast("bigint").alias(k) for k, v in totals.asDict().items()])


def event_months(panel: DataFrame, e: str = "entity") -> DataFrame:
    return panel.groupBy(e).agg(F.count_if(F.col("flood_occurrence") > 0).alias("event_months"),
                                F.count(F.lit(1)).alias("total_months"))


def name_variants(parts: DataFrame, part_col: str, alias: dict[str, str], e: str = "entity") -> DataFrame:
    """For each canonical name with alternate spellings: one row per distinct listed
    name that contains the canonical name or one of its alternates (case-insensitive),
    with the family size; a family without variants gives one row with a null variant.
    Long form, so a large family is never gathered into one value."""
    spark = parts.sparkSession
    fam = [(c, c.lower()) for c in sorted(set(alias.values()))] + [(c, a.lower()) for a, c in alias.items()]
    fam_df = spark.createDataFrame(fam, f"{e} string, probe string")
    names = parts.select(F.col(part_col).alias("variant")).distinct().withColumn("_t", F.lower("variant"))
    hits = contains_pairs(names.select("_t").distinct(), "_t", fam_df.select("probe").distinct(), "probe")
    v = hits.join(fam_df, "probe").join(names, "_t").select(e, "variant").distinct()
    sizes = v.groupBy(e).agg(F.count(F.lit(1)).alias("n_variants"))
    return (fam_df.select(e).distinct().join(v, e, "left").join(sizes, e, "left")
            .fillna({"n_variants": 0}).select(e, "variant", "n_variants"))


def event_trace(events: DataFrame, domain: DataFrame, year: int, needle: str, alias: dict[str, str],
                list_col: str = "districts", date_col: str = "start_date", e: str = "entity",
                prefix_len: int = 200) -> DataFrame:
    """Events of ``year`` whose list mentions ``needle``: every listed part with its
    title-cased and canonical form and whether it is in the domain."""
    ev = events.where((F.year(date_col) == year) & F.lower(list_col).contains(needle.lower()))
    x = ev.select("event_id", F.substring(list_col, 1, prefix_len).alias("list_prefix"),
                  F.posexplode(split_list(list_col)).alias("pos", "part"))
    x = x.withColumn("normalized", title_case("part")).withColumn(e, canonical_name("part", alias))
    flag = domain.select(e).distinct().withColumn("in_domain", F.lit(True))
    return (x.join(flag, e, "left").withColumn("in_domain", F.coalesce("in_domain", F.lit(False)))
            .select("event_id", "list_prefix", "pos", "part", "normalized", e, "in_domain"))
