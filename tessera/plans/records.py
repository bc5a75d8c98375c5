"""Work records from ``orders`` ⟕ ``lineitem`` (line items play authors, concepts, topics…).

Two forms:

* :func:`order_feature_table` — the per-order record features computed from the
  flat line items with partial aggregates (count, max, avg, distinct counts,
  ``min_by`` for the first author). A hot order is spread over many tasks
  before its partials are merged; nothing is collected per key.
* :func:`line_records` — one nested record per line item (arrays and structs
  built from the row itself, no grouping), the shape raw JSON-lines records
  have; the nested-array features run on it.

"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, nested
from ..sources.tables import table

AS_OF = dt.datetime(2025, 1, 1)


def order_feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-order F1, F5-F21, F29-F32 from flat line items (same values as the nested path)."""
    li = table(spark, sf_dir, "lineitem")
    z = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))  # noqa: E731  (missing value → 0)
    agg = li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("num_authors"),
        F.min_by(F.struct(z("l_quantity").alias("h"), z("l_extendedprice").alias("c"),
                          z("l_linenumber").alias("w")),
                 F.struct("l_linenumber", "l_quantity", "l_extendedprice")).alias("__first"),
        F.max(z("l_quantity")).alias("max_author_h_index"), F.avg(z("l_quantity")).alias("avg_author_h_index"),
        F.sum(z("l_extendedprice")).alias("total_author_citations"),
        F.avg(z("l_extendedprice")).alias("avg_author_citations"),
        F.count_if(F.col("l_linenumber") <= 3).alias("num_authorships"),
        F.max(z("l_discount") * 10).alias("max_concept_score"), F.avg(z("l_discount") * 10).alias("avg_concept_score"),
        F.count_if(z("l_discount") * 10 >= nested.HIGH_CONCEPT_SCORE).alias("num_high_concepts"),
        F.count("l_partkey").alias("num_references"),
        F.count_if(F.col("l_returnflag") == "R").alias("num_grants"),
        F.max(z("l_tax") * 10).alias("max_topic_score"), F.avg(z("l_tax") * 10).alias("avg_topic_score"),
        F.count_if(F.col("l_linestatus") == "O").alias("num_mesh_terms"),
        F.count_if(F.col("l_discount") > 0.08).alias("num_sdgs"))
    # distinct counts in their own aggregation: Spark expands rows once per distinct column, and
    # only these two columns need it (institution ids are "I" + supplier key, so their distinct
    # count is the distinct count of non-null supplier keys)
    distinct = li.groupBy("l_orderkey").agg(F.count_distinct("l_suppkey").alias("num_institutions"),
                                            F.count_distinct("l_returnflag").alias("num_keywords"))
    agg = agg.join(distinct, "l_orderkey")
    o = table(spark, sf_dir, "orders")
    j = o.join(agg, o["o_orderkey"] == agg["l_orderkey"], "left")
    n = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    d = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    ref = F.lit(AS_OF.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    return j.select(
        F.col("o_orderkey").alias("id"),
        F.coalesce(F.year("o_orderdate").cast("long"), F.lit(0)).alias("publication_year"),
        F.coalesce("o_orderpriority", F.lit(nested.UNKNOWN)).alias("type"),
        F.coalesce("o_orderstatus", F.lit(nested.UNKNOWN)).alias("language"),
        n("num_authors").alias("num_authors"), n("num_institutions").alias("num_institutions"),
        d("__first.h").alias("first_author_h_index"), d("__first.c").alias("first_author_citations"),
        d("__first.w").alias("first_author_papers"),
        d("max_author_h_index").alias("max_author_h_index"), d("avg_author_h_index").alias("avg_author_h_index"),
        d("total_author_citations").alias("total_author_citations"),
        d("avg_author_citations").alias("avg_author_citations"), n("num_authorships").alias("num_authorships"),
        F.coalesce(F.col("o_totalprice") / 1000, F.lit(0.0)).alias("venue_impact_factor"),
        F.pmod(F.col("o_custkey"), F.lit(100)).cast("double").alias("venue_h_index"),
        F.coalesce(F.col("o_totalprice"), F.lit(0.0)).alias("venue_citations"),
        nested.flag(F.col("o_orderstatus") == "O").alias("is_oa_venue"),
        nested.flag(F.col("o_orderpriority").startswith("1")).alias("is_in_doaj"),
        n("num_authors").alias("num_concepts"), d("max_concept_score").alias("max_concept_score"),
        d("avg_concept_score").alias("avg_concept_score"), n("num_high_concepts").alias("num_high_concepts"),
        nested.flag(F.col("o_orderstatus") == "F").alias("is_oa"),
        F.coalesce(F.when(F.col("o_orderstatus") == "F", F.lit("gold"))
                   .when(F.col("o_orderstatus") == "P", F.lit("green")), F.lit(nested.DEFAULT_OA_STATUS))
        .alias("oa_status"),
        nested.flag(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).alias("any_repository_has_fulltext"),
        n("num_references").alias("num_references"), n("num_institutions").alias("num_related_works"),
        nested.flag(F.col("o_orderpriority") == "1-URGENT").alias("has_doi"),
        nested.flag(F.col("o_orderstatus") == "F").alias("has_pmid"), F.lit(0).alias("has_pmcid"),
        n("num_grants").alias("num_grants"), (n("num_grants") > 0).cast("int").alias("has_grants"),
        n("num_authors").alias("num_locations"), n("num_authors").alias("num_topics"),
        d("max_topic_score").alias("max_topic_score"), d("avg_topic_score").alias("avg_topic_score"),
        n("num_keywords").alias("num_keywords"), n("num_mesh_terms").alias("num_mesh_terms"),
        n("num_sdgs").alias("num_sdgs"), (n("num_sdgs") > 0).cast("int").alias("has_sdgs"),
        (F.lit(AS_OF.year) - F.year("o_orderdate")).cast("long").alias("num_years_after_publication"),
        dates.days_since(F.col("o_orderdate"), AS_OF).alias("days_since_updated"),
        dates.days_since(F.date_trunc("day", F.col("o_orderdate")).cast("timestamp_ntz"), AS_OF)
        .alias("days_since_publication"))


def line_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested work record per line item, built from the row alone (no grouping).

    Arrays of one or two elements with explicit nulls, empty strings, empty
    and missing arrays, so the nested features meet every default path.
    """
    li = table(spark, sf_dir, "lineitem")
    c = F.col
    ss = lambda h, cit, w: F.struct(h.alias("2yr_h_index"), cit.alias("2yr_citedness_count"),
                                    w.alias("2yr_works_count"))
    inst = lambda v: F.struct(v.alias("id"))
    first = F.struct(F.lit("first").alias("author_position"),
                     F.struct(ss(c("l_quantity"), c("l_extendedprice"), c("l_linenumber").cast("double"))
                              .alias("summary_stats")).alias("author"),
                     F.array(inst(F.concat(F.lit("I"), c("l_suppkey").cast("string"))),
                             inst(F.when(c("l_returnflag") == "R", F.lit(""))
                                  .otherwise(F.concat(F.lit("I"), c("l_partkey").cast("string")))))
                     .alias("institutions"))
    second = F.struct(F.lit(None).cast("string").alias("author_position"),
                      F.struct(ss(F.when(c("l_linestatus") == "O", F.lit(None).cast("double"))
                                  .otherwise(c("l_tax") * 100), c("l_discount") * 1000,
                                  F.lit(None).cast("double")).alias("summary_stats")).alias("author"),
                      F.array(inst(F.concat(F.lit("I"), c("l_suppkey").cast("string")))).alias("institutions"))
    return li.select(
        F.concat_ws("-", c("l_orderkey").cast("string"), c("l_linenumber").cast("string")).alias("id"),
        F.year("l_shipdate").cast("long").alias("publication_year"),
        c("l_returnflag").alias("type"),
        F.when(c("l_linestatus") == "O", F.lit("en")).alias("language"),
        F.array(first, second).alias("authorships"),
        F.struct(F.struct((c("l_linestatus") == "O").alias("is_oa"), F.when(c("l_returnflag") != "N", c("l_returnflag") == "A").alias("is_in_doaj"),
                          F.struct((c("l_extendedprice") / 1000).alias("2yr_impact_factor"),
                                   F.when(c("l_linestatus") == "F", c("l_tax") * 10).alias("2yr_h_index"),
                                   c("l_quantity").alias("2yr_cited_by_count")).alias("summary_stats"))
                 .alias("source")).alias("primary_location"),
        F.array(F.struct((c("l_discount") * 10).alias("score")), F.struct((c("l_tax") * 10).alias("score")))
        .alias("concepts"),
        F.when(c("l_returnflag") != "N", F.array(F.struct((c("l_tax") * 5).alias("score")))).alias("topics"),
        F.struct((c("l_returnflag") == "A").alias("is_oa"),
                 F.when(c("l_returnflag") == "A", F.lit("gold")).when(c("l_returnflag") == "R", F.lit("bronze"))
                 .alias("oa_status"),
                 F.when(c("l_linenumber") > 1, c("l_discount") > 0.05).alias("any_repository_has_fulltext")).alias("open_access"),
        F.array(c("l_partkey").cast("string"), c("l_suppkey").cast("string")).alias("referenced_works"),
        F.when(c("l_linestatus") == "O", F.array(c("l_partkey").cast("string"))).otherwise(F.array().cast("array<string>")).alias("related_works"),
        F.struct(F.when(c("l_linestatus") == "F", F.concat(F.lit("10."), c("l_orderkey").cast("string")))
                 .alias("doi"), F.when(c("l_returnflag") == "R", F.lit("123")).otherwise(F.lit("")).alias("pmid"),
                 F.when(c("l_linestatus") == "O", F.lit("PMC1")).alias("pmcid")).alias("ids"),
        F.when(c("l_returnflag") == "R", F.array(F.lit("g"))).alias("grants"),
        F.array(c("l_shipdate").cast("string")).alias("locations"),
        F.array(c("l_returnflag"), c("l_linestatus")).alias("keywords"),
        F.when(c("l_returnflag") == "N", F.array(F.lit("m"), F.lit("n"))).alias("mesh"),
        F.when(c("l_discount") > 0.05, F.array(F.lit("s"))).otherwise(F.array().cast("array<string>"))
        .alias("sustainable_development_goals"))
