"""Features of nested work records (F1, F5-F21, F29, F32-F34), as native expressions.

Missing keys, explicit nulls and empty arrays all fall back to the
feature's default, like a path lookup with a default value (P1). Arrays are
handled with higher-order functions, so a record is never exploded.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the record features.
HIGH_CONCEPT_SCORE = 0.5
DEFAULT_OA_STATUS = "closed"
UNKNOWN = "unknown"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def path(col, *keys: str, default=None) -> Column:
    """Nested lookup ``col.k1.k2…`` (struct fields, or 0-based list indexes as digits);
    missing or null → ``default``."""
    c = _c(col)
    for k in keys:
        c = F.get(c, int(k)) if k.isdigit() else c.getField(k)
    return c if default is None else F.coalesce(c, F.lit(default))


def n_items(arr) -> Column:
    """Length of an array; null → 0."""
    a = _c(arr)
    return F.when(a.isNull(), F.lit(0)).otherwise(F.size(a)).cast("long")


def has_items(arr) -> Column:
    return (n_items(arr) > 0).cast("int")


def flag(c) -> Column:
    """Boolean-like → 0/1 with null → 0."""
    return F.coalesce(_c(c).cast("boolean"), F.lit(False)).cast("int")


def nonempty_string_flag(c) -> Column:
    x = _c(c).cast("string")
    return (x.isNotNull() & (x != "")).cast("int")


def _max0(values: Column) -> Column:
    return F.coalesce(F.array_max(values), F.lit(0.0))


def _mean0(values: Column) -> Column:
    total = F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)
    return F.when(F.size(values) > 0, total / F.size(values)).otherwise(F.lit(0.0))


def _sum0(values: Column) -> Column:
    return F.coalesce(F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v), F.lit(0.0))


def author_features(authorships="authorships") -> list[Column]:
    """F5-F9, F32."""
    a = _c(authorships)
    h = F.transform(a, lambda e: F.coalesce(e.getField("author").getField("summary_stats")
                                            .getField("2yr_h_index").cast("double"), F.lit(0.0)))
    cites = F.transform(a, lambda e: F.coalesce(e.getField("author").getField("summary_stats")
                                                .getField("2yr_citedness_count").cast("double"), F.lit(0.0)))
    inst_ids = F.flatten(F.transform(a, lambda e: F.coalesce(e.getField("institutions").getField("id"),
                                                             F.array().cast("array<string>"))))
    first = F.get(a, 0)
    first_stat = lambda k: F.coalesce(first.getField("author").getField("summary_stats").getField(k)
                                      .cast("double"), F.lit(0.0))
    return [
        n_items(a).alias("num_authors"),
        F.coalesce(F.size(F.array_distinct(F.filter(inst_ids, lambda x: x.isNotNull() & (x != "")))), F.lit(0))
        .cast("long").alias("num_institutions"),
        first_stat("2yr_h_index").alias("first_author_h_index"),
        first_stat("2yr_citedness_count").alias("first_author_citations"),
        first_stat("2yr_works_count").alias("first_author_papers"),
        F.coalesce(_max0(h), F.lit(0.0)).alias("max_author_h_index"),
        F.coalesce(_mean0(h), F.lit(0.0)).alias("avg_author_h_index"),
        F.coalesce(_sum0(cites), F.lit(0.0)).alias("total_author_citations"),
        F.coalesce(_mean0(cites), F.lit(0.0)).alias("avg_author_citations"),
        F.coalesce(F.size(F.filter(a, lambda e: e.getField("author_position").isNotNull())), F.lit(0))
        .cast("long").alias("num_authorships"),
    ]


def venue_features(primary_location="primary_location") -> list[Column]:
    """F10-F11."""
    src = _c(primary_location).getField("source")
    ss = src.getField("summary_stats")
    return [
        F.coalesce(ss.getField("2yr_impact_factor").cast("double"), F.lit(0.0)).alias("venue_impact_factor"),
        F.coalesce(ss.getField("2yr_h_index").cast("double"), F.lit(0.0)).alias("venue_h_index"),
        F.coalesce(ss.getField("2yr_cited_by_count").cast("double"), F.lit(0.0)).alias("venue_citations"),
        flag(src.getField("is_oa")).alias("is_oa_venue"),
        flag(src.getField("is_in_doaj")).alias("is_in_doaj"),
    ]


def scored_list_features(arr, prefix: str, with_high: bool = False) -> list[Column]:
    """F12-F13 (concepts) and F19 (topics): count, max and mean score, count ≥ 0.5."""
    a = _c(arr)
    s = F.transform(a, lambda e: F.coalesce(e.getField("score").cast("double"), F.lit(0.0)))
    cols = [
        n_items(a).alias(f"num_{prefix}s"),
        F.coalesce(_max0(s), F.lit(0.0)).alias(f"max_{prefix}_score"),
        F.coalesce(_mean0(s), F.lit(0.0)).alias(f"avg_{prefix}_score"),
    ]
    if with_high:
        cols.append(F.coalesce(F.size(F.filter(s, lambda v: v >= HIGH_CONCEPT_SCORE)), F.lit(0)).cast("long")
                    .alias(f"num_high_{prefix}s"))
    return cols


def open_access_features(open_access="open_access") -> list[Column]:
    """F14, F27 input (oa_status with default 'closed'), F29."""
    oa = _c(open_access)
    return [
        flag(oa.getField("is_oa")).alias("is_oa"),
        F.coalesce(oa.getField("oa_status"), F.lit(DEFAULT_OA_STATUS)).alias("oa_status"),
        flag(oa.getField("any_repository_has_fulltext")).alias("any_repository_has_fulltext"),
    ]


def identifier_features(ids="ids") -> list[Column]:
    """F16."""
    i = _c(ids)
    return [nonempty_string_flag(i.getField(k)).alias(f"has_{k}") for k in ("doi", "pmid", "pmcid")]


def record_features(df_columns: list[str]) -> list[Column]:
    """F1 and F5-F21 (+F29, F32) for a DataFrame of raw work records (explicit schema)."""
    cols = [
        F.coalesce(F.col("publication_year").cast("long"), F.lit(0)).alias("publication_year"),
        F.coalesce(F.col("type"), F.lit(UNKNOWN)).alias("type"),
        F.coalesce(F.col("language"), F.lit(UNKNOWN)).alias("language"),
    ]
    cols += author_features("authorships")
    cols += venue_features("primary_location")
    cols += scored_list_features("concepts", "concept", with_high=True)
    cols += open_access_features("open_access")
    cols += [n_items("referenced_works").alias("num_references"),
             n_items("related_works").alias("num_related_works")]
    cols += identifier_features("ids")
    cols += [n_items("grants").alias("num_grants"), has_items("grants").alias("has_grants"),
             n_items("locations").alias("num_locations")]
    cols += scored_list_features("topics", "topic")
    cols += [n_items("keywords").alias("num_keywords"), n_items("mesh").alias("num_mesh_terms"),
             n_items("sustainable_development_goals").alias("num_sdgs"),
             has_items("sustainable_development_goals").alias("has_sdgs")]
    return cols


# ----------------------------------------------------------------- strings holding nested values

def lenient_json(s) -> Column:
    """parse a JSON string leniently; malformed → an empty object (VARIANT)."""
    return F.coalesce(F.try_parse_json(_c(s)), F.parse_json(F.lit("{}")))


def json_value(s, json_path: str, type_name: str) -> Column:
    """P1 over a JSON string: value at ``json_path`` cast to ``type_name``; bad/missing → null."""
    return F.try_variant_get(lenient_json(s), json_path, type_name)


def json_list_length(s) -> Column:
    """number of items of a JSON list held as a string; malformed or not a list → 0."""
    v = F.try_parse_json(_c(s))
    arr = F.try_variant_get(v, "$", "array<variant>")
    return F.coalesce(F.size(arr), F.lit(0)).cast("long")


def fulltext_flag_from_string(s) -> Column:
    """F29 when ``open_access`` is stored as a string: its ``any_repository_has_fulltext`` → 0/1."""
    return flag(json_value(s, "$.any_repository_has_fulltext", "boolean"))
