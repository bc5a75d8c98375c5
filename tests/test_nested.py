import datetime as dt
import json
import math
import os
import tempfile

from pyspark.sql import types as T

from tessera.functions import dates, nested
from tessera.sources import files

SS_A = T.StructType([T.StructField("2yr_h_index", T.DoubleType()), T.StructField("2yr_citedness_count", T.DoubleType()),
                     T.StructField("2yr_works_count", T.DoubleType())])
SCHEMA = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("title", T.StringType()),
    T.StructField("publication_year", T.LongType()), T.StructField("type", T.StringType()),
    T.StructField("language", T.StringType()),
    T.StructField("authorships", T.ArrayType(T.StructType([
        T.StructField("author_position", T.StringType()),
        T.StructField("author", T.StructType([T.StructField("summary_stats", SS_A)])),
        T.StructField("institutions", T.ArrayType(T.StructType([T.StructField("id", T.StringType())])))]))),
    T.StructField("primary_location", T.StructType([T.StructField("source", T.StructType([
        T.StructField("is_oa", T.BooleanType()), T.StructField("is_in_doaj", T.BooleanType()),
        T.StructField("summary_stats", T.StructType([T.StructField("2yr_impact_factor", T.DoubleType()),
                                                     T.StructField("2yr_h_index", T.DoubleType()),
                                                     T.StructField("2yr_cited_by_count", T.DoubleType())]))]))])),
    T.StructField("concepts", T.ArrayType(T.StructType([T.StructField("score", T.DoubleType())]))),
    T.StructField("topics", T.ArrayType(T.StructType([T.StructField("score", T.DoubleType())]))),
    T.StructField("open_access", T.StructType([T.StructField("is_oa", T.BooleanType()),
                                               T.StructField("oa_status", T.StringType()),
                                               T.StructField("any_repository_has_fulltext", T.BooleanType())])),
    T.StructField("referenced_works", T.ArrayType(T.StringType())),
    T.StructField("related_works", T.ArrayType(T.StringType())),
    T.StructField("ids", T.StructType([T.StructField("doi", T.StringType()), T.StructField("pmid", T.StringType()),
                                       T.StructField("pmcid", T.StringType())])),
    T.StructField("grants", T.ArrayType(T.StringType())), T.StructField("locations", T.ArrayType(T.StringType())),
    T.StructField("keywords", T.ArrayType(T.StringType())), T.StructField("mesh", T.ArrayType(T.StringType())),
    T.StructField("sustainable_development_goals", T.ArrayType(T.StringType())),
])

FULL = {
    "id": "https://openalex.org/W1", "title": "A", "publication_year": 2020, "type": "article", "language": "en",
    "authorships": [
        {"author_position": "first", "author": {"summary_stats": {"2yr_h_index": 4, "2yr_citedness_count": 10,
                                                                    "2yr_works_count": 3}},
         "institutions": [{"id": "I1"}, {"id": "I2"}]},
        {"author_position": None, "author": {"summary_stats": {"2yr_h_index": None, "2yr_citedness_count": 2}},
         "institutions": [{"id": "I1"}, {"id": ""}]},
        {"author": {"summary_stats": {"2yr_h_index": 8}}},
    ],
    "primary_location": {"source": {"is_oa": True, "is_in_doaj": None,
                                    "summary_stats": {"2yr_impact_factor": 1.5, "2yr_h_index": 7}}},
    "concepts": [{"score": 0.5}, {"score": 0.2}, {"score": 0.9}],
    "topics": [{"score": 0.1}],
    "open_access": {"is_oa": True, "oa_status": "weird-status"},
    "referenced_works": ["a", "b"], "related_works": [],
    "ids": {"doi": "10.1/x", "pmid": "", "pmcid": None},
    "grants": ["g"], "locations": ["l1", "l2"], "keywords": [], "mesh": None, "sustainable_development_goals": ["s"],
}


def _write(lines):
    d = tempfile.mkdtemp(prefix="tessera-test-")
    with open(os.path.join(d, "part.jsonl"), "w") as f:
        f.write("\n".join(lines) + "\n")
    return d


def test_record_features_full_null_absent_and_malformed(spark):
    lines = [json.dumps(FULL), json.dumps({"id": "W2", "authorships": None, "concepts": []}),
             json.dumps({"id": "W3", "extra_key": 1}), '{"id": "W4", "title": ', json.dumps({"id": "W2"})]
    df = files.read_jsonl(spark, _write(lines), SCHEMA)
    assert df.count() == 4                          # the malformed line is dropped
    rows = {r["id"]: r.asDict() for r in df.select("id", *nested.record_features(df.columns)).collect()}
    f = rows["https://openalex.org/W1"]
    assert f["num_authors"] == 3 and f["num_institutions"] == 2          # I1 counted once, '' ignored
    assert f["first_author_h_index"] == 4 and f["first_author_papers"] == 3
    assert f["max_author_h_index"] == 8 and math.isclose(f["avg_author_h_index"], 4.0)   # null → 0
    assert f["total_author_citations"] == 12 and math.isclose(f["avg_author_citations"], 4.0)
    assert f["num_authorships"] == 1
    assert f["venue_impact_factor"] == 1.5 and f["venue_citations"] == 0 and f["is_oa_venue"] == 1
    assert f["is_in_doaj"] == 0
    assert f["num_concepts"] == 3 and f["num_high_concepts"] == 2 and math.isclose(f["avg_concept_score"], 1.6 / 3)
    assert f["oa_status"] == "weird-status" and f["is_oa"] == 1 and f["any_repository_has_fulltext"] == 0
    assert (f["has_doi"], f["has_pmid"], f["has_pmcid"]) == (1, 0, 0)
    assert (f["num_grants"], f["has_grants"], f["num_locations"], f["num_mesh_terms"], f["num_sdgs"]) == (1, 1, 2, 0, 1)
    for k in ("W2", "W3"):
        g = rows[k]
        assert g["num_authors"] == 0 and g["first_author_h_index"] == 0 and g["max_concept_score"] == 0
        assert g["oa_status"] == "closed" and g["type"] == "unknown" and g["publication_year"] == 0


def test_rejects_kept_when_asked(spark):
    df = files.read_jsonl(spark, _write([json.dumps({"id": "W1"}), "{bad"]), SCHEMA, keep_rejects=True)
    assert [r[files.CORRUPT_COLUMN] for r in files.rejected_lines(df).collect()] == ["{bad"]


def test_json_helpers(spark):
    df = spark.createDataFrame([('{"k": 3}',), ("not json",), ('["a","b"]',), (None,)], "s string")
    out = df.select(nested.json_value("s", "$.k", "int").alias("k"), nested.json_list_length("s").alias("n")).collect()
    assert [r["k"] for r in out] == [3, None, None, None]
    assert [r["n"] for r in out] == [0, 0, 2, 0]


def test_path_lookup(spark):
    df = spark.createDataFrame([({"a": {"b": 5}}, [1, 2])], "m struct<a: struct<b: int>>, l array<int>")
    r = df.select(nested.path("m", "a", "b").alias("x"), nested.path("l", "1").alias("y"),
                  nested.path("l", "5", default=0).alias("z")).first()
    assert (r["x"], r["y"], r["z"]) == (5, 2, 0)


def test_dates(spark):
    df = spark.createDataFrame([("2024-12-31T12:00:00.5", "2024-12-01"), ("garbage", "2024-13-40")],
                               "u string, p string")
    out = df.select(*dates.date_features("u", "p", dt.datetime(2025, 1, 1))).collect()
    assert (out[0]["days_since_updated"], out[0]["days_since_publication"]) == (0, 31)
    assert (out[1]["days_since_updated"], out[1]["days_since_publication"]) == (None, None)
    assert df.select(dates.years_after("p", 2025)).count() == 2
