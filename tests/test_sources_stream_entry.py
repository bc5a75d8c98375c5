import os
import tempfile

from pyspark.sql import functions as F

from tessera.sources import files
from tessera.streaming import ingest


def test_spec_roundtrip_and_union(spark):
    d = tempfile.mkdtemp(prefix="tessera-test-")
    spec = {"numeric_impute_values": {"x": 1.5}, "id_cols": ["id"]}
    files.write_spec(spark, spec, f"{d}/spec")
    assert files.read_spec(spark, f"{d}/spec") == spec
    a = spark.createDataFrame([(1, 2.0)], "id long, x double")
    b = spark.createDataFrame([(2, "s")], "id long, y string")
    u = files.union_by_name([a, b])
    assert u.where(F.col("id") == 2).first()["x"] is None


def test_family_discovery_and_split_loader(spark):
    d = tempfile.mkdtemp(prefix="tessera-test-")
    df = spark.createDataFrame([(1, [0.1])], "id long, embedding array<float>")
    for fam, splits in (("scibert", ("train", "val", "test")), ("specter2", ("train", "val"))):
        for s in splits:
            df.write.parquet(f"{d}/{fam}_X_{s}.parquet")
    assert files.discover_families(spark, d) == ["scibert"]
    df.write.parquet(f"{d}/train_model_ready_reduced")
    assert files.load_split(spark, d, "train").count() == 1


def test_streaming_ingest_exactly_once(spark):
    src = tempfile.mkdtemp(prefix="tessera-src-")
    sink = tempfile.mkdtemp(prefix="tessera-sink-") + "/out"
    ckpt = tempfile.mkdtemp(prefix="tessera-ckpt-")
    schema = "id long, text string"
    spark.createDataFrame([(1, "a b"), (2, "c")], schema).write.mode("append").parquet(src)

    def tf(df):
        return df.withColumn("n", F.length("text"))
    ingest.ingest_available(spark, src, spark.createDataFrame([], schema).schema, tf, sink, ckpt)
    assert spark.read.parquet(sink).count() == 2
    spark.createDataFrame([(3, "dd")], schema).write.mode("append").parquet(src)
    ingest.ingest_available(spark, src, spark.createDataFrame([], schema).schema, tf, sink, ckpt)
    assert sorted(r["id"] for r in spark.read.parquet(sink).collect()) == [1, 2, 3]


def test_entry_and_registry(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.columns == ["feature", "n", "pearson_r", "spearman_r"]
    assert df.count() > 0
    q, o = e.queries(), e.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 60
    assert os.path.isdir(e.SMOKE_DIR)


def test_schema_inference_from_sample(spark):
    import json
    d = tempfile.mkdtemp(prefix="tessera-test-")
    with open(f"{d}/a.jsonl", "w") as f:
        f.write("\n".join(json.dumps({"id": f"W{i}", "n": i, "tags": ["x"]}) for i in range(5)) + "\n{broken\n")
    df = files.read_jsonl(spark, d)
    assert set(df.columns) == {"id", "n", "tags"} and df.count() == 5


def test_extract_struct_and_compose(spark):
    from tessera.operators import schema
    df = spark.createDataFrame([(1, {"a": 1, "b": "x", "c": 2.0})], "id long, s struct<a: int, b: string, c: double>")
    out = schema.extract_struct(df, "s", "source_", drop=["source_c"])
    assert out.columns == ["id", "source_a", "source_b"]
    composed = schema.compose(df, [(True, lambda d: d.withColumn("k", F.lit(1))), (False, lambda d: d.drop("id"))])
    assert composed.columns == ["id", "s", "k"]


def test_streaming_bounded_batches(spark):
    src = tempfile.mkdtemp(prefix="tessera-src-")
    sink = tempfile.mkdtemp(prefix="tessera-sink-") + "/out"
    schema = "id long, text string"
    for i in range(3):
        spark.createDataFrame([(i, "t" * (i + 1))], schema).coalesce(1).write.mode("append").parquet(src)
    ingest.ingest_available(spark, src, spark.createDataFrame([], schema).schema, lambda d: d, sink,
                            max_files_per_trigger=1)
    assert sorted(r["id"] for r in spark.read.parquet(sink).collect()) == [0, 1, 2]


def test_schema_inference_sees_the_last_line(spark, tmp_path):
    from tessera.sources import files

    path = f"{tmp_path}/late.jsonl"
    with open(path, "w") as f:
        f.writelines('{"id": %d}\n' % k for k in range(1500))
        f.write('not json\n{"id": 1500, "late": "x"}\n')
    df = files.read_jsonl(spark, path)
    assert df.columns == ["id", "late"] and df.where("late = 'x'").count() == 1


def test_jsonl_sink_is_compressed_and_split(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "JSONL_FILE_LINES", 1000)
    df = spark.range(0, 2500, 1, 1).select("id", F.lit("the same words in every line, " * 10).alias("text"), F.lit(None).cast("int").alias("n"))
    files.write_jsonl(df, f"{tmp_path}/lines")
    sizes = [os.path.getsize(f"{tmp_path}/lines/{f}") for f in os.listdir(f"{tmp_path}/lines") if f.startswith("part-")]
    assert len(sizes) == 3 and sum(sizes) < 2500 * 300 / 5
    back = files.read_jsonl(spark, f"{tmp_path}/lines", df.schema)
    assert back.exceptAll(df).count() == 0 and back.count() == 2500


def test_stream_features_of_a_table_in_several_files(spark, tmp_path):
    from tessera.plans import catalog

    docs = spark.createDataFrame([(i, f"title {i}\nsome text", "en", "web", 17) for i in range(20)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    assert len([f for f in os.listdir(f"{tmp_path}/documents.parquet") if f.endswith(".parquet")]) > 1
    assert sorted(r["id"] for r in catalog.QUERIES["s13_stream_features"](spark, str(tmp_path)).collect()) == list(range(20))
