import math

from pyspark.sql import functions as F

from tessera.functions import text


def _one(spark, value, cols):
    df = spark.createDataFrame([(value,)], "t string")
    return df.select(*cols).first().asDict()


def test_nlp_features_hand_computed(spark):
    r = _one(spark, "Hello world. It is 2024! Ok?", text.nlp_features("t"))
    assert r["nlp_char_count"] == 28
    assert r["nlp_word_count"] == 6                      # Hello world It is 2024 Ok
    assert math.isclose(r["nlp_avg_word_length"], (5 + 5 + 2 + 2 + 4 + 2) / 6)
    assert r["nlp_sentence_count"] == 3
    assert math.isclose(r["nlp_avg_sentence_length"], (2 + 3 + 1) / 3)
    assert math.isclose(r["nlp_capital_ratio"], 3 / 28)  # H I O
    assert math.isclose(r["nlp_number_ratio"], 4 / 28)
    assert math.isclose(r["nlp_punctuation_ratio"], 3 / 28)


def test_nlp_features_empty_and_null(spark):
    for v in ("", None):
        r = _one(spark, v, text.nlp_features("t"))
        assert all(x == 0 for x in r.values())


def test_punctuation_only_and_unicode(spark):
    r = _one(spark, "...!!!", text.nlp_features("t"))
    assert r["nlp_word_count"] == 0 and r["nlp_sentence_count"] == 0
    r = _one(spark, "Élan café ١٢٣", text.nlp_features("t"))
    assert r["nlp_word_count"] == 3          # Unicode letters and Arabic-Indic digits are word characters
    assert math.isclose(r["nlp_number_ratio"], 3 / 13)


def test_title_abstract_features(spark):
    df = spark.createDataFrame([("A  title\there", None), ("T", "")], "title string, abstract string")
    rows = df.select(*text.title_abstract_features("title", "abstract")).collect()
    assert rows[0]["title_word_count"] == 3 and rows[0]["title_length"] == 13
    assert rows[0]["has_abstract"] == 0 and rows[0]["abstract_word_count"] == 0
    assert rows[1]["has_abstract"] == 0 and rows[1]["abstract_length"] == 0


def test_clean_text(spark):
    r = _one(spark, "  Hi\t\tthere @you #1 (ok)-'yes' ", [text.clean_text("t").alias("c")])
    assert r["c"] == "Hi there you 1 (ok)-'yes'"
    long = "a" * 10005
    r = _one(spark, long, [text.clean_text("t", max_chars=10000).alias("c"), text.clean_text("t").alias("w")])
    assert r["c"] == "a" * 10000 + "..."
    assert r["w"] == long                     # default: whole text


def test_embedding_text(spark):
    df = spark.createDataFrame([("T", "Abs"), ("T", None), ("T", "")], "title string, abstract string")
    out = [r[0] for r in df.select(text.embedding_text("title", "abstract")).collect()]
    assert out == ["T. Abs", "T", "T"]


def test_work_id(spark):
    vals = ["W12", "https://openalex.org/W12", "W/12", "abc", "xW5y"]
    df = spark.createDataFrame([(v,) for v in vals], "id string")
    out = [r[0] for r in df.select(text.work_id("id")).collect()]
    assert out == ["W12", "W12", "W/12", "abc", "W5"]


def test_first_line_split(spark):
    df = spark.createDataFrame([("a\nb\nc",), ("solo",)], "t string")
    rows = df.select(text.first_line("t").alias("h"), text.after_first_line("t").alias("r")).collect()
    assert (rows[0]["h"], rows[0]["r"]) == ("a", "b\nc")
    assert (rows[1]["h"], rows[1]["r"]) == ("solo", None)
    assert df.select(F.lit(1)).count() == 2


def test_counts_are_those_of_the_regexes(spark):
    """Counted by bytes; held against Java's regexes on all kinds of characters."""
    import random

    rng = random.Random(5)
    kinds = ["a", "Z", "_", "7", " ", "\t", "\n", "\x0b", "\x1c", "\x85", "\xa0", "\u2003", "\u3000", "\u200d", "\u0301", "\u203f", "\u00bd", "\u24b6", "\u0663", "\u00c9",
             "\u4e2d", "\U0001d7d8", "\U0001f130", "\U0001f600", ".", "!", "?", ",", ";", ":", "-", "'", "\0", "\x7f"]
    rows = [(i, "".join(rng.choice(kinds) for _ in range(rng.randrange(40)))) for i in range(2000)] + [(2000, None)]
    df = spark.createDataFrame(rows, "i int, t string")
    n = lambda regex: F.regexp_count(F.coalesce("t", F.lit("")), F.lit(regex))
    chars, r = F.length(F.coalesce("t", F.lit(""))), lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    want = [chars, n(r"(?U)\w+"), r(F.length(F.regexp_replace(F.coalesce("t", F.lit("")), r"(?U)\W+", "")), n(r"(?U)\w+")), n(r"(?U)[^.!?\s][^.!?]*"),
            r(n(r"(?U)[^\s.!?]+"), n(r"(?U)[^.!?\s][^.!?]*")), r(n("[A-Z]"), chars), r(n(r"\p{Nd}"), chars), r(n("[.,;:!?]"), chars), n(r"(?U)\S+")]
    got = df.select("i", *text.nlp_features("t"), text.title_abstract_features("t", "t")[-1]).orderBy("i").collect()
    assert [tuple(x) for x in got] == [tuple(x) for x in df.select("i", *want).orderBy("i").collect()]


def test_counts_list_no_matches(spark):
    """A list of matches a count made most of the time of every query over the feature table."""
    df = spark.createDataFrame([("a", "b")], "title string, abstract string")
    plan = df.select(*text.nlp_features("title"), *text.title_abstract_features("title", "abstract"))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" not in plan
