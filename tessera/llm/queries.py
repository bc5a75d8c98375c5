"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.llm import decontaminate, line_dedup, mixing, near_dups, periodic_runs, piece_codec, quality, spelling, token_files, token_rollups, topk, toxicity, warc_audit
from tessera.llm.scratch import Scratch

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.report(near_dups.components(read(spark, sf_dir, "documents")))


def op2_warc_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as WARC records against a replica with damage that follows from the page's digest.

    In the replica one page in 256 has a byte more, one in 256 is lost, and one in 256 is
    found a second time, at an offset where the original has nothing.
    """
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html", F.substring(F.md5(F.coalesce("html", F.lit("")).cast("binary")), 1, 2).alias("mark"))
    body = F.when(F.col("mark") == "00", F.concat(F.col("html"), F.lit("?"))).otherwise(F.col("html"))
    original = pages.select(F.col("page_id").alias("offset"), warc_audit.warc_record(F.col("url"), F.col("html")).alias("record"))
    replica = pages.where("mark <> '01'").select(F.col("page_id").alias("offset"), warc_audit.warc_record(F.col("url"), body).alias("record"))
    twice = pages.where("mark = '02'").select((F.col("page_id") + 1_000_000_000).alias("offset"), warc_audit.warc_record(F.col("url"), F.col("html")).alias("record"))
    return warc_audit.audit(original, replica.union(twice))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(mixing.mix(read(spark, sf_dir, "documents")))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op5_token_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token totals after four batches: all documents inserted (and the state compacted), low-quality ones revised, toxic ones deleted, the revision replayed.

    Tokenizer versions: blank-separated words, and words of ASCII letters and digits. The revised count is that of
    the text without runs of ``* $ % # & ! |``.
    """
    scratch = Scratch(spark, "rollups")
    count = lambda text, word: F.coalesce(F.regexp_count(text, F.lit(word)), F.lit(0)).cast("long")
    cleaned = F.regexp_replace("text", r"[*$%#&!|]+", "")
    words, alnum = r"[^\x20\x09-\x0D]+", "[0-9A-Za-z]+"
    # a row is counted under a number of its own: ids may be null or repeat
    measured = scratch.table(read(spark, sf_dir, "documents").select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "source", "lang", count(F.col("text"), words).alias("words"), count(F.col("text"), alnum).alias("alnum"), count(cleaned, words).alias("cleaned")), "measured")
    labels = read(spark, sf_dir, "labels")

    def batch(rows: DataFrame, first: str, second: str) -> DataFrame:
        versions = F.explode(F.array(*[F.struct(F.lit(name).alias("tokenizer"), F.expr(value).cast("long").alias("n_tokens")) for name, value in (("words-1", first), ("alnum-1", second))]))
        return rows.select(F.col("row").alias("doc_id"), "source", "lang", versions.alias("v")).select("doc_id", "source", "lang", "v.tokenizer", "v.n_tokens")

    rollups = token_rollups.TokenRollups(spark, scratch.path("state"))
    rollups.commit("b1-insert", batch(measured, "words", "alnum"))
    rollups.compact()
    low = measured.join(labels.where("quality = 0").select("doc_id").distinct(), "doc_id", "left_semi")
    revision = batch(low, "cleaned", "alnum")
    rollups.commit("b2-revise", revision)
    toxic = measured.join(labels.where("toxic = 1").select("doc_id").distinct(), "doc_id", "left_semi")
    rollups.commit("b3-delete", batch(toxic, "null", "null"))
    rollups.commit("b2-revise", revision)
    return rollups.totals()


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.encode_corpus(read(spark, sf_dir, "documents"), TOKENIZER)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(line_dedup.dedup_lines(read(spark, sf_dir, "documents")))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(decontaminate.find_hits(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vocabulary of ``documents`` with each word's near words, form and root; null texts have no words."""
    return spelling.group_variants(read(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of each document, a period written over the tail of one in ten; texts without words have none."""
    return periodic_runs.report(periodic_runs.detect(read(spark, sf_dir, "documents"), periodic_runs.planted))


def op13_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of each document and the text read back from them; null text is empty and has no ids."""
    return piece_codec.report(piece_codec.encode(read(spark, sf_dir, "documents").select("doc_id", "text"), PIECES, decoded="decoded"))


QUERIES = {f.__name__: f for f in (
    op1_near_dups, op2_warc_audit, op3_mixing, op4_topk, op5_token_rollups, op6_quality, op7_token_files, op8_line_dedup, op9_toxicity, op10_decontaminate,
    op11_spelling, op12_periodic_runs, op13_pieces)}

# A-Z in lower case only
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_ALNUM = r"regexp_extract_all({}, '[^\x{{0}}-\x{{2F}}\x{{3A}}-\x{{60}}\x{{7B}}-\x{{7F}}]+')"

ORACLES: dict[str, str] = {
    "op1_near_dups": f"""
        with recursive w as (select doc_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} as w from documents),
        s as (select doc_id, unnest(case when len(w) = 0 then [] when len(w) = 1 then [w[1]]
                  else list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) end) as s from w),
        n as (select doc_id, count(*) as n from s group by 1),
        sets as (select doc_id, md5(string_agg(s, chr(10) order by s)) as h from s group by 1),
        reps as (select h, min(doc_id) as id from sets group by 1),
        t as (select s.doc_id as id, s from s join reps on s.doc_id = reps.id),
        common as (select a.id as a, b.id as b, count(*) as k from t a join t b on a.s = b.s and a.id < b.id group by 1, 2),
        links as (select a, b from common c join n x on x.doc_id = c.a join n y on y.doc_id = c.b where 100 * k >= 80 * (x.n + y.n - k)),
        both_ways as (select a, b from links union select b, a from links),
        reach as (select id, id as other from reps union select r.id, l.b from reach r join both_ways l on l.a = r.other),
        label as (select id, min(other) as label from reach group by 1)
        select d.doc_id, coalesce(n.n, 0) as n_shingles, coalesce(label.label, d.doc_id) as component_id,
            d.doc_id = coalesce(label.label, d.doc_id) as kept
        from documents d left join n using (doc_id) left join sets using (doc_id) left join reps using (h) left join label on label.id = reps.id""",
    "op2_warc_audit": r"""
        with p as (select page_id, coalesce(url, '') as url, coalesce(html, '') as html, substr(md5(coalesce(html, '')), 1, 2) as mark from pages),
        r as (select page_id, mark, url, html, case when mark = '00' then html || '?' else html end as copy from p),
        d as (select page_id, mark,
            sha256('WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url || chr(13) || chr(10)
                || 'Content-Length: ' || strlen(html) || chr(13) || chr(10) || chr(13) || chr(10) || html || chr(13) || chr(10) || chr(13) || chr(10)) as a,
            sha256('WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url || chr(13) || chr(10)
                || 'Content-Length: ' || strlen(copy) || chr(13) || chr(10) || chr(13) || chr(10) || copy || chr(13) || chr(10) || chr(13) || chr(10)) as b from r)
        select page_id as "offset", 'changed' as status, a as digest_a, b as digest_b from d where mark = '00'
        union all select page_id, 'missing', a, null from d where mark = '01'
        union all select page_id + 1000000000, 'extra', null, a from d where mark = '02'""",
    "op4_topk": """
        with v as (select vec_id, list_transform(embedding, lambda x: floor(x::double * 1024)::bigint) as q from embeddings
            where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        c as (select a.vec_id as query_id, b.vec_id, list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2]))::bigint as score
            from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
        r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from c)
        select query_id, rank::int as rank, vec_id, score from r where rank <= 10""",
    "op5_token_rollups": rf"""
        with l as (select doc_id, max(quality = 0) as low, max(toxic = 1) as toxic from labels group by 1),
        d as (select source, lang, coalesce(len(regexp_extract_all(case when low then regexp_replace(text, '[*$%#&!|]+', '', 'g') else text end, '[^\x20\x09-\x0D]+')), 0) as w,
            coalesce(len(regexp_extract_all(text, '[0-9A-Za-z]+')), 0) as a from documents left join l using (doc_id) where not coalesce(toxic, false)),
        t as (select source, lang, 'words-1' as tokenizer, w as n from d union all select source, lang, 'alnum-1', a from d)
        select source, lang, tokenizer, count(*) as n_docs, sum(n)::bigint as n_tokens from t group by 1, 2, 3""",
    "op8_line_dedup": f"""
        with l as (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos from documents),
        k as (select *, trim({_LOWER.format('line')}, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') as key from l),
        c as (select key, count(distinct doc_id) as n, max(doc_id) as last from k where length(key) >= 20 group by 1),
        m as (select k.*, coalesce(c.n >= 3 and c.last <> doc_id, false) as gone from k left join c using (key))
        select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
            sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256 from m group by 1""",
    "op10_decontaminate": f"""
        with d as (select doc_id, {_ALNUM.format(_LOWER.format("coalesce(text, '')"))} as w from documents),
        b as (select item_id::varchar as item, {_ALNUM.format(_LOWER.format("coalesce(text, '')"))} as w from benchmark),
        win as (select distinct item, least(len(w), 10) as k, unnest(list_transform(range(1, len(w) - least(len(w), 10) + 2), lambda i: array_to_string(w[i:i + least(len(w), 10) - 1], ' '))) as s from b where len(w) > 0),
        sizes as (select distinct k from win),
        dw as (select doc_id, k, unnest(range(1, len(w) - k + 2)) as p0, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) as s from d, sizes where len(w) >= k),
        hits as (select doc_id, p0, k, item from dw join win using (k, s)),
        pos as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(p0, p0 + k)) as p from hits) group by 1),
        items as (select doc_id, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as list from hits group by 1)
        select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
            sha256(coalesce(list, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
        from d left join pos using (doc_id) left join items using (doc_id)""",
    "op11_spelling": rf"""
        with recursive tab as (select list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end)) as t),
        r as (select doc_id, unnest(regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[a-z\x{{C0}}-\x{{FF}}]+')) as run from documents),
        k as (select doc_id, run, count(*) as k, flatten(list_transform(string_split(doc_id::varchar || ':' || run, ''), lambda c: case when unicode(c) < 128 then [unicode(c)::bigint]
                  else [192 + unicode(c)::bigint // 64, 128 + unicode(c)::bigint % 64] end)) as bytes from r where length(run) >= 6 group by 1, 2),
        h as (select run, k, xor(4294967295, list_reduce(list_prepend(4294967295, bytes), lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8))) as h from k, tab),
        w as (select case when h % 199 = 0 then substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end as word, sum(k)::bigint as n from h group by 1),
        v as (select word, n from w where length(word) >= 6 and n >= 5),
        cut as (select distinct word, n, substr(word, 1, i - 1) || substr(word, i + 1) as rest from (select word, n, unnest(range(1, length(word) + 1)) as i from v)),
        hole as (select word, n, i, substr(word, 1, i - 1) || '.' || substr(word, i + 1) as rest from (select word, n, unnest(range(1, length(word) + 1)) as i from v)),
        del as (select c.word as a, c.n as na, v.word as b, v.n as nb from cut c join v on v.word = c.rest),
        near as (select a, na, b, nb from del union all select b, nb, a, na from del
            union all select x.word, x.n, y.word, y.n from hole x join hole y on x.rest = y.rest and x.i = y.i and x.word <> y.word),
        best as (select a as word, count(*) as n_near, max(nb) as most from near group by 1),
        form as (select word, min(b) as form, min(nb) as form_n from best join near on a = word and nb = most where nb >= 5 * na group by 1),
        chain as (select word, word as root, 0 as step from v union all select c.word, f.form, step + 1 from chain c join form f on f.word = c.root),
        root as (select word, arg_max(root, step) as root from chain group by 1)
        select v.word, form.form, root.root, v.n, coalesce(n_near, 0) as n_near, form.form_n
        from v join root using (word) left join best using (word) left join form using (word)""",
}
