"""DuckDB spellings of the feature definitions, for the oracle SQL.

RE2 character classes are ASCII unless written as Unicode properties, so the
Unicode-aware Java classes used on the Spark side are spelled out here.
"""

from __future__ import annotations

from ..functions import keys
from . import works

# Unicode whitespace (Java's (?U)\s) and word characters (Java's (?U)\w).
WS = r"[\t\n\x{0B}\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
NON_WS = r"[^\t\n\x{0B}\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
WORD = r"[\p{L}\p{Nl}\p{Nd}\p{M}\p{Pc}]"
NON_WORD = r"[^\p{L}\p{Nl}\p{Nd}\p{M}\p{Pc}]"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def ws_words(t: str) -> str:
    return f"CAST(len(list_filter(regexp_split_to_array(coalesce({t}, ''), {q(WS + '+')}), lambda w: w <> '')) AS BIGINT)"


def clen(t: str) -> str:
    return f"CAST(coalesce(length({t}), 0) AS BIGINT)"


def ratio(num: str, den: str) -> str:
    return f"(CASE WHEN ({den}) > 0 THEN CAST({num} AS DOUBLE) / ({den}) ELSE 0.0 END)"


def regex_count(t: str, pat: str) -> str:
    return f"CAST(len(regexp_extract_all({t}, {q(pat)})) AS BIGINT)"


def nlp_select(t: str) -> str:
    """The eight nlp_* columns for a non-null text expression ``t``."""
    words = regex_count(t, WORD + "+")
    word_chars = f"length(regexp_replace({t}, {q(NON_WORD)}, '', 'g'))"
    sentences = (f"CAST(len(list_filter(regexp_split_to_array({t}, '[.!?]+'), "
                 f"lambda s: regexp_matches(s, {q(NON_WS)}))) AS BIGINT)")
    sent_words = ws_words(f"regexp_replace({t}, '[.!?]+', ' ', 'g')")
    chars = f"CAST(length({t}) AS BIGINT)"
    return ",\n".join([
        f"{chars} AS nlp_char_count",
        f"{words} AS nlp_word_count",
        f"{ratio(word_chars, words)} AS nlp_avg_word_length",
        f"{sentences} AS nlp_sentence_count",
        f"{ratio(sent_words, sentences)} AS nlp_avg_sentence_length",
        f"{ratio(regex_count(t, '[A-Z]'), chars)} AS nlp_capital_ratio",
        f"{ratio(regex_count(t, r'\p{Nd}'), chars)} AS nlp_number_ratio",
        f"{ratio(regex_count(t, '[.,;:!?]'), chars)} AS nlp_punctuation_ratio",
    ])


def split_sql(id_sql: str) -> str:
    u = f"(CAST({keys.seeded_key_sql(id_sql, works.SPLIT_SEED)} AS DOUBLE) / 2147483648.0)"
    return (f"(CASE WHEN {u} < {works.TRAIN_FRACTION} THEN 'train' "
            f"WHEN {u} < {works.TRAIN_FRACTION + works.VAL_FRACTION} THEN 'val' ELSE 'test' END)")


WORKS_CTE = f"""
works_raw AS (
  SELECT d.doc_id AS id,
         split_part(d.text, chr(10), 1) AS title,
         nullif(substring(d.text, length(split_part(d.text, chr(10), 1)) + 2), '') AS abstract,
         d.lang AS language, d.source AS type, d.n_chars,
         l.quality AS label, l.toxic
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
),
works AS (SELECT *, {split_sql('id')} AS split FROM works_raw),
feats AS (
  SELECT id,
         coalesce(type, 'unknown') AS type,
         coalesce(language, 'unknown') AS language,
         {clen('title')} AS title_length,
         {clen('abstract')} AS abstract_length,
         CAST(CASE WHEN {clen('abstract')} > 0 THEN 1 ELSE 0 END AS INTEGER) AS has_abstract,
         {ws_words('title')} AS title_word_count,
         {ws_words('abstract')} AS abstract_word_count,
         {nlp_select("(coalesce(title, '') || ' ' || coalesce(abstract, ''))")},
         n_chars, label, split
  FROM works
)"""


def unpivot_features(src: str, feats: list[str], label: str = "label", cast: str = "DOUBLE") -> str:
    """Long (feature, x, y) rows of ``src`` via UNION ALL (one branch per feature)."""
    return "\nUNION ALL\n".join(
        f"SELECT '{f}' AS feature, CAST({f} AS {cast}) AS x, CAST({label} AS DOUBLE) AS y FROM {src}"
        for f in feats)


def _model_values() -> str:
    from .scores import MODEL_PARAMS
    return ", ".join(f"('{m}', {a}, {b})" for m, a, b in MODEL_PARAMS)


def scores_cte() -> str:
    from .scores import FOLD_SEED, N_FOLDS
    key = keys.seeded_key_sql("id", FOLD_SEED)
    return f"""
labeled AS (
  SELECT d.doc_id AS id, l.quality AS label FROM documents d JOIN labels l ON l.doc_id = d.doc_id),
scores AS (
  SELECT b.id, b.label, m.model, CAST((b.id * m.a + b.label * m.b) % 1000 AS DOUBLE) / 1000.0 AS p
  FROM labeled b, (VALUES {_model_values()}) AS m(model, a, b)),
lpos AS (
  SELECT id, label,
         row_number() OVER (PARTITION BY label ORDER BY {key}, id) - 1 AS pos,
         count(*) OVER (PARTITION BY label) AS class_n
  FROM labeled),
lfold AS (
  SELECT id, label, CAST(CASE WHEN class_n // {N_FOLDS} = 0 THEN {N_FOLDS - 1}
                         ELSE least(pos // (class_n // {N_FOLDS}), {N_FOLDS - 1}) END AS INTEGER) AS fold
  FROM lpos),
sfold AS (SELECT s.*, f.fold FROM scores s JOIN lfold f USING (id)),
counts AS (
  SELECT model, p AS threshold, sum(CAST(label = 1 AS BIGINT)) AS pos, sum(CAST(label <> 1 AS BIGINT)) AS neg
  FROM scores GROUP BY model, p),
curve AS (
  SELECT model, threshold, pos, neg,
         sum(pos) OVER (PARTITION BY model ORDER BY threshold DESC) AS tp,
         sum(neg) OVER (PARTITION BY model ORDER BY threshold DESC) AS fp,
         sum(pos) OVER (PARTITION BY model) AS n_pos,
         sum(neg) OVER (PARTITION BY model) AS n_neg
  FROM counts)"""


def grid_values(name: str, grid: list[float]) -> str:
    """A VALUES table (t_index, threshold) with exact doubles."""
    rows = ", ".join(f"({i}, CAST('{float(t)!r}' AS DOUBLE))" for i, t in enumerate(grid))
    return f"{name}(t_index, threshold) AS (SELECT * FROM (VALUES {rows}))"


def grid_f1(grid_name: str, src: str = "scores", keys: str = "model") -> str:
    """Per (keys, t_index): tp, fp, fn and F1 of p ≥ threshold, by brute force over the grid."""
    return f"""
  SELECT {keys}, g.t_index, g.threshold,
         sum(CAST(s.label = 1 AND s.p >= g.threshold AS BIGINT)) AS tp,
         sum(CAST(s.label <> 1 AND s.p >= g.threshold AS BIGINT)) AS fp,
         sum(CAST(s.label = 1 AND s.p < g.threshold AS BIGINT)) AS fn
  FROM {src} s, {grid_name} g GROUP BY ALL"""
