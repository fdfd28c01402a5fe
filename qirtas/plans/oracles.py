"""The SQL twin of each registered query, written for DuckDB.

Works on the generic test tables and spells every rule out in SQL terms
(lists, unnest, CASE), independently of the Column expressions.
"""

from __future__ import annotations

from qirtas.functions.lexicons import RULE_WORDS, TOP_WORDS
from qirtas.functions.stem import KEPT_WORDS
from qirtas.functions.text import fold_words
from qirtas.sources import fixtures as fx

TABLES = ["documents", "labels", "conversations", "pages", "benchmark"]


def _strings(words) -> str:
    return ", ".join("'" + w + "'" for w in words)


def _list(words) -> str:
    return f"[{_strings(words)}]"


# Shared pieces ---------------------------------------------------------------
_ARABIC = f"translate(lower(text), '{fx.LATIN}', '{fx.ARABIC}')"
DOCS = f"docs AS (SELECT doc_id, source, {_ARABIC} AS text FROM documents)"
_METHOD = "['by_polishing', 'from_title', 'from_title_and_content'][({} % 3 + 1)::INT]"
LAB = f"""{DOCS}, lab AS (
  SELECT d.doc_id, d.text, CASE WHEN l.quality = 1 THEN 'ai' ELSE 'human' END AS label,
         {_METHOD.format("d.doc_id")} AS generation_method, d.source AS source_model
  FROM docs d JOIN labels l ON d.doc_id = l.doc_id)"""
_SLOTS = [
    "original_abstract",
    "allam_generated_abstract",
    "jais_generated_abstract",
    "llama_generated_abstract",
    "openai_generated_abstract",
]
WIDE = (
    "wide AS (SELECT conv_id, turn // 5 AS part, "
    + ", ".join(f"max(CASE WHEN turn % 5 = {k} THEN text END) AS {n}" for k, n in enumerate(_SLOTS))
    + f", {_METHOD.format('conv_id')} AS generation_method"
    + " FROM conversations GROUP BY conv_id, turn // 5)"
)
RAW = f"""{WIDE}, raw AS (
  SELECT conv_id, part, text,
         CASE WHEN slot = 'original_abstract' THEN 'human' ELSE 'ai' END AS label,
         generation_method,
         CASE WHEN slot = 'original_abstract' THEN 'human' ELSE split_part(slot, '_', 1) END
           AS source_model
  FROM (UNPIVOT wide ON {", ".join(_SLOTS)} INTO NAME slot VALUE text))"""


def _bare(col: str) -> str:
    return (
        f"regexp_replace(coalesce({col}, ''), "
        "'[\\x{0617}-\\x{061A}\\x{064B}-\\x{0652}]', '', 'g')"
    )


def _folded(col: str) -> str:
    return f"translate({_bare(col)}, 'إأآىؤئة', 'ااايويه')"


def _script(expr: str) -> str:
    return f"regexp_replace({expr}, '[^\\x{{0600}}-\\x{{06FF}} ]+', ' ', 'g')"


def _tokens(expr: str) -> str:
    return f"list_filter(string_split({expr}, ' '), lambda x: x <> '')"


def _clean_cte(source: str, stopwords=(), name: str = "c") -> str:
    toks = _tokens(_script(_folded("text")))
    if stopwords:
        toks = f"list_filter({toks}, lambda x: x NOT IN ({_strings(sorted(stopwords))}))"
    return (
        f"{name} AS (SELECT *, array_to_string(tok, ' ') AS cleaned_text "
        f"FROM (SELECT *, {toks} AS tok FROM {source}) WHERE len(tok) > 0)"
    )


_LIGHT = (
    "trim(" + _script(f"translate({_bare('text')}, 'إأآىة', 'ااايه')") + ")"
)
CLEAN_DOCS = f"{DOCS}, {_clean_cte('docs')}"
CLEAN_LAB = f"{LAB}, {_clean_cte('lab')}"

# Features of a cleaned relation c(doc_id, text, tok) ---------------------------
_LENGTHS = "list_transform(tok, lambda x: length(x)::DOUBLE)"
_F15 = f"CASE WHEN len(tok) < 2 THEN 0.0 ELSE list_var_pop({_LENGTHS}) END::FLOAT::DOUBLE"
_WS = r"[\s\x0b\x1c-\x1f\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_NOT_BLANK = f"NOT regexp_full_match(x, '{_WS}*')"
_LINES = f"list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: {_NOT_BLANK})"
_SENTENCES = (
    f"list_sum(list_transform({_LINES}, lambda p: "
    f"len(list_filter(regexp_split_to_array(p, '[.!?؟،]'), lambda x: {_NOT_BLANK}))))"
)
_F36 = f"(coalesce({_SENTENCES}, 0) / greatest(len({_LINES}), 1))::FLOAT::DOUBLE"


def _hits(words) -> str:
    return f"len(list_intersect(list_distinct(tok), {_list(words)}))::BIGINT"


def _entropy_cte(rel: str = "c") -> str:
    return f"""e AS (
  SELECT doc_id, (log2(sum(n)) - sum(n * log2(n)) / sum(n))::FLOAT::DOUBLE AS f78
  FROM (SELECT doc_id, w, count(*)::DOUBLE AS n
        FROM (SELECT doc_id, unnest(tok) AS w FROM {rel}) GROUP BY doc_id, w)
  GROUP BY doc_id)"""


def _features_cte(source_ctes: str, lexicon, extra: str = "", rel: str = "c") -> str:
    return f"""{source_ctes}, {_entropy_cte(rel)}, f AS (
  SELECT x.doc_id{extra}, {_F15} AS f15, {_F36} AS f36, {_hits(lexicon)} AS f57,
         coalesce(e.f78, 0.0) AS f78
  FROM {rel} x LEFT JOIN e ON x.doc_id = e.doc_id)"""


# Stemming of single words: relation v0(token, w) ------------------------------
def _at(i: int) -> str:
    return f"substr(w, {i + 1}, 1)"


def _cut(*positions: int) -> str:
    return " || ".join(_at(i) for i in positions)


def _case(length: int, rules: list[tuple[str, str]], fallback: bool) -> str:
    whens = [f"WHEN {cond} THEN {keep}" for cond, keep in rules]
    if fallback:
        whens.append(f"WHEN {_at(length - 1)} IN ('ة','ه','ي','ك','ت','ا','ن') THEN left(w, {length - 1})")
        whens.append(f"WHEN {_at(0)} IN ('ل','ب','ف','س','و','ي','ت','ن','ا') THEN substr(w, 2)")
    return f"CASE WHEN kept OR length(w) <> {length} THEN w {' '.join(whens)} ELSE w END"


def _is(i: int, letters: str) -> str:
    return f"{_at(i)} IN ({', '.join(chr(39) + x + chr(39) for x in letters)})"


_SIX = [
    ("left(w, 3) IN ('است', 'مست')", "substr(w, 4)"),
    (f"{_is(0, 'م')} AND {_is(3, 'ا')} AND {_is(5, 'ة')}", _cut(1, 2, 4)),
    (f"{_is(0, 'ا')} AND {_is(2, 'ت')} AND {_is(4, 'ا')}", _cut(1, 3, 5)),
    (f"{_is(0, 'ا')} AND {_is(3, 'و')} AND {_at(2)} = {_at(4)}", _cut(1, 4, 5)),
    (f"{_is(0, 'ت')} AND {_is(2, 'ا')} AND {_is(4, 'ي')}", _cut(1, 3, 5)),
]
_FIVE = [
    (f"{_is(2, 'ات')} AND {_is(0, 'ا')}", _cut(1, 3, 4)),
    (f"{_is(3, 'ايو')} AND {_is(0, 'م')}", _cut(1, 2, 4)),
    (f"{_is(0, 'اتم')} AND {_is(4, 'ة')}", _cut(1, 2, 3)),
    (f"{_is(0, 'ميت')} AND {_is(2, 'ت')}", _cut(1, 3, 4)),
    (f"{_is(0, 'مت')} AND {_is(2, 'ا')}", _cut(1, 3, 4)),
    (f"{_is(2, 'او')} AND {_is(4, 'ة')}", _cut(0, 1, 3)),
    (f"{_is(0, 'ام')} AND {_is(1, 'ن')}", _cut(2, 3, 4)),
    (f"{_is(3, 'ا')} AND {_is(0, 'ا')}", _cut(1, 2, 4)),
    (f"{_is(4, 'ن')} AND {_is(3, 'ا')}", _cut(0, 1, 2)),
    (f"{_is(3, 'ي')} AND {_is(0, 'ت')}", _cut(1, 2, 4)),
    (f"{_is(3, 'و')} AND {_is(1, 'ا')}", _cut(0, 2, 4)),
    (f"{_is(2, 'ا')} AND {_is(1, 'و')}", _cut(0, 3, 4)),
    (f"{_is(3, 'ئ')} AND {_is(2, 'ا')}", _cut(0, 1, 4)),
    (f"{_is(4, 'ة')} AND {_is(1, 'ا')}", _cut(0, 2, 3)),
    (f"{_is(4, 'ي')} AND {_is(2, 'ا')}", _cut(0, 1, 3)),
]
_FOUR = [
    (_is(0, "م"), "substr(w, 2)"),
    (_is(1, "ا"), _cut(0, 2, 3)),
    (_is(2, "اوي"), _cut(0, 1, 3)),
    (_is(3, "ة"), "left(w, 3)"),
]
_FIVE_FOUR = [
    (_is(0, "اتم"), "substr(w, 2)"),
    (_is(4, "ة"), "left(w, 4)"),
    (_is(2, "ا"), _cut(0, 1, 3, 4)),
]
_SIX_FOUR = [
    (f"{_is(0, 'ا')} AND {_is(4, 'ا')}", _cut(1, 2, 3, 5)),
    ("left(w, 2) = 'مت'", "substr(w, 3)"),
]
_STEPS = [
    "CASE WHEN kept THEN w "
    "WHEN length(w) >= 6 AND left(w, 3) IN ('كال','بال','ولل','وال') THEN substr(w, 4) "
    "WHEN length(w) >= 5 AND left(w, 2) IN ('ال','لل') THEN substr(w, 3) ELSE w END",
    "CASE WHEN kept THEN w "
    "WHEN length(w) >= 6 AND right(w, 3) IN ('تمل','همل','تان','تين','كمل') "
    "THEN left(w, length(w) - 3) "
    "WHEN length(w) >= 5 AND right(w, 2) IN ('ون','ات','ان','ين','تن','كم','هن','نا','يا','ها',"
    "'تم','كن','ني','وا','ما','هم') THEN left(w, length(w) - 2) ELSE w END",
    "CASE WHEN kept THEN w WHEN length(w) >= 4 AND left(w, 2) = 'وو' THEN substr(w, 2) ELSE w END",
    "CASE WHEN kept THEN w WHEN left(w, 1) IN ('آ','أ','إ') THEN 'ا' || substr(w, 2) ELSE w END",
    _case(7, [], True),
    _case(6, _SIX, True),
    _case(5, _FIVE, True),
    _case(4, _FOUR, True),
    _case(5, _FIVE_FOUR, False),
    _case(6, _SIX_FOUR, False),
]


def _stem_ctes(tokens_sql: str, carry: str = "") -> str:
    """CTEs ending in s(token, stem, ``carry``) for a query that gives distinct ``token``."""
    kept = _strings(KEPT_WORDS)
    ctes = [f"v0 AS (SELECT token, token AS w, token IN ({kept}) AS kept{carry} FROM ({tokens_sql}))"]
    for i, step in enumerate(_STEPS):
        ctes.append(f"v{i + 1} AS MATERIALIZED (SELECT token, {step} AS w, kept{carry} FROM v{i})")
    ctes.append(f"s AS (SELECT token, w AS stem{carry} FROM v{len(_STEPS)})")
    return ",\n".join(ctes)


_SOURCES = f"{DOCS}, sources AS (SELECT doc_id, source AS source_model FROM docs)"
_STOPPED = _clean_cte("docs", fx.STOPWORDS)
_POSITIONS = (
    "p AS (SELECT doc_id, unnest(tok) AS token, unnest(range(1, len(tok) + 1)) AS pos FROM c)"
)
_STEMMED = (
    "st AS (SELECT p.doc_id, string_agg(s.stem, ' ' ORDER BY p.pos) AS cleaned_text "
    "FROM p JOIN s ON p.token = s.token GROUP BY p.doc_id)"
)
# The processed table of the model chain: labelled, stopped, stemmed.
_PROCESSED = ", ".join(
    [
        LAB,
        _clean_cte("lab", fx.STOPWORDS),
        _POSITIONS,
        _stem_ctes("SELECT DISTINCT token FROM p"),
        _STEMMED,
        "pr AS (SELECT lab.doc_id, lab.label, lab.text, st.cleaned_text, "
        "string_split(st.cleaned_text, ' ') AS tok FROM lab JOIN st ON lab.doc_id = st.doc_id)",
    ]
)

_BUCKET = "(('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT % 100)"
_SPLIT = f"CASE WHEN {_BUCKET} < 70 THEN 'train' WHEN {_BUCKET} < 85 THEN 'val' ELSE 'test' END"


def _rule(lexicon) -> tuple[str, str]:
    """(score, label) over a column ``w``: the distinct tokens of ``cleaned``."""
    letters = "coalesce(list_sum(list_transform(w, lambda x: length(x)::DOUBLE)), 0)"
    mean = f"({letters} / greatest(len(w), 1))"
    score = (
        f"(len(list_intersect(w, {_list(lexicon)})) * 0.6::DOUBLE "
        f"+ 10::DOUBLE / greatest({mean}, 1::DOUBLE))"
    )
    label = f"CASE WHEN cleaned = '' THEN 'unknown' WHEN {score} > 3.5::DOUBLE THEN 'ai' ELSE 'human' END"
    return score, label


_SCORE, _LABEL = _rule(fx.STREAM_LEXICON)
_LABEL_BUILT_IN = _rule(RULE_WORDS)[1]


def _light_cte(source: str, columns: str) -> str:
    return (
        f"lc AS (SELECT *, list_distinct({_tokens('cleaned')}) AS w "
        f"FROM (SELECT {columns}, {_LIGHT} AS cleaned FROM {source}))"
    )


RULED = (
    f"{LAB}, {_light_cte('lab', 'doc_id, label')}, "
    f"ruled AS (SELECT doc_id, label, {_LABEL} AS prediction, round({_SCORE}, 9) AS score FROM lc)"
)


def _per_document(**columns: str) -> str:
    listed = ", ".join(f"{sql} AS {name}" for name, sql in columns.items())
    return f"WITH {DOCS} SELECT doc_id, {listed} FROM docs"


def _counts(ctes: str, table: str, column: str) -> str:
    return f"WITH {ctes} SELECT {column}, count(*) AS n FROM {table} GROUP BY {column}"


def _message(text: str, label: str, id_: str) -> str:
    return f"to_json({{'text': {text}, 'label': {label}, 'id': ({id_})::INT}})::VARCHAR"


def _index(column: str, rows: str = LAB, rel: str = "lab") -> str:
    return (
        f"WITH {rows} SELECT {column}, n, "
        f"(row_number() OVER (ORDER BY n DESC, {column}) - 1)::DOUBLE AS label_idx "
        f"FROM (SELECT {column}, count(*) AS n FROM {rel} GROUP BY {column})"
    )


# The slot of a word: 32-bit MurmurHash3 of its bytes (seed 42) as a signed number, modulo 5000.
def _product(x: str, factor: int) -> str:
    return f"(({x})::HUGEINT * {factor} % 4294967296)::BIGINT"


def _turned(x: str, bits: int) -> str:
    return f"(((({x}) << {bits}) & 4294967295) | (({x}) >> {32 - bits}))"


def _fold_down(x: str, bits: int) -> str:
    return f"xor({x}, ({x}) >> {bits})"


def _slot_ctes(words: str) -> str:
    """CTEs ending in slots(term, slot) for a query that gives distinct ``term``."""
    mixed = _product(_turned(_product("k", 0xCC9E2D51), 15), 0x1B873593)
    stages = [
        f"SELECT term, list_transform(range(0, strlen(term)), lambda i: "
        f"('0x' || substr(hex(term), (2 * i + 1)::INT, 2))::BIGINT) AS b FROM ({words})",
        "SELECT term, len(b) AS n, list_transform(range(0, (len(b) + 3) // 4), lambda i: "
        "b[4 * i + 1] + coalesce(b[4 * i + 2], 0) * 256 + coalesce(b[4 * i + 3], 0) * 65536 "
        "+ coalesce(b[4 * i + 4], 0) * 16777216) AS ks FROM m0",
        f"SELECT term, n, list_transform(ks, lambda k: {mixed}) AS ks FROM m1",
        "SELECT term, n, CASE WHEN n % 4 = 0 THEN ks ELSE ks[:-2] END AS whole, CASE WHEN n % 4 = 0 THEN 0 ELSE ks[-1] END AS rest FROM m2",
        "SELECT term, n, rest, list_reduce(list_concat([42::BIGINT], whole), lambda h, k: "
        f"(({_turned('xor(h, k)', 13)})::HUGEINT * 5 + 3864292196) % 4294967296) AS h FROM m3",
        "SELECT term, xor(xor(h::BIGINT, rest), n) AS h FROM m4",
        f"SELECT term, {_product(_fold_down('h', 16), 0x85EBCA6B)} AS h FROM m5",
        f"SELECT term, {_product(_fold_down('h', 13), 0xC2B2AE35)} AS h FROM m6",
        f"SELECT term, {_fold_down('h', 16)} AS h FROM m7",
    ]
    ctes = [f"m{i} AS MATERIALIZED ({sql})" for i, sql in enumerate(stages)]
    signed = "(h - CASE WHEN h > 2147483647 THEN 4294967296 ELSE 0 END)"
    ctes.append(f"slots AS (SELECT term, (({signed} % 5000 + 5000) % 5000)::INT AS slot FROM m8)")
    return ",\n".join(ctes)


_TEST = f"FROM pr WHERE {_SPLIT} = 'test'"
_TRAINED = f"(SELECT count(*) FROM pr WHERE {_SPLIT} = 'train') AS n_train"
_MODEL_NAMES = "(VALUES ('Logistic Regression'), ('Random Forest'), ('Linear SVM'), ('Feed Forward')) AS models(model)"

_SAMPLE = (
    "(row_number() OVER (ORDER BY md5(doc_id::VARCHAR), doc_id) - 1) AS id FROM {} "
    "ORDER BY md5(doc_id::VARCHAR), doc_id LIMIT 100"
)
_BIGRAMS = (
    "list_transform(range(1, len(tok)), lambda i: tok[i] || ' ' || tok[i + 1])"
)

ORACLES: dict[str, str] = {
    "scan_profile": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows, "
        f"(SELECT count(*) FROM (DESCRIBE {t})) AS n_columns FROM {t}"
        for t in TABLES
    ),
    "stopword_vocab": f"WITH {CLEAN_DOCS} SELECT DISTINCT unnest(tok) AS word FROM c",
    "processed_roundtrip": f"""WITH {LAB}, {_clean_cte("lab", fx.STOPWORDS)}
SELECT doc_id, label, source_model, generation_method, cleaned_text FROM c""",
    "split_sinks": f"""WITH {DOCS} SELECT {_SPLIT} AS split, count(*) AS n,
  sum(doc_id)::BIGINT AS sum_doc_id FROM docs GROUP BY 1""",
    "raw_roundtrip": f"""WITH {RAW} SELECT label, generation_method, source_model,
  count(*) AS n, sum(length(text))::BIGINT AS chars FROM raw GROUP BY ALL""",
    "encode_messages": f"""WITH {LAB},
sampled AS (SELECT text, label, {_SAMPLE.format("lab")})
SELECT {_message("left(text, 500)", "label", "id")} AS value FROM sampled""",
    "encode_all_messages": f"""WITH {DOCS}, every AS (SELECT docs.doc_id, docs.text,
  CASE WHEN quality = 1 THEN 'ai' WHEN quality IS NOT NULL THEN 'human' END AS label
  FROM docs LEFT JOIN labels ON docs.doc_id = labels.doc_id)
SELECT doc_id, {_message("text", "label", "doc_id")} AS value FROM every""",
    "decode_messages": f"""WITH {DOCS}
SELECT doc_id AS source_id, text, source AS label, doc_id AS id FROM docs
UNION ALL SELECT page_id, NULL, NULL, NULL FROM pages""",
    "unpivot_sources": f"""WITH {RAW}
SELECT conv_id, part, text, label, generation_method, source_model FROM raw""",
    "union_splits": f"WITH {WIDE} SELECT * FROM wide",
    "source_counts_raw": _counts(RAW, "raw", "source_model"),
    "nonempty_rows": f"""WITH {DOCS}, both_forms AS (
  SELECT 'latin' AS script, doc_id, text FROM documents
  UNION ALL SELECT 'arabic', doc_id, text FROM docs), {_clean_cte("both_forms")}
SELECT script, count(*) AS n, sum(doc_id)::BIGINT AS sum_doc_id FROM c GROUP BY script""",
    "sample_rows": f"WITH {DOCS} SELECT doc_id, source, {_SAMPLE.format('docs')}",
    "strip_diacritics": _per_document(stripped=_bare("text")),
    "normalize_letters": _per_document(
        normalized="replace(replace(replace(replace(regexp_replace(text, '[إأآ]', 'ا', 'g'), "
        "'ى', 'ي'), 'ؤ', 'و'), 'ئ', 'ي'), 'ة', 'ه')"
    ),
    "script_filter": _per_document(filtered=_script("text")),
    "tokenize": _per_document(
        joined=f"array_to_string({_tokens(_script('text'))}, '|')",
        n_tokens=f"len({_tokens(_script('text'))})",
    ),
    "remove_stopwords": f"WITH {DOCS}, {_STOPPED} SELECT doc_id, cleaned_text FROM c",
    "drop_words_long": f"WITH {DOCS}, {_STOPPED} SELECT doc_id, cleaned_text FROM c",
    "remove_stopwords_folded": f"""WITH {DOCS}, {_clean_cte("docs", fold_words(fx.STOPWORDS))}
SELECT doc_id, cleaned_text FROM c""",
    "stem_vocab": f"""WITH {CLEAN_DOCS},
t AS (SELECT token, count(*) AS n FROM (SELECT unnest(tok) AS token FROM c) GROUP BY token),
{_stem_ctes("SELECT token, n FROM t", ", n")}
SELECT token, stem, n FROM s""",
    "clean_text": _per_document(
        cleaned_text=f"array_to_string({_tokens(_script(_folded('text')))}, ' ')"
    ),
    "clean_text_stemmed": f"""WITH {DOCS}, {_STOPPED}, {_POSITIONS},
{_stem_ctes("SELECT DISTINCT token FROM p")}, {_STEMMED}
SELECT doc_id, cleaned_text FROM st""",
    "stream_clean": _per_document(cleaned=_LIGHT),
    "char_length": _per_document(n_chars="length(text)"),
    "word_count": _per_document(
        n=f"len(string_split(array_to_string({_tokens(_script(_folded('text')))}, ' '), ' '))"
    ),
    "truncate_text": _per_document(head="left(text, 500)"),
    "bigram_rows": f"""WITH {CLEAN_DOCS}
SELECT doc_id, unnest(range(0, len(tok) - 1)) AS pos, unnest({_BIGRAMS}) AS bigram
FROM c WHERE len(tok) > 1""",
    "label_counts": _counts(LAB, "lab", "label"),
    "source_counts": _counts(_SOURCES, "sources", "source_model"),
    "length_stats": f"""WITH {LAB} SELECT label, round(avg(length(text)), 2) AS avg_length,
  min(length(text))::INT AS min_length, max(length(text))::INT AS max_length
FROM lab GROUP BY label""",
    "null_profile": f"WITH {WIDE} SELECT "
    + ", ".join(
        f"count(*) FILTER ({c} IS NULL) AS {c}"
        for c in ["conv_id", "part", *_SLOTS, "generation_method"]
    )
    + " FROM wide",
    "ttr_by_label": f"""WITH {CLEAN_LAB} SELECT label,
  round(avg(len(list_distinct(tok))::DOUBLE / len(tok)), 4) AS avg_ttr FROM c GROUP BY label""",
    "clean_stats": f"""WITH {CLEAN_LAB} SELECT label, count(*) AS n,
  round(avg(length(cleaned_text)), 1) AS avg_cleaned_length FROM c GROUP BY label""",
    "avg_words": f"""WITH {CLEAN_LAB} SELECT label,
  round(avg(len(string_split(cleaned_text, ' '))), 6) AS avg_words FROM c GROUP BY label""",
    "word_count_top": f"""WITH {CLEAN_DOCS} SELECT word, count(*) AS n
FROM (SELECT unnest(tok) AS word FROM c) GROUP BY word ORDER BY n DESC, word LIMIT 20""",
    "bigram_top": f"""WITH {CLEAN_DOCS} SELECT bigram, count(*) AS n
FROM (SELECT unnest({_BIGRAMS}) AS bigram FROM c) GROUP BY bigram
ORDER BY n DESC, split_part(bigram, ' ', 1), split_part(bigram, ' ', 2) LIMIT 10""",
    "feature_means": f"""WITH {_features_cte(CLEAN_LAB, fx.BATCH_LEXICON, ", label")}
SELECT label, round(avg(f15), 3) AS avg_f15, round(avg(f36), 3) AS avg_f36,
  round(avg(f57), 3) AS avg_f57, round(avg(f78), 3) AS avg_f78 FROM f GROUP BY label""",
    "f15": f"WITH {CLEAN_DOCS} SELECT doc_id, round({_F15}, 6) AS f15 FROM c",
    "f36": f"WITH {DOCS} SELECT doc_id, round({_F36}, 6) AS f36 FROM docs",
    "f57": f"""WITH {CLEAN_DOCS} SELECT doc_id, {_hits(fx.BATCH_LEXICON)} AS hits,
  {_hits(TOP_WORDS)} AS hits_built_in FROM c""",
    "f78": f"""WITH {CLEAN_DOCS}, {_entropy_cte()}
SELECT c.doc_id, round(coalesce(f78, 0.0), 6) AS f78 FROM c LEFT JOIN e ON c.doc_id = e.doc_id""",
    "features": f"""WITH {_features_cte(CLEAN_DOCS, fx.BATCH_LEXICON)}
SELECT doc_id, round(f15, 6) AS f15_word_len_variance, round(f36, 6) AS f36_avg_sent_per_para,
  f57 AS f57_top50_words_count, round(f78, 6) AS f78_perplexity FROM f""",
    "tfidf_terms": f"""WITH {CLEAN_DOCS},
tf AS (SELECT doc_id, term, count(*) AS tf
       FROM (SELECT doc_id, unnest(tok) AS term FROM c) GROUP BY doc_id, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
i AS (SELECT term, df, ln(((SELECT count(*) FROM c) + 1)::DOUBLE / (df + 1)) AS idf FROM df)
SELECT tf.doc_id, tf.term, tf.tf, i.df, round(i.idf, 6) AS idf, round(tf.tf * i.idf, 6) AS tfidf
FROM tf JOIN i ON tf.term = i.term""",
    "label_index": _index("label"),
    "source_index": _index("source_model", _SOURCES, "sources"),
    "hashed_tf": f"""WITH {CLEAN_DOCS}
SELECT doc_id, 5000::BIGINT AS vector_size, len(tok)::BIGINT AS n_tokens FROM c""",
    "tfidf_vectors": f"""WITH {_PROCESSED},
ix AS (SELECT label, (row_number() OVER (ORDER BY count(*) DESC, label) - 1)::DOUBLE AS label_idx
       FROM pr GROUP BY label)
SELECT pr.doc_id, pr.label, ix.label_idx, len(pr.tok)::BIGINT AS n_words,
  5000::BIGINT AS vector_size FROM pr JOIN ix ON pr.label = ix.label""",
    "assemble": f"""WITH {_features_cte(_PROCESSED, fx.BATCH_LEXICON, rel="pr")}
SELECT doc_id, 5004::BIGINT AS vector_size, round(f15, 6) AS f15_word_len_variance,
  round(f36, 6) AS f36_avg_sent_per_para, f57::DOUBLE AS f57_top50_words_count,
  round(f78, 6) AS f78_perplexity FROM f""",
    "split_rows": f"WITH {DOCS} SELECT doc_id, {_BUCKET} AS bucket, {_SPLIT} AS split FROM docs",
    "split_counts": f"WITH {DOCS} SELECT {_SPLIT} AS split, count(*) AS n FROM docs GROUP BY 1",
    "model_roundtrip": f"""WITH {_PROCESSED}, t AS (SELECT doc_id {_TEST})
SELECT model, doc_id, true AS same FROM t CROSS JOIN {_MODEL_NAMES}""",
    "tfidf_slots": f"""WITH {CLEAN_DOCS},
words AS (SELECT doc_id, unnest(tok) AS term FROM c), {_slot_ctes("SELECT DISTINCT term FROM words")},
tf AS (SELECT doc_id, slot, count(*) AS tf FROM words JOIN slots ON words.term = slots.term GROUP BY doc_id, slot),
df AS (SELECT slot, count(*) AS df FROM tf GROUP BY slot)
SELECT tf.doc_id, tf.slot, tf.tf, df.df,
  round(tf.tf * ln(((SELECT count(*) FROM c) + 1)::DOUBLE / (df.df + 1)), 6) AS weight
FROM tf JOIN df ON tf.slot = df.slot""",
    "tfidf_vectors_equal": f"""WITH {_PROCESSED},
words AS (SELECT doc_id, unnest(tok) AS term FROM pr), {_slot_ctes("SELECT DISTINCT term FROM words")}
SELECT doc_id, count(DISTINCT slot) AS n_slots, true AS same
FROM words JOIN slots ON words.term = slots.term GROUP BY doc_id""",
    # Checks of trained models: what must hold, for every row that the tables give.
    **{
        name: f"WITH {_PROCESSED} SELECT doc_id, true AS same_margin, true AS same_sign {_TEST}"
        for name in ("lr_margins", "svm_margins")
    },
    "lr_stationary": f"""WITH {_PROCESSED}
SELECT unnest(range(-1, 5004))::INT AS slot, true AS stationary, {_TRAINED}""",
    "svm_certificate": f"""WITH {_PROCESSED}
SELECT unnest(range(-1, 5004))::INT AS slot, true AS minimal, {_TRAINED}""",
    "rf_votes": f"WITH {_PROCESSED} SELECT doc_id, true AS same_votes, true AS same_prediction {_TEST}",
    "rf_importance_recomputed": f"""WITH {_PROCESSED}
SELECT unnest(range(0, 5004))::INT AS slot, true AS same, {_TRAINED}""",
    "best_model_saved": f"WITH {_PROCESSED} SELECT doc_id, true AS same {_TEST}",
    "mlp_forward": f"WITH {_PROCESSED} SELECT doc_id, true AS same {_TEST}",
    "model_confusion_totals": f"""WITH {_PROCESSED}, t AS (SELECT label, count(*) AS n {_TEST} GROUP BY label)
SELECT model, label, n FROM t CROSS JOIN {_MODEL_NAMES}""",
    "evaluation_equal": f"""WITH {_PROCESSED}, t AS (SELECT count(*) AS n {_TEST})
SELECT model, n, true AS same_accuracy, true AS same_f1, true AS same_precision, true AS same_recall, true AS same_auc
FROM t CROSS JOIN {_MODEL_NAMES}""",
    "rule_classify": f"""WITH {DOCS}, {_light_cte("docs", "doc_id")}
SELECT doc_id, {_LABEL} AS prediction, {_LABEL_BUILT_IN} AS prediction_built_in,
  round({_SCORE}, 6) AS score FROM lc""",
    "class_metrics": f"""WITH {RULED},
k AS (SELECT label AS class FROM ruled UNION SELECT prediction FROM ruled),
m AS (SELECT class, count(*) FILTER (label = class)::DOUBLE AS actual,
             count(*) FILTER (prediction = class)::DOUBLE AS said,
             count(*) FILTER (label = class AND prediction = class)::DOUBLE AS tp
      FROM k, ruled GROUP BY class),
r AS (SELECT *, CASE WHEN said > 0 THEN tp / said ELSE 0 END AS pre,
             CASE WHEN actual > 0 THEN tp / actual ELSE 0 END AS rec FROM m)
SELECT sum(actual)::BIGINT AS n, round(sum(tp) / sum(actual), 6) AS accuracy,
  round(sum(actual * CASE WHEN pre + rec > 0 THEN 2 * pre * rec / (pre + rec) ELSE 0 END)
        / sum(actual), 6) AS weighted_f1,
  round(sum(actual * pre) / sum(actual), 6) AS weighted_precision,
  round(sum(actual * rec) / sum(actual), 6) AS weighted_recall FROM r""",
    "auc": f"""WITH {RULED},
k AS (SELECT label, rank() OVER (ORDER BY score)
             + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS mean_rank FROM ruled),
t AS (SELECT sum(mean_rank) FILTER (label = 'ai') AS ranks,
             count(*) FILTER (label = 'ai')::DOUBLE AS pos,
             count(*) FILTER (label <> 'ai')::DOUBLE AS neg FROM k)
SELECT round((ranks - pos * (pos + 1) / 2) / (pos * neg), 6) AS auc FROM t""",
    "confusion": f"""WITH {RULED} SELECT label,
  count(*) FILTER (prediction = 'ai') AS predicted_ai,
  count(*) FILTER (prediction = 'human') AS predicted_human,
  count(*) FILTER (prediction = 'unknown') AS predicted_unknown,
  count(*) FILTER (prediction IS NULL OR prediction NOT IN ('ai', 'human', 'unknown')) AS predicted_other
FROM ruled GROUP BY label""",
    "stream_score": f"""WITH {DOCS}, {_light_cte("docs", "doc_id, source")}
SELECT doc_id AS id, source AS label, {_LABEL} AS prediction FROM lc
UNION ALL SELECT NULL, NULL, 'unknown' FROM pages""",
    "stream_cut": f"""WITH {DOCS}, {_light_cte("docs", "doc_id, source")}
SELECT doc_id AS id, source AS label, {_LABEL} AS prediction FROM lc
UNION ALL SELECT NULL, NULL, 'unknown' FROM pages""",
    "stream_batches": """SELECT doc_id AS id, 1::BIGINT AS n_rows, 1::BIGINT AS n_batches, 1::BIGINT AS n_times FROM documents""",
    "stream_restart": f"""WITH {DOCS}, {_light_cte("docs", "doc_id, source")},
scored AS (SELECT {_LABEL} AS prediction FROM lc UNION ALL SELECT 'unknown' FROM pages)
SELECT prediction, 2 * count(*) AS n FROM scored GROUP BY prediction""",
}
