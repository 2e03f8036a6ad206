"""Queries of the core operators over the Parquet tables, and the SQL that checks them.

The SQL is written for an engine with RE2 expressions: classes are listed instead of Unicode shorthands.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import clean, tokens, words
from textloom.operators import exact, lexicon, lines, minhash, order, parallel, perplexity, rules, translate
from textloom.sources import readers, writers
from textloom.sources.tables import table

from . import chains, expected

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

WS = expected.BLANKS
PRIME = 2147483647


def _words(e: str) -> str:
    return f"regexp_extract_all({e}, '[^{WS}]+')"


def _strip(e: str) -> str:
    return f"regexp_replace({e}, '^[{WS}]+|[{WS}]+$', '', 'g')"


def _collapse(e: str) -> str:
    return f"trim(regexp_replace({e}, '[{WS}]+', ' ', 'g'))"



def _q(sql: str | None = None):
    def add(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLE[function.__name__] = sql
        return function

    return add


_quote = expected.quote


# --- scans and scalars ----------------------------------------------------------------------------------------------
_N = f"len({_words('text')})"


@_q(f"SELECT id, CAST({_N} AS BIGINT) AS n_words FROM docu WHERE {_N} >= 15")
def word_count_filter(spark, d):
    return table(spark, d, "docu").select("id", words.word_count(F.col("text")).cast("long").alias("n_words")).filter("n_words >= 15")


@_q(
    f"""SELECT id, {_strip('text')} AS stripped, {_collapse('text')} AS collapsed, CAST(length(text) AS BIGINT) AS n_chars,
        CAST(len(string_split(text, chr(10))) AS BIGINT) AS n_lines FROM docu"""
)
def text_scalars(spark, d):
    t = F.col("text")
    return table(spark, d, "docu").select("id", words.strip(t).alias("stripped"), words.collapse(t).alias("collapsed"), F.length(t).cast("long").alias("n_chars"), words.line_count(t).cast("long").alias("n_lines"))


# no text has these line ends, so every line end becomes one
@_q("SELECT id, replace(replace(text, chr(10), chr(13) || chr(10)), chr(13) || chr(10), chr(10)) AS text FROM docu")
def eol_normalized(spark, d):
    docu = table(spark, d, "docu").withColumn("text", F.replace("text", F.lit("\n"), F.lit("\r\n")))
    return docu.select("id", words.lines_ended(F.col("text")).alias("text"))


@_q("SELECT id, text, CAST(num_words AS BIGINT) AS num_words FROM docu WHERE text IS NOT NULL")
def jsonl_roundtrip(spark, d):
    docu = table(spark, d, "docu").filter("text is not null").select("id", "text", F.col("num_words").cast("long"))
    as_lines = docu.select(writers.json_line("id", "text", "num_words").alias("value"))
    back = readers.parse_documents(as_lines)
    return back.select(F.variant_get("rest", "$.id", "long").alias("id"), "text", F.variant_get("rest", "$.num_words", "long").alias("num_words"))


@_q(
    """SELECT source_file, regexp_replace(string_agg(coalesce(line, ''), chr(10) ORDER BY pos), '\\n{4,}', repeat(chr(10), 3), 'g') AS text
       FROM doc_lines GROUP BY source_file"""
)
def newline_clamp(spark, d):
    rows = table(spark, d, "doc_lines").groupBy("source_file").agg(F.array_sort(F.collect_list(F.struct("pos", F.coalesce("line", F.lit("")).alias("line")))).alias("r"))
    return rows.select("source_file", clean.clamp_newlines(F.array_join("r.line", "\n")).alias("text"))



def _norm(e: str) -> str:
    return _collapse(f"replace(regexp_replace({e}, '--+', ' ', 'g'), '. . .', ' ')")



@_q(f"SELECT source_file, pos, {_norm('line')} AS line FROM doc_lines")
def normalize_lines(spark, d):
    return table(spark, d, "doc_lines").select("source_file", "pos", clean.normalize_line(F.col("line")).alias("line"))


_A2 = """
WITH b AS (SELECT source_file, pos, coalesce(line, '') AS line, coalesce({strip} = '', true) AS blank FROM doc_lines),
i AS (SELECT *, sum(CASE WHEN blank THEN 0 ELSE 1 END) OVER (PARTITION BY source_file ORDER BY pos) AS isl FROM b),
k AS (SELECT *, row_number() OVER (PARTITION BY source_file, isl, blank ORDER BY pos) AS k FROM i),
n AS (SELECT *, sum(CASE WHEN blank AND k = {lf} - 1 AND {lf} > 1 THEN 1 ELSE 0 END) OVER (PARTITION BY source_file ORDER BY pos) AS doc FROM k)
SELECT source_file AS file, row_number() OVER (PARTITION BY source_file ORDER BY doc) AS doc_no,
       string_agg({norm}, chr(10) ORDER BY pos) AS text, count(*) AS n_lines
FROM {body} GROUP BY source_file, doc
"""


@_q(_A2.format(strip=_strip("line"), lf=3, norm=_norm("line"), body="n WHERE NOT blank"))
def newline_docs(spark, d):
    return lines.newline_documents(table(spark, d, "doc_lines"))


@_q(_A2.format(strip=_strip("line"), lf=2, norm=_norm("line"), body="n WHERE NOT blank"))
def newline_docs_two(spark, d):
    return lines.newline_documents(table(spark, d, "doc_lines"), input_lf=2)


@_q(
    _A2.format(strip=_strip("line"), lf=3, norm=_norm("line"), body="(SELECT *, max(CASE WHEN NOT blank THEN pos END) OVER (PARTITION BY source_file, doc) AS hi, min(CASE WHEN NOT blank THEN pos END) OVER (PARTITION BY source_file, doc) AS lo FROM n) WHERE pos BETWEEN lo AND hi")
)
def newline_docs_strict(spark, d):
    return lines.newline_documents(table(spark, d, "doc_lines"), strict=True)


@_q("SELECT doc_id AS id, CAST(p AS BIGINT) AS par_no, t[p] AS text FROM (SELECT doc_id, string_split(text, chr(10) || chr(10)) AS t FROM documents WHERE text IS NOT NULL), LATERAL (SELECT unnest(range(1, len(t) + 1)) AS p)")
def paragraph_docs(spark, d):
    return lines.paragraphs(table(spark, d, "documents"), "doc_id")


@_q(
    f"""WITH s AS (SELECT doc_id, string_split_regex(text, '\\.\\s+') AS t FROM documents WHERE text IS NOT NULL),
        r AS (SELECT doc_id, p, len(t) AS n, t[p] AS raw FROM s, LATERAL (SELECT unnest(range(1, len(t) + 1)) AS p)),
        x AS (SELECT doc_id AS id, CAST(p - 1 AS BIGINT) AS part, CASE WHEN p = n THEN raw ELSE {_strip('raw')} END AS text FROM r WHERE NOT (p = n AND raw = ''))
        SELECT id, part, text, CAST({_N} AS INTEGER) AS num_words FROM x"""
)
def regex_split_docs(spark, d):
    return lines.split_documents(table(spark, d, "documents"), "doc_id", r"\.[ \t\n\f\r]+")


@_q("SELECT id, CAST(CASE WHEN rn <= extra * (size + 1) THEN (rn - 1) // (size + 1) + 1 ELSE extra + (rn - 1 - extra * (size + 1)) // greatest(size, 1) + 1 END AS BIGINT) AS chunk FROM (SELECT id, row_number() OVER (ORDER BY id) AS rn, count(*) OVER () // 10 AS size, count(*) OVER () % 10 AS extra FROM docu)")
def chunk_rows(spark, d):
    return order.chunks(table(spark, d, "docu").select("id"), "id").select("id", "chunk")


# --- exact duplicates -----------------------------------------------------------------------------------------------
_STATUS = f"""
WITH b AS (SELECT id, source_file, text, coalesce({_N} < 15, true) AS short FROM docu),
s AS (SELECT *, CASE WHEN short THEN 'short' WHEN row_number() OVER (PARTITION BY short, md5(text) ORDER BY id) = 1 THEN 'kept' ELSE 'duplicate' END AS status FROM b)
"""


@_q(_STATUS + "SELECT id, md5(text) AS h FROM s WHERE status = 'kept'")
def exact_dedup_first(spark, d):
    return exact.kept(table(spark, d, "docu"), "id").select("id", F.md5("text").alias("h"))


@_q(_STATUS + "SELECT id, status FROM s")
def dedup_status(spark, d):
    return exact.with_status(table(spark, d, "docu"), "id").select("id", "status")


@_q(_STATUS + "SELECT id FROM s WHERE status IN ('short', 'duplicate')")
def dedup_removed(spark, d):
    return exact.removed(table(spark, d, "docu"), "id", save_duplicates=True).select("id")


@_q(_STATUS + "SELECT count(*) AS processed, count(*) FILTER (short) AS removed, count(*) FILTER (status = 'kept') AS unique_docs FROM s")
def dedup_counters(spark, d):
    return exact.counters(table(spark, d, "docu"))


@_q(
    f"""WITH b AS (SELECT id, source_file, text FROM docu WHERE {_N} >= 15)
        SELECT id, source_file FROM (SELECT *, row_number() OVER (PARTITION BY md5(text) ORDER BY source_file, id) AS rn FROM b) WHERE rn = 1"""
)
def dedup_parts(spark, d):
    docs = table(spark, d, "docu")
    return exact.with_status(docs, exact.parts_order("source_file", "id")).filter("status = 'kept'").select("id", "source_file")


@_q(f"SELECT source_file AS file, count(*) FILTER (coalesce({_N} >= 15, false)) AS n_docs, count(*) FILTER (NOT coalesce({_N} >= 15, false)) AS n_short FROM docu GROUP BY ROLLUP (source_file)")
def dedup_parts_counts(spark, d):
    return exact.count_parts(table(spark, d, "docu"), "source_file")


@_q("SELECT id, text FROM docu WHERE text IS NOT NULL UNION ALL SELECT doc_id AS id, text FROM documents WHERE text IS NOT NULL")
def union_parts(spark, d):
    a = table(spark, d, "docu").select("id", "text")
    return a.unionByName(table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text")).filter("text is not null")


# --- parallel corpora -----------------------------------------------------------------------------------------------
_PAIRS = "WITH p AS (SELECT DISTINCT source_file, pos, src, tgt FROM parallel_corpus)"


def _sides(spark, d):
    pairs = table(spark, d, "parallel_corpus").select("source_file", "pos", "src", "tgt").distinct()
    return pairs.select("source_file", "pos", "src"), pairs.select("source_file", "pos", "tgt")


@_q(_PAIRS + " SELECT a.source_file, a.pos, a.src, b.tgt FROM p a JOIN p b USING (source_file, pos)")
def parallel_align(spark, d):
    return parallel.align(*_sides(spark, d), ["source_file", "pos"])


_GONE = _PAIRS + """, g AS (SELECT source_file, pos FROM (SELECT *, first_value((source_file, pos)) OVER (PARTITION BY coalesce(md5(src), '') ORDER BY source_file, pos) AS f FROM p) WHERE f <> (source_file, pos))"""


@_q(_GONE + " SELECT source_file, pos, src FROM p WHERE (source_file, pos) NOT IN (SELECT (source_file, pos) FROM g)")
def parallel_dedup_source(spark, d):
    src, tgt = _sides(spark, d)
    return parallel.drop_repeated(src, tgt, ["source_file", "pos"], "src")[0]


@_q(_GONE + " SELECT source_file, pos, tgt FROM p WHERE (source_file, pos) NOT IN (SELECT (source_file, pos) FROM g)")
def parallel_dedup_target(spark, d):
    src, tgt = _sides(spark, d)
    return parallel.drop_repeated(src, tgt, ["source_file", "pos"], "src")[1]


# --- lexicons and languages -----------------------------------------------------------------------------------------
_SEP, _SEP_DOC = expected.LINE_SEPARATORS, expected.DOCUMENT_SEPARATORS


def _tok(e: str, sep: str = _SEP) -> str:
    spaced = f"lower(regexp_replace({e}, {_quote(sep)}, ' \\1 ', 'g'))"
    return f"list_filter({_words(spaced)}, lambda t: NOT regexp_matches(t, {_quote(_SEP)}))"


def _tok_doc(e: str) -> str:
    return _tok(f"regexp_replace({e}, '([A-Z])\\.([A-Z])', '\\1\\2', 'g')", _SEP_DOC)



@_q(f"SELECT lang, token, count(*) AS n FROM (SELECT lang, unnest({_tok('text')}) AS token FROM docu) GROUP BY lang, token")
def token_frequency(spark, d):
    return lexicon.token_counts(table(spark, d, "docu"))


@_q(
    f"""WITH c AS (SELECT lang, token, count(*) AS n FROM (SELECT lang, unnest({_tok('text')}) AS token FROM docu) WHERE NOT regexp_matches(token, {_quote(expected.UNUSABLE)}) GROUP BY lang, token)
        SELECT lang, token AS term, CAST(rn AS INTEGER) AS term_rank FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, token) AS rn FROM c) WHERE rn <= 250"""
)
def lexicon_topk(spark, d):
    return lexicon.top_terms(lexicon.token_counts(table(spark, d, "docu")), 250)


@_q(f"SELECT lang, term_rank, term FROM lexicon WHERE NOT regexp_matches(term, {_quote(expected.UNUSABLE)})")
def lexicon_usable(spark, d):
    return lexicon.usable_terms(table(spark, d, "lexicon")).select("lang", "term_rank", "term")


@_q("SELECT lang, term, max(term_rank) AS term_rank FROM lexicon WHERE term IS NOT NULL GROUP BY lang, term")
def lexicon_ranks(spark, d):
    return lexicon.term_ranks(table(spark, d, "lexicon"))


#: Entries of the last lexicon of the table, and one.
TOP = "(SELECT count(*) + 1.0 FROM lexicon WHERE term IS NOT NULL AND lang = (SELECT max(lang) FROM lexicon WHERE term IS NOT NULL))"


def _scored(tokens_from: str, keys: str) -> str:
    return f"""
r AS (SELECT lang, term, max(term_rank) AS rk FROM lexicon WHERE term IS NOT NULL GROUP BY lang, term),
e AS (SELECT DISTINCT {_strip('suffix')} AS suffix, lang FROM suffixes WHERE lang IN (SELECT lang FROM r) AND {_strip('suffix')} <> ''),
t AS (SELECT {keys}, token, count(*) AS n FROM ({tokens_from}) GROUP BY ALL),
w AS (SELECT {keys}, r.lang, n * ({TOP} - rk) AS w, n AS h FROM t JOIN r ON r.term = t.token
      UNION ALL
      SELECT {keys}, e.lang, n * {TOP} / 2 AS w, 0 AS h FROM t JOIN e ON suffix(t.token, e.suffix) WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.lang = e.lang AND r.term = t.token)),
g AS (SELECT {keys}, lang, sum(w) AS w, sum(h) AS h FROM w GROUP BY {keys}, lang),
best AS (SELECT {keys}, lang FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY w DESC, lang) AS rn, sum(h) OVER (PARTITION BY {keys}) AS hits FROM g) WHERE rn = 1 AND hits > 0)
"""


_LINES = """l AS (SELECT id, p - 1 AS line_no, ls[p] AS line FROM (SELECT id, string_split(replace({text}, chr(13) || chr(10), chr(10)), chr(10)) AS ls FROM {table} WHERE {text} IS NOT NULL), LATERAL (SELECT unnest(range(1, len(ls) + 1)) AS p))"""
_TAGGED = (
    "WITH " + _LINES.format(text="text", table="docu") + "," + _scored(f"SELECT id, line_no, unnest({_tok('line')}) AS token FROM l", "id, line_no")
    + f", tagged AS (SELECT l.id, CAST(l.line_no AS BIGINT) AS line_no, l.line, coalesce(best.lang, CASE WHEN {_strip('l.line')} = '' THEN 'gl' ELSE 'en' END) AS lang FROM l LEFT JOIN best USING (id, line_no))"
)


def _lexicon(spark, d):
    terms = table(spark, d, "lexicon")
    return terms, table(spark, d, "suffixes"), lexicon.last_rank(terms)


def _tagged(spark, d):
    return lexicon.tag_lines(table(spark, d, "docu"), "id", *_lexicon(spark, d))


@_q(_TAGGED + " SELECT id, line_no, lang FROM tagged")
def lang_id_line(spark, d):
    return _tagged(spark, d).select("id", "line_no", "lang")


@_q("WITH " + _scored(f"SELECT id, unnest({_tok_doc('text')}) AS token FROM docu", "id") + " SELECT docu.id, coalesce(best.lang, 'es') AS lang FROM docu LEFT JOIN best USING (id)")
def lang_id_doc(spark, d):
    return lexicon.tag_documents(table(spark, d, "docu"), "id", *_lexicon(spark, d))


@_q(_TAGGED + f" SELECT id, text, 'gl' AS lang FROM (SELECT id, string_agg(line, chr(10) ORDER BY line_no) AS text FROM tagged WHERE lang = 'gl' AND NOT contains(line, chr(9)) GROUP BY id) WHERE {_strip('text')} <> ''")
def filter_lang_docs(spark, d):
    return lexicon.filter_lines(_tagged(spark, d), "gl")


@_q(
    _TAGGED
    + f""", m AS (SELECT id, lang, count(*) AS n, min(line_no) AS f FROM tagged WHERE NOT contains(line, chr(9)) GROUP BY id, lang),
       o AS (SELECT id, lang FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY n DESC, f) AS rn FROM m) WHERE rn = 1)
       SELECT id, text, o.lang FROM (SELECT id, string_agg(line, chr(10) ORDER BY line_no) AS text FROM tagged WHERE NOT contains(line, chr(9)) GROUP BY id) JOIN o USING (id) WHERE {_strip('text')} <> ''"""
)
def dominant_lang_docs(spark, d):
    return lexicon.filter_lines(_tagged(spark, d), None)


_MT = (
    "WITH p AS (SELECT DISTINCT source_file, pos, src, tgt FROM parallel_corpus), l AS (SELECT (source_file, pos) AS id, src AS line FROM p WHERE src IS NOT NULL AND NOT contains(src, chr(10))),"
    + _scored(f"SELECT id, unnest({_tok('line')}) AS token FROM l", "id")
    + f" SELECT p.source_file, p.pos, p.src, p.tgt, CASE WHEN coalesce(best.lang, CASE WHEN p.src IS NULL THEN '' WHEN {_strip('p.src')} = '' THEN 'gl' ELSE 'en' END) = 'gl' THEN 'matched' ELSE 'mismatched' END AS status FROM p LEFT JOIN best ON best.id = (p.source_file, p.pos)"
)


@_q(_MT)
def mt_lang_filter(spark, d):
    pairs = table(spark, d, "parallel_corpus").select("source_file", "pos", "src", "tgt").distinct().withColumn("line_id", F.struct("source_file", "pos"))
    tags = lexicon.tag_lines(pairs, "line_id", *_lexicon(spark, d), "src").select(F.col("id").alias("line_id"), "lang")
    out = parallel.with_language_status(pairs.join(tags, "line_id", "left"), "lang", "gl")
    return out.select("source_file", "pos", "src", "tgt", "status")


@_q("WITH matched AS (" + _MT.replace("WITH p AS", "WITH p AS", 1) + ") SELECT count(*) AS total, count(*) FILTER (status = 'mismatched') AS mismatched FROM matched")
def mt_mismatch_counts(spark, d):
    return parallel.mismatch_counts(mt_lang_filter(spark, d))


# --- tokens -----------------------------------------------------------------------------------------------------------
@_q(f"SELECT source_file, pos, {expected.tokens('src', expected.TOKENIZER)} AS tokens FROM parallel_corpus")
def tokenize(spark, d):
    return table(spark, d, "parallel_corpus").select("source_file", "pos", tokens.tokenize(F.col("src")).alias("tokens"))


@_q(f"SELECT source_file, pos, {expected.tokens(expected.tokens('tgt', expected.TOKENIZER), expected.DETOKENIZER)} AS line FROM parallel_corpus")
def detokenize(spark, d):
    return table(spark, d, "parallel_corpus").select("source_file", "pos", tokens.detokenize(tokens.tokenize(F.col("tgt"))).alias("line"))


_TAGS = expected.tag_case("token")


@_q(f"SELECT token, CASE {_TAGS} WHEN regexp_matches(token, '^(<<|«)') THEN 'Fra' WHEN regexp_matches(token, '^(>>|»)') THEN 'Frc' ELSE '' END AS tag, count(*) AS n FROM (SELECT unnest(string_split({expected.tokens('line', expected.TOKENIZER)}, ' ')) AS token FROM doc_lines) GROUP BY ALL")
def punct_tags(spark, d):
    toks = table(spark, d, "doc_lines").select(F.explode(F.split(tokens.tokenize(F.col("line")), " ")).alias("token"))
    return toks.groupBy("token", words.punctuation_tag(F.col("token")).alias("tag")).agg(F.count("*").alias("n"))


@_q(f"SELECT id, regexp_replace(regexp_replace(text, '([A-Z])\\.([A-Z])', '\\1\\2', 'g'), {_quote(_SEP)}, ' \\1 ', 'g') AS text FROM docu")
def separator_spacing(spark, d):
    return table(spark, d, "docu").select("id", words.space_separators(words.join_acronyms(F.col("text"))).alias("text"))


# --- characters -------------------------------------------------------------------------------------------------------
# every row gets codes of its own: its letters and blanks are coded, and percent signs open what follows them
_CODED = [("á", "%C3%A1"), ("ñ", "%F1"), ("e", "%65"), (" ", "%20"), ("t", "%2574"), ("—", "%E2%80%94"), ("º", "%C2%BA"), ("3", "%E2%80"), ("5", "%E2%84"), ("7", "%0A"), ("9", "%2537"), ("o", "%6f")]


@_q(f"SELECT doc_id, {expected.replaced(expected.replaced('text', _CODED), expected.percent_pairs())} AS text FROM documents WHERE NOT contains(text, '%')")
def percent_decode(spark, d):
    coded = F.col("text")
    for a, b in _CODED:
        coded = F.replace(coded, F.lit(a), F.lit(b))
    return table(spark, d, "documents").filter(~F.col("text").contains("%")).select("doc_id", clean.percent_decode(coded).alias("text"))


@_q(f"SELECT id, {expected.replaced('text', expected.broken_pairs())} AS text FROM docu")
def broken_letters(spark, d):
    return table(spark, d, "docu").select("id", clean.latin1_letters(F.col("text")).alias("text"))


_CONTROLS = "regexp_replace(regexp_replace(regexp_replace(text, '[\\x01-\\x1f\\x7f-\\x9f]', '', 'g'), '[\\p{Cc}\\p{Cf}\\p{Co}\\p{Zl}\\p{Zp}]|[\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{202f}\\x{205f}\\x{3000}]', '', 'g'), '[\\x{fffd}\\x{fffe}\\x{ffff}\\x{feff}\\x{fffc}]', '', 'g')"


@_q(f"SELECT id, {expected.replaced(_CONTROLS, expected.broken_pairs(12))} AS text FROM docu")
def alternative_fix(spark, d):
    return table(spark, d, "docu").select("id", clean.alternative_fix(F.col("text")).alias("text"))


@_q("SELECT doc_id, regexp_replace(text, '(?is)<!--.*?-->|<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>|</?[a-z][^<>]*>', ' ', 'g') AS text FROM documents WHERE contains(text, '<') AND NOT contains(text, '&')")
def tags_removed(spark, d):
    docs = table(spark, d, "documents").filter(F.col("text").contains("<") & ~F.col("text").contains("&"))
    return docs.select("doc_id", clean.remove_tags(F.col("text")).alias("text"))


@_q("SELECT doc_id, text FROM (SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 500)")
def first_documents(spark, d):
    return order.first_rows(table(spark, d, "documents").select("doc_id", "text"), 500, "doc_id")


_BLANKS = "".join(chr(cp) for cp in range(0x2400, 0x2422) if cp not in (0x2405, 0x240A))


@_q(f"SELECT id, translate(translate(text, 'aeiouñ', '␀␅␊␤␡␢'), {_quote(_BLANKS + '␅␤␊')}, repeat(' ', {len(_BLANKS)}) || '?' || chr(10) || chr(10)) AS text FROM docu")
def control_pictures(spark, d):
    docu = table(spark, d, "docu").withColumn("text", F.translate("text", "aeiouñ", "␀␅␊␤␡␢"))
    return docu.select("id", clean.control_pictures(F.col("text")).alias("text"))


@_q("SELECT id, regexp_replace(text, '[^\\p{Lu}\\p{Ll}\\p{Nd}\\p{Po}\\p{Zs}\\x{2d}]', ' ', 'g') AS text FROM docu")
def char_category_filter(spark, d):
    return table(spark, d, "docu").select("id", clean.keep_categories(F.col("text"), "Lu Ll Nd Po Zs", "-").alias("text"))


@_q("SELECT id, regexp_replace(text, '[\\p{Cc}\\p{Cf}\\p{Co}\\p{Zl}\\p{Zp}]|[\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{202f}\\x{205f}\\x{3000}]', '', 'g') AS text FROM docu")
def printable_text(spark, d):
    return table(spark, d, "docu").select("id", clean.printable(F.col("text")).alias("text"))


@_q("SELECT id, regexp_replace(regexp_replace(regexp_replace(text, '[\\x01-\\x1f\\x7f-\\x9f]', '', 'g'), '[\\p{Cc}\\p{Cf}\\p{Co}\\p{Zl}\\p{Zp}]|[\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{202f}\\x{205f}\\x{3000}]', '', 'g'), '[\\x{fffd}\\x{fffe}\\x{ffff}\\x{feff}\\x{fffc}]', '', 'g') AS text FROM docu")
def controls_dropped(spark, d):
    return table(spark, d, "docu").select("id", clean.drop_controls(F.col("text")).alias("text"))


@_q()
def encode_fix(spark, d):
    return table(spark, d, "docu").select("id", clean.encode_fix(F.col("text")).alias("text"))


@_q()
def decoding_fixed(spark, d):
    fixed = table(spark, d, "docu").select("id", "text", clean.fix_decoding(F.col("text")).alias("fixed"))
    return fixed.filter("text <> fixed").select("id", "fixed")


# --- near duplicates --------------------------------------------------------------------------------------------------
_SIG = f"""
h AS (SELECT id, list_transform(list_distinct({_words('text')}), lambda w: CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) % {PRIME}) AS hs FROM docu WHERE {_N} > 0),
x AS (SELECT id, unnest(hs) AS v FROM h),
k AS (SELECT k, (k * 48271 + 11) % {PRIME - 1} + 1 AS a, (k * k * 69621 + 7 * k + 5) % {PRIME} AS b FROM range(128) t(k)),
m AS (SELECT id, k, min((v * a + b) % {PRIME}) AS s FROM x, k GROUP BY id, k),
sig AS (SELECT id AS pos, list(s ORDER BY k) AS signature FROM m GROUP BY id),
reps AS (SELECT min(pos) AS pos, signature FROM sig GROUP BY signature),
cut AS (SELECT pos, band, signature[band * 13 + 1 : band * 13 + 13] AS h FROM reps, range(9) t(band)),
cand AS (SELECT DISTINCT a.pos AS i, b.pos AS j FROM cut a JOIN cut b ON a.band = b.band AND a.h = b.h AND a.pos < b.pos),
links AS (SELECT i, j, len(list_filter(list_zip(a.signature, b.signature), lambda z: z[1] = z[2])) / 128 AS similarity, least(length(da.text), length(db.text)) AS l
  FROM cand JOIN reps a ON a.pos = i JOIN reps b ON b.pos = j JOIN docu da ON da.id = i JOIN docu db ON db.id = j),
lk AS (SELECT i, j, similarity FROM links WHERE l > 0 AND similarity > 3.0 / l),
grp AS (SELECT DISTINCT i AS rep, i AS member FROM lk UNION SELECT i, j FROM lk),
best AS (SELECT rep, member AS best FROM (SELECT rep, member, row_number() OVER (PARTITION BY rep ORDER BY len(string_split(text, chr(10))), member) AS rn FROM grp JOIN docu ON docu.id = member) WHERE rn = 1),
mem AS (SELECT s.pos, r.pos AS rep FROM sig s JOIN reps r ON s.signature = r.signature),
st AS (SELECT pos, rep, CASE WHEN pos <> rep THEN 'copy' WHEN rep IN (SELECT best FROM best) THEN 'kept_as_best' WHEN rep IN (SELECT member FROM grp) THEN 'near_duplicate' ELSE 'kept' END AS status FROM mem)
"""


@_q("WITH " + _SIG.lstrip().split(",\nreps")[0] + " SELECT pos, signature FROM sig")
def minhash_signature(spark, d):
    return minhash.signatures(table(spark, d, "docu"))


@_q("WITH " + _SIG + " SELECT i, j FROM cand")
def lsh_candidates(spark, d):
    return minhash.candidates(minhash.sets(table(spark, d, "docu"))[1])


@_q("WITH " + _SIG + " SELECT i, j, similarity FROM lk")
def near_dup_links(spark, d):
    docu = table(spark, d, "docu")
    return minhash.links(docu, minhash.sets(docu)[1])


@_q("WITH " + _SIG + " SELECT rep, best FROM best")
def near_dup_best(spark, d):
    docu = table(spark, d, "docu")
    return minhash.best_members(minhash.groups(minhash.links(docu, minhash.sets(docu)[1])), docu)


@_q("WITH " + _SIG + " SELECT pos, rep, status FROM st")
def near_dup_status(spark, d):
    return minhash.near_status(table(spark, d, "docu"))


@_q("WITH " + _SIG + " SELECT count(*) AS processed, count(*) FILTER (status IN ('kept', 'kept_as_best')) AS kept_docs, count(*) FILTER (status NOT IN ('kept', 'kept_as_best')) AS removed FROM st")
def near_dup_counters(spark, d):
    return minhash.counters(minhash.near_status(table(spark, d, "docu")))


@_q("WITH " + _SIG + " SELECT best AS best_document_id, member AS document_id, CASE WHEN member = grp.rep THEN 1.0 ELSE similarity END AS jaccard_similarity, md5(text) AS text_key FROM grp JOIN best USING (rep) JOIN docu ON docu.id = member LEFT JOIN lk ON lk.i = grp.rep AND lk.j = member")
def near_dup_samples(spark, d):
    docu = table(spark, d, "docu")
    found = minhash.samples(minhash.groups(minhash.links(docu, minhash.sets(docu)[1])), docu)
    rows = found.select("best_document_id", F.explode("documents").alias("x"))
    return rows.select("best_document_id", "x.document_id", "x.jaccard_similarity", F.md5("x.text").alias("text_key"))


@_q("WITH " + _SIG + " SELECT id, coalesce(status = 'kept_as_best', false) AS best FROM docu LEFT JOIN st ON pos = id WHERE status IS NULL OR status IN ('kept', 'kept_as_best')")
def near_dup_best_first(spark, d):
    docu = table(spark, d, "docu")
    return minhash.best_first(docu, minhash.near_status(docu)).select("id", (F.col("place.rest") == 0).alias("best"))


# --- rules --------------------------------------------------------------------------------------------------------------
def _side(e: str) -> str:
    return f"CASE WHEN sheet = 'transform' THEN {e} ELSE {_strip(e)} END"


@_q(f"SELECT sheet, {_side('pattern')} AS pattern, coalesce({_side('replacement')}, '') AS replacement, min(ord) AS ord FROM rules WHERE {_side('pattern')} <> '' GROUP BY ALL")
def rules_usable(spark, d):
    return rules.usable_rules(table(spark, d, "rules"))


@_q(f"SELECT source_file, pos, {expected.rules_applied(_strip('tgt'))} AS tgt FROM parallel_corpus")
def rule_normalize(spark, d):
    rows = rules.rule_list(table(spark, d, "rules"))
    return table(spark, d, "parallel_corpus").select("source_file", "pos", rules.normalize(F.col("tgt"), rows).alias("tgt"))


@_q()
def rule_normalize_bel(spark, d):
    rows = rules.rule_list(table(spark, d, "rules"), bel=True, exact=True)
    return table(spark, d, "docu").select("id", rules.normalize(F.col("text"), rows, detok=True).alias("text"))


# --- language model -----------------------------------------------------------------------------------------------------
_LM = f"""
WITH w AS (SELECT id, list_concat(['<s>'], regexp_extract_all(lower({_strip('text')}), '[^{WS}]+'), ['</s>']) AS w FROM docu WHERE text IS NOT NULL),
g AS (SELECT id, w[p] AS a, w[p + 1] AS b FROM w, LATERAL (SELECT unnest(range(1, len(w))) AS p)),
c AS (SELECT a, b, count(*) AS n FROM g GROUP BY a, b),
f AS (SELECT a, sum(n) AS n FROM c GROUP BY a),
v AS (SELECT count(*) AS v FROM (SELECT a AS x FROM c UNION SELECT b FROM c)),
s AS (SELECT id, exp(-avg(ln((c.n + 1) / (f.n + v.v)))) AS perplexity FROM g JOIN c USING (a, b) JOIN f USING (a), v GROUP BY id)
"""


def _perplexity(spark, d):
    docu = table(spark, d, "docu")
    return perplexity.score(docu, perplexity.fit(docu))


@_q(_LM + "SELECT id, round(perplexity, 4) AS perplexity FROM s")
def bigram_perplexity(spark, d):
    return _perplexity(spark, d).select("id", F.round("perplexity", 4).alias("perplexity"))


@_q(_LM.replace("\ns AS", "\ns AS") + "SELECT id FROM s WHERE round(perplexity, 4) < 2000")
def bigram_perplexity_kept(spark, d):
    return _perplexity(spark, d).filter(F.round("perplexity", 4) < 2000).select("id")


@_q("SELECT DISTINCT id, model, CASE WHEN coalesce(pyplexity_score < 2000 AND NOT isnan(pyplexity_score), false) THEN 'kept' ELSE 'high_perplexity' END AS status FROM scored_docs")
def perplexity_filter(spark, d):
    return perplexity.filter_scores(table(spark, d, "scored_docs")).select("id", "model", "status").distinct()


@_q("SELECT id, model, scored_at FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY scored_at DESC NULLS LAST, model DESC NULLS LAST) AS rn FROM scored_docs) WHERE rn = 1")
def latest_scores(spark, d):
    return perplexity.latest_scores(table(spark, d, "scored_docs")).select("id", "model", "scored_at")


# --- translation --------------------------------------------------------------------------------------------------------
@_q(f"SELECT DISTINCT word, {expected.transliterated('word')} AS transliterated FROM (SELECT unnest(regexp_extract_all(tgt, {_quote(expected.MARK)}, 2)) AS word FROM parallel_corpus)")
def marked_words(spark, d):
    return translate.marked_words(table(spark, d, "parallel_corpus"), "tgt")


@_q(
    f"""WITH p AS (SELECT source_file, pos, src, string_split(regexp_replace(tgt, {_quote(expected.MARK)}, chr(1) || '\\2' || chr(2), 'g'), chr(1)) AS ps FROM parallel_corpus WHERE tgt IS NOT NULL)
        SELECT source_file, pos, src, {expected.marks_cleaned(f"array_to_string(list_transform(ps, lambda x: CASE WHEN contains(x, chr(2)) THEN {expected.transliterated('split_part(x, chr(2), 1)')} || split_part(x, chr(2), 2) ELSE x END), '')")} AS tgt FROM p"""
)
def mark_cleanup(spark, d):
    return table(spark, d, "parallel_corpus").filter("tgt is not null").select("source_file", "pos", "src", translate.clean_marks(F.col("tgt")).alias("tgt"))


def _dictionary(spark, d):
    return table(spark, d, "rules").filter("sheet in ('error', 'RAG_fc')").select(F.col("pattern").alias("term"), F.col("replacement").alias("translation"))


@_q(
    f"""WITH p AS (SELECT DISTINCT source_file, pos, tgt FROM parallel_corpus WHERE tgt IS NOT NULL), dic AS (SELECT lower(pattern) AS k, min(replacement) AS t FROM rules WHERE sheet IN ('error', 'RAG_fc') AND pattern IS NOT NULL GROUP BY 1),
        w AS (SELECT source_file, pos, tgt, ws[i] AS word, i FROM (SELECT *, {_words('tgt')} AS ws FROM p), LATERAL (SELECT unnest(range(1, len(ws) + 1)) AS i))
        SELECT source_file, pos, tgt, string_agg(coalesce(dic.t, '[[UNK]] ' || word), ' ' ORDER BY i) AS translated FROM w LEFT JOIN dic ON dic.k = lower(word) GROUP BY source_file, pos, tgt"""
)
def dictionary_translation(spark, d):
    pairs = table(spark, d, "parallel_corpus").filter("tgt is not null").select("source_file", "pos", "tgt").distinct()
    return translate.translate_lines(pairs, _dictionary(spark, d), ["source_file", "pos", "tgt"], "tgt", transliterated=False)


# --- chains ---------------------------------------------------------------------------------------------------------------
def _pairs(spark, d):
    """Full repeats go only; different pairs of one place stay apart by a key of their own."""
    pairs = table(spark, d, "parallel_corpus").dropDuplicates(["source_file", "pos", "src", "tgt"])
    return pairs.withColumn("pair_key", F.sha2(F.to_json(F.struct("src", "tgt")), 256))


_KEYS = ["source_file", "pos", "pair_key"]


@_q()
def cleaned_documents(spark, d):
    scores = perplexity.latest_scores(table(spark, d, "scored_docs"))
    terms, suffixes, top = _lexicon(spark, d)
    return chains.documents(table(spark, d, "docu"), scores, terms, suffixes, table(spark, d, "rules"), top)


@_q()
def cleaned_pairs(spark, d):
    terms, suffixes, top = _lexicon(spark, d)
    return chains.pairs(_pairs(spark, d), terms, suffixes, table(spark, d, "rules"), top, _KEYS).drop("pair_key")


@_q()
def translated_pairs(spark, d):
    return chains.translated(_pairs(spark, d), _dictionary(spark, d), table(spark, d, "rules"), _KEYS).drop("pair_key")
