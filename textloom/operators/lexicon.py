"""Ranked lexicons and language identification by lexicon and suffixes."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textloom.functions.words import language_tokens, lines_ended, same_language, strip

from .skew import dealt, small

# Characters that make a lexicon entry unusable.
UNUSABLE = "[.,;:«»\"'&%+=$()<>!¡?¿\\[\\]/*_{}|@#0-9-]"
#: Lexicon rows up to which lookups are broadcast; larger lexicons are joined with a shuffle.
BROADCAST_ROWS = 200_000


def token_counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``lang, token, n``: how often each language token occurs."""
    return docs.select(F.col(lang).alias("lang"), F.explode(language_tokens(F.col(text))).alias("token")).groupBy("lang", "token").agg(F.count("*").alias("n"))


def top_terms(counts: DataFrame, most: int, clean: bool = True) -> DataFrame:
    """``lang, term, term_rank``: the most frequent tokens of each language; ties by the token itself.

    The rank filter runs in every task before the shuffle, so a language with most of the tokens sends few rows.
    """
    if clean:
        counts = usable_terms(counts, "token")
    w = W.partitionBy("lang").orderBy(F.desc("n"), "token")
    return counts.withColumn("term_rank", F.row_number().over(w)).filter(F.col("term_rank") <= most).select("lang", F.col("token").alias("term"), F.col("term_rank").cast("int"))


def usable_terms(terms: DataFrame, term: str = "term") -> DataFrame:
    """Without entries that hold punctuation or digits."""
    return terms.filter(~F.col(term).rlike(UNUSABLE))


def term_ranks(lexicon: DataFrame) -> DataFrame:
    """``lang, term, term_rank`` once per term: the last rank counts."""
    return lexicon.filter("term is not null").groupBy("lang", "term").agg(F.max("term_rank").alias("term_rank"))


def lexicon_from_files(lines: DataFrame, varieties: bool = False) -> DataFrame:
    """``lang, term, term_rank`` from ``path, pos, value``: the file's stem is the language, the line number the rank.

    Stems of varieties have a region behind the language (``es-AR``, ``pt_BR``); without ``varieties`` only files of plain
    languages count, with it only those of varieties.
    """
    lang = F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1)
    lines = lines.filter(lang.rlike("[-_]") == F.lit(varieties))
    w = W.partitionBy("path").orderBy("pos")
    return lines.select(lang.alias("lang"), F.col("value").alias("term"), F.row_number().over(w).alias("term_rank"))


def last_rank(lexicon: DataFrame, lang: str | None = None) -> int:
    """Entries of the lexicon of ``lang``, else of the last language in order, and one: what a first term is measured from."""
    rows = lexicon.filter("term is not null")
    last = lang or rows.agg(F.max("lang")).first()[0]
    return rows.filter(F.col("lang") == last).count() + 1


def _weights(lexicon: DataFrame, suffixes: DataFrame, top: int) -> tuple[DataFrame, Callable, Callable, list[str]]:
    """``(terms, tails, ending, languages)``: ``token, ws`` of the lexicon, a function from a token and the languages that hold
    it to its weights by suffix, whether a token ends in any suffix, and the languages that weights can name. The suffix table is a hand-written one, read whole."""
    ranks = term_ranks(lexicon)
    terms = ranks.groupBy(F.col("term").alias("token")).agg(F.collect_list(F.struct("lang", (F.lit(float(top)) - F.col("term_rank")).alias("w"), F.lit(1).alias("hit"))).alias("ws"))
    languages = sorted(r[0] for r in ranks.select("lang").distinct().collect())
    ends = suffixes.select(strip(F.col("suffix")).alias("suffix"), "lang").filter(F.col("lang").isin(*languages) & (F.col("suffix") != "")).distinct().collect() if languages else []

    def tails(token: Column, held: Column) -> Column:
        """Half of ``top`` for each suffix of the token in each language that does not hold the token."""
        found = [F.when(token.endswith(e.suffix) & ~F.array_contains(held, e.lang), F.struct(F.lit(e.lang).alias("lang"), F.lit(top / 2).alias("w"), F.lit(0).alias("hit"))) for e in ends]
        return F.filter(F.array(*found), lambda x: x.isNotNull()) if found else F.array().cast("array<struct<lang:string,w:double,hit:int>>")

    def ending(token: Column) -> Column:
        quoted = sorted({re.sub(r"([^\w])", r"\\\1", e.suffix) for e in ends})
        return token.rlike("(?:" + "|".join(quoted) + ")$") if quoted else F.lit(False)

    return terms, tails, ending, languages


def best_language(tokens: DataFrame, keys: list[str], lexicon: DataFrame, suffixes: DataFrame, top: int) -> DataFrame:
    """``keys, lang`` from ``keys, token``: the language of most weight, of keys with at least one lexicon hit.

    A lexicon term weighs ``top`` minus its rank; where a language does not hold the token, each of its suffixes that ends
    the token weighs half of ``top``. Suffixes of languages without a lexicon never count; ties go to the first language by
    name. A lexicon of at most ``BROADCAST_ROWS`` terms is broadcast, and one aggregation per key, a sum per language, is all
    that is shuffled. A larger one is joined by token with frequent tokens dealt to salts.
    """
    terms, tails, ending, languages = _weights(lexicon, suffixes, top)
    if not languages:
        return tokens.select(*keys, F.lit(None).cast("string").alias("lang")).limit(0)
    if small(terms, BROADCAST_ROWS):
        weighed = tokens.join(F.broadcast(terms), "token", "left")
    else:
        a, b, on = dealt(tokens, terms, ["token"], keys[0])
        weighed = a.join(b, on, "left")
    # most tokens end in no suffix, and many are in no lexicon either
    ends = ending(F.col("token"))
    ws = F.coalesce("ws", F.array().cast("array<struct<lang:string,w:double,hit:int>>"))
    both = F.concat(ws, tails(F.col("token"), F.coalesce(F.col("ws.lang"), F.array().cast("array<string>"))))
    weighed = weighed.filter(F.col("ws").isNotNull() | ends).select(*keys, F.inline(F.when(ends, both).otherwise(ws)))
    sums = [F.sum(F.when(F.col("lang") == x, F.col("w"))).alias(f"w{k}") for k, x in enumerate(languages)]
    scored = weighed.groupBy(*keys).agg(F.sum("hit").alias("hits"), *sums).filter("hits > 0")
    # least of (-weight, name)
    best = F.array_min(F.filter(F.array(*(F.when(F.col(f"w{k}").isNotNull(), F.struct((-F.col(f"w{k}")).alias("w"), F.lit(x).alias("lang"))) for k, x in enumerate(languages))), lambda x: x.isNotNull()))
    return scored.select(*keys, best["lang"].alias("lang"))


def tag_lines(docs: DataFrame, id_col: str, lexicon: DataFrame, suffixes: DataFrame, top: int, text: str = "text") -> DataFrame:
    """``id, line_no, line, lang`` for every line of every text; lines without a lexicon term are ``en``, empty ones ``gl``.

    Null texts have no lines. Ties go to the language that comes first in the alphabet. Ids are taken as unique.
    """
    lines = docs.select(F.col(id_col).alias("id"), F.posexplode(F.split(lines_ended(F.col(text)), "\n")).alias("line_no", "line"))
    tokens = lines.select("id", "line_no", F.explode(language_tokens(F.col("line"))).alias("token"))
    best = best_language(tokens, ["id", "line_no"], lexicon, suffixes, top)
    fallback = F.when(strip(F.col("line")) == "", "gl").otherwise("en")
    return lines.join(best, ["id", "line_no"], "left").select("id", F.col("line_no").cast("long").alias("line_no"), "line", F.coalesce("lang", fallback).alias("lang"))


def tag_documents(docs: DataFrame, id_col: str, lexicon: DataFrame, suffixes: DataFrame, top: int, text: str = "text") -> DataFrame:
    """``id, lang`` of whole documents; ``es`` where no term is in a lexicon, also for null texts."""
    picked = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    tokens = picked.select("id", F.explode(language_tokens(F.col("text"), document=True)).alias("token"))
    best = best_language(tokens, ["id"], lexicon, suffixes, top)
    return picked.select("id").join(best, "id", "left").select("id", F.coalesce("lang", F.lit("es")).alias("lang"))


def filter_lines(tagged: DataFrame, wanted: str | None) -> DataFrame:
    """``id, text, lang`` per document from tagged lines.

    With ``wanted`` only lines of that language stay and documents left empty are dropped; else all lines stay and ``lang``
    is the most frequent tag, the earlier one on ties. Lines that hold a tab are dropped.
    """
    rows = tagged.filter(~F.col("line").contains("\t"))
    if wanted is not None:
        rows = rows.filter(same_language(F.col("lang"), F.lit(wanted)))
    per_lang = rows.groupBy("id", "lang").agg(F.count("*").alias("n"), F.min("line_no").alias("first"))
    lang = per_lang.groupBy("id").agg(F.min_by("lang", F.struct(-F.col("n"), "first")).alias("lang"))
    text = rows.groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n").alias("text"))
    return text.join(lang, "id").filter(strip(F.col("text")) != "").select("id", "text", "lang")
