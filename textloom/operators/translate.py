"""Dictionary translation with marks, transliteration of unknown words and the clean-up of marks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.words import words

# Fixed value: marks of a translation engine and the word behind each.
MARK = r"\[\[(UNK|GEN_ERR|NO_TRANS)\]\]\s*(\p{L}+)"
# Spelling correspondences from Portuguese to Galician, longest first.
SPELLING = [
    ("ções", "cións"), ("ção", "ción"), ("sões", "sións"), ("são", "sión"), ("ões", "óns"), ("ão", "ón"), ("lh", "ll"),
    ("nh", "ñ"), ("ss", "s"), ("j", "x"), ("ge", "xe"), ("gi", "xi"), ("ç", "z"), ("ê", "é"), ("ô", "ó"), ("â", "á"),
    ("qua", "cua"), ("y", "i"),
]


# What is deleted from a translated line and what is replaced, in order.
LEFT_OVER = ["[[UNK]]", "[[GEN_ERR]]", "[[NO_TRANS]]"]
PUT_RIGHT = [("'@", "'"), ("-@", "-"), ('"@', '"'), ("\\@", "\\\\"), ("http://@www", "http://www")]


def transliterate(word: Column, table: list[tuple[str, str]] | None = None) -> Column:
    """A word by the rule table, rule after rule; ``table`` replaces the built-in one. Case is kept where a rule is small."""
    for a, b in table if table is not None else SPELLING:
        word = F.replace(word, F.lit(a), F.lit(b))
    return F.regexp_replace(word, "m$", "n")


def marked_words(lines: DataFrame, line: str = "line") -> DataFrame:
    """``word, transliterated``: the distinct words behind marks."""
    found = lines.select(F.explode(F.regexp_extract_all(F.col(line), F.lit(MARK), F.lit(2))).alias("word")).distinct()
    return found.select("word", transliterate(F.col("word")).alias("transliterated"))


def _replace_marked(line: Column) -> Column:
    """Every mark and its word become the word's transliteration, without leaving the row."""
    pieces = F.split(F.regexp_replace(line, MARK, "\x01$2\x02"), "\x01")
    done = F.transform(pieces, lambda p: F.when(p.contains("\x02"), F.concat(transliterate(F.split_part(p, F.lit("\x02"), F.lit(1))), F.split_part(p, F.lit("\x02"), F.lit(2)))).otherwise(p))
    return F.array_join(done, "")


def clean_marks(line: Column) -> Column:
    """Marks, stray signs, blanks before punctuation and control characters of a translated line put right."""
    c = _replace_marked(line)
    for tag in LEFT_OVER:
        c = F.replace(c, F.lit(tag), F.lit(""))
    for a, b in PUT_RIGHT:
        c = F.replace(c, F.lit(a), F.lit(b))
    c = F.regexp_replace(c, r" +([,.!?;:)\]}])", "$1")
    c = F.regexp_replace(c, " {2,}", " ")
    return F.regexp_replace(c, r"[\x01-\x03]", "")


def translate_lines(lines: DataFrame, dictionary: DataFrame, keys: list[str], line: str = "line", transliterated: bool = True) -> DataFrame:
    """``keys, translated``: words through ``dictionary (term, translation)``, unknown ones behind ``[[UNK]]``, or on request
    transliterated. Words are looked up once each: distinct words join the dictionary, the result joins back by word.

    Null and blank lines give an empty text. Of several translations the first in order is used.
    """
    placed = lines.select(*keys, F.posexplode(words(F.coalesce(F.col(line), F.lit("")))).alias("p", "word"))
    entry = dictionary.filter("term is not null").groupBy(F.lower("term").alias("k")).agg(F.min("translation").alias("t"))
    known = placed.select("word").distinct().withColumn("k", F.lower("word")).join(entry, "k", "left")
    unknown = F.col("word") if not transliterated else transliterate(F.col("word"))
    known = known.select("word", F.when(F.col("t").isNotNull(), F.col("t")).when(F.lit(transliterated), unknown).otherwise(F.concat(F.lit("[[UNK]] "), "word")).alias("out"))
    done = placed.join(known, "word").groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p", "out"))), lambda x: x["out"]), " ").alias("translated"))
    return lines.select(*keys).join(done, keys, "left").select(*keys, F.coalesce("translated", F.lit("")).alias("translated"))
