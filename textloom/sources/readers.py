"""Readers. Every reader of lines carries ``path`` and, where order matters, a place ``pos``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textloom.functions.clean import invalid_bytes
from textloom.functions.words import strip, word_count
from textloom.operators.lexicon import lexicon_from_files
from textloom.operators.lines import newline_documents, paragraphs, split_documents
from textloom.operators.order import first_rows, with_position


def read_lines(spark: SparkSession, path: str | list[str], line_sep: str | None = None) -> DataFrame:
    """``path, pos, value``: lines numbered from 1 over all files, in the order of the files' names.

    Without ``line_sep`` CRLF, CR and LF all end a line. Files are split as usual; the numbering is a range sort by file and
    byte order of the splits.
    """
    reader = spark.read.option("lineSep", line_sep) if line_sep else spark.read
    rows = reader.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("k"), "value")
    return with_position(rows, "path", "block", "k").drop("block", "k")


def read_folder(spark: SparkSession, root: str, match: str = "*") -> DataFrame:
    """``path, text``: whole files below a folder whose names match."""
    return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", match).text(root, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def list_files(spark: SparkSession, root: str, match: str = "*.txt") -> DataFrame:
    """``path`` of the files below a folder, without reading them."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", match).load(root).select("path")


def parse_documents(lines: DataFrame, field: str = "text", value: str = "value", strict: bool = False) -> DataFrame:
    """JSON lines as documents: the given columns, ``text`` and ``rest`` (the whole object as a variant).

    Blank lines are skipped. Control characters inside strings are let through. A line that is no object, or lacks the field,
    gives a null text and a null ``rest``; with ``strict`` it raises.
    """
    body = lines.filter(F.coalesce(strip(F.col(value)), F.lit("")) != "")
    # raw control characters would make the parser reject the line
    safe = F.regexp_replace(value, r"[\x00-\x1f]", " ")
    rest = F.try_parse_json(safe)
    loose = F.from_json(value, f"`{field}` STRING", {"allowUnquotedControlChars": "true", "mode": "PERMISSIVE"})
    out = body.withColumn("text", loose[field]).withColumn("rest", rest)
    if strict:
        out = out.withColumn("text", F.when(F.col("text").isNull(), F.raise_error(F.lit(f"a line has no field '{field}'"))).otherwise(F.col("text")))
    return out.drop(value)


def read_jsonl(spark: SparkSession, path: str | list[str], field: str = "text", strict: bool = True, limit: int | None = None) -> DataFrame:
    """``path, pos, text, rest`` of JSON lines files; with ``limit`` of the first documents only."""
    return first_rows(parse_documents(read_lines(spark, path, "\n"), field, strict=strict), limit, "pos")


def read_newline_documents(spark: SparkSession, path: str | list[str], input_lf: int = 3, strict: bool = False) -> DataFrame:
    """``file, doc_no, text, n_lines`` of newline-delimited files."""
    return newline_documents(read_lines(spark, path, "\n"), "path", "pos", "value", input_lf, strict)


def read_paragraphs(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """``id, par_no, text`` of the parts between empty lines; with ``limit`` the first ones over all files."""
    return first_rows(paragraphs(read_folder(spark, path), "path"), limit, "id", "par_no")


def read_delimited(spark: SparkSession, path: str, delimiter: str = "\n\n\n", literal: bool = False) -> DataFrame:
    """``id, part, text, num_words`` of files cut at a regular expression.

    A file is one row until it is cut, so it must fit a task. With ``literal`` the delimiter is plain text, files of any size
    are split where they are read, and the last part of a file is stripped like the others.
    """
    if not literal:
        return split_documents(read_folder(spark, path), "path", delimiter)
    rows = read_lines(spark, path, delimiter)
    begin = rows.groupBy("path").agg(F.min("pos").alias("_begin"))
    text = strip(F.col("value"))
    return rows.join(F.broadcast(begin), "path").select(F.col("path").alias("id"), (F.col("pos") - F.col("_begin")).alias("part"), text.alias("text"), word_count(text).cast("int").alias("num_words"))


def read_bytes(spark: SparkSession, path: str) -> DataFrame:
    """``path, pos, value`` of files whose bytes need not be UTF-8: lines end at a line feed, invalid bytes are left out.

    Files are read whole, one row each until they are cut.
    """
    files = spark.read.format("binaryFile").load(path).select("path", F.posexplode(F.split(invalid_bytes(F.col("content")), "\n")).alias("p", "value"))
    # a line feed at the end opens no line
    last = F.row_number().over(W.partitionBy("path").orderBy(F.desc("p"))) == 1
    rows = files.withColumn("_last", last).filter(~(F.col("_last") & (F.col("value") == "")))
    return rows.select("path", (F.col("p") + 1).cast("long").alias("pos"), "value")


def read_parallel(spark: SparkSession, source: str, target: str) -> tuple[DataFrame, DataFrame]:
    """Two aligned files as ``pos, src`` and ``pos, tgt``."""
    a, b = read_lines(spark, source, "\n"), read_lines(spark, target, "\n")
    return a.select("pos", F.col("value").alias("src")), b.select("pos", F.col("value").alias("tgt"))


def read_lexicon(spark: SparkSession, folder: str, varieties: bool = False) -> DataFrame:
    """``lang, term, term_rank`` of a folder of ranked word lists named by language, or of those named by variety."""
    return lexicon_from_files(read_lines(spark, folder, "\n"), varieties)


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """``sheet, ord, pattern, replacement`` from a CSV file with these columns."""
    return spark.read.schema("sheet string, ord int, pattern string, replacement string").csv(path, header=True)


def field_text(lines: DataFrame, field: str, value: str = "value") -> DataFrame:
    """One field of JSON lines as text; malformed lines are skipped."""
    return lines.filter(F.try_parse_json(value).isNotNull()).withColumn("text", F.get_json_object(value, f"$.{field}")).drop(value)
