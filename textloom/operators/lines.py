"""Documents out of lines and out of texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textloom.functions.clean import normalize_document
from textloom.functions.words import strip, word_count


def newline_documents(lines: DataFrame, file: str = "source_file", pos: str = "pos", line: str = "line", input_lf: int = 3, strict: bool = False) -> DataFrame:
    """``file, doc_no, text, n_lines``: documents of a newline-delimited file.

    A document ends where ``input_lf - 1`` blank lines follow one another; longer runs are one separator, leading blanks open
    no document, a last document needs no separator and ``input_lf = 1`` never splits. Blank lines inside a document are
    dropped unless ``strict``; null lines count as blank. Lines are put in order within their file; each text is normalized.
    Windows run per file, so a file is the unit that must fit a task's sort (it spills); files run in parallel.
    """
    by_file = W.partitionBy(file).orderBy(pos)
    blank = F.coalesce(strip(F.col(line)) == "", F.lit(True))
    marked = lines.select(F.col(file).alias("file"), F.col(pos).alias("pos"), F.coalesce(F.col(line), F.lit("")).alias("line"), blank.alias("blank"))
    by_file = W.partitionBy("file").orderBy("pos")
    islands = marked.withColumn("island", F.sum((~F.col("blank")).cast("int")).over(by_file))
    run = F.row_number().over(W.partitionBy("file", "island").orderBy("pos")) - F.when(F.col("island") > 0, 1).otherwise(0)
    cut = islands.withColumn("cut", (F.col("blank") & (run == input_lf - 1) & F.lit(input_lf > 1)).cast("int"))
    numbered = cut.withColumn("doc", F.sum("cut").over(by_file))
    if strict:
        # blanks of a separator's own run are not part of the document before it
        body = numbered.withColumn("last", F.max(F.when(~F.col("blank"), F.col("pos"))).over(W.partitionBy("file", "doc")))
        body = body.withColumn("first", F.min(F.when(~F.col("blank"), F.col("pos"))).over(W.partitionBy("file", "doc")))
        body = body.filter((F.col("pos") <= F.col("last")) & (F.col("pos") >= F.col("first")))
    else:
        body = numbered.filter(~F.col("blank"))
    docs = body.groupBy("file", "doc").agg(F.array_sort(F.collect_list(F.struct("pos", "line"))).alias("rows"))
    numbered = docs.withColumn("doc_no", F.row_number().over(W.partitionBy("file").orderBy("doc")).cast("long"))
    return numbered.select("file", "doc_no", normalize_document(F.col("rows.line")).alias("text"), F.size("rows").cast("long").alias("n_lines"))


def paragraphs(docs: DataFrame, id_col: str, text: str = "text", limit: int | None = None) -> DataFrame:
    """``id, par_no, text`` of the parts between empty lines, numbered from 1; with ``limit`` the first ones only."""
    parts = F.split(F.col(text), "\n\n")
    parts = F.slice(parts, 1, limit) if limit is not None else parts
    return docs.select(F.col(id_col).alias("id"), F.posexplode(parts).alias("p", "text")).select("id", (F.col("p") + 1).cast("long").alias("par_no"), "text")


def split_documents(docs: DataFrame, id_col: str, delimiter: str = "\n\n\n", text: str = "text") -> DataFrame:
    """``id, part, text, num_words``: parts between matches of ``delimiter``, numbered from 0.

    All parts but the last are stripped; empty ones stay, an empty last one is dropped.
    """
    pieces = docs.select(F.col(id_col).alias("id"), F.split(F.col(text), delimiter).alias("parts"))
    rows = pieces.select("id", F.size("parts").alias("n"), F.posexplode("parts").alias("p", "raw"))
    last = F.col("p") == F.col("n") - 1
    rows = rows.filter(~(last & (F.col("raw") == ""))).select("id", F.col("p").cast("long").alias("part"), F.when(last, F.col("raw")).otherwise(strip(F.col("raw"))).alias("text"))
    return rows.withColumn("num_words", word_count(F.col("text")).cast("int"))
