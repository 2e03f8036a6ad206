"""Commands by name: each reads a path, runs one operator and writes its result, with the parameters of the command.

Documents are JSON lines (``mode="jsonl"``, text in ``field``, other fields kept in ``rest``) or lines of text (``txt``).
An existing output is refused.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import clean, tokens
from textloom.operators import exact, lexicon, minhash, parallel, perplexity, rules, translate
from textloom.sources import readers, writers

COMMANDS: dict[str, Callable] = {}


def _command(function: Callable) -> Callable:
    COMMANDS[function.__name__] = function
    return function


def run(name: str, spark: SparkSession, path: str, output: str, **parameters) -> DataFrame:
    """Run a command; its result is returned as well. Unknown names raise ``KeyError``."""
    return COMMANDS[name](spark, path, output, **parameters)


def _read(spark: SparkSession, path: str, mode: str, field: str, limit: int | None = None) -> DataFrame:
    if mode == "jsonl":
        return readers.read_jsonl(spark, path, field, limit=limit)
    if mode == "txt":
        return readers.first_rows(readers.read_lines(spark, path, "\n"), limit, "pos").withColumnRenamed("value", "text")
    raise ValueError(f"mode is jsonl or txt, not {mode}")


def _write(docs: DataFrame, output: str, mode: str, field: str, *more: str) -> DataFrame:
    if mode == "txt":
        docs.sort("pos").select("text").write.text(output)
    else:
        # fields of the input that the command does not set stay as they are
        line = F.to_json(F.struct(F.col("text").alias(field), *more))
        if "rest" in docs.columns:
            kept = F.map_filter(F.coalesce(F.col("rest").cast("map<string,variant>"), F.create_map().cast("map<string,variant>")), lambda k, _: ~k.isin(field, *more))
            own = F.create_map(*(x for name, c in ((field, "text"), *((m, m) for m in more)) for x in (F.lit(name), F.col(c).cast("variant"))))
            line = F.to_json(F.map_concat(kept, own))
        docs.sort("pos").select(line).write.text(output)
    return docs


@_command
def formatter(spark, path, output, technique="regex", delimiter="\\n\\n\\n"):
    if technique not in ("regex", "folder"):
        raise ValueError("technique is regex or folder")
    parts = readers.read_delimited(spark, path, clean.delimiter(delimiter)) if technique == "regex" else readers.read_folder(spark, path).select(F.col("path").alias("id"), F.lit(0).alias("part"), "text", readers.word_count(F.col("text")).cast("int").alias("num_words"))
    writers.write_jsonl(parts, output, "id", "part", "text", "num_words")
    return parts


@_command
def encoder(spark, path, output, mode="jsonl", field="text", categories="", characters="", remove="", emojis=False):
    fixed = clean.encode_fix(F.col("text"), categories, characters, remove, emojis, keep_breaks=mode == "jsonl")
    return _write(_read(spark, path, mode, field).withColumn("text", fixed), output, mode, field)


@_command
def tokenizer(spark, path, output, mode="jsonl", field="text"):
    return _write(_read(spark, path, mode, field).withColumn("text", tokens.each_line(F.col("text"), tokens.tokenize)), output, mode, field)


@_command
def detokenizer(spark, path, output, mode="jsonl", field="text"):
    return _write(_read(spark, path, mode, field).withColumn("text", tokens.each_line(F.col("text"), tokens.detokenize)), output, mode, field)


@_command
def filter_lang(spark, path, output, words: DataFrame, suffixes: DataFrame, lang=None, mode="jsonl", field="text"):
    docs = _read(spark, path, mode, field)
    tagged = lexicon.tag_lines(docs, "pos", words, suffixes, lexicon.last_rank(words))
    kept = lexicon.filter_lines(tagged, lang).withColumnRenamed("id", "pos")
    return _write(docs.drop("text").join(kept, "pos"), output, mode, field, *(["lang"] if mode == "jsonl" else []))


@_command
def document_language(spark, path, output, words: DataFrame, suffixes: DataFrame, mode="txt", field="text"):
    found = lexicon.tag_documents(_read(spark, path, mode, field), "pos", words, suffixes, lexicon.last_rank(words))
    writers.write_jsonl(found, output, "id", "lang", order="id")
    return found


@_command
def perplexity_filter(spark, path, output, model: DataFrame, score=True, perpl_limit=2000.0, remove_low_scores=True, mode="jsonl", field="text"):
    perplexity.requested(score=score)
    docs = _read(spark, path, mode, field)
    scored = docs.join(perplexity.score(docs.withColumn("text", readers.strip(F.col("text"))), model, "pos").withColumnsRenamed({"id": "pos", "perplexity": "perplexity"}), "pos", "left")
    kept = perplexity.filter_scores(scored, "perplexity", limit=perpl_limit, remove=remove_low_scores)
    return _write(kept.filter("status = 'kept'"), output, mode, field, *(["perplexity"] if mode == "jsonl" else []))


@_command
def mt_transliteration(spark, path, output, dictionary: DataFrame, transliterate=False, mode="txt", field="text"):
    docs = _read(spark, path, mode, field)
    done = translate.translate_lines(docs, dictionary, ["pos"], "text", transliterate)
    text = translate.clean_marks(F.col("translated")) if transliterate else F.col("translated")
    return _write(docs.drop("text").join(done, "pos").withColumn("text", text), output, mode, field)


@_command
def normalize(spark, path, output, rule_table: DataFrame, detokenize=False, bel=False, exact=False, mode="jsonl", field="text"):
    steps = rules.rule_list(rule_table, bel, exact)
    return _write(_read(spark, path, mode, field).withColumn("text", rules.normalize(F.col("text"), steps, detokenize)), output, mode, field)


@_command
def fix_new_lines(spark, path, output, most=3):
    docs = readers.read_folder(spark, path).withColumn("text", clean.clamp_newlines(F.col("text"), most))
    # the writer ends the text with a line feed of its own
    docs.select(F.regexp_replace("text", r"\n\z", "")).write.text(output)
    return docs


@_command
def jaccard(spark, path, output, max_documents=None, length_threshold=3, lsh_threshold=0.8, samples=False, mode="jsonl", field="text"):
    docs = _read(spark, path, mode, field, max_documents)
    if samples:
        linked = minhash.links(docs, minhash.sets(docs, "pos")[1], "pos", threshold=lsh_threshold, length_threshold=length_threshold)
        found = minhash.samples(minhash.groups(linked), docs, "pos")
        if mode == "jsonl":
            writers.write_jsonl(found, output, order="best_document_id")
        else:
            writers.write_report(minhash.sample_report(found, minhash.signatures(docs, "pos")), output)
        return found
    status = minhash.near_status(docs, "pos", "text", lsh_threshold, length_threshold)
    stay = minhash.best_first(docs, status, "pos")
    return _write(stay.drop("pos").withColumnRenamed("place", "pos"), output, mode, field)


@_command
def deduplication(spark, path, output, threshold=15, save_duplicates=False, input_lf=3, output_lf=2, mode="jsonl", field="text"):
    if mode == "jsonl":
        docs = _read(spark, path, mode, field)
    else:
        docs = readers.read_newline_documents(spark, path, input_lf).withColumn("pos", F.struct("file", "doc_no"))
    marked = exact.with_status(docs, "pos", threshold=threshold)
    gone = ["short", "duplicate"] if save_duplicates else ["short"]
    for rows, at in ((marked.filter("status = 'kept'"), output), (marked.filter(F.col("status").isin(gone)), writers.output_name(output, "_removed"))):
        if mode == "jsonl":
            _write(rows, at, mode, field)
        else:
            writers.write_newline_documents(rows, at, output_lf=output_lf, order="pos")
    return marked


@_command
def mt_deduplication(spark, path, output, target):
    src, tgt = readers.read_parallel(spark, path, target)
    a, b = parallel.drop_repeated(src, tgt, ["pos"], "src")
    a.sort("pos").select("src").write.text(f"{output}/src")
    b.sort("pos").select("tgt").write.text(f"{output}/tgt")
    return a


@_command
def mt_language(spark, path, output, target, words: DataFrame, suffixes: DataFrame, lang="gl", tag="_lang"):
    src, tgt = readers.read_parallel(spark, path, target)
    found = lexicon.tag_lines(src, "pos", words, suffixes, lexicon.last_rank(words), "src").select(F.col("id").alias("pos"), "lang")
    pairs = parallel.with_language_status(parallel.align(src, tgt, ["pos"]).join(found, "pos", "left"), "lang", lang)
    writers.write_pairs(pairs, output, tag)
    return parallel.mismatch_counts(pairs)


@_command
def count(spark, path, output, threshold=15, input_lf=2):
    docs = readers.read_newline_documents(spark, path, input_lf)
    found = exact.count_parts(docs, "file", threshold=threshold)
    writers.write_jsonl(found, output)
    return found
