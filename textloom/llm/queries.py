"""Queries of the training-data problems and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textloom.sources.tables import table

from . import consistent, encode, expected, garble, language, layout, leak, near, pairs, quality, subject


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return quality.quality(table(spark, d, "docu")).filter("kind is not null").select("id", "kind")


def p1_statistics(spark: SparkSession, d: str) -> DataFrame:
    return quality.quality(table(spark, d, "docu"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return language.languages(table(spark, d, "docu"), table(spark, d, "lexicon")).select("id", "seg_no", "lang")


def p2_passages(spark: SparkSession, d: str) -> DataFrame:
    return language.languages(table(spark, d, "docu"), table(spark, d, "lexicon"), cases_only=False)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return garble.garbled(table(spark, d, "docu")).select("id")


def p3_restored(spark: SparkSession, d: str) -> DataFrame:
    return garble.garbled(table(spark, d, "docu"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return near.near_pairs(table(spark, d, "docu"))


def p4_documents(spark: SparkSession, d: str) -> DataFrame:
    return near.near_documents(table(spark, d, "docu"))


def p5_groups(spark: SparkSession, d: str) -> DataFrame:
    return layout.layout_groups(table(spark, d, "docu"))[1].select("keep_id", "n_copies")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return layout.layout_copies(table(spark, d, "docu")).select("keep_id", "copy_id")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return pairs.differing_pairs(consistent.lookalike_classes(table(spark, d, "docu")))


def p6_forms(spark: SparkSession, d: str) -> DataFrame:
    return consistent.canonical_forms(table(spark, d, "docu"))


def p6_classes(spark: SparkSession, d: str) -> DataFrame:
    return consistent.lookalike_classes(table(spark, d, "docu")).select("id", "class_id", "canonical")


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return encode.encode(table(spark, d, "documents"))


def p7_texts(spark: SparkSession, d: str) -> DataFrame:
    return encode.decode(encode.encode(table(spark, d, "documents")))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return leak.leaks(table(spark, d, "documents"), table(spark, d, "benchmark"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return subject.subjects(table(spark, d, "documents"), table(spark, d, "subject_samples"))


QUERIES = {f.__name__: f for f in (p1_found, p1_statistics, p2_found, p2_passages, p3_found, p3_restored, p4_found, p4_documents, p5_found, p5_groups, p6_found, p6_forms, p6_classes, p7_ids, p7_texts, p8_found, p9_found)}
ORACLE: dict[str, str] = expected.ORACLE
