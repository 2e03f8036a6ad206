"""Every query with SQL agrees with it on the smallest tables."""

import glob
import os

import pytest

from textloom.plans.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"
QUICK = ["word_count_filter", "dedup_status", "dedup_parts_counts", "newline_docs", "normalize_lines", "parallel_dedup_target", "tokenize", "detokenize", "mark_cleanup", "latest_scores", "percent_decode", "lang_id_doc"]


def norm(v):
    if isinstance(v, float):
        return repr(round(v, 9))
    if hasattr(v, "tzinfo"):
        return v.replace(tzinfo=None).isoformat()
    return repr(v)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")
@pytest.mark.parametrize("name", QUICK)
def test_query_agrees_with_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for p in glob.glob(FOLDER + "/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    df = QUERIES[name](spark, FOLDER)
    cols = sorted(df.columns)
    got = sorted(tuple(norm(v) for v in r) for r in df.select(*cols).collect())
    want = con.execute("select {} from ({})".format(", ".join(cols), ORACLE[name])).fetchall()
    assert got == sorted(tuple(norm(v) for v in r) for r in want)


def test_translation_keeps_different_pairs_of_one_place(spark, tmp_path):
    pairs = [("f", 1, "a casa", "la casa"), ("f", 1, "a casa", "la casa"), ("f", 1, "o can", "el perro"), ("f", 1, "o gato", None), ("f", 2, "a lúa", "la luna")]
    spark.createDataFrame(pairs, "source_file string, pos long, src string, tgt string").write.parquet(f"{tmp_path}/parallel_corpus.parquet")
    spark.createDataFrame([("error", 1, "perro", "can")], "sheet string, ord int, pattern string, replacement string").write.parquet(f"{tmp_path}/rules.parquet")
    got = sorted((r.pos, r.src) for r in QUERIES["translated_pairs"](spark, str(tmp_path)).collect())
    assert got == [(1, "a casa"), (1, "o can"), (1, "o gato"), (2, "a lúa")]
