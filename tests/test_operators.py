import json
import random

from pyspark.sql import functions as F

from textloom.operators import exact, lexicon, lines, minhash, order, parallel, perplexity, rules, translate
from textloom.plans.registry import list_commands, register
from textloom.sources import readers, writers

LONG = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"


def test_exact_dedup_states(spark):
    rows = [(1, LONG, "x"), (2, "short", "x"), (3, LONG, "x"), (4, None, None), (5, "", "x"), (6, LONG + " more", None)]
    docs = spark.createDataFrame(rows, "id long, text string, status2 string")
    got = {r.id: r.status for r in exact.with_status(docs, "id").collect()}
    assert got == {1: "kept", 2: "short", 3: "duplicate", 4: "short", 5: "short", 6: "kept"}
    assert exact.counters(docs).first() == (6, 3, 2)
    kept = exact.kept(docs, "id")
    assert sorted(r.id for r in exact.kept(kept, "id").collect()) == [1, 6]
    empty = docs.limit(0)
    assert exact.counters(empty).first() == (0, 0, 0) and exact.with_status(empty, "id").count() == 0


def test_parts_and_whole_agree(spark):
    rng = random.Random(1)
    rows = [(f"f{k % 3}", k, LONG + f" {rng.randint(0, 9)}") for k in range(60)]
    docs = spark.createDataFrame(rows, "file string, pos long, text string")
    by_parts = exact.with_status(docs, exact.parts_order("file", "pos")).filter("status = 'kept'").count()
    assert by_parts == exact.counters(docs).first().unique_docs


def machine(lines_, lf, strict=False):
    """The line-by-line reading, as the brute force."""
    docs, cur, blanks = [], [], 0
    for x in lines_:
        if (x or "").strip() == "":
            blanks += 1
            if blanks == lf - 1 and lf > 1:
                if cur:
                    docs.append(cur)
                cur = []
        else:
            blanks = 0
            cur.append(x)
    return docs + ([cur] if cur else [])


def test_newline_documents_against_state_machine(spark):
    rng = random.Random(2)
    rows, expected = [], {}
    for f in range(12):
        ls = [rng.choice(["", "", " ", "a b", "c", None]) for _ in range(rng.randint(0, 14))]
        rows += [(str(f), k, x) for k, x in enumerate(ls)]
        expected[str(f)] = [len(d) for d in machine(ls, 3)]
    df = spark.createDataFrame(rows, "source_file string, pos long, line string")
    got = {}
    for r in lines.newline_documents(df).sort("file", "doc_no").collect():
        got.setdefault(r.file, []).append(r.n_lines)
    assert got == {f: n for f, n in expected.items() if n}


def test_split_documents_drops_an_empty_tail(spark):
    docs = spark.createDataFrame([(1, " a b\n\n\n\n\n\nc\n\n\n"), (2, None), (3, "")], "id long, text string")
    got = [tuple(r) for r in lines.split_documents(docs, "id").sort("id", "part").collect()]
    assert got == [(1, 0, "a b", 2), (1, 1, "", 0), (1, 2, "c", 1)]


def test_chunks_sizes(spark):
    df = spark.range(23).repartition(5)
    sizes = [r[0] for r in order.chunks(df, "id").groupBy("chunk").count().sort("chunk").select("count").collect()]
    assert sizes == [3, 3, 3, 2, 2, 2, 2, 2, 2, 2]


def test_parallel_keeps_alignment_and_tail(spark):
    src = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "pos long, src string")
    tgt = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z"), (4, "tail")], "pos long, tgt string")
    s, t = parallel.drop_repeated(src, tgt, ["pos"], "src")
    assert [r.pos for r in s.sort("pos").collect()] == [1, 2] and [r.pos for r in t.sort("pos").collect()] == [1, 2, 4]
    assert parallel.align(src, tgt, ["pos"]).count() == 3


def test_language_tags(spark):
    lex = spark.createDataFrame([("gl", "de", 1), ("gl", "unha", 2), ("en", "the", 1), ("en", "the", 3), ("en", "of", 2)], "lang string, term string, term_rank int")
    suf = spark.createDataFrame([("tion", "en"), (" xión", "gl"), ("ing", "xx")], "suffix string, lang string")
    docs = spark.createDataFrame([(1, "Unha casa de\n\nthe nation"), (2, None), (3, "zzz")], "id long, text string")
    tagged = lexicon.tag_lines(docs, "id", lex, suf, 10)
    assert [(r.id, r.line_no, r.lang) for r in tagged.sort("id", "line_no").collect()] == [(1, 0, "gl"), (1, 1, "gl"), (1, 2, "en"), (3, 0, "en")]
    assert {r.id: r.lang for r in lexicon.tag_documents(docs, "id", lex, suf, 10).collect()} == {1: "gl", 2: "es", 3: "es"}
    assert [tuple(r) for r in lexicon.filter_lines(tagged, "GL").select("id", "text").collect()] == [(1, "Unha casa de\n")]


def test_rules_follow_the_first_match(spark):
    table = spark.createDataFrame(
        [("error", 1, "rua", "rúa Nova"), ("error", 2, "x", None), ("exact", 1, "a o", "ao"), ("error", 1, "rua", "rúa Nova"), ("transform", 1, r"(\d+) %", r"\1%")],
        "sheet string, ord int, pattern string, replacement string",
    )
    plain, bel = rules.rule_list(table), rules.rule_list(table, bel=True, exact=True)
    assert len(plain) == 2 and len(bel) == 4
    df = spark.createDataFrame([(" Rua e rua ",), ("a rua, x a o 5 %",), (None,), ("carua",), ("",)], "t string")
    # a rule without a replacement deletes the word
    assert [r[0] for r in df.select(rules.normalize(F.col("t"), bel)).collect()] == ["Rúa nova e Rúa nova", "a rúa Nova,  ao 5%", None, "carua", ""]
    assert [r[0] for r in df.select(rules.normalize(F.col("t"), [])).collect()][0] == "Rua e rua"


def test_rules_are_stripped_and_bounded(spark):
    table = spark.createDataFrame([("error", 1, " rua ", " rúa\t"), ("error", 2, "sr.", "señor"), ("error", 3, "a.c", "b"), ("all", 1, "can", "gato"), ("error", 4, "   ", "x")], "sheet string, ord int, pattern string, replacement string")
    steps = rules.rule_list(table)
    assert [s[1:] for s in steps] == [("rua", "rúa"), ("sr.", "señor"), ("a.c", "b")]
    ready = rules.Rules(steps)
    # a boundary behind a mark needs a letter behind it
    assert ready.apply("a rua do sr. e sr.x, abc a.c can") == "a rúa do sr. e señorx, abc b can"
    # one engine for tables of every size
    many = rules.Rules([("word", f"palabra{k}", f"p{k}") for k in range(200)] + [("transform", r"p(\d+) p(\d+)", r"\2-\1")])
    assert many.apply("palabra7 palabra199") == "199-7"


def test_near_duplicates(spark):
    base = [f"w{k}" for k in range(60)]
    rows = [(1, " ".join(base)), (2, " ".join(base[:-1] + ["z"])), (3, "\n".join(base)), (4, "outra cousa"), (5, ""), (6, None)]
    docs = spark.createDataFrame(rows, "id long, text string")
    got = {r.pos: r.status for r in minhash.near_status(docs).collect()}
    assert got == {1: "kept_as_best", 2: "near_duplicate", 3: "copy", 4: "kept"}
    assert minhash.optimal_bands(0.8, 128) == (9, 13)
    assert minhash.near_status(docs.limit(0)).count() == 0


def test_perplexity_is_the_formula(spark):
    import math

    docs = spark.createDataFrame([(1, "a b"), (2, "a c"), (3, ""), (4, None)], "id long, text string")
    got = {r.id: r.perplexity for r in perplexity.score(docs, perplexity.fit(docs)).collect()}
    v = 5  # <s>, </s>, a, b, c
    p = [(2 + 1) / (3 + v), (1 + 1) / (2 + v), (1 + 1) / (1 + v)]
    assert abs(got[1] - math.exp(-sum(map(math.log, p)) / 3)) < 1e-9 and set(got) == {1, 2, 3}
    scored = spark.createDataFrame([(1, 5.0), (2, float("nan")), (3, None), (4, 2000.0)], "id long, pyplexity_score double")
    assert [r.status for r in perplexity.filter_scores(scored).sort("id").collect()] == ["kept"] + ["high_perplexity"] * 3


def test_marks(spark):
    df = spark.createDataFrame([("a [[UNK]] estação , b",), ("'@x [[GEN_ERR]]",), (None,)], "line string")
    assert [r[0] for r in df.select(translate.clean_marks(F.col("line"))).collect()] == ["a estación, b", "'x ", None]


def test_readers_and_writers(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"text": "ola\tñ", "k": 1}\n\n{"text": "dous"}\n', encoding="utf-8")
    docs = readers.read_jsonl(spark, str(tmp_path / "a.jsonl"))
    assert [r.text for r in docs.sort("pos").collect()] == ["ola\tñ", "dous"]
    writers.write_jsonl(docs, str(tmp_path / "out"), "text", order="pos")
    assert spark.read.text(str(tmp_path / "out")).count() == 2
    (tmp_path / "lex").mkdir()
    (tmp_path / "lex" / "gl.lx").write_text("de\ne\n")
    (tmp_path / "lex" / "es-AR.lx").write_text("che\n")
    assert [r.lang for r in readers.read_lexicon(spark, str(tmp_path / "lex"), varieties=True).collect()] == ["es-AR"]
    (tmp_path / "raw").write_bytes(b"ola \xff\xc3\xb1\n\xed\xa0\x80x\n\nfin\n")
    assert [tuple(r) for r in readers.read_bytes(spark, str(tmp_path / "raw")).sort("pos").select("pos", "value").collect()] == [(1, "ola ñ"), (2, "x"), (3, ""), (4, "fin")]
    (tmp_path / "cut.txt").write_text("a b \n\n\nc\n\n\n")
    for literal in (True, False):
        parts = readers.read_delimited(spark, str(tmp_path / "cut.txt"), literal=literal)
        assert [tuple(r) for r in parts.sort("part").select("part", "text", "num_words").collect()] == [(0, "a b", 2), (1, "c", 1)]
    assert readers.read_jsonl(spark, str(tmp_path / "a.jsonl"), limit=1).count() == 1
    assert writers.output_name("/x/a.b.txt", "_dedup") == "/x/a.b_dedup.txt" and writers.output_name("/x/out", "_removed", "/y/") == "/y/out_removed"
    assert [tuple(r) for r in readers.read_lexicon(spark, str(tmp_path / "lex")).sort("term_rank").collect()] == [("gl", "de", 1), ("gl", "e", 2)]


def test_registry(spark):
    assert {"deduplication", "jaccard", "encoder", "document_language", "mt_language", "count"} <= set(list_commands())
    assert len(register(spark)) == 8
    got = spark.sql("SELECT tl_words(' a b ') AS n, tl_strip(' a ') AS s, tl_tokenize('a, b') AS t, tl_detokenize('a , b') AS d, tl_punctuation_tag(',') AS p, tl_clamp_newlines('a\n\n\n\n\nb') AS c").first()
    assert tuple(got) == (2, "a", "a , b", "a, b", "Fc", "a\n\n\nb")


def test_a_hot_text_a_null_and_a_hot_token(spark):
    from textloom.operators import skew

    rows = [(k, LONG if k % 3 else None, "gl") for k in range(300)] + [(1000 + k, LONG + f" {k}", None) for k in range(50)]
    docs = spark.createDataFrame(rows, "id long, text string, lang string")
    got = exact.with_status(docs, "id").groupBy("status").count().collect()
    assert {r.status: r["count"] for r in got} == {"short": 100, "kept": 51, "duplicate": 199}
    gone = parallel.first_lines(docs.select("id", "text"), ["id"], "text")
    assert gone.count() == 199 + 99
    a, b, keys = skew.dealt(docs.withColumn("k", F.lit(1)), spark.createDataFrame([(1, "x")], "k long, v string"), ["k"], "id", most=20)
    joined = a.join(b, keys)
    assert keys == ["k", "_salt"] and joined.count() == 350
    assert joined.groupBy("_salt").count().agg(F.max("count")).first()[0] < 60
    lex = spark.createDataFrame([("gl", "one", 1), ("en", "two", 1)], "lang string, term string, term_rank int")
    suf = spark.createDataFrame([("x", "gl")], "suffix string, lang string")
    small = lexicon.tag_documents(docs, "id", lex, suf, 10)
    before, lexicon.BROADCAST_ROWS = lexicon.BROADCAST_ROWS, 0
    try:
        large = lexicon.tag_documents(docs, "id", lex, suf, 10)
        assert sorted(map(tuple, small.collect())) == sorted(map(tuple, large.collect()))
    finally:
        lexicon.BROADCAST_ROWS = before


def test_candidates_of_full_buckets(spark, monkeypatch):
    base = [f"w{k}" for k in range(80)]
    rows = [(k, " ".join(base[:79] + [f"z{k}"])) for k in range(30)]
    docs = spark.createDataFrame(rows, "id long, text string")
    expected = sorted(map(tuple, minhash.candidates(minhash.sets(docs)[1]).collect()))
    monkeypatch.setattr(minhash, "BUCKET", 3)
    assert sorted(map(tuple, minhash.candidates(minhash.sets(docs)[1]).collect())) == expected and expected


def test_perplexity_with_unseen_and_frequent_pairs(spark):
    import math

    train = spark.createDataFrame([(k, "de a casa de a lúa") for k in range(80)] + [(100, "un can")], "id long, text string")
    model = perplexity.fit(train)
    docs = spark.createDataFrame([(1, "de a casa"), (2, "can de xeo"), (3, "gato"), (4, None), (5, "")], "id long, text string")
    counts = {(r.a, r.b): r.n for r in model.collect()}
    first = {r.a: r.n_a for r in model.collect()}
    v = len({w for p in counts for w in p})
    for r in perplexity.score(docs, model).collect():
        w = ["<s>", *{1: "de a casa", 2: "can de xeo", 3: "gato", 5: ""}[r.id].split(), "</s>"]
        logs = [math.log((counts.get(p, 0) + 1) / (first.get(p[0], 0) + v)) for p in zip(w, w[1:])]
        assert abs(r.perplexity - math.exp(-sum(logs) / len(logs))) < 1e-9
    try:
        perplexity.requested()
        raise AssertionError
    except ValueError:
        perplexity.requested(score=True)


def test_commands(spark, tmp_path):
    from textloom.plans.commands import run

    rows = ['{"text": "  a casa\\u00a0vella , e o can", "k": 1, "z": {"q": [1]}}', '{"text": "' + LONG + '", "k": 2}', '{"text": "' + LONG + '", "k": 3}']
    (tmp_path / "in.jsonl").write_text("\n".join(rows) + "\n", encoding="utf-8")
    (tmp_path / "in.txt").write_text("a casa\n\n\n" + LONG + "\n\n\n" + LONG + "\n", encoding="utf-8")
    lex = spark.createDataFrame([("gl", "casa", 1), ("en", "one", 1)], "lang string, term string, term_rank int")
    suf = spark.createDataFrame([], "suffix string, lang string")
    table = spark.createDataFrame([("error", 1, "can", "gato")], "sheet string, ord int, pattern string, replacement string")
    at, out = str(tmp_path / "in.jsonl"), lambda n: str(tmp_path / n)

    def lines_of(name):
        return [json.loads(r.value) for r in spark.read.text(out(name)).collect()]

    run("encoder", spark, at, out("e"))
    assert lines_of("e")[0] == {"text": "a casa vella , e o can", "k": 1, "z": {"q": [1]}}
    run("detokenizer", spark, out("e"), out("d"))
    run("normalize", spark, out("d"), out("n"), rule_table=table)
    assert lines_of("n")[0]["text"] == "a casa vella, e o gato"
    run("deduplication", spark, at, out("dd"))
    assert [x["k"] for x in lines_of("dd")] == [2] and [x["k"] for x in lines_of("dd_removed")] == [1]
    run("deduplication", spark, out("in.txt"), out("dt"), mode="txt", save_duplicates=True)
    run("jaccard", spark, at, out("j"), max_documents=2)
    assert len(lines_of("j")) == 2
    run("filter_lang", spark, at, out("f"), words=lex, suffixes=suf, lang="gl")
    assert [(x["k"], x["lang"]) for x in lines_of("f")] == [(1, "gl")]
    run("perplexity_filter", spark, at, out("p"), model=perplexity.fit(readers.read_jsonl(spark, at)))
    assert all(x["perplexity"] > 1 for x in lines_of("p"))
    assert run("count", spark, out("in.txt"), out("c"), input_lf=3).filter("file is null").first()[1:] == (2, 1)
    assert run("mt_language", spark, out("in.txt"), out("q"), target=out("in.txt"), words=lex, suffixes=suf).first().total == 7
    for name, more in (("tokenizer", {}), ("document_language", {"words": lex, "suffixes": suf, "mode": "jsonl"}), ("formatter", {}), ("fix_new_lines", {}), ("mt_deduplication", {"target": at}), ("mt_transliteration", {"dictionary": table.select(F.col("pattern").alias("term"), F.col("replacement").alias("translation"))})):
        run(name, spark, at, out("x" + name), **more)
    try:
        run("tokenizer", spark, at, out("y"), mode="csv")
        raise AssertionError
    except ValueError:
        pass


def test_scratch_tables_go_and_clusters_need_a_folder(spark):
    import os

    from textloom.plans import materialize as m

    with m.scratch(spark):
        m.materialize(spark.range(3), "gone")
        path = m._PATHS[-1].removeprefix("file://")
        assert os.path.isdir(path)
    assert not os.path.isdir(path)

    class Cluster:
        class conf:  # noqa: N801
            get = staticmethod(lambda *a: None)

        class sparkContext:  # noqa: N801
            master = "spark://host:7077"
            getConf = staticmethod(lambda: Cluster.conf)

    try:
        m.shared_dir(Cluster)
        raise AssertionError
    except RuntimeError:
        pass


def test_report_and_best_first(spark):
    base = [f"w{k}" for k in range(60)]
    rows = [(1, " ".join(base)), (2, "outra cousa"), (3, " ".join(base[:-1] + ["z"])), (4, None)]
    docs = spark.createDataFrame(rows, "id long, text string")
    first = minhash.best_first(docs, minhash.near_status(docs))
    assert [r.id for r in first.sort("place").collect()] == [1, 2, 4]
    found = minhash.samples(minhash.groups(minhash.links(docs, minhash.sets(docs)[1])), docs)
    report = minhash.sample_report(found, minhash.signatures(docs)).first().report
    assert report.startswith("Group IDs: 1, 3\nBest Document: 1\n\nDocuments:\n\nDocument id: 1\n") and "with Best Document: 1.00" in report


def test_stream_dedup(spark, tmp_path):
    from textloom.streaming.incremental import dedup_stream

    spark.createDataFrame([(1, LONG), (2, LONG), (3, "short")], "id long, text string").write.parquet(str(tmp_path / "in"))
    q = dedup_stream(spark.readStream.schema("id long, text string").parquet(str(tmp_path / "in"))).writeStream.format("memory").queryName("dd").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("dd").count() == 1
