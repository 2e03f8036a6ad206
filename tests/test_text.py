from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textloom.functions import clean, tokens, words


def run(spark, values, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r.x for r in df.select("i", f(F.col("t")).alias("x")).sort("i").collect()]


def test_words_and_blanks(spark):
    texts = ["a  b\tc", "", None, " 　x y ", "\x1cz"]
    assert run(spark, texts, words.word_count) == [3, 0, None, 2, 1]
    assert run(spark, texts, words.collapse) == ["a b c", "", None, "x y", "z"]
    assert run(spark, texts, words.strip) == ["a  b\tc", "", None, "x y", "z"]


def test_word_count_is_pythons(spark):
    @settings(max_examples=5, deadline=None)
    @given(st.lists(st.text(alphabet="ab \t\n é.", max_size=20), min_size=1, max_size=30))
    def check(texts):
        assert run(spark, texts, words.word_count) == [len(t.split()) for t in texts]

    check()


def test_normalize_line_and_clamp(spark):
    assert run(spark, ["a---b . . . c", "- - x", None], clean.normalize_line) == ["a b c", "- - x", None]
    assert run(spark, ["a\n\n\n\n\nb", "a\n\n\nb"], clean.clamp_newlines) == ["a\n\n\nb", "a\n\n\nb"]


def test_tokenizer(spark):
    # the number rules put a blank after what they protect, so a second separator begins a token
    got = run(spark, ["Custa 1,234.5 euros, si!", "«Ola», dixo.", "", None, "a - b -c d-"], tokens.tokenize)
    assert got == ["Custa 1,234 .5 euros , si !", "« Ola » , dixo .", "", None, "a - b - c d -"]


def test_detokenizer(spark):
    # matches do not overlap: of two marks in a row the second keeps its blank
    got = run(spark, ["« Ola » , dixo .", "I ' m here", 'el " x y " z', None], tokens.detokenize)
    assert got == ["«Ola» , dixo.", "I'm here", 'el "x y" z', None]


def test_decoding_repair(spark):
    texts = ["cafÃ© maÃ±Ã¡", "cafÃƒÂ©", "a &amp; b", "<b>&amp;</b>", r"x\x41 é", "limpo é", None, ""]
    assert run(spark, texts, clean.fix_decoding) == ["café mañá", "café", "a & b", "<b>&amp;</b>", "xA é", "limpo é", None, ""]


def test_percent_codes_in_sequence(spark):
    assert run(spark, ["%2541 %2520 %C3%A9 %E9 %0A", "100%", None], clean.percent_decode) == ["A %20 é é  ", "100%", None]


def test_encode_fix_is_idempotent_on_clean_text(spark):
    texts = ["Unha liña limpa, con acentos é ó.", "two  words\nhere", "", None]
    once = run(spark, texts, clean.encode_fix)
    assert once == ["Unha liña limpa, con acentos é ó.", "two words here", "", None]
    assert run(spark, once, clean.encode_fix) == once


def test_categories_and_pictures(spark):
    f = lambda c: clean.keep_categories(c, "Ll Zs", "-", "x")
    assert run(spark, ["aB-x c1"], f) == ["a -  c "]
    assert run(spark, ["a␀b␤c␅d"], clean.control_pictures) == ["a b\nc?d"]


def test_punctuation_tags(spark):
    assert run(spark, [".", "<<x", "palabra", "¿", None], words.punctuation_tag) == ["Fp", "Fra", "", "Fia", None]


def test_encoder_on_texts_of_every_shape(spark):
    rows = {
        "CafÃ© e pÃ£o": "Café e pão",
        r"a \xe1 ñ b": "a á ñ b",
        "“dixo”": '"dixo"',
        "fin� de": "fin de",
        "&amp; &eacute; &#241;": "& é ñ",
        "a​b⁠c﻿": "abc",
        "uno dous　tres": "uno dous tres",
        "ola 🙂 мир 中文 ابجد": "ola 🙂 мир 中文 ابجد",
        "%C3%A1 %2541 %2520 %2500x %E2%80%9C %E2%80 %E2%84": "á A %20 x “ › ™",
        "Å\"uvre Ã<81>": "œuvre Á",
        "a␍b␊c␅d": "a b c ?d".replace(" ?", "?"),
        "ﬁn Ｏｌａ": "fin Ola",
        "liña\nnova\tcorta": "liña nova corta",
        "": "",
        "   ": "",
    }
    df = spark.createDataFrame([(k,) for k in [*rows, None]], "t string")
    got = {r.t: r.f for r in df.select("t", clean.encode_fix(F.col("t")).alias("f")).collect()}
    assert got == rows | {None: None}
    # every line by itself: line ends and tabs vanish with the other non-printables
    lines = df.select("t", clean.encode_fix(F.col("t"), keep_breaks=False).alias("f")).filter("t like 'liña%'").first()
    assert lines.f == "liñanovacorta"
    kept = df.select("t", clean.encode_fix(F.col("t"), "Lu Ll Zs", emojis=True).alias("f")).filter("t like 'ola%'").first()
    assert kept.f == "ola 🙂 мир"


def test_tags_delimiters_and_bytes(spark):
    df = spark.createDataFrame([("<p class='x'>a&amp;b</p><!-- c --><script>if (a<b) x()</script> 3 < 4",), (None,), ("",)], "t string")
    assert [r[0] for r in df.select(clean.remove_tags(F.col("t"))).collect()] == [" a&b    3 < 4", None, ""]
    assert clean.delimiter(r"\n\n\tá\\") == "\n\n\tá\\" and clean.delimiter("||") == "||"
    raw = spark.createDataFrame([(bytearray(b"a\xff\xc3\xb1\xed\xa0\x80"),), (None,), (bytearray("ñ 🙂".encode()),)], "b binary")
    assert [r[0] for r in raw.select(clean.invalid_bytes(F.col("b"))).collect()] == ["añ", None, "ñ 🙂"]
