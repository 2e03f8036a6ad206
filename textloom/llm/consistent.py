"""p6: visually identical text with different characters.

The *consistent form* of a text replaces full-width and styled letters, ligatures, decomposed accents, space-like
characters, invisible characters and look-alike letters of other scripts by the plain character they stand for.

Only rows that hold such a character pay for it: a JVM regular expression finds them, all other rows pass a null through
the Arrow stage and keep their text.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache
from itertools import chain

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from textloom.plans.materialize import materialize

# Letters of other scripts that are drawn like a Latin letter.
LOOKALIKES = {
    "А": "A", "В": "B", "Е": "E", "Ѕ": "S", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C",
    "Т": "T", "У": "Y", "Х": "X", "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i",
    "ј": "j", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ѵ": "v", "ӏ": "l", "Ү": "Y", "ү": "y",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T",
    "Υ": "Y", "Χ": "X", "α": "a", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "υ": "u", "ϲ": "c", "ϳ": "j",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ſ": "s", "օ": "o", "ս": "u", "ո": "n", "հ": "h", "Տ": "S", "Ց": "8",
}

_PLAIN = r"\x00-\x9f¡-¬®-İĲ-ž‐-‧‰-⁞₠-⃏"
#: Characters that can change: anything outside plain Latin text and common visible punctuation and signs.
ODD = rf"[^{_PLAIN}]"
#: A text without such characters. Java matches this over 20 times as fast as it searches a text for an odd character.
UNCHANGED = rf"\A[{_PLAIN}]*+\z"


@lru_cache(maxsize=1)
def mapping() -> dict[int, str]:
    """Code point to replacement, from the Unicode database plus :data:`LOOKALIKES`.

    Wide, narrow, font and circle forms and Latin ligatures map to what they stand for; every space separator to a blank;
    format characters and variation selectors to nothing. Superscripts, fractions, signs and dots keep their form.
    """
    out: dict[int, str] = {}
    # ideographs, Hangul, private use and unassigned planes hold nothing to map
    for cp in chain(range(0xA0, 0x3400), range(0xA000, 0xAC00), range(0xF900, 0x20000), range(0xE0000, 0xE0200)):
        ch = chr(cp)
        kind = unicodedata.category(ch)
        if kind in ("Zs", "Zl", "Zp"):
            out[cp] = " "
        elif kind == "Cf" or 0xFE00 <= cp <= 0xFE0F or 0xE0100 <= cp <= 0xE01EF or cp in (0x034F, 0x115F, 0x1160, 0x3164, 0xFFA0):
            out[cp] = ""
        else:
            d = unicodedata.decomposition(ch)
            if d.startswith(("<wide>", "<narrow>", "<font>", "<circle>")) or 0xFB00 <= cp <= 0xFB06:
                plain = unicodedata.normalize("NFKC", ch)
                out[cp] = "".join(LOOKALIKES.get(c, c) for c in plain)
    out.update({ord(a): b for a, b in LOOKALIKES.items()})
    return out


def consistent_text(text: str) -> str:
    """The consistent form of one text."""
    return unicodedata.normalize("NFC", unicodedata.normalize("NFC", text).translate(mapping()))


def _consistent_series(s: pd.Series) -> pd.Series:
    return s.map(consistent_text, na_action="ignore")


def consistent(col: Column | str) -> Column:
    """Consistent form of a string column; null stays null, an empty text stays empty."""
    c = F.col(col) if isinstance(col, str) else col
    udf = F.pandas_udf(_consistent_series, StringType())
    return F.coalesce(udf(F.when(~c.rlike(UNCHANGED), c)), c)


def word_count(col: Column) -> Column:
    """Runs of letters and digits."""
    return F.regexp_count(col, F.lit(r"[\p{L}\p{N}]+"))


def consistent_forms(docu: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """One row per record: ``id, text, form``. Null texts have a null form; ids may repeat."""
    return docu.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), consistent(text_col).alias("form"))


#: Parts into which the members of one class are dealt where they meet it, so that a class of any size is spread.
SALTS = 8
#: Replaced forms up to which they are looked up by broadcast; more are joined with a shuffle.
BROADCAST_ROWS = 100_000


def lookalike_classes(docu: DataFrame, id_col: str = "id", text_col: str = "text", min_words: int = 15) -> DataFrame:
    """Classes of texts that look alike: ``id, text_key, form_key, class_id, canonical`` of records in a class of at least
    two different texts.

    A coarse key (letters and digits of the consistent form, lower case) finds texts that have any partner at all. Their
    different texts are grouped, in SQL, under the accent-sensitive ``UNICODE`` collation, which also equates characters
    without a look, such as controls. The member with the smallest id is the canonical one: its id names the class, and its
    form is joined back to every member. ``form_key`` tells the exact forms of a class apart. Records of fewer than
    ``min_words`` words, null, empty and blank texts are in no class; a table without partners, or an empty one, gives no
    rows. Identical copies share a ``text_key``. Members meet their class by text and salt, so copies of one text are spread.
    """
    spark = docu.sparkSession
    # not by the form, which would be made once for the filter and once more for the key
    forms = consistent_forms(docu, id_col, text_col).filter(F.col("text").isNotNull())
    skel = F.xxhash64(F.regexp_replace(F.lower("form"), r"[^\p{L}\p{N}]+", ""))
    # the one pass over all texts; what follows touches texts that have a partner
    keyed = materialize(forms.select("id", skel.alias("skel"), F.xxhash64("text").alias("text_hash")), "skeletons")
    # keys under which at least two different texts stand: min and max of the text hash combine on the map side
    partners = (
        keyed.groupBy("skel").agg(F.min("text_hash").alias("lo"), F.max("text_hash").alias("hi"))
        .filter("lo <> hi").select("skel")
    )
    wanted = keyed.join(partners, "skel", "left_semi").distinct()
    texts = docu.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    cand = texts.join(wanted, ["id", "text_hash"]).withColumn("form", consistent("text"))
    cand = cand.select("id", "skel", F.md5("text").alias("text_key"), "form", word_count(F.col("form")).alias("words"))
    # short texts are written too: a filter on the form would be pushed below the join and make the form of every text
    cand = materialize(cand, "look-alikes").filter(F.col("words") >= min_words)
    return spark.sql(
        """
        WITH texts AS (
          SELECT skel, text_key, min(struct(id, form)) AS t FROM {cand} GROUP BY skel, text_key),
        canon AS (
          SELECT skel, t.form COLLATE UNICODE AS cls, min(t) AS c FROM texts
          GROUP BY skel, t.form COLLATE UNICODE HAVING count(*) > 1),
        classes AS (
          SELECT x.text_key, md5(x.t.form) AS form_key, c.id AS class_id, c.form AS canonical, explode(sequence(0, {salts} - 1)) AS salt
          FROM texts x JOIN canon ON x.skel = canon.skel AND x.t.form COLLATE UNICODE = canon.cls)
        SELECT m.id, m.text_key, form_key, class_id, canonical
        FROM {cand} m JOIN classes ON m.text_key = classes.text_key AND pmod(xxhash64(m.id), {salts}) = classes.salt
        """,
        cand=cand, salts=SALTS,
    )


def canonical_forms(docu: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """``id, form`` of every record: its consistent form, and for members of a class the canonical member's form.

    Null texts have a null form. Of repeated ids all rows are kept; a form is replaced only where it is the member's own.
    """
    members = lookalike_classes(docu, id_col, text_col)
    moved = members.filter(F.col("form_key") != F.md5("canonical")).select("id", "form_key", "canonical").distinct()
    moved = materialize(moved, "canonical-forms")
    few = moved.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    forms = consistent_forms(docu, id_col, text_col).select("id", "form").withColumn("form_key", F.md5("form"))
    out = forms.join(F.broadcast(moved) if few else moved, ["id", "form_key"], "left")
    return out.select("id", F.coalesce("canonical", "form").alias("form"))
