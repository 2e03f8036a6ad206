"""p5: duplicates hidden by formatting differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.plans.materialize import materialize

from .consistent import consistent, word_count

#: A name of one to three words, the first of which begins with a letter.
_NAME = r"[\p{L}_][\p{L}\p{N}_]{0,39}(?: [\p{L}\p{N}_]{1,40}){0,2}"
#: A field name and its sign: behind a separator any name, elsewhere a single word; quoted or not, then a colon or an equals
#: sign.
_FIELD = rf"(?:(?:^|[\n|;,{{\t])\s*[\"']?({_NAME})|(?<![\p{{L}}\p{{N}}])([\p{{L}}_]{{2,40}}))[\"']?\s*[:=](?!//)"
_STARTS = rf"^[^\p{{L}}\p{{N}}]*{_NAME}[\"']?\s*[:=](?!//)"
_GLUE = r"[^\p{L}\p{N}\x01\x02]+"


def layout_key(form: Column) -> Column:
    """Text that is equal for records differing in layout only.

    Letters and digits in lower case and in order. A record that begins with a field name is cut before every name; its
    fields, each still holding its value, are sorted. JSON objects go through the JSON reader first, so escapes are read.
    """
    parsed = F.from_json(F.when(form.rlike(r"^\s*\{"), form), "map<string,string>")
    as_lines = F.array_join(F.transform(F.map_entries(parsed), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\n")
    text = F.lower(F.coalesce(as_lines, form))
    cut = F.regexp_replace(F.regexp_replace(text, _FIELD, "\x01$1$2\x02"), _GLUE, "")
    fields = F.array_join(F.array_sort(F.split(cut, "\x01")), "\x01")
    return F.when(text.rlike(_STARTS), fields).otherwise(F.regexp_replace(text, r"[^\p{L}\p{N}]+", ""))


def layout_groups(docu: DataFrame, id_col: str = "id", text_col: str = "text", min_words: int = 15) -> tuple[DataFrame, DataFrame]:
    """``(keys, groups)``: ``keys`` has ``id, h1, h2, guard``, ``groups`` has ``h1, h2, guard, keep_id, n_copies``.

    The canonical text is hashed to 128 bits (``h1``, ``h2``); a third, independent hash with the length is the collision
    guard and part of the group key, so two texts that met in 128 bits would still stand apart. Counting and the smallest
    id combine on the map side: a group that holds a third of all rows sends one row per task. Records under ``min_words``
    words, null, empty and blank texts form no groups. Repeated rows count as copies; ids may repeat.
    """
    form = consistent(text_col)
    base = docu.select(F.col(id_col).alias("id"), form.alias("form")).filter(F.col("form").isNotNull())
    base = base.filter(word_count(F.col("form")) >= min_words).select("id", layout_key(F.col("form")).alias("k"))
    digest = F.md5("k")
    keys = base.select(
        "id",
        F.conv(F.substring(digest, 1, 16), 16, -10).cast("long").alias("h1"),
        F.conv(F.substring(digest, 17, 16), 16, -10).cast("long").alias("h2"),
        F.xxhash64("k", F.length("k")).alias("guard"),
    )
    keys = materialize(keys, "layout-keys")
    groups = keys.groupBy("h1", "h2", "guard").agg(F.min("id").alias("keep_id"), F.count("*").alias("n_copies"))
    return keys, groups


def layout_copies(docu: DataFrame, id_col: str = "id", text_col: str = "text", min_words: int = 15) -> DataFrame:
    """One row per surplus copy: ``keep_id, copy_id, n_copies``. See :func:`layout_groups` for the defined cases."""
    keys, groups = layout_groups(docu, id_col, text_col, min_words)
    surplus = groups.filter("n_copies > 1")
    out = keys.join(surplus, ["h1", "h2", "guard"]).filter("id <> keep_id")
    return out.select("keep_id", F.col("id").alias("copy_id"), "n_copies")
