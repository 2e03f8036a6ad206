"""SQL that checks queries of this subpackage, for an engine with RE2 expressions.

Word lists and rules are written out here; only the fixed table of look-alike letters is the operators' own.
"""

from __future__ import annotations

import sys
import unicodedata

from .consistent import LOOKALIKES


def _quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _consistent(column: str) -> str:
    """The consistent form: composed, characters replaced by the plain ones they stand for, composed again."""
    one, gone, several = dict(LOOKALIKES), "", {}
    for cp in range(0xA0, sys.maxunicode):
        c = chr(cp)
        kind, how = unicodedata.category(c), unicodedata.decomposition(c).partition(">")[0]
        if c in one or kind in ("Co", "Cn", "Cs"):
            continue
        if kind in ("Zs", "Zl", "Zp"):
            one[c] = " "
        elif kind == "Cf" or "VARIATION SELECTOR" in unicodedata.name(c, "") or c in "͏ᅟᅠㅤﾠ":
            gone += c
        elif how in ("<wide", "<narrow", "<font", "<circle") or 0xFB00 <= cp < 0xFB07:
            plain = "".join(LOOKALIKES.get(x, x) for x in unicodedata.normalize("NFKC", c))
            (several if len(plain) > 1 else one)[c] = plain
    expr = f"nfc_normalize({column})"
    # of the rest only what texts hold in practice: ligatures and numbers in circles
    for c, plain in several.items():
        if c < "　" or 0xFB00 <= ord(c) < 0xFB07:
            expr = f"replace({expr}, {_quote(c)}, {_quote(plain)})"
    return f"nfc_normalize(translate({expr}, {_quote(''.join(one) + gone)}, {_quote(''.join(one.values()))}))"


_WORDS = "regexp_extract_all({0}, '[\\p{{L}}\\p{{N}}]+')"
_FORMS = f"forms AS (SELECT id, text, {_consistent('text')} AS form FROM docu)"
_FOLDED = _WORDS.format("strip_accents(lower(regexp_replace(nfc_normalize(text), '\\p{Cf}|\\p{M}', '', 'g')))")


def _windows(table: str, key: str) -> str:
    return f"SELECT DISTINCT {key}, list_slice(w, p, p + 7) AS g FROM (SELECT {key}, {_FOLDED} AS w FROM {table} WHERE text IS NOT NULL), LATERAL (SELECT unnest(range(1, len(w) - 6)) AS p)"


ORACLE: dict[str, str] = {
    "p4_found": f"""WITH {_FORMS}, w AS (SELECT id, {_WORDS.format('lower(form)')} AS w FROM forms WHERE form IS NOT NULL),
        s AS (SELECT id, list_distinct(w) AS s FROM w WHERE len(w) >= 15)
        SELECT a.id AS id_a, b.id AS id_b FROM s a JOIN s b ON a.id < b.id AND len(a.s) >= 0.8 * len(b.s) AND len(b.s) >= 0.8 * len(a.s)
        WHERE 1.8 * len(list_intersect(a.s, b.s)) >= 0.8 * (len(a.s) + len(b.s)) - 1e-9""",
    "p6_found": f"""WITH {_FORMS}, f AS (SELECT id, text, form FROM forms WHERE len({_WORDS.format('form')}) >= 15)
        SELECT a.id AS id_a, b.id AS id_b FROM f a JOIN f b ON a.form = b.form AND a.id < b.id AND a.text <> b.text""",
    "p6_forms": f"WITH {_FORMS} SELECT id, form FROM forms",
    "p7_texts": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
    "p8_found": f"SELECT DISTINCT d.doc_id, b.item_id FROM ({_windows('documents', 'doc_id')}) d JOIN ({_windows('benchmark', 'item_id')}) b USING (g)",
}
