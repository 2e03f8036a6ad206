"""Cleaning of characters: ``Column -> Column``, all in the JVM except :func:`fix_decoding`.

Null stays null and an empty text stays empty in every function.
"""

from __future__ import annotations

import html
import re
import unicodedata

import pandas as pd
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .words import WS, collapse, strip


def clamp_newlines(c: Column, most: int = 3) -> Column:
    """More than ``most`` successive newlines become ``most``."""
    return F.regexp_replace(c, "\n{%d,}" % (most + 1), "\n" * most)


def normalize_line(c: Column) -> Column:
    """Dash runs and spaced dots become blanks, blanks collapse."""
    return collapse(F.replace(F.regexp_replace(c, "--+", " "), F.lit(". . ."), F.lit(" ")))


def normalize_document(lines: Column) -> Column:
    """An array of lines as one text of normalized lines."""
    return F.array_join(F.transform(lines, normalize_line), "\n")


#: Control, format, surrogate, private-use and unassigned characters, line and paragraph separators, blanks but the space.
NON_PRINTABLE = r"[\p{Cc}\p{Cf}\p{Cs}\p{Co}\p{Cn}\p{Zl}\p{Zp}]|[\x{a0}\x{1680}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}]"


def printable(c: Column) -> Column:
    return F.regexp_replace(c, NON_PRINTABLE, "")


# What is left of letters after a wrong decoding and the letters, in the order of replacement.
LATIN1 = [
    ("Ã¡", "á"), ("Ã©", "é"), ("Ã ", "í"), ("Ã³", "ó"), ("Ãº", "ú"), ("Ã±", "ñ"), ("Ã§", "ç"), ("Ã£", "ã"), ("Ãµ", "õ"), ("áº½", "ẽ"),
    ("Ã<81>", "Á"), ("Ã<89>", "É"), ("Æ'", "ƒ"), ("Å'", "Œ"), ("Ëœ", "˜"), ('â"¢', "™"), ("Å¡", "š"), ('Å"', "œ"), ("Â¥", "¥"),
    ("Ã…", "Å"), ("ÃŒ", "Ì"), ("ÃŽ", "Î"), ("Ã'", "Ò"), ("Ãœ", "Ü"), ("Ã¥", "å"),
]
#: How many of them the alternative fixer knows.
LATIN1_SHORT = 12


def latin1_letters(c: Column, most: int = len(LATIN1)) -> Column:
    """Letters in place of what a wrong decoding left of them; only texts that hold an opening character are touched."""
    out = c
    for a, b in LATIN1[:most]:
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.when(c.rlike("[ÃáÆÅËâÂ]"), out).otherwise(c)


def alternative_fix(c: Column) -> Column:
    """The alternative fixer: controls and stray characters vanish, then the commonest broken letters are put right."""
    return latin1_letters(drop_controls(c), LATIN1_SHORT)


def drop_controls(c: Column) -> Column:
    """Alternative fixer's first step: C0 and C1 controls, non-characters and replacement marks vanish."""
    return F.regexp_replace(printable(F.regexp_replace(c, r"[\x01-\x1f\x7f-\x9f]", "")), r"[\x{fffd}\x{fffe}\x{ffff}\x{feff}\x{fffc}]", "")


def quotes_straight(c: Column, json_escaped: bool = False) -> Column:
    return F.regexp_replace(c, "[“”]", '\\\\\\\\"' if json_escaped else '"')


def hard_blanks(c: Column) -> Column:
    return F.translate(c, " ", " ")


def drop_replacement(c: Column) -> Column:
    """Replacement character and one private-use character become a blank."""
    return F.translate(c, "�", "  ")


def control_pictures(c: Column) -> Column:
    """Pictures of control characters: those of line ends become newlines, that of an enquiry ``?``, others a blank."""
    blanks = "".join(chr(cp) for cp in range(0x2400, 0x2422) if cp not in (0x2405, 0x240A))
    return F.translate(c, blanks + "␅␤␊", " " * len(blanks) + "?\n\n")


CATEGORIES = "Lu Ll Lt Lm Lo Mn Mc Me Nd Nl No Pc Pd Ps Pe Pi Pf Po Sm Sc Sk So Zs Zl Zp Cc Cf Cs Co Cn".split()
#: Emoji blocks, for engines without an emoji property.
EMOJI = r"\x{2600}-\x{27bf}\x{1f300}-\x{1f64f}\x{1f680}-\x{1f6ff}\x{1f900}-\x{1f9ff}\x{1fa70}-\x{1faff}\x{1f1e6}-\x{1f1ff}\x{fe0f}\x{200d}"


def keep_categories(c: Column, categories: str = "", characters: str = "", remove: str = "", emojis: bool = False) -> Column:
    """Characters outside the named categories become blanks, but for ``characters`` and, on request, emoji; characters of
    ``remove`` always do. No categories means all."""
    kept = "".join(rf"\p{{{k}}}" for k in (categories.split() or CATEGORIES))
    quoted = "".join(rf"\x{{{ord(x):x}}}" for x in characters)
    out = F.regexp_replace(c, f"[^{kept}{quoted}{EMOJI if emojis else ''}]", " ")
    gone = "".join(rf"\x{{{ord(x):x}}}" for x in remove)
    return F.regexp_replace(out, f"[{gone}]", " ") if gone else out


def percent_table(table: str = "utf8") -> list[tuple[str, str]]:
    """Percent codes and their characters in the order in which they are replaced, made from the code pages themselves.

    ``ascii``: printable ASCII; ``utf8``: two- and three-byte codes of the code page's upper half, and after them the first two
    bytes of three alone, which stand for the last of them; ``windows``: its single bytes; ``control``: control bytes, which
    become blanks.
    """
    if table == "ascii":
        return [(f"%{b:02X}", chr(b)) for b in range(0x20, 0x7F)]
    if table == "control":
        return [(f"%{b:02X}", " ") for b in range(0x20)]
    upper = [(b, bytes([b]).decode("cp1252", "ignore")) for b in range(0x80, 0x100)]
    if table == "windows":
        return [(f"%{b:02X}", ch) for b, ch in upper if ch]
    codes = [("".join(f"%{x:02X}" for x in ch.encode()), ch) for _, ch in upper if ch]
    return codes + [("%E2%80", "›"), ("%E2%84", "™")]


def _percent_steps():
    """The tables in order, each as one pass; the ASCII table in three, since ``%25`` opens what follows it."""
    steps = []
    ascii_codes = percent_table("ascii")
    parts = [ascii_codes[:5], ascii_codes[5:6], ascii_codes[6:]]
    for table in (percent_table("utf8"), percent_table("windows"), *parts, percent_table("control")):
        codes = dict(table)
        pattern = re.compile("|".join(sorted(map(re.escape, codes), key=len, reverse=True)))
        steps.append((pattern, codes))
    return steps


def percent_decode_text(text: str, steps=None) -> str:
    for pattern, codes in steps or _percent_steps():
        text = pattern.sub(lambda m: codes[m[0]], text)
    return text


def _percent_series(s: pd.Series) -> pd.Series:
    steps = _percent_steps()
    return s.map(lambda t: percent_decode_text(t, steps), na_action="ignore")


def percent_decode(c: Column) -> Column:
    """Percent codes as characters, table after table: multi-byte codes, upper bytes, ASCII, controls (as a blank).

    Codes are case-sensitive; what ``%25`` opens is decoded too where its code follows ``%25`` in the table. Only rows that
    hold a code leave the JVM.
    """
    udf = F.pandas_udf(_percent_series, StringType())
    return F.coalesce(udf(F.when(c.rlike("%[0-9A-F]{2}"), c)), c)


_LITERAL = re.compile(r"\\x([0-9a-fA-F]{2})|\\u([0-9a-fA-F]{4})")
_TAGGED = re.compile("<")
_WIDTH = {cp: unicodedata.normalize("NFKC", chr(cp)) for cp in [*range(0xFF01, 0xFF5F), *range(0xFB00, 0xFB07), 0x3000]}
_QUOTES = {0x2018: "'", 0x2019: "'", 0x201A: "'", 0x201B: "'", 0x201C: '"', 0x201D: '"', 0x201E: '"', 0x201F: '"', 0x02BC: "'"}
_SLOPPY = {chr(b): b for b in range(0x80, 0xA0)}


def _bytes_of(text: str) -> bytes:
    """Windows-1252 bytes, with the bytes that page leaves free as themselves."""
    out = bytearray()
    for ch in text:
        try:
            out += ch.encode("cp1252")
        except UnicodeEncodeError:
            out.append(_SLOPPY[ch])
    return bytes(out)


_MOJIBAKE = re.compile("[Â-ô][\u0080-¿ŒœŠšŸŽžƒˆ˜–—‘’‚“”„†‡•…‰‹›€™]{1,3}")


def _undo(m: re.Match) -> str:
    try:
        return _bytes_of(m[0]).decode("utf-8")
    except (UnicodeError, KeyError):
        return m[0]


def fix_decoding_text(text: str) -> str:
    """Undo UTF-8 read as Windows-1252 (repeatedly), entities in texts without mark-up, literal ``\\x`` and ``\\u`` codes;
    straighten quotes, split ligatures, narrow wide letters, compose accents, unify line ends."""
    text = _LITERAL.sub(lambda m: chr(int(m[1] or m[2], 16)), text)
    text = "".join(c for c in text if not 0xD800 <= ord(c) <= 0xDFFF)
    if "&" in text and not _TAGGED.search(text):
        text = html.unescape(text)
    for _ in range(4):
        new = _MOJIBAKE.sub(_undo, text)
        if new == text:
            break
        text = new
    text = text.translate(_QUOTES).translate(_WIDTH).replace("\r\n", "\n").replace("\r", "\n")
    return unicodedata.normalize("NFC", text)


def _fix_series(s: pd.Series) -> pd.Series:
    return s.map(fix_decoding_text, na_action="ignore")


#: Texts that :func:`fix_decoding_text` can change at all.
_MAY_CHANGE = r"[^\x00-\x{24f}–—…]|[\x80-\x9f\r&]|\\[xu][0-9a-fA-F]|[Â-ô][\x80-\x{bf}]|[\x{300}-\x{36f}]"


def fix_decoding(c: Column) -> Column:
    """:func:`fix_decoding_text` in Arrow batches, for the rows that can change only."""
    udf = F.pandas_udf(_fix_series, StringType())
    return F.coalesce(udf(F.when(c.rlike(_MAY_CHANGE), c)), c)


def invalid_bytes(raw: Column) -> Column:
    """Text of a binary column without the bytes that are no UTF-8."""
    udf = F.pandas_udf(lambda s: s.map(lambda b: bytes(b).decode("utf-8", "ignore"), na_action="ignore"), StringType())
    return F.when(F.is_valid_utf8(raw.cast("string")), raw.cast("string")).otherwise(udf(raw))


def remove_tags(c: Column) -> Column:
    """HTML comments, scripts, styles and tags become blanks, then entities are read."""
    bare = F.regexp_replace(c, r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>|</?[a-z][^<>]*>", " ")
    udf = F.pandas_udf(lambda s: s.map(html.unescape, na_action="ignore"), StringType())
    return F.coalesce(udf(F.when(bare.contains("&"), bare)), bare)


def delimiter(escaped: str) -> str:
    r"""A delimiter as it is typed on a command line: ``\n`` is a line feed, ``\t`` a tab, ``\u00e1`` a letter."""
    return re.sub(r"\\(?:x[0-9a-fA-F]{2}|u[0-9a-fA-F]{4}|[abfnrtv0'\"\\])", lambda m: m[0].encode().decode("unicode_escape"), escaped)


def encode_fix(c: Column, categories: str = "", characters: str = "", remove: str = "", emojis: bool = False, json_escaped: bool = False, keep_breaks: bool = True) -> Column:
    """The whole encoding fixer, in order: decoding repair, hard blanks, non-printables, broken letters, percent codes,
    replacement marks, control pictures, category filter, blanks. The result has no line ends.

    Line ends and tabs inside a text become blanks; without ``keep_breaks`` they vanish with the other non-printables, as they
    do where every line is fixed by itself. Repair and percent codes run in one Arrow pass, for the texts that need either.
    """
    c = quotes_straight(c, json_escaped)
    if keep_breaks:
        # they must outlive the Arrow pass, which ends where line ends would go
        c = F.regexp_replace(c, r"[\n\r\t]", " ")
    udf = F.pandas_udf(_repair_series, StringType())
    c = F.coalesce(udf(F.when(c.rlike(_MAY_CHANGE + "|%[0-9A-F]{2}|[ÃáÆÅËâÂ]"), c)), printable(hard_blanks(c)))
    c = drop_replacement(c)
    c = keep_categories(control_pictures(c), categories, characters, remove, emojis) if categories or characters or remove else control_pictures(c)
    return strip(F.regexp_replace(c, f"[{WS}]+", " "))


_PRINTABLE = regex.compile(r"[\p{Cc}\p{Cf}\p{Cs}\p{Co}\p{Cn}\p{Zl}\p{Zp}]|[\u00a0\u1680\u2000-\u200a\u202f\u205f\u3000]")


def repair_text(text: str, steps=None) -> str:
    """Decoding repair, hard blanks, non-printables, broken letters and percent codes of one text."""
    text = _PRINTABLE.sub("", fix_decoding_text(text).replace("\xa0", " "))
    for a, b in LATIN1:
        if a in text:
            text = text.replace(a, b)
    return percent_decode_text(text, steps)


def _repair_series(s: pd.Series) -> pd.Series:
    steps = _percent_steps()
    return s.map(lambda t: repair_text(t, steps), na_action="ignore")
