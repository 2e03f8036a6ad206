"""Word, blank and line functions: ``Column -> Column``. Null in, null out; an empty text has no words and one line."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as a character class body: Unicode blanks, line ends and the four information separators.
WS = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
# Characters that separate tokens for language identification; the document variant lacks the last two.
SEPARATORS = ".,;:«»\"&%=$()<>!¡?¿[]+#"
_CLASS = "[" + "".join("\\" + c if c in "[]" else c for c in SEPARATORS) + "]"
_CLASS_DOCUMENT = "[" + "".join("\\" + c if c in "[]" else c for c in SEPARATORS[:-2]) + "]"


#: One range that holds every blank beyond ASCII's six, and more: texts without it take the engine's short class.
_UNUSUAL = r"[\x1c-\x1f\x{85}\x{a0}\x{1680}-\x{3000}]"


def _by_blanks(c: Column, function) -> Column:
    return F.when(c.rlike(_UNUSUAL), function(f"[{WS}]", f"[^{WS}]")).otherwise(function(r"\s", r"\S"))


def _once(c: Column, function) -> Column:
    """``function(c)`` with ``c`` evaluated once, however often the function names it."""
    return F.get(F.transform(F.array(c), function), F.lit(0))


def word_count(c: Column) -> Column:
    """Runs of non-blank characters."""
    return F.array_size(words(c))


def words(c: Column) -> Column:
    """Cut at blanks: the engine's expressions that extract or count all matches copy the whole text for each match."""
    return _once(c, lambda x: _by_blanks(x, lambda s, w: F.array_remove(F.split(x, f"{s}+"), "")))


def strip(c: Column) -> Column:
    """Without white space at either end (``trim`` knows the blank only)."""
    return _by_blanks(c, lambda s, w: F.regexp_replace(c, rf"^{s}+|{s}+\z", ""))


def collapse(c: Column) -> Column:
    """White space runs become one blank, none at the ends."""
    return _once(c, lambda x: _by_blanks(x, lambda s, w: F.trim(F.regexp_replace(x, f"{s}+", " "))))


def line_count(c: Column) -> Column:
    return F.size(F.split(c, "\n"))


def same_language(a: Column, b: Column) -> Column:
    return F.lower(strip(a)) == F.lower(strip(b))


def join_acronyms(c: Column) -> Column:
    """``A.B`` becomes ``AB``."""
    return F.regexp_replace(c, r"([A-Z])\.([A-Z])", "$1$2")


def space_separators(c: Column, document: bool = False) -> Column:
    """A blank on both sides of each separator character."""
    return F.regexp_replace(c, f"({_CLASS_DOCUMENT if document else _CLASS})", " $1 ")


def language_tokens(c: Column, document: bool = False) -> Column:
    """Lower-case tokens with separators split off and left out; the document variant joins acronyms first, splits at two
    separators less and leaves out tokens that hold one of these.

    Tokens are the runs between blanks and separators, so one expression finds them.
    """
    text = F.lower(join_acronyms(c) if document else c)
    apart = (_CLASS_DOCUMENT if document else _CLASS)[1:-1]
    found = _once(text, lambda x: _by_blanks(x, lambda s, w: F.array_remove(F.split(x, f"[{s[1:-1] if s.startswith('[') else s}{apart}]+"), "")))
    return F.filter(found, lambda t: ~t.rlike(_CLASS)) if document else found


# Part-of-speech tags of punctuation.
PUNCTUATION_TAGS = {
    ".": "Fp", ",": "Fc", ":": "Fd", ";": "Fx", "-": "Fg", "--": "Fg", "'": "Fe", '"': "Fe", "``": "Fe", "''": "Fe",
    "...": "Fs", "<<": "Fra", "«": "Fra", ">>": "Frc", "»": "Frc", "%": "Ft", "/": "Fh", "\\": "Fh", "(": "Fpa", ")": "Fpt",
    "¿": "Fia", "?": "Fit", "¡": "Faa", "!": "Fat", "[": "Fca", "]": "Fct", "{": "Fla", "}": "Flt",
}


def punctuation_tag(c: Column) -> Column:
    """Tag of a punctuation token, the empty text for others; opening and closing quotes may be followed by more."""
    exact = F.create_map(*(F.lit(x) for pair in PUNCTUATION_TAGS.items() for x in pair))[c]
    return F.when(c.isNull(), c).otherwise(F.coalesce(exact, F.when(c.rlike("^(<<|«)"), "Fra"), F.when(c.rlike("^(>>|»)"), "Frc"), F.lit("")))


# Capital accented letters and their small forms.
_ACCENTED = ("ÁÉÍÓÚÀÈÌÒÙÂÊÎÔÛÑÇÜ", "áéíóúàèìòùâêîôûñçü")


def lower_accented(c: Column) -> Column:
    """Lower case of ASCII and the accented letters of the tokenizer; other letters stay."""
    ascii_upper = "".join(map(chr, range(65, 91)))
    return F.translate(c, ascii_upper + _ACCENTED[0], ascii_upper.lower() + _ACCENTED[1])


def trim_end(c: Column) -> Column:
    """Without blanks at the beginning and without one white space character at the end."""
    return F.regexp_replace(F.ltrim(c), r"\s$", "")


def lines_ended(c: Column) -> Column:
    """CRLF becomes LF."""
    return F.regexp_replace(c, "\r\n", "\n")
