"""Tables and patterns of the SQL that checks the core queries.

They are written out here for an engine with RE2 expressions and share nothing with the functions under test.
"""

from __future__ import annotations


def quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# White space, as the contents of a character class.
BLANKS = r"\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
# Separators of tokens for language identification, in lines and in whole documents.
LINE_SEPARATORS = r"""([.,;:«»"&%=$()<>!¡?¿\[\]+#])"""
DOCUMENT_SEPARATORS = r"""([.,;:«»"&%=$()<>!¡?¿\[\]])"""
# Characters that make a lexicon entry unusable.
UNUSABLE = r"""[.,;:«»"'&%+=$()<>!¡?¿\[\]/*_{}|@#0-9\-]"""

# Tokenizer, compound marks held by private characters.
TOKENIZER = [
    (r" +$", ""),
    (r"\.\.\.", " \ue100 "), ("<<", " \ue101 "), (">>", " \ue102 "), ("''", " \ue103 "), ("``", " \ue104 "),
    (r"([0-9]+)\.([0-9]+)", "\\1\ue105\\2 "), (r"([0-9]+),([0-9]+)", "\\1\ue106\\2 "), (r"([0-9]+)'([0-9]+)", "\\1\ue107\\2 "),
    (r"""([,;«»“”'"&$#=()<>!¡?¿\\\[\]{}|^*€·¬…])""", r" \1 "),
    (r"([:/~])(?:[\t\n\f\r ]|$)", r" \1 "),
    (r"([\p{L}\p{N}_])- ", r"\1 - "), (r" -([\p{L}\p{N}_])", r" - \1"), (r"([\p{L}\p{N}_])-$", r"\1 -"), (r"^-([\p{L}\p{N}_])", r"- \1"),
    (r"\.$", " . "),
]
# Detokenizer.
DETOKENIZER = [
    (r" +$", ""),
    (r" \.\.\.", "\ue100 "), (" <<", "\ue101 "), (" >>", "\ue102 "), (" ''", "\ue103 "), (" ``", "\ue104 "),
    (r"([0-9]+)\.([0-9]+)", "\\1\ue105\\2"), (r"([0-9]+),([0-9]+)", "\\1\ue106\\2"), (r"([0-9]+)'([0-9]+)", "\\1\ue107\\2"),
    (r"I (['’]) (m|ve|d)(?:[\t\n\f\r ]|$)", r"I\1\2 "),
    (r"(You|you|They|they|We|we) (['’]) (re|ve|d)(?:[\t\n\f\r ]|$)", r"\1\2\3 "),
    (r"(She|she|He|he) (['’]) (s|ve|d)(?:[\t\n\f\r ]|$)", r"\1\2\3 "),
    (r" (['’]) s(?:[\t\n\f\r ]|$|\.)", r"\1s "), (r" (['’]) t(?:[\t\n\f\r ]|$|\.)", r"\1t "), (r" (['’]) ll(?:[\t\n\f\r ]|$|\.)", r"\1ll "),
    (r'" ([^"]+) "', r'"\1"'), (r"' ([^']+) '", r"'\1'"), (r"' ([^’]+) ’", r"'\1’"), (r"\* ([^*]+) \*", r"*\1*"),
    (r" ([‘«“(<¡¿\\\[{#*]) ", r" \1"), (r"^([‘«“(<¡¿\\\[{#*]) ", r"\1"), (r"([‘«“(<¡¿\\\[{#*])([‘«“(<¡¿\\\[{#*]) ", r"\1\2"),
    (r" ([:/~])(?:[\t\n\f\r ]|$) ", r"\1"),
    (r" ([:,;»”’&$=)>!?\]}|^€·¬…]) ", r"\1 "), (r" ([:,;»”’&$=)>!?\]}|^€·¬…])$", r"\1"),
    (r"([\p{L}\p{N}_]) - ", r"\1- "), (r" - ([\p{L}\p{N}_])", r" -\1"), (r"([\p{L}\p{N}_]) -$", r"\1-"), (r"^- ([\p{L}\p{N}_])", r"-\1"),
    (r"[\t\n\x0b\f\r ]*\.", "."),
]
_HELD = [("\ue100", "..."), ("\ue101", "<<"), ("\ue102", ">>"), ("\ue103", "''"), ("\ue104", "``"), ("\ue105", "."), ("\ue106", ","), ("\ue107", "'")]


def tokens(expr: str, steps: list[tuple[str, str]]) -> str:
    for pattern, replacement in steps:
        expr = f"regexp_replace({expr}, {quote(pattern)}, {quote(replacement)}, 'g')"
    for held, mark in _HELD:
        expr = f"replace({expr}, {quote(held)}, {quote(mark)})"
    return f"trim(regexp_replace({expr}, '[ \\t\\n\\x0b\\f\\r]+', ' ', 'g'))"


def replaced(expr: str, pairs) -> str:
    for a, b in pairs:
        expr = f"replace({expr}, {quote(a)}, {quote(b)})"
    return expr


# Tags of punctuation.
TAGS = """. Fp|, Fc|: Fd|; Fx|- Fg|-- Fg|' Fe|" Fe|`` Fe|'' Fe|... Fs|<< Fra|« Fra|>> Frc|» Frc|% Ft|/ Fh|\\ Fh|( Fpa|) Fpt|¿ Fia|? Fit|¡ Faa|! Fat|[ Fca|] Fct|{ Fla|} Flt"""


def tag_case(column: str) -> str:
    return " ".join(f"WHEN {column} = {quote(mark)} THEN {quote(tag)}" for mark, tag in (x.split(" ") for x in TAGS.split("|")))


# The upper half of the code page whose percent codes are decoded, in the order of its bytes.
_UPPER = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ" + "".join(map(chr, range(0xA0, 0x100)))
_BYTES = [b for b in range(0x80, 0x100) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)]


def percent_pairs() -> list[tuple[str, str]]:
    """Codes in the order in which they are replaced."""
    from urllib.parse import quote as coded

    several = sorted(((coded(c), c) for c in _UPPER), key=lambda x: -len(x[0]))
    single = [(f"%{b:02X}", c) for b, c in zip(_BYTES, _UPPER)]
    plain = [(f"%{b:02X}", chr(b)) for b in range(0x20, 0x7F)]
    return [*several, ("%E2%80", "›"), ("%E2%84", "™"), *single, *plain, *((f"%{b:02X}", " ") for b in range(0x20))]


# Broken letters and the letters, as one line of pairs.
BROKEN = """Ã¡ á|Ã© é|Ã_ í|Ã³ ó|Ãº ú|Ã± ñ|Ã§ ç|Ã£ ã|Ãµ õ|áº½ ẽ|Ã<81> Á|Ã<89> É|Æ' ƒ|Å' Œ|Ëœ ˜|â"¢ ™|Å¡ š|Å" œ|Â¥ ¥|Ã… Å|ÃŒ Ì|ÃŽ Î|Ã' Ò|Ãœ Ü|Ã¥ å"""


def broken_pairs(most: int = 25) -> list[tuple[str, str]]:
    return [tuple(y.replace("_", " ") for y in x.split(" ")) for x in BROKEN.split("|")][:most]


# Spelling correspondences and marks of a translation engine.
SPELLING = "ções cións|ção ción|sões sións|são sión|ões óns|ão ón|lh ll|nh ñ|ss s|j x|ge xe|gi xi|ç z|ê é|ô ó|â á|qua cua|y i"
MARK = r"\[\[(UNK|GEN_ERR|NO_TRANS)\]\][\t\n\f\r ]*(\p{L}+)"


def transliterated(expr: str) -> str:
    return f"regexp_replace({replaced(expr, (x.split(' ') for x in SPELLING.split('|')))}, 'm$', 'n')"


def marks_cleaned(expr: str) -> str:
    expr = replaced(expr, [("[[NO_TRANS]]", ""), ("[[UNK]]", ""), ("[[GEN_ERR]]", ""), ("'@", "'"), ("-@", "-"), ('"@', '"'), ("\\@", "\\\\"), ("http://@www", "http://www")])
    return f"regexp_replace(regexp_replace(regexp_replace({expr}, ' +([,.!?;:)\\]}}])', '\\1', 'g'), ' {{2,}}', ' ', 'g'), '[\\x01-\\x03]', '', 'g')"


def rules_applied(text: str, table: str = "rules", sheets: str = "'error', 'RAG_fc'") -> str:
    """A text under all word rules in order, by literal replacement between separators.

    Runs of letters and of other characters are set apart by a mark, in texts and in patterns, so that a literal that begins
    and ends with marks stands between word boundaries; it is only right for patterns whose ends are letters or digits.
    """
    apart = lambda e: f"(chr(1) || array_to_string(regexp_extract_all({e}, '[\\p{{L}}\\p{{N}}_]+|[^\\p{{L}}\\p{{N}}_]+'), chr(1)) || chr(1))"
    ruled = f"""(SELECT list(k || chr(2) || r ORDER BY g, ord, p) FROM (
        SELECT trim(pattern) AS p, {apart('trim(pattern)')} AS k, coalesce(trim(replacement), '') AS r, min(ord) AS ord, min(CASE sheet WHEN 'error' THEN 0 ELSE 1 END) AS g
        FROM {table} WHERE sheet IN ({sheets}) AND trim(pattern) <> '' GROUP BY 1, 2, 3))"""
    k, r = "split_part(x, chr(2), 1)", "split_part(x, chr(2), 2)"
    low, high = f"(chr(1) || lower({k}[2]) || {k}[3:])", f"(chr(1) || upper({k}[2]) || {k}[3:])"
    capital = f"(upper({r}[1]) || lower({r}[2:]))"
    step = f"""CASE WHEN upper({k}[2]) <> lower({k}[2]) AND starts_with({apart('a')}, {high})
                 THEN replace(replace(replace({apart('a')}, {high}, {capital}), {low}, {capital}), chr(1), '')
                 ELSE replace(replace(replace({apart('a')}, {high}, {r}), {low}, {r}), chr(1), '') END"""
    return f"list_reduce({ruled}, lambda a, x: CASE WHEN a = '' THEN '' ELSE {step} END, {text})"
