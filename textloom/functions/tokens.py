"""Tokenizer and detokenizer as chains of JVM regular expressions.

Protected marks are held by private-use characters, so digits around them cannot be taken for numbers again.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Punctuation classes.
SPLIT_MARKS = r"[,;«»“”'\"&$#=()<>!¡?¿\\\[\]{}|^*€·¬…]"
OPEN_MARKS = r"[‘«“(<¡¿\\\[{#*]"
CLOSE_MARKS = r"[:,;»”’&$=)>!?\]}|^€·¬…]"
URL_MARKS = r"[:/~]"
# Compound marks and number separators, in the order of their placeholders.
COMPOUND = ["...", "<<", ">>", "''", "``"]
NUMERIC = [".", ",", "'"]
_HOLD = [chr(0xE000 + k) for k in range(len(COMPOUND) + len(NUMERIC))]
_WORD = r"[\p{L}\p{N}_]"

# The rules of both directions, ``(pattern, replacement)``, in the order in which they apply.
TOKENIZE = [
    (r" +\z", ""),
    *((c.replace(".", r"\."), f" {h} ") for c, h in zip(COMPOUND, _HOLD)),
    *((rf"([0-9]+){n.replace('.', chr(92) + '.')}([0-9]+)", f"$1{h}$2 ") for n, h in zip(NUMERIC, _HOLD[len(COMPOUND) :])),
    (f"({SPLIT_MARKS})", " $1 "),
    (rf"({URL_MARKS})(?:\s|\z)", " $1 "),
    (f"({_WORD})- ", "$1 - "),
    (f" -({_WORD})", " - $1"),
    (rf"({_WORD})-\z", "$1 -"),
    (f"^-({_WORD})", "- $1"),
    (r"\.\z", " . "),
]
DETOKENIZE = [
    (r" +\z", ""),
    (r" \.\.\.", f"{_HOLD[0]} "),
    *((" " + c, f"{h} ") for c, h in list(zip(COMPOUND, _HOLD))[1:]),
    *((rf"([0-9]+){n.replace('.', chr(92) + '.')}([0-9]+)", f"$1{h}$2") for n, h in zip(NUMERIC, _HOLD[len(COMPOUND) :])),
    (r"I (['’]) (m|ve|d)(?:\s|\z)", "I$1$2 "),
    (r"([yY]ou|[tT]hey|[wW]e) (['’]) (re|ve|d)(?:\s|\z)", "$1$2$3 "),
    (r"([sS]he|[hH]e) (['’]) (s|ve|d)(?:\s|\z)", "$1$2$3 "),
    (r" (['’]) s(?:\s|\z|\.)", "$1s "),
    (r" (['’]) t(?:\s|\z|\.)", "$1t "),
    (r" (['’]) ll(?:\s|\z|\.)", "$1ll "),
    (r'" ([^"]+) "', '"$1"'),
    (r"' ([^']+) '", "'$1'"),
    (r"' ([^’]+) ’", "'$1’"),
    (r"\* ([^*]+) \*", "*$1*"),
    (f" ({OPEN_MARKS}) ", " $1"),
    (f"^({OPEN_MARKS}) ", "$1"),
    (f"({OPEN_MARKS})({OPEN_MARKS}) ", "$1$2"),
    (rf" ({URL_MARKS})(?:\s|\z) ", "$1"),
    (f" ({CLOSE_MARKS}) ", "$1 "),
    (rf" ({CLOSE_MARKS})\z", "$1"),
    (f"({_WORD}) - ", "$1- "),
    (f" - ({_WORD})", " -$1"),
    (rf"({_WORD}) -\z", "$1-"),
    (f"^- ({_WORD})", "-$1"),
    (r"\s*\.", "."),
]


def _apply(c: Column, steps) -> Column:
    for pattern, replacement in steps:
        c = F.regexp_replace(c, pattern, replacement)
    for held, mark in zip(_HOLD, COMPOUND + NUMERIC):
        c = F.replace(c, F.lit(held), F.lit(mark))
    return F.trim(F.regexp_replace(c, r"[ \t\n\x0b\f\r]+", " "))


def tokenize(line: Column) -> Column:
    """Tokens of one line, joined by blanks. Null stays null, a blank line gives an empty text."""
    return _apply(line, TOKENIZE)


def detokenize(line: Column) -> Column:
    """One line of tokens as running text; not an exact inverse of :func:`tokenize`."""
    return _apply(line, DETOKENIZE)


def each_line(text: Column, function) -> Column:
    """Apply a line function to every line of a text."""
    return F.array_join(F.transform(F.split(text, "\n"), function), "\n")
