"""p3: text that went through a wrong character encoding.

An unknown swap of code pages is a substitution cipher: every accented letter became a unit of one or more odd characters.
Records fall into sources by the kind of their odd characters. Over all records the contexts of each source's units (letters
before, unit, letters after) are counted with map-side combining. The driver reads the letter trigrams only, which the
alphabet bounds; expectation-maximization against them then learns on the executors, unit by unit over all its contexts,
which letter each unit stands for, with two more readings that leave text as it is: a sign between words, and the plain
letter a look-alike stands for. Units whose contexts speak clearly for a letter make up the source's cipher; a record that
holds one is affected.

What is learned unit by unit knows neither capitals nor rare letters, so a record's cipher is then completed as a whole: of
the swaps between public code pages, all made from the code pages themselves, the one under which the record's letters are
likeliest among their neighbours replaces all its units, with ``translate`` for single characters and repeatedly for texts
swapped more than once. Where none fits, the learned letters are put in one by one.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.plans.materialize import materialize

from .consistent import LOOKALIKES, mapping

#: Contexts of a unit that are weighed at once; more are taken block by block.
BLOCK = 50_000
#: Log-likelihood by which a unit's contexts must favour a letter over text as it is.
EVIDENCE = 6.0
#: Occurrences below which a unit is not learned by itself; swaps of whole code pages restore it all the same.
LEAST_TIMES = 3
#: Share of the gain of letters learned unit by unit that a swap of code pages must reach to take their place.
OWN_SHARE = 0.7
#: Steps of likelihood that a Python worker remembers (about 200 bytes each).
REMEMBERED_STEPS = 100_000
_NATIVE = "áéíóúñçãõâêôàèùîïëûüœÁÉÍÓÚÑÇÃÕÂÊÔÀÈÙÎÏËÛÜŒ"
_LETTERS = "abcdefghijklmnopqrstuvwxyz" + "áéíóúñçãõâêôàèùîïëûüœ"
_INDEX = {c: k for k, c in enumerate(_LETTERS)}
_EDGE = len(_LETTERS)
_SIZE = _EDGE + 1
_LOST = "�"

_UPPER = "ÁÉÍÓÚÑÇÃÕÂÊÔÀÈÙÎÏËÛÜŒ"
_ODD_CHAR = rf"[^\x00-\x7f{_NATIVE}]"
#: A run of odd characters with the accented letters that open its parts, or an accented capital inside a small word.
_UNIT = re.compile(rf"(?:[ÃÂÅÄãâåä]?{_ODD_CHAR}+)+|(?<=[a-z])[{_UPPER}](?![A-Z{_UPPER}])")
_HAS_ODD = re.compile(rf"{_ODD_CHAR}|[a-z][{_UPPER}]")
_WORD = re.compile(rf"[a-zA-Z{_NATIVE}]+")
#: Signs that may touch a word from outside.
_EDGE_SIGNS = frozenset("¿¡«»“”‘’‚„…–—•·°ºª€£¥§¬¦©®™★→½¼¾¹²³×÷")
_CYRILLIC = {ord(c): x for c, x in LOOKALIKES.items() if "\u0400" <= c <= "\u052f"}
_GREEK_ALIKE = {ord(c): x for c, x in LOOKALIKES.items() if "\u0370" <= c <= "\u03ff" and (c.isupper() or c == "ο")}
_CONTROL = re.compile("[␀-␦]")
_INVISIBLE = re.compile("[\u200b-\u200d\u2060\ufeff]")
_FOREIGN = re.compile(r"[\u0370-\u052f\u0590-\u08ff\u0900-\u0dff\u3040-\ud7ff]+")


class _Prepare:
    """Removes what p6 describes, so that only possible garbling stays odd."""

    def __init__(self):
        table = {cp: s for cp, s in mapping().items() if chr(cp) not in LOOKALIKES and cp > 0xFF}
        self.table = table | _GREEK_ALIKE

    def __call__(self, text: str) -> str:
        noisy = _INVISIBLE.search(text) is not None
        text = text.translate(self.table)
        # soft hyphens and hard blanks are garbling only after a character that opens a unit
        if "\xad" in text:
            # beside other invisible characters a soft hyphen is one of them
            text = text.replace("\xad", "") if noisy else re.sub(r"(?<![ÃÂãâГ])\xad", "", text)
        if "\xa0" in text:
            text = re.sub(r"(?<![ÃÂãâГ])\xa0", " ", text)
        return unicodedata.normalize("NFC", text)


def contexts(text: str) -> list[tuple[int, int, str, str]]:
    """``(begin, end, two letters before, two after)`` of every unit that stands in a word, or as one."""
    out = []
    for m in _UNIT.finditer(text):
        a, b = m.span()
        before = "".join(c if c.isalpha() else " " for c in text[max(0, a - 2) : a].lower())
        after = "".join(c if c.isalpha() else " " for c in text[b : b + 2].lower())
        p, n = before.rpartition(" ")[2], after.partition(" ")[0]
        unit = text[a:b]
        # words of another script, whole or behind a look-alike capital
        if _FOREIGN.fullmatch(unit) and (len(unit) > 2 or not p and not n and len(unit) > 1):
            continue
        if len(unit) == 1 and unit in _EDGE_SIGNS and not (p and n):
            continue
        if not p and not n and (len(unit) < 2 or unit[0] in _EDGE_SIGNS or _CONTROL.search(unit)):
            continue
        out.append((a, b, p, n))
    return out


def source_of(text: str, found) -> str:
    """Kind of the odd characters inside words: C, B, G or L."""
    chars = "".join(text[a:b] for a, b, p, n in found if p or n)
    if any("\u0400" <= c <= "\u052f" and c not in LOOKALIKES for c in chars):
        return "C"
    if any("\u2190" <= c <= "\u25ff" for c in chars):
        return "B"
    if any("\u0370" <= c <= "\u03ff" for c in chars):
        return "G"
    return "L"


def _reading(prepare: _Prepare, text: str):
    """``(prepared text, units, source)``; without units when odd characters make up too much to be letters."""
    own = prepare(text)
    found = contexts(own)
    source = source_of(own, found)
    if source != "C" and any("\u0400" <= c <= "\u052f" for c in own):
        own = own.translate(_CYRILLIC)
        found = contexts(own)
        source = source_of(own, found)
    odd = sum(b - a for a, b, _, _ in found)
    if odd * 10 > 4 * len(own) or len(_CONTROL.findall(own)) * 20 > len(own):
        found = []
    return own, found, source


def _around(p: str, n: str) -> tuple[int, int, int, int]:
    """Numbers of the two letters before and the two after a unit."""
    p2, p1 = ([_EDGE, _EDGE] + [_INDEX.get(c, _EDGE) for c in p])[-2:]
    n1, n2 = ([_INDEX.get(c, _EDGE) for c in n] + [_EDGE, _EDGE])[:2]
    return p2, p1, n1, n2


def _code(letters) -> int:
    code = 0
    for k in letters:
        code = code * _SIZE + k
    return code


def _count_stage(batches):
    """``source, unit, code, times, inside``: contexts of units, and under the source '' the letter trigrams."""
    prepare = _Prepare()
    for b in batches:
        words: Counter = Counter()
        seen: Counter = Counter()
        for t in b.column(0).to_pylist():
            if not t:
                continue
            if _HAS_ODD.search(t):
                own, found, source = _reading(prepare, t)
                for a, e, p, n in found:
                    if _LOST not in own[a:e]:
                        seen[source, own[a:e], p, n] += 1
            else:
                words.update(_WORD.findall(t))
        grams: Counter = Counter()
        for w, times in words.items():
            w = "^^" + w.lower() + "$$"
            for k in range(len(w) - 2):
                grams[w[k : k + 3]] += times
        rows = [(source, unit, _code(_around(p, n)), times, times if p or n else 0) for (source, unit, p, n), times in seen.items()]
        rows += [("", "", _code(_INDEX.get(c, _EDGE) for c in g), times, 0) for g, times in grams.items()]
        cols = list(zip(*rows)) if rows else [[]] * 5
        kinds = (pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, x) for c, x in zip(cols, kinds)], names=["source", "unit", "code", "times", "inside"])


def _groups(batches):
    """``(source, unit), [codes, times, inside]`` of each unit in rows sorted by source and unit."""
    key, held = None, []
    for b in batches:
        keys = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        numbers = np.stack([b.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (2, 3, 4)])
        starts = [k for k in range(len(keys)) if k == 0 or keys[k] != keys[k - 1]]
        for a, e in zip(starts, [*starts[1:], len(keys)]):
            if keys[a] != key:
                if held:
                    yield key, np.concatenate(held, 1)
                key, held = keys[a], []
            held.append(numbers[:, a:e])
    if held:
        yield key, np.concatenate(held, 1)


class Ciphers:
    """``theta[source][unit]``: probabilities of the letters a unit stands for, last the text as it is."""

    def __init__(self, grams):
        count = np.zeros(_SIZE**3)
        for code, times in grams:
            count[code] += times
        count = count.reshape(_SIZE, _SIZE, _SIZE)
        two = count.sum(0) + 0.05
        one = two.sum(0)
        back = two / two.sum(1, keepdims=True)
        self.go = (count + 3 * back[None]) / (count.sum(2, keepdims=True) + 3)
        self.letter = one / one.sum()
        self.accented = np.array([not c.isascii() for c in _LETTERS])
        self.theta: dict[str, dict[str, np.ndarray]] = {}
        self.steps: dict[tuple, float] = {}

    def likelihood(self, unit: str, p: str, n: str) -> np.ndarray:
        """Of the letters around a unit under each letter, and last under the text as it is."""
        p2, p1, n1, n2 = _around(p, n)
        m = _EDGE
        under = self.go[p2, p1, :m] * self.go[p1, :m, n1] * self.go[:m, n1, n2]
        sign = self.go[p2, p1, m] * self.go[m, m, n1] * self.go[m, n1, n2]
        plain = self._same(unit)
        if plain is not None:
            sign = max(sign, under[plain])
        return np.append(under * self.accented, sign)

    def step(self, unit: str, letter: str, p: str, n: str) -> float:
        """How much likelier a letter is in the place of a unit than the unit itself, as a bounded logarithm; remembered."""
        key = (unit, letter, p, n)
        found = self.steps.get(key)
        if found is None:
            if len(self.steps) >= REMEMBERED_STEPS:
                self.steps.clear()
            x = self.likelihood(unit, p, n)
            same = x[_EDGE] if unit.lower() not in _INDEX else max(x[_EDGE], x[_INDEX[unit.lower()]])
            own = x[_INDEX[letter]] if letter in _INDEX else x[_EDGE]
            found = self.steps[key] = min(3.0, max(-4.0, math.log(own + 1e-12) - math.log(same + 1e-12)))
        return found

    def likelihoods(self, unit: str, codes: np.ndarray) -> np.ndarray:
        """:meth:`likelihood` of many contexts, one row each."""
        rest, n2 = np.divmod(codes, _SIZE)
        rest, n1 = np.divmod(rest, _SIZE)
        p2, p1 = np.divmod(rest, _SIZE)
        m = _EDGE
        under = self.go[p2, p1, :m] * self.go[p1, :m, n1] * self.go[:m, n1, n2].T
        sign = self.go[p2, p1, m] * self.go[m, m, n1] * self.go[m, n1, n2]
        plain = self._same(unit)
        if plain is not None:
            sign = np.maximum(sign, under[:, plain])
        return np.column_stack([under * self.accented, sign])

    def learn(self, unit: str, codes: np.ndarray, times: np.ndarray, inside: int) -> np.ndarray | None:
        """``theta`` of a unit from all its contexts, or None where they do not speak clearly for a letter."""
        w = times.astype(float)
        if inside == 0 or w.sum() < LEAST_TIMES:
            return None
        cuts = [slice(k, k + BLOCK) for k in range(0, len(w), BLOCK)]
        kept = self.likelihoods(unit, codes) if len(cuts) == 1 else None

        def blocks():
            return ((self.likelihoods(unit, codes[c]) if kept is None else kept, w[c]) for c in cuts)

        theta = np.where(self.accented, self.letter[:_EDGE] + 1e-5, 0)
        theta = np.append(theta / theta.sum() * 0.5, 0.5)
        for _ in range(25):
            theta = theta * sum((x / (keep @ theta)) @ keep for keep, x in blocks()) + 1e-3
            theta /= theta.sum()
        if theta[_EDGE] >= 0.5:
            return None
        letters = theta[:_EDGE] / max(theta[:_EDGE].sum(), 1e-9)
        gain = sum((np.clip(np.log(keep[:, :_EDGE] @ letters + 1e-12) - np.log(keep[:, _EDGE] + 1e-12), -4, 3) * x).sum() for keep, x in blocks())
        return theta if gain > EVIDENCE else None

    def decode(self, source: str, unit: str, p: str, n: str) -> str | None:
        """The letters of a unit in its place, or None where it stays."""
        table = self.theta.get(source, {})
        # a run of several learned units
        for k in range(len(unit) - 1, 0, -1):
            if unit[:k] in table and (min(k, len(unit) - k) > 1 or unit[:k] != "√" and (len(unit) == 2 or unit not in table)):
                first = self.decode(source, unit[:k], p, "")
                rest = self.decode(source, unit[k:], (p + (first or ""))[-2:], n) if first else None
                if first and rest:
                    return first + rest
        theta = table.get(unit)
        if theta is None:
            return None
        best = int((self.likelihood(unit, p, n) * theta).argmax())
        return None if best == _EDGE else _LETTERS[best]

    @staticmethod
    def _same(unit: str) -> int | None:
        """The plain letter that the unit is a form of: a look-alike's letter or a letter without its mark."""
        if len(unit) != 1 or not unit.isalpha():
            return None
        base = LOOKALIKES.get(unit) or unicodedata.normalize("NFD", unit)[0]
        return _INDEX.get({"ł": "l", "ø": "o", "æ": "a", "ß": "s", "đ": "d", "ð": "d", "þ": "t"}.get(base.lower(), base.lower()))


#: Code pages that texts were read with by mistake, and those they were written in, beside UTF-8.
READ_AS = ("cp1252", "latin-1", "cp437", "cp850", "mac_roman", "cp1251", "cp1250", "cp866", "koi8_r", "iso8859_15")
WRITTEN_IN = ("cp1252", "cp437", "cp850", "mac_roman", "iso8859_15")
_SIGNS = "¿¡ºª«»“”‘’„…–—€"


def _read(raw: bytes, page: str) -> str:
    """Bytes in a code page; those it leaves free are read as controls, as lenient readers do."""
    out = []
    for k in raw:
        try:
            out.append(bytes([k]).decode(page))
        except UnicodeDecodeError:
            out.append(chr(k))
    return "".join(out)


class Swap:
    """Text written in one code page and read in another: what each character became, and the way back."""

    def __init__(self, written: str, read: str):
        self.name, self.multi = f"{written} as {read}", written == "utf-8"
        values = _NATIVE + _SIGNS
        if self.multi:
            # all that a second swap can have made
            values += "".join(c for c in _read(bytes(range(128, 256)), read) if c not in values)
        self.table: dict[str, str] = {}
        for c in values:
            try:
                key = _read(c.encode(written), read)
            except UnicodeEncodeError:
                continue
            if key != c and (len(key) > 1 or not key.isascii()):
                self.table.setdefault(key, c)
        self.single = {ord(k): v for k, v in self.table.items() if len(k) == 1}
        self.pattern = re.compile("|".join(map(re.escape, sorted(self.table, key=len, reverse=True))))

    def undo(self, text: str, ciphers: Ciphers, prior: float = 0.0, times: int = 4) -> tuple[str, float]:
        """The text before the swap, and how much likelier its letters are among their neighbours than what stood there.

        ``prior`` speaks for the swap where letters do not; with it signs are replaced too.
        """
        gain = 0.0
        for _ in range(times if self.multi else 1):
            out, at = [], 0
            for m in self.pattern.finditer(text):
                a, b = m.span()
                before, after = text[max(0, a - 2) : a].lower(), text[b : b + 2].lower()
                p = "".join(c if c.isalpha() else " " for c in before).rpartition(" ")[2]
                n = "".join(c if c.isalpha() else " " for c in after).partition(" ")[0]
                unit, letter = m[0], self.table[m[0]]
                k = _INDEX.get(letter.lower())
                step = ciphers.step(unit, letter.lower(), p, n)
                if self.multi:
                    step = max(step, 0.5)
                elif (k is None or not (p or n)) and not prior:
                    continue
                elif unit in _NATIVE and step + prior <= 0 and not (unit.isupper() and (text[a - 1 : a] + text[b : b + 1]).islower() and prior):
                    # letters of the language stay unless another one in their place is likelier
                    continue
                gain += step
                out += [text[at:a], letter]
                at = b
            if not out:
                break
            text = "".join(out) + text[at:]
        return text, gain


@lru_cache(maxsize=1)
def swaps() -> tuple[Swap, ...]:
    pairs = [("utf-8", r) for r in READ_AS] + [(w, r) for w in WRITTEN_IN for r in READ_AS if w != r]
    return tuple(x for x in (Swap(w, r) for w, r in pairs) if x.table)


@lru_cache(maxsize=1)
def _several_bytes() -> re.Pattern:
    """Any character of several bytes as any of the code pages shows it."""
    return re.compile("|".join(map(re.escape, sorted({k for s in swaps() if s.multi for k, v in s.table.items() if len(k) > 1}, key=len, reverse=True))))


class Finder:
    def __init__(self, ciphers: Ciphers):
        self.prepare, self.ciphers = _Prepare(), ciphers

    def check(self, text: str | None) -> tuple[bool, str | None]:
        """Whether a text is affected, and its restored form (unknown units stay)."""
        if not text or not _HAS_ODD.search(text):
            return False, text
        own, found, source = _reading(self.prepare, text)
        if source != "C" and any("\u0400" <= c <= "\u052f" for c in text):
            other = self._look_alikes_as_cipher(text)
            if other is not None:
                return True, self._swapped(text) or other
        out, hits = self._apply(own, found, source)
        if not hits and not any(_several_bytes().search(own[a:b]) for a, b, _, _ in found):
            if _LOST in own:
                return True, text
            # too dense to be letters of one text, unless a swap makes it one
            dense = sum(b - a for a, b, _, _ in contexts(own)) * 10 > 4 * len(own)
            other = self._swapped(text, EVIDENCE) if dense else None
            return other is not None, text if other is None else other
        # what was learned unit by unit competes with the swaps; it picks the likeliest letter of each place by itself, so a
        # swap, which must read the whole record one way, may gain somewhat less
        learned = [(own[a:b], self.ciphers.decode(source, own[a:b], p, n), p, n) for a, b, p, n in found]
        gain = sum(self.ciphers.step(u, x, p, n) for u, x, p, n in learned if x is not None) - 2.0 * len(contexts(out))
        return True, self._swapped(text, max(OWN_SHARE * gain, 0.0), [(u, x) for u, x, _, _ in learned if x is not None]) or out

    def _swapped(self, text: str, least: float = 0.0, learned: Sequence[tuple[str, str]] = ()) -> str | None:
        """The text under the swap that gains most, less what it leaves odd; None where none gains more than ``least``.

        A swap of single characters must not read units otherwise than their letters were ``learned``.
        """
        own = self.prepare(text)
        units = "\n".join(own[a:b] for a, b, _, _ in contexts(own))
        # swaps that explain the units about as far as any does, once per way to read them
        reach = {}
        for swap in swaps():
            hits = swap.pattern.findall(units)
            if hits:
                reach[swap] = sum(map(len, hits))
        wide = 0.8 * max(reach.values(), default=0)
        chosen = {frozenset((h, swap.table[h]) for h in swap.pattern.findall(text)): swap for swap in reversed(list(reach)) if reach[swap] >= wide}
        best, most = None, least
        for swap in chosen.values():
            out, gain = swap.undo(text, self.ciphers)
            score = gain - 2.0 * len(contexts(self.prepare(out)))
            if not swap.multi:
                score -= 1.0 * sum(1 for u, x in learned if u in swap.table and swap.table[u].lower() != x)
            if score > most:
                best, most = (swap, out), score
        if best is None:
            return None
        return best[0].undo(text, self.ciphers, prior=2.0)[0] if most > EVIDENCE / 2 else best[1]

    def _apply(self, own: str, found, source: str) -> tuple[str, int]:
        pieces, at, hits = [], 0, 0
        for a, b, p, n in found:
            letter = self.ciphers.decode(source, own[a:b], p, n)
            if letter is not None:
                near = own[max(0, a - 2) : a] + own[b : b + 2]
                pieces += [own[at:a], letter.upper() if len(near) > 1 and near.isupper() else letter]
                at = b
                hits += 1
        return "".join(pieces) + own[at:], hits

    def _look_alikes_as_cipher(self, text: str) -> str | None:
        """Text whose only odd letters are look-alikes, read by the Cyrillic cipher, where that fits the bigrams better."""
        own = self.prepare(text)
        found = contexts(own)
        gain = 0.0
        for a, b, p, n in found:
            unit = own[a:b]
            theta = self.ciphers.theta.get("C", {}).get(unit)
            if theta is None:
                gain -= 1.0
            else:
                x = self.ciphers.likelihood(unit, p, n)
                gain += float(np.log((x[:_EDGE] * theta[:_EDGE]).sum() + 1e-12) - np.log(x[_EDGE] + 1e-12))
        if gain <= EVIDENCE / 2:
            return None
        return self._apply(own, found, "C")[0]


def garbled(docu: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """``id, restored``: one row per affected record.

    ``restored`` is the text with every learned unit replaced; where nothing was learned (characters lost for good) it is the
    text as it is. Null, empty, blank and plain ASCII texts give no row; repeated rows are judged one by one. Ciphers are
    learned from all contexts of all records.
    """
    text = docu.select(F.col(text_col).alias("text")).filter(F.col("text").isNotNull())
    counts = text.mapInArrow(_count_stage, "source string, unit string, code int, times long, inside long")
    counts = materialize(counts.groupBy("source", "unit", "code").agg(F.sum("times").alias("times"), F.sum("inside").alias("inside")), "contexts")
    ciphers = Ciphers(counts.filter("source = ''").select("code", "times").collect())
    context = docu.sparkSession.sparkContext
    trigrams = context.broadcast(ciphers)

    def learn(batches):
        for (source, unit), (codes, times, inside) in _groups(batches):
            theta = trigrams.value.learn(unit, codes, times, int(inside.sum()))
            if theta is not None:
                yield pa.RecordBatch.from_arrays([pa.array([source]), pa.array([unit]), pa.array([theta.tolist()], pa.list_(pa.float64()))], names=["source", "unit", "theta"])

    units = counts.filter("source <> ''").repartition("source", "unit").sortWithinPartitions("source", "unit", "code")
    for r in units.mapInArrow(learn, "source string, unit string, theta array<double>").collect():
        ciphers.theta.setdefault(r.source, {})[r.unit] = np.array(r.theta)
    shared = context.broadcast(ciphers)
    picked = docu.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).filter(F.col("text").isNotNull())

    def run(batches):
        finder = Finder(shared.value)
        for b in batches:
            ids, out = [], []
            for k, t in enumerate(b.column(1).to_pylist()):
                hit, restored = finder.check(t)
                if hit:
                    ids.append(k)
                    out.append(restored)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(ids, pa.int32())), pa.array(out, pa.string())], names=["id", "restored"])

    return picked.mapInArrow(run, "id long, restored string")
