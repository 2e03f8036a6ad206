"""p1: per-document text quality statistics, and what records that are not prose are.

All statistics are sums over lines or over words, so they form a monoid: a document is cut into chunks, every chunk gives its
sums plus the state of the open lines at both of its ends, and merging two neighbours joins the line that their ends make
together. An open line is a state too (:class:`Open`): counts of what is behind its last safe blank, and the text from there
on; so a line is judged once, as a whole, however many chunks it runs through. Chunks of one document are merged in a tree
(by groups of 64, then per document); the many documents of one chunk are finished where they are read. The number of
different word trigrams is no sum: chunks and joints give digests of their trigrams, and a shuffle counts the different ones
of each document. Ratios and the rules come last.
"""

from __future__ import annotations

import hashlib
import pickle
import re
import unicodedata

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.plans.materialize import materialize

from .consistent import ODD, consistent_text

#: Characters of a chunk.
CHUNK = 1_000_000
#: Chunks that one step of the merge tree takes.
FAN_IN = 64

# Frequent words of Galician, Spanish, Portuguese, English and French that stand in sentences rather than in
# names of things; without accents.
SENTENCE_WORDS = frozenset(
    """que se non e mais pero como xa ata cando desde foi hai moi tamen entre despois onde porque sen contra todo diso menos
    case sobre ve asi quen so nin ninguen daquela ainda nunha antes durante diante persoas anos dias meses agora semana
    no y mas ya hasta cuando fue hay muy tambien despues donde sin ello nadie ni si hace delante personas ahora ayer
    nao ja ate quando ha muito depois sem disso nem perante pessoas ontem
    the and that was were for with not have had there from who would when which until than only about nothing neither nor is
    it are by before after people years days months now week yesterday as
    et qui est pas pour dans avec sont nous etait plus sur ne il jusqu depuis alors avant devant annees mois semaine hier
    segun disse dixo said""".split()
)
# Labels of site navigation in the same languages, without accents.
NAVIGATION = frozenset(
    """inicio portada menu contacto contactar axuda ayuda ajuda help aide home accueil seguinte siguiente next suivant anterior
    previous precedent galeria gallery galerie buscar pesquisar search rechercher compartir partilhar share partager imprimir
    print imprimer comentarios comments commentaires axenda agenda novas noticias news actualites subscribirse suscribirse
    subscrever subscribe termos terminos terms arquivo archivo archive archives rss login registro rexistro
    mapa_web mapa_do_site site_map sitemap plan_du_site ver_mais ver_mas see_more read_more voir_plus aviso_legal legal_notice mentions_legales
    politica_de_cookies cookie_policy cookies privacidade privacidad privacy confidentialite iniciar_sesion iniciar_sessao entrar
    sign_in log_in connexion contact contacts contato sobre_nos quen_somos quienes_somos quem_somos about about_us a_propos volver voltar arriba""".split()
)
NAMES = (
    "chars nonspace alnum letters vowels digits words word_chars sentence_words lines punct_end long_chars code_chars "
    "prose_words row_words item_words rows items cells value_cells nav_items tri tri_distinct alnum_words"
).split()
_AT = {n: k for k, n in enumerate(NAMES)}

_WORD = re.compile(r"[^\W_]+")
_BULLET = re.compile(r"(?:[-–—•*·‣▪o]|\(?(?:\d{1,3}(?:\.\d{1,3}){0,12}|[a-z]|[ivx]{1,4})[.)]|\d+\.\d+|\[\s?x?\])\s+\S|[•·‣▪–—*-]\S|<li\b")
_CELLS = re.compile(r'\s*[|¦]\s*|\t|","|;|\s{2,}|\s&\s|</?t[dh][^<>]{0,80}>')
_SPLITS = re.compile(r'[|¦\t;]|","|\S\s{2,}\S|\s&\s|<t[dh]')
_VALUE = re.compile(r"[\s\"']*(?:-|–|n/?a|[+-]?\d[\d.,:%/]*)?[\s\"']*$")
_NAV_CUT = re.compile(r"\s*[>|»·/•\t]\s*")
_MENU = re.compile(r"\s[>»·/•]\s")
_CONTROL = re.compile("[␀-␦]")
_LONG = re.compile(r"[^\W_+/=]{1}[a-z0-9+/=]{24,}")
_DIGIT = re.compile(r"\d")
_CODE = "{}()[]=<>;#!+"
_MARK = re.compile("[̀-ͯ]")
_ODD = re.compile(ODD)
_KNOWN = SENTENCE_WORDS.__contains__


# The broken bar, a cell border, as its two bytes look in wrong code pages.
_BORDER = "|".join(sorted({re.escape("¦".encode().decode(page)) for page in ("cp437", "cp850", "cp1252", "mac_roman", "cp866")} | {"┬[ªÂ]", "б╕"}))
_BORDERS = re.compile(_BORDER)


def fold(text: str) -> str:
    """Consistent form in lower case without accents, cell borders put right."""
    if text.isascii():
        return text.lower()
    text = _BORDERS.sub("¦", text)
    if _ODD.search(text):
        text = consistent_text(text)
    return _MARK.sub("", unicodedata.normalize("NFD", text.lower())).replace("ς", "σ")


class Whole:
    """A whole line; what few lines need is found when it is asked for."""

    def __init__(self, bare: str, words: list[str]):
        self.bare, self.last, self.words = bare, bare[-1], len(words)
        self.strong = sum(map(_KNOWN, words))
        self.split = _SPLITS.search(bare) is not None

    def menu(self) -> bool:
        return _MENU.search(self.bare) is not None

    def bullet(self) -> bool:
        return _BULLET.match(self.bare) is not None

    def cells(self) -> tuple[int, int]:
        cells = _CELLS.split(self.bare.strip("|¦ ").rstrip(";,. ")) if self.split else (self.bare,)
        return len(cells), sum(1 for c in cells if _VALUE.match(c))

    def borders(self) -> bool:
        b = self.bare
        return "|" in b or "¦" in b or "\t" in b or '","' in b

    def marks(self) -> tuple[int, int]:
        return self.bare.count("; "), self.bare.count(", ")

    def navigation(self) -> tuple[int, int]:
        cut = _NAV_CUT.split(self.bare)
        return sum(map(_is_nav, cut)), len(cut)


def _is_nav(piece: str) -> bool:
    return piece.replace(" ", "_") in NAVIGATION


def _decide(x, sums: list[float]) -> None:
    """Add what one line with words is; ``x`` is a :class:`Whole` or a closed :class:`Open`."""
    n, strong = x.words, x.strong
    sums[8] += strong
    spoken = strong >= 1 and (strong * 12 >= n or n >= 12)
    if spoken and not x.split:
        sums[13] += n
        if n > 8 and not x.menu():
            return
    else:
        bullet = x.bullet()
        k, values = x.cells()
        semicolons, commas = x.marks()
        is_row = k >= 2 and (values >= 1 or x.borders() or k >= 3) and n <= 6 * k and not (bullet and not values)
        # "a; b; c" on one line are items, "a;b;c" are cells
        if is_row and semicolons and values * 4 < k:
            is_row = False
        if spoken and not (is_row and values * 3 >= k):
            sums[13] += n
        elif is_row:
            sums[14] += n
            sums[16] += 1
            sums[18] += k
            sums[19] += values
        else:
            sums[15] += n
            sums[17] += 1 if bullet else 1 + semicolons + commas // 2
    nav, cut = x.navigation()
    sums[20] += nav
    sums[23] += cut


def _line(line: str, sums: list[float]) -> None:
    """Add what one whole line (folded) is."""
    bare = line.strip()
    if not bare:
        return
    sums[9] += 1
    sums[10] += bare[-1] in ENDS
    words = _WORD.findall(bare)
    if words:
        _decide(Whole(bare, words), sums)


#: Characters that end a sentence or close one.
ENDS = ".!?…\"»”:"
#: Where a line may be cut: after the blank between two words of one cell, with no mark-up near before it.
_CUT = re.compile(r"(?<=[a-z0-9] )(?=[a-z0-9])|(?<=[a-z0-9][,.] )(?=[a-z0-9])")
#: Characters before a cut that must hold no mark-up and no run of blanks; longer than a tag of a cell or a bullet.
_CLEAR = 100
_UNCLEAR = re.compile(r"<|\s\s")


def _cuts(text: str) -> tuple[int, int] | None:
    """First and last place where a piece of a line can be cut, whatever stands around the piece."""
    first = None
    for m in _CUT.finditer(text, _CLEAR):
        if not _UNCLEAR.search(text, m.start() - _CLEAR, m.start()):
            first = m.start()
            break
    if first is None:
        return None
    # the last one is looked for in stretches from the end
    size = 4 * _CLEAR
    while True:
        begin = max(first, len(text) - size)
        for m in reversed(list(_CUT.finditer(text, begin))):
            if not _UNCLEAR.search(text, m.start() - _CLEAR, m.start()):
                return first, m.start()
        if begin == first:
            return first, first
        size *= 4


class Open:
    """Counts of a piece of a line between two safe cuts; pieces of one line add up.

    A cell that is cut holds a word, a blank and a word, so it is no value; an entry of a menu that is cut is kept as text
    until both of its ends are known, up to a length that no name of a menu has.
    """

    LONGEST = 40

    def __init__(self, text: str, first: bool = False, last: bool = False):
        words = _WORD.findall(text)
        self.words, self.strong = len(words), sum(map(_KNOWN, words))
        self.split, self._menu = _SPLITS.search(text) is not None, _MENU.search(text) is not None
        self._bullet = first and _BULLET.match(text) is not None
        self.last = text[-1:]
        self._borders = "|" in text or "¦" in text or "\t" in text or '","' in text
        self._marks = (text.count("; "), text.count(", "))
        inner = text.lstrip("|¦ ") if first else text
        inner = inner.rstrip("|¦ ").rstrip(";,. ") if last else inner
        cells = _CELLS.split(inner)
        whole = cells[0 if first else 1 : len(cells) if last else len(cells) - 1]
        self._cells, self._values = len(cells) - 1, sum(1 for c in whole if _VALUE.match(c))
        nav = _NAV_CUT.split(text)
        self._seps, self._nav = len(nav) - 1, sum(map(_is_nav, nav[1:-1]))
        self._head, self._tail = nav[0][: self.LONGEST], nav[-1][: self.LONGEST] if self._seps else ""

    def __add__(self, other: Open) -> Open:
        out = object.__new__(Open)
        for k in ("words", "strong", "_cells", "_values", "_seps"):
            setattr(out, k, getattr(self, k) + getattr(other, k))
        for k in ("split", "_menu", "_bullet", "_borders"):
            setattr(out, k, getattr(self, k) or getattr(other, k))
        out._marks = (self._marks[0] + other._marks[0], self._marks[1] + other._marks[1])
        out.last = other.last or self.last
        joint = ((self._tail if self._seps else self._head) + other._head)[: self.LONGEST]
        out._nav = self._nav + other._nav + (bool(self._seps and other._seps) and _is_nav(joint))
        out._head = self._head if self._seps else joint
        out._tail = other._tail if other._seps else joint if self._seps else ""
        return out

    def menu(self) -> bool:
        return self._menu

    def bullet(self) -> bool:
        return self._bullet

    def cells(self) -> tuple[int, int]:
        return (self._cells + 1, self._values) if self.split else (1, 0)

    def borders(self) -> bool:
        return self._borders

    def marks(self) -> tuple[int, int]:
        return self._marks

    def navigation(self) -> tuple[int, int]:
        return self._nav + _is_nav(self._head) + (self._seps > 0 and _is_nav(self._tail)), self._seps + 1


def _characters(text: str, sums) -> list[str]:
    """Add what counts by characters; the words."""
    words = _WORD.findall(text)
    joined = "".join(words)
    digits = len(_DIGIT.findall(joined))
    sums[0] += len(text) - text.count("\n")
    sums[1] += len("".join(text.split()))
    sums[3] += len(joined) - digits
    sums[4] += sum(map(joined.count, "aeiouy"))
    sums[5] += digits
    sums[6] += len(words)
    sums[7] += len(joined)
    sums[11] += sum(map(len, _LONG.findall(text)))
    sums[12] += sum(map(text.count, _CODE)) + (0 if text.isascii() else 3 * len(_CONTROL.findall(text)))
    return words


def text_sums(text: str, repeats: bool = True) -> list[float]:
    """Sums over a stretch of whole lines of a folded text, with word repetition inside it if it is the whole text."""
    sums = [0.0] * len(NAMES)
    words = _characters(text, sums)
    for line in text.split("\n"):
        _line(line, sums)
    if repeats and len(words) >= 20:
        sums[21] = len(words) - 2
        sums[22] = len(set(zip(words, words[1:], words[2:])))
    return sums


class Piece:
    """A piece of one line with open ends: text up to its first safe cut, counts up to its last one, text behind it.

    Without a safe cut all of it is text (``head``), and ``mid`` is None.
    """

    def __init__(self, head: str, mid: Open | None = None, sums=None, tail: str = ""):
        self.head, self.mid, self.sums, self.tail = head, mid, sums, tail

    @classmethod
    def of(cls, text: str) -> Piece:
        cuts = _cuts(text) if len(text) > 4 * _CLEAR else None
        if cuts is None:
            return cls(text)
        a, b = cuts
        sums = [0.0] * len(NAMES)
        _characters(text[a:b], sums)
        return cls(text[:a], Open(text[a:b]), sums, text[b:])

    def __add__(self, other: Piece) -> Piece:
        if self.mid is None:
            return Piece.of(self.head + other.head) if other.mid is None else Piece(self.head + other.head, other.mid, other.sums, other.tail)
        if other.mid is None:
            return Piece(self.head, self.mid, self.sums, self.tail + other.head)
        between = self.tail + other.head
        sums = [0.0] * len(NAMES)
        _characters(between, sums)
        return Piece(self.head, self.mid + Open(between) + other.mid, _add(self.sums, sums, other.sums), other.tail)

    def close(self) -> list[float]:
        """Sums of the piece as a whole line."""
        if self.mid is None:
            return text_sums(self.head, False)
        sums = list(self.sums)
        _characters(self.head, sums)
        _characters(self.tail, sums)
        line = Open(self.head.lstrip(), first=True) + self.mid + Open(self.tail.rstrip(), last=True)
        sums[9] += 1
        sums[10] += line.last in ENDS
        _decide(line, sums)
        return sums


def _add(*sums) -> list[float]:
    return [sum(x) for x in zip(*sums)]


def _digests(words: list[str]) -> set[bytes]:
    return {hashlib.blake2b(" ".join(t).encode("utf-8", "surrogatepass"), digest_size=16).digest() for t in zip(words, words[1:], words[2:])}


class Words:
    """Trigrams of a stretch of text whose first and last word may go on outside it.

    ``lead`` and ``trail`` hold its first and last three words, with a blank where the outer word is whole; their own trigrams
    are not in ``seen`` yet. Under four words all stand in ``lead`` and ``trail`` is None.
    """

    def __init__(self, lead: str, trail: str | None = None, seen: set[bytes] | None = None):
        self.lead, self.trail, self.seen = lead, trail, set() if seen is None else seen

    @classmethod
    def of(cls, text: str) -> Words:
        words = _WORD.findall(text)
        before = " " if text and not _WORD.match(text[0]) else ""
        after = " " if text and not _WORD.match(text[-1]) else ""
        if len(words) < 4:
            return cls(before + " ".join(words) + after if words else before)
        return cls(before + " ".join(words[:3]), " ".join(words[-3:]) + after, _digests(words[1:-1]))

    def __add__(self, other: Words) -> Words:
        if self.trail is None and other.trail is None:
            return Words.of(self.lead + other.lead)
        joint = (self.lead if self.trail is None else self.trail) + other.lead
        new = Words.of(joint)
        words = _WORD.findall(joint)
        if self.trail is None:
            return Words(joint if new.trail is None else new.lead, other.trail, other.seen | _digests(words[1:]))
        if other.trail is None:
            return Words(self.lead, joint if new.trail is None else new.trail, self.seen | _digests(words[:-1]))
        return Words(self.lead, other.trail, self.seen | other.seen | _digests(words))

    def close(self) -> set[bytes]:
        return self.seen | _digests(_WORD.findall(self.lead)) | _digests(_WORD.findall(self.trail or ""))


class Part:
    """Sums of a stretch of text and the open lines at its ends; ``head`` is None when no line is finished."""

    def __init__(self, sums, head: Piece | None, tail: Piece, words: Words):
        self.sums, self.head, self.tail, self.words = list(sums), head, tail, words

    @classmethod
    def of(cls, text: str) -> Part:
        text = fold(text)
        words = Words.of(text)
        if "\n" in text:
            head, rest = text.split("\n", 1)
            body, tail = rest.rsplit("\n", 1) if "\n" in rest else ("", rest)
            return cls(text_sums(body, False), Piece.of(head), Piece.of(tail), words)
        return cls([0.0] * len(NAMES), None, Piece.of(text), words)

    def __add__(self, other: Part) -> Part:
        words = self.words + other.words
        if other.head is None:
            return Part(self.sums, self.head, self.tail + other.tail, words)
        joint = self.tail + other.head
        if self.head is None:
            return Part(other.sums, joint, other.tail, words)
        return Part(_add(self.sums, other.sums, joint.close()), self.head, other.tail, words)

    def close(self) -> list[float]:
        """The sums of the whole text, but for the different trigrams among ``self.words.close()`` and its parts."""
        out = _add(self.sums, *(end.close() for end in (self.head, self.tail) if end is not None))
        if out[_AT["words"]] >= 20:
            out[_AT["tri"]] = out[_AT["words"]] - 2
        return out


def kind(s) -> str | None:
    """``list``, ``table``, ``junk``, or None for prose, notices and blank texts."""
    (chars, nonspace, _, letters, vowels, digits, words, word_chars, strong, lines, punct, long_chars, code, prose, row, item, rows, items, cells, values, nav, tri, tri_distinct, cut) = s
    if nonspace == 0:
        return None
    if word_chars < 0.5 * nonspace and not (rows >= 2 and row > 0.6 * words and values * 4 >= cells):
        return "junk" if nonspace >= 12 else None
    if tri >= 18 and tri_distinct < 0.45 * tri:
        return "junk"
    if words < 15 and lines < 3 and items < 3 and nav < 3 and long_chars < 0.5 * nonspace:
        return None
    if nav >= 3 and nav * 4 >= cut and nav * 12 >= words:
        return "junk"
    if long_chars > 0.5 * nonspace:
        return "junk"
    if code > 0.11 * nonspace and word_chars < 0.86 * nonspace and prose < 0.6 * words and values * 4 < max(cells, 1):
        return "junk"
    if letters >= 40 and vowels < 0.24 * letters and prose < 0.6 * words:
        return "junk"
    if prose >= row + item:
        return None
    return "table" if row >= item else "list"


def _sums_stage(batches):
    kinds = [pa.list_(pa.float64()), pa.binary(), pa.list_(pa.binary()), pa.string()]
    names = ["sums", "state", "grams", "kind"]

    def out(b, rows):
        cols = list(zip(*rows)) if rows else [[]] * 4
        return pa.RecordBatch.from_arrays([b.column(0), *b.columns[2:], *(pa.array(c, x) for c, x in zip(cols, kinds))], names=["id", "k", "n", "row", *names])

    for b in batches:
        rows, at = [], 0
        for j, (text, n) in enumerate(zip(b.column(1).to_pylist(), b.column(3).to_pylist())):
            if n == 1:
                s = text_sums(fold(text)) if text else [0.0] * len(NAMES)
                rows.append([s, None, None, kind(s)])
            else:
                # a chunk has many digests: it goes out at once, the digests beside its state
                part = Part.of(text)
                grams, part.words.seen = list(part.words.seen), set()
                rows.append([None, pickle.dumps(part), grams, None])
                yield out(b.slice(at, j + 1 - at), rows)
                rows, at = [], j + 1
        yield out(b.slice(at), rows)


def _merge(pdf: pd.DataFrame) -> Part:
    """Chunks merged in order; ``words.seen`` has the trigrams of their joints only."""
    total = None
    for state in pdf.sort_values("k")["state"]:
        p = pickle.loads(state)
        total = p if total is None else total + p
    return total


def _merge_some(pdf: pd.DataFrame) -> pd.DataFrame:
    row = {"id": pdf["id"].iloc[0], "row": pdf["row"].iloc[0], "part": pdf["part"].iloc[0], "k": pdf["k"].min()}
    return pd.DataFrame([row | {"state": pickle.dumps(_merge(pdf))}])


def _merge_all(pdf: pd.DataFrame) -> pd.DataFrame:
    p = _merge(pdf)
    return pd.DataFrame({"id": [pdf["id"].iloc[0]], "row": [pdf["row"].iloc[0]], "sums": [p.close()], "grams": [list(p.words.close())]})


def _judge(batches):
    """Sums and kinds of merged documents once their different trigrams are counted."""
    for b in batches:
        sums = b.column(1).to_pylist()
        for s, n in zip(sums, b.column(2).to_pylist()):
            s[_AT["tri_distinct"]] = float(n or 0) if s[_AT["tri"]] else 0.0
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sums, pa.list_(pa.float64())), pa.array([kind(s) for s in sums], pa.string())], names=["id", "sums", "kind"])


def quality(docu: DataFrame, id_col: str = "id", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """One row per record: ``id, kind`` and the statistics.

    ``kind`` is ``list``, ``table``, ``junk`` or null (prose, notices, null and blank texts). Ratios over nothing are 0, so a
    null, empty or blank text has zeros. Repeated rows are judged one by one, in any order. Very long texts are cut into
    chunks of ``chunk`` characters and merged; no part of a text is left out.
    """
    length = F.coalesce(F.length(text_col), F.lit(0))
    n = F.greatest(F.ceil(length / F.lit(chunk)), F.lit(1)).cast("int")
    text = F.col(text_col)
    # a border of two characters must not be cut
    whole = F.regexp_replace(text, _BORDER, "¦")
    pieces = F.when(n == 1, F.array(text)).otherwise(F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.substr(whole, k * chunk + 1, F.lit(chunk))))
    # every row has a number of its own before it is cut, so that chunks of repeated ids stay apart; it is written with them
    numbered = docu.select(F.col(id_col).cast("long").alias("id"), n.alias("n"), pieces.alias("pieces"), F.monotonically_increasing_id().alias("row"))
    base = numbered.select("id", "n", "row", F.posexplode("pieces").alias("k", "text")).select("id", "text", "k", "n", "row")
    parts = base.mapInArrow(_sums_stage, "id long, k int, n int, row long, sums array<double>, state binary, grams array<binary>, kind string")
    parts = materialize(parts, "quality")
    cut = parts.filter("n > 1").withColumn("part", F.floor(F.col("k") / FAN_IN).cast("int"))
    # the tree carries the digests of joints only; those of the chunks go straight to the count
    some = cut.select("id", "row", "part", "k", "state").groupBy("row", "part").applyInPandas(_merge_some, "id long, row long, part int, k int, state binary")
    whole = materialize(some.groupBy("row").applyInPandas(_merge_all, "id long, row long, sums array<double>, grams array<binary>"), "merged")
    grams = cut.select("row", F.explode("grams").alias("gram")).unionByName(whole.select("row", F.explode("grams").alias("gram")))
    distinct = grams.distinct().groupBy("row").agg(F.count("*").alias("n"))
    whole = whole.join(distinct, "row", "left").select("id", "sums", "n").mapInArrow(_judge, "id long, sums array<double>, kind string")
    both = parts.filter("n = 1").select("id", "sums", "kind").unionByName(whole)

    def s(name: str):
        return F.get("sums", F.lit(_AT[name]))

    def ratio(a, b):
        return F.when(b > 0, a / b).otherwise(F.lit(0.0))

    return both.select(
        "id", "kind",
        s("words").cast("long").alias("word_count"),
        ratio(s("word_chars"), s("words")).alias("mean_word_length"),
        ratio(s("nonspace") - s("word_chars"), s("nonspace")).alias("symbol_ratio"),
        ratio(s("digits"), s("word_chars")).alias("digit_ratio"),
        s("lines").cast("long").alias("line_count"),
        ratio(s("punct_end"), s("lines")).alias("punct_line_share"),
        ratio(s("sentence_words"), s("words")).alias("common_word_share"),
        ratio(s("prose_words"), s("words")).alias("prose_share"),
        ratio(s("tri") - s("tri_distinct"), s("tri")).alias("repetition"),
    )
