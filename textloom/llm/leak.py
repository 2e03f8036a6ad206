"""p8: evaluation texts leaking into training text.

A document is read as one stream of folded characters: the consistent form without accents and case, words separated by
one blank. A passage of ``words`` successive words of a test item that stands in a document with at most ``edits`` words
changed, added or left out holds a run of unchanged words, of which the shortest possible has ``run`` words; all its
character q-grams lie on one diagonal. By the q-gram lemma a region can only match if a diagonal band counts at least as
many shared q-grams as the shortest such run has. Bands overlap by half, so a match never falls between two. Regions that
reach the bound are verified by a banded alignment of words, ``edits`` word diagonals to either side.

Hashing, filtering, counting and aligning run on whole Arrow batches in numpy; only the test items, a table of fixed size
that is read in blocks, travel to the tasks.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .consistent import mapping

#: Characters of test items that one block holds; more items mean more passes over the documents.
BLOCK_CHARS = 4_000_000
#: Characters that the filter hashes at a time, so that its arrays stay in the processor's cache.
CHUNK_CHARS = 200_000
#: Pairs of equal q-grams that are held at a time.
PAIRS = 5_000_000
_MULT = np.uint64(0x9E3779B97F4A7C15)
#: Stands between texts; folds to 1, which no item holds.
_BOUND = 0x10FFFF


@lru_cache(maxsize=1)
def fold_table() -> np.ndarray:
    """Code point to folded code point: 0 is dropped, 32 separates words.

    Letters and digits lose case and accents; other characters separate words, but marks and invisible characters vanish.
    """
    out = np.full(0x110000, 32, np.uint32)
    same = mapping()
    for cp in range(0x20000):
        ch = same.get(cp, chr(cp))
        if ch == "":
            out[cp] = 0
            continue
        kind = unicodedata.category(ch[0])
        if kind[0] == "M":
            out[cp] = 0
        elif kind[0] in "LN":
            base = unicodedata.normalize("NFD", ch[0].lower())[0]
            out[cp] = ord(base)
    out[0x20000:0x31350] = np.arange(0x20000, 0x31350)
    for cp, ch in same.items():
        if ch == "":
            out[cp] = 0
    out[_BOUND] = 1
    return out


@lru_cache(maxsize=1)
def _expanding() -> dict[int, str]:
    return {cp: s for cp, s in mapping().items() if len(s) > 1}


@lru_cache(maxsize=1)
def mix_table() -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (np.arange(0x31400).astype(np.uint64) + np.uint64(0x51ED27)) * _MULT
        return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def gram_hashes(h: np.ndarray, q: int) -> np.ndarray:
    """Rolling hashes of q characters each, by doubling."""
    n, b = 1, 0x2545F4914F6CDD1D
    with np.errstate(over="ignore"):
        while n < q:
            g = h[: max(0, len(h) - n)] * np.uint64(b)
            g += h[n:]
            h, b, n = g, b * b & 0xFFFFFFFFFFFFFFFF, n * 2
    return h


class Stream:
    """Folded characters of many texts, words numbered across all of them."""

    def __init__(self, texts: list[str | None]):
        grow = _expanding()
        joined = "\n".join(t or "" for t in texts)
        owner_len = np.fromiter((len(t or "") + 1 for t in texts), np.int64, len(texts))
        if not joined.isascii() and not grow.keys().isdisjoint(set(map(ord, set(joined)))):
            texts = [(t or "").translate(grow) for t in texts]
            joined = "\n".join(texts)
            owner_len = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        raw = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        owner = np.repeat(np.arange(len(texts), dtype=np.int32), owner_len)[: len(raw)]
        chars = fold_table()[raw]
        keep = chars != 0
        chars, owner = chars[keep], owner[keep]
        blank = chars == 32
        # one blank between words, none at the ends of a text
        lead = np.concatenate([[True], blank[:-1] | (owner[1:] != owner[:-1])]) if len(chars) else blank
        keep = ~(blank & lead)
        self.chars, self.owner = chars[keep], owner[keep]
        start = np.concatenate([[True], (self.chars[:-1] == 32) | (self.owner[1:] != self.owner[:-1])]) if len(self.chars) else np.zeros(0, bool)
        start &= self.chars != 32
        self.word = np.cumsum(start).astype(np.int64) - 1  # number of the word at each character
        at = np.flatnonzero(start)
        mixed = self._mix()
        body = np.where(self.chars == 32, np.uint64(0), mixed)
        # position-dependent sum: weights follow the place inside the word
        place = np.arange(len(self.chars)) - at[self.word] if len(at) else np.zeros(0, np.int64)
        with np.errstate(over="ignore"):
            weight = (place.astype(np.uint64) + np.uint64(1)) * _MULT | np.uint64(1)
            self.word_hash = np.add.reduceat(body * weight, at) if len(at) else np.zeros(0, np.uint64)
        self.word_owner = self.owner[at]
        self.word_len = np.diff(np.append(at, len(self.chars))) if len(at) else np.zeros(0, np.int64)

    def _mix(self) -> np.ndarray:
        return mix_table()[self.chars]

    def grams(self, q: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all q-grams (q a power of two), and which of them lie within one text."""
        h = gram_hashes(self._mix(), q)
        at = np.arange(len(h))
        ok = self.owner[at] == self.owner[at + q - 1] if len(h) else np.zeros(0, bool)
        return h, ok


class Items:
    """Index of the q-grams of a block of test items."""

    def __init__(self, ids: list[int], texts: list[str], words: int, edits: int):
        self.ids, self.words, self.edits = np.asarray(ids, np.int64), words, edits
        self.stream = s = Stream(texts)
        owner = s.word_owner
        n = len(owner) - words + 1
        inside = np.flatnonzero(owner[: max(n, 0)] == owner[words - 1 :]) if n > 0 else np.zeros(0, np.int64)
        self.usable = len(inside) > 0
        if not self.usable:
            return
        # characters of each run of words that a match must leave whole, without a blank at its end
        run = -(-(words - edits) // (edits + 1))
        ends = np.cumsum(s.word_len)
        first = ends - s.word_len
        last_is_blank = s.chars[ends - 1] == 32
        runs = np.flatnonzero(owner[: len(owner) - run + 1] == owner[run - 1 :])
        length = (ends - last_is_blank)[runs + run - 1] - first[runs]
        self.least = int(length.min())
        q = 1
        while q * 2 <= min(32, self.least):
            q *= 2
        self.q = q
        self.bound = max(1, self.least + 1 - q)
        h, ok = s.grams(q)
        at = np.flatnonzero(ok)
        order = np.argsort(h[at], kind="stable")
        self.place, self.hash = at[order], h[at][order]
        self.bits = np.zeros(1 << 22, bool)
        self.bits[self.hash >> np.uint64(42)] = True


def sharing(items: Items, texts: list[str | None]) -> list[int]:
    """Numbers of the texts that share at least one q-gram with the items."""
    fold, mix, grow = fold_table(), mix_table(), _expanding()
    odd = re.compile("[" + "".join(map(chr, grow)) + "]").search
    out: list[int] = []
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size < CHUNK_CHARS):
            size += len(texts[end] or "")
            end += 1
        joined = chr(_BOUND).join(t or "" for t in texts[at:end])
        if not joined.isascii() and odd(joined):
            joined = joined.translate(grow)
        chars = fold[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
        if not chars.all():
            chars = chars[chars != 0]
        blank = chars == 32
        if len(chars):
            chars = chars[~np.concatenate([[False], blank[1:] & blank[:-1]])]
        h = gram_hashes(mix[chars], items.q)
        near = np.flatnonzero(items.bits[h >> np.uint64(42)])
        g = h[near]
        k = np.minimum(np.searchsorted(items.hash, g), len(items.hash) - 1)
        near = near[items.hash[k] == g]
        if len(near):
            bounds = np.flatnonzero(chars == 1)
            out.extend((np.unique(np.searchsorted(bounds, near)) + at).tolist())
        at = end
    return out


def find(items: Items, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """``(text number, item id)`` of every text that holds the wanted number of successive words of an item."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    some = sharing(items, texts) if items.usable else []
    if not some:
        return none
    docs, ids = _regions(items, [texts[k] for k in some])
    return np.asarray(some, np.int64)[docs], ids


def _regions(items: Items, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    s = Stream(texts)
    h, ok = s.grams(items.q)
    at = np.flatnonzero(ok & items.bits[h >> np.uint64(42)])
    lo = np.searchsorted(items.hash, h[at], "left")
    many = np.searchsorted(items.hash, h[at], "right") - lo
    at, lo, many = at[many > 0], lo[many > 0], many[many > 0]
    out = [np.zeros((2, 0), np.int64)]
    if len(at) and many.sum() <= PAIRS:
        out.append(_match(items, s, np.repeat(at, many), items.place[_ranges(lo, many)]))
    elif len(texts) > 1:
        half = len(texts) // 2
        for first, part in ((0, texts[:half]), (half, texts[half:])):
            d, i = _regions(items, part)
            out.append(np.stack([d + first, np.searchsorted(items.ids, i)]))
    elif len(at):
        # one text that shares very many q-grams: a group of items at a time, pairs made in stretches
        cuts = np.searchsorted(np.cumsum(many), np.arange(0, many.sum(), PAIRS) + 1)
        cuts = [*np.unique(cuts).tolist(), len(at)]
        groups = np.array_split(np.arange(len(items.ids)), min(len(items.ids), len(cuts)))
        for group in groups:
            kept = []
            for x, y in zip(cuts, cuts[1:]):
                d, i = np.repeat(at[x:y], many[x:y]), items.place[_ranges(lo[x:y], many[x:y])]
                near = (items.stream.owner[i] >= group[0]) & (items.stream.owner[i] <= group[-1])
                kept.append((d[near], i[near]))
            out.append(_match(items, s, *map(np.concatenate, zip(*kept))))
    hit = np.unique(np.concatenate(out, axis=1), axis=1)
    return hit[0], items.ids[hit[1]]


def _ranges(lo: np.ndarray, many: np.ndarray) -> np.ndarray:
    """``lo, lo + 1, ...`` of each range."""
    return np.repeat(lo, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)


def _match(items: Items, s: Stream, d: np.ndarray, i: np.ndarray) -> np.ndarray:
    """``text number, item number`` of matches among shared q-grams at ``d`` of the texts and ``i`` of the items."""
    none = np.zeros((2, 0), np.int64)
    t, n, edits = items.stream, items.words, items.edits
    if not len(d):
        return none
    # diagonals of one text and item, gathered into bands that overlap by half
    doc, item = s.owner[d].astype(np.int64), t.owner[i].astype(np.int64)
    diagonal, width = d - i, 2
    found = np.zeros(len(d), bool)
    for shift in (0, width // 2):
        band = (diagonal + shift) // width
        order = np.lexsort((band, item, doc))
        a, b, c = doc[order], item[order], band[order]
        new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (c[1:] != c[:-1])])
        group = np.cumsum(new) - 1
        size = np.bincount(group)
        found[order] |= size[group] >= items.bound
    d, i = d[found], i[found]
    if not len(d):
        return none
    # windows of the item that hold a word a q-gram of a region touches, on that word's diagonal
    cells = np.unique(np.stack([s.word[d] - t.word[i], t.word[i], s.owner[d]]), axis=1)
    starts = np.repeat(cells, n + 1, axis=1)
    starts[1] += np.tile(np.arange(1 - n, 2), cells.shape[1])
    starts = starts[:, (starts[1] >= 0) & (starts[1] + n <= len(t.word_hash))]
    starts = starts[:, t.word_owner[starts[1]] == t.word_owner[starts[1] + n - 1]]
    if not starts.shape[1]:
        return none
    starts = np.unique(starts, axis=1)
    shift, begin, doc = starts
    at = begin + shift
    cost = np.zeros((2 * edits + 1, len(begin)), np.int32)
    for k in range(n):
        step = np.empty_like(cost)
        for b in range(2 * edits + 1):
            w = at + k + b - edits
            ok = (w >= 0) & (w < len(s.word_hash))
            w = np.where(ok, w, 0)
            same = ok & (s.word_owner[w] == doc) & (s.word_hash[w] == t.word_hash[begin + k])
            # a changed word, or one of the item left out, or one of the text added
            step[b] = cost[b] + ~same
            if b < 2 * edits:
                step[b] = np.minimum(step[b], cost[b + 1] + 1)
            if b > 0:
                step[b] = np.minimum(step[b], step[b - 1] + 1)
        cost = step
    hit = cost.min(0) <= edits
    return np.unique(np.stack([doc[hit], t.word_owner[begin[hit]].astype(np.int64)]), axis=1)


def _stage(shared):
    def run(batches):
        for b in batches:
            texts = b.column(1).to_pylist()
            docs, ids = find(shared.value, texts)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(docs)), pa.array(ids, pa.int64())], names=["doc_id", "item_id"])

    return run


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", words: int = 8, edits: int = 0) -> DataFrame:
    """``doc_id, item_id``: every document that holds at least ``words`` successive words of an item.

    Case, accents, punctuation and white space are ignored. With ``edits`` up to so many of the words may be changed, added
    or left out in the document (fewer than half of ``words``). Null, empty and blank texts on either side, and items of
    fewer words, match nothing; an empty table gives no rows. Repeated documents are reported once each; item ids are taken
    as unique. Items are read to the driver in blocks of ``BLOCK_CHARS`` characters; a block's index is broadcast, and each
    further block is one more pass over the documents.
    """
    if not 0 <= edits * 2 < words:
        raise ValueError("edits must be fewer than half of the words")
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).filter(F.col("text").isNotNull())
    out, ids, texts, size = None, [], [], 0

    def flush(out):
        order = sorted(range(len(ids)), key=ids.__getitem__)
        items = Items([ids[k] for k in order], [texts[k] for k in order], words, edits)
        part = picked.mapInArrow(_stage(docs.sparkSession.sparkContext.broadcast(items)), "doc_id long, item_id long")
        return part if out is None else out.unionByName(part)

    rows = benchmark.select(F.col(item_col).cast("long"), F.col(item_text_col)).filter(F.col(item_text_col).isNotNull()).filter(F.length(F.trim(item_text_col)) > 0)
    for i, t in rows.toLocalIterator():
        if texts and size + len(t) > BLOCK_CHARS:
            out, ids, texts, size = flush(out), [], [], 0
        ids.append(i)
        texts.append(t)
        size += len(t)
    return flush(out)
