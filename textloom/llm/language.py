"""p2: missing or wrong language labels, and texts of several languages.

A linear-chain conditional random field labels the words of a text: affixes, character n-grams, the word itself and ranked
lexicons give each language a score, learned transitions say how rarely a text changes language, and forward-backward turns
both into a probability per word and language. It is trained on a bounded sample of labelled records, from which records
that the first model contradicts are left out; joined passages of different records teach the transitions. The languages are
those that the labels of the sample name often enough; a text that holds few of their words is in none of them (``und``).

Scores of words are remembered by the Python workers, so the chain itself, a few array operations per position for hundreds
of texts at a time, is all that whole texts cost. Long texts run as windows side by side, with margins that the chain forgets.
"""

from __future__ import annotations

import heapq
import random
import re
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .consistent import consistent_text
from .quality import kind, text_sums
from .quality import fold as quality_fold

#: Most labelled rows the field is trained on, and most terms of each language's lexicon, by rank.
MAX_SAMPLES = 4000
MAX_TERMS = 20_000
#: Share of the sample's labels from which a language is learned; rarer ones are labels only.
MIN_SHARE = 0.02
#: Share of words met in training below which a text is in none of the languages.
KNOWN_SHARE = 0.15
UNKNOWN = "und"
#: Words of a window of a long text, and of its margins on both sides.
WINDOW, MARGIN = 4096, 256
#: Words below which a stretch is no passage.
MIN_PASSAGE = 8
#: Mean probability of its language below which a stretch is no passage of its own.
MIN_CONFIDENCE = 0.5
#: Words of a stretch of training text.
STRETCH = 64
_DIM = 1 << 17
REMEMBERED_WORDS = 300_000
_WORD = re.compile(r"[^\W\d_]+")
_WORD_OR_NUMBER = re.compile(r"[^\W_]+")

# Three-letter codes and names of the languages.
ALIASES = {
    "glg": "gl", "galician": "gl", "galego": "gl", "gallego": "gl", "spa": "es", "spanish": "es", "castellano": "es",
    "espanol": "es", "castelan": "es", "cas": "es", "por": "pt", "portuguese": "pt", "portugues": "pt", "eng": "en",
    "english": "en", "ingles": "en", "fra": "fr", "fre": "fr", "french": "fr", "francais": "fr", "frances": "fr",
}
# Labels that name no language.
NO_LANGUAGE = frozenset(["", "und", "unk", "unknown", "none", "null", "nan", "na", "n/a", "mul", "mis", "zxx", "xx", "other", "?", "??", "-"])


def label_code(label: str | None) -> str | None:
    """Two-letter code of a label; None when it names no language, the label's own first part for other languages."""
    if label is None:
        return None
    d = unicodedata.normalize("NFD", label.strip().lower())
    first = re.split(r"[-_ ,;(.@]", "".join(c for c in d if not unicodedata.combining(c)))[0]
    if first in NO_LANGUAGE or not first.isalpha() or len(first) < 2:
        return None
    return ALIASES.get(first, first)


#: A name: a capital letter and small ones right behind another word.
_NAME = re.compile(r"(?<=[^\W\d_] )[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]+")
#: What no language here writes: a wrong encoding, or another script; the whole run up to the blanks around it is masked.
_FOREIGN = re.compile(r"[^\x00-\x7fÀ-ÖØ-öø-ž«»“”„‘’‚…–—¿¡ªº·\s]|[ÃÂ][¡-¿]")
_WORD_OR_MASK = re.compile(r"[^\W\d_]+|\x02")


def words_of(text: str) -> list[str]:
    """Words in lower case; names, and what no language here writes, are empty words, which speak for no language.

    A text in which they would be more than half, such as a title in capitals, keeps all its words.
    """
    if not text.isascii():
        text = consistent_text(text)
    masked = text
    if not text.isascii() and _FOREIGN.search(text):
        masked = " ".join("\x02" if not w.isascii() and _FOREIGN.search(w) else w for w in text.split())
    words = _WORD_OR_MASK.findall(_NAME.sub("\x02", masked).lower())
    if words.count("\x02") * 2 > len(words):
        return _WORD.findall(text.lower())
    return ["" if w == "\x02" else w for w in words]


def _plain(word: str) -> str:
    return word if word.isascii() else "".join(c for c in unicodedata.normalize("NFD", word) if not "̀" <= c <= "ͯ")


class Field:
    """The random field over ``languages``. ``lexicon`` maps a word to ``{language: rank}``; ``met`` has the words that
    several training texts hold."""

    def __init__(self, lexicon: dict[str, dict[str, int]], languages: tuple[str, ...] = (), seed: int = 7):
        self.lexicon, self.languages, self.seed = lexicon, tuple(languages), seed
        n = len(self.languages)
        self.met: frozenset[str] = frozenset()
        self.weights = np.zeros((_DIM, n), np.float32)
        self.trans = np.log(np.full((n, n), 0.02) + np.eye(n) * 0.9)
        self.start = np.zeros(n)

    def features(self, word: str) -> list[int]:
        if not word:
            return [0]
        f = _plain(word)
        out = ["w" + word, "f" + f, "b"]
        out += ["s" + word[-k:] for k in (1, 2, 3, 4) if len(word) > k] + ["p" + f[:k] for k in (1, 2, 3) if len(f) > k]
        edge = "<" + f + ">"
        out += ["t" + edge[k : k + 3] for k in range(len(edge) - 2)]
        if word != f:
            out += ["a" + c for c in word if not c.isascii()]
        for lang, rank in self.lexicon.get(word, self.lexicon.get(f, {})).items():
            out += [f"l{lang}", f"l{lang}{rank.bit_length()}"]
        return [zlib.crc32(x.encode("utf-8", "surrogatepass")) % (_DIM - 1) + 1 for x in out]

    def scores(self, feats: list[list[int]]) -> np.ndarray:
        flat = np.fromiter((f for x in feats for f in x), np.int64)
        lens = np.array([len(x) for x in feats])
        cuts = np.cumsum(lens) - lens
        return np.add.reduceat(self.weights[flat], cuts) / np.sqrt(lens)[:, None]

    # --- chain -----------------------------------------------------------------------------------------------------
    def forward_backward(self, score: np.ndarray, idx: np.ndarray, lens: np.ndarray, pairs: bool = False):
        """Posterior ``(texts, words, languages)`` of padded texts; ``pairs`` adds the expected transitions."""
        b = np.exp(score - score.max(1, keepdims=True))
        size, top = idx.shape
        p, n = np.exp(self.trans), len(self.languages)
        emit = b[idx]
        past = np.arange(top)[None, :] >= lens[:, None]
        emit[past] = 1.0
        alpha = np.empty((top, size, n))
        scale = np.empty((top, size))
        a = np.exp(self.start)[None, :] * emit[:, 0]
        for t in range(top):
            if t:
                a = (alpha[t - 1] @ p) * emit[:, t]
            s = a.sum(1)
            a = a / s[:, None]
            if t:
                # past the end of a text nothing changes
                still = past[:, t]
                if still.any():
                    a[still] = alpha[t - 1][still]
                    s[still] = 1.0
            alpha[t], scale[t] = a, s
        beta = np.ones((size, n))
        post = np.empty((size, top, n))
        expected = np.zeros((n, n))
        for t in range(top - 1, -1, -1):
            g = alpha[t] * beta
            post[:, t] = g / g.sum(1, keepdims=True)
            if t:
                e = emit[:, t] * beta / scale[t][:, None]
                live = ~past[:, t]
                if pairs:
                    x = alpha[t - 1][live].T @ e[live]
                    expected += x * p
                new = e @ p.T
                beta = np.where(live[:, None], new, beta)
        return (post, expected) if pairs else post

    # --- training ----------------------------------------------------------------------------------------------------
    def train(self, texts: list[list[str]], labels: list[list[int]], epochs: int, warm: int, rate: float = 0.01, l2: float = 1e-6) -> None:
        vocab = {w: k for k, w in enumerate(sorted({w for t in texts for w in t}))}
        # stretches of one length run side by side
        texts, labels = ([t[k : k + STRETCH] for t in x for k in range(0, len(t), STRETCH)] for x in (texts, labels))
        feats = [self.features(w) for w in vocab]
        flat = np.fromiter((f for x in feats for f in x), np.int64)
        flens = np.array([len(x) for x in feats])
        owner = np.repeat(np.arange(len(feats)), flens)
        root = (1 / np.sqrt(flens)).astype(np.float32)
        cuts = np.cumsum(flens) - flens
        order = sorted(range(len(texts)), key=lambda k: len(texts[k]))
        groups = []
        for at in range(0, len(order), 1024):
            part = order[at : at + 1024]
            lens = np.array([len(texts[k]) for k in part])
            idx = np.zeros((len(part), lens.max()), np.int64)
            gold = np.zeros(idx.shape, np.int64)
            for r, k in enumerate(part):
                idx[r, : lens[r]] = [vocab[w] for w in texts[k]]
                gold[r, : lens[r]] = labels[k]
            groups.append((idx, lens, gold))
        n, total = len(self.languages), sum(map(len, texts))
        eye = np.eye(n)
        seen = np.zeros((n, n))
        first = np.zeros(n)
        for idx, lens, gold in groups:
            for r, m in enumerate(lens):
                np.add.at(seen, (gold[r, : m - 1], gold[r, 1:m]), 1)
                first[gold[r, 0]] += 1
        # the scores of words begin as a classifier of single words, so that every word of a language carries its part
        count = np.zeros((len(vocab), n))
        for idx, lens, gold in groups:
            live = np.arange(idx.shape[1])[None, :] < lens[:, None]
            np.add.at(count, (idx[live], gold[live]), 1)
        empty = vocab.get("")
        if empty is not None:
            count[empty] = 0
        share = np.log1p(count.sum(1, keepdims=True)) / np.maximum(count.sum(1, keepdims=True), 1)
        target, mass = count * share, (count * share).sum(1, keepdims=True)
        used, flat = np.unique(flat, return_inverse=True)
        weights = self.weights[used]

        def scored():
            return np.add.reduceat(weights[flat], cuts) * root[:, None]

        def gathered(by_word):
            by_word = (by_word * root[:, None]).astype(np.float32)
            return np.stack([np.bincount(flat, by_word[owner, c], len(used)) for c in range(n)], 1).astype(np.float32)

        moments = [np.zeros_like(weights), np.zeros_like(weights)]
        for epoch in range(1, warm + 1):
            score = scored()
            e = np.exp(score - score.max(1, keepdims=True))
            g = gathered(target - mass * e / e.sum(1, keepdims=True)) / np.float32(mass.sum()) - np.float32(l2) * weights
            moments[0] += 0.1 * (g - moments[0])
            moments[1] += 0.01 * (g**2 - moments[1])
            weights += 0.1 * (moments[0] / (1 - 0.9**epoch)) / (np.sqrt(moments[1] / (1 - 0.99**epoch)) + 1e-8)
        moments = [np.zeros_like(x) for x in (weights, weights, self.trans, self.trans)]
        for epoch in range(1, epochs + 1):
            score = scored().astype(float)
            by_word, expected = np.zeros((len(vocab), n)), np.zeros((n, n))
            for idx, lens, gold in groups:
                post, e = self.forward_backward(score, idx, lens, pairs=True)
                expected += e
                live = np.arange(idx.shape[1])[None, :] < lens[:, None]
                d = eye[gold[live]] - post[live]
                for c in range(n):
                    by_word[:, c] += np.bincount(idx[live], d[:, c], len(vocab))
            if empty is not None:
                by_word[empty] = 0
            g = gathered(by_word) / np.float32(total) - np.float32(l2) * weights
            h = (seen - expected) / total
            for x, grad, k, r in ((weights, g, 0, rate), (self.trans, h, 2, 20 * rate)):
                moments[k] += 0.1 * (grad - moments[k])
                moments[k + 1] += 0.01 * (grad**2 - moments[k + 1])
                x += r * (moments[k] / (1 - 0.9**epoch)) / (np.sqrt(moments[k + 1] / (1 - 0.99**epoch)) + 1e-8)
        self.weights[used] = weights
        self.start = np.log((first + 1) / (first.sum() + n))

    def fit(self, rows: list[tuple[str, str]]) -> Field:
        """Train on ``(text, language)``; the second round leaves out what the first model contradicts."""
        rng = random.Random(self.seed)
        code = {x: k for k, x in enumerate(self.languages)}
        data = [(words_of(t), code[x]) for t, x in rows if x in code]
        data = [(w, x) for w, x in data if len(w) >= 5]
        held: dict[str, int] = {}
        for w, _ in data:
            for x in set(w) - {""}:
                held[x] = held.get(x, 0) + 1
        self.met = frozenset(w for w, k in held.items() if k >= 3)
        for last in (False, True):
            texts = [w for w, _ in data]
            labels = [[x] * len(w) for w, x in data]
            by = {x: [w for w, y in data if y == x] for x in range(len(self.languages))}
            some = [x for x in by if by[x]]
            if len(some) > 1:
                for _ in range(len(data) // 4):
                    text, label = [], []
                    for x in rng.sample(some, 2) + ([rng.choice(some)] if rng.random() < 0.3 else []):
                        w = rng.choice(by[x])
                        m = rng.randint(8, 50)
                        at = rng.randint(0, max(0, len(w) - m))
                        text += w[at : at + m]
                        label += [x] * len(w[at : at + m])
                    texts.append(text)
                    labels.append(label)
            if not texts:
                return self
            self.train(texts, labels, epochs=20 if last else 5, warm=40 if last else 80)
            if not last:
                tagger = Tagger(self)
                found = tagger.passages([w for w, _ in data])
                data = [d for d, f in zip(data, found) if len(f) == 1 and f[0][0] == d[1]]
        return self


class Tagger:
    """Applies a field; remembers the scores of words."""

    def __init__(self, field: Field):
        self.field, self.row, self.table, self.used = field, {}, np.zeros((1024, len(field.languages))), 0

    def _index(self, texts: list[list[str]]) -> list[np.ndarray]:
        new = sorted(set().union(*texts).difference(self.row)) if texts else []
        if self.used + len(new) > REMEMBERED_WORDS:
            self.row, self.used = {}, 0
            new = sorted(set().union(*texts))
        if new:
            s = self.field.scores([self.field.features(w) for w in new])
            while self.used + len(new) > len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            self.table[self.used : self.used + len(new)] = s
            self.row.update(zip(new, range(self.used, self.used + len(new))))
            self.used += len(new)
        get = self.row.__getitem__
        return [np.fromiter(map(get, w), np.int64, len(w)) for w in texts]

    def known(self, words: list[str]) -> bool:
        """Whether a text holds enough words of the languages to be in one of them."""
        return sum(map(self.field.met.__contains__, words)) >= KNOWN_SHARE * (len(words) - words.count(""))

    def passages(self, texts: list[list[str]], block: int = 256) -> list[list[tuple[int, int, int, float]]]:
        """Of each text (a list of words) its passages ``(language, first word, end, confidence)``, in order."""
        idx = self._index(texts)
        out: list[list[tuple[int, int, int, float]]] = [[] for _ in texts]
        # windows ``(text, first word, end, words of the margin before, end without the margin after)``
        windows = []
        for k, x in enumerate(idx):
            for a in range(0, len(x), WINDOW):
                e = min(a + WINDOW, len(x))
                begin, end = max(a - MARGIN, 0), min(e + MARGIN, len(x))
                windows.append((k, begin, end, a - begin, e - begin))
        windows.sort(key=lambda w: w[2] - w[1])
        parts: dict[int, list] = {}
        at = 0
        while at < len(windows):
            end = at + 1
            while end < len(windows) and end - at < block and (windows[end][2] - windows[end][1]) * (end - at) < 400_000:
                end += 1
            some = windows[at:end]
            at = end
            lens = np.array([e - a for _, a, e, _, _ in some])
            padded = np.zeros((len(some), lens.max()), np.int64)
            for r, (k, a, e, _, _) in enumerate(some):
                padded[r, : lens[r]] = idx[k][a:e]
            used, local = np.unique(padded, return_inverse=True)
            post = self.field.forward_backward(self.table[used], local.reshape(padded.shape), lens)
            for r, (k, a, _, x, y) in enumerate(some):
                if len(idx[k]) <= WINDOW:
                    out[k] = _merge(post[r, x:y])
                else:
                    parts.setdefault(k, []).append((a + x, post[r, x:y].astype(np.float32)))
        for k, p in parts.items():
            out[k] = _merge(np.concatenate([x for _, x in sorted(p, key=lambda p: p[0])]))
        return out


def _merge(post: np.ndarray) -> list[tuple[int, int, int, float]]:
    """Runs of one language; runs too short or too doubtful for a passage, shortest and first ones first, join the neighbour whose language
    explains them better."""
    best = post.argmax(1)
    change = np.flatnonzero(np.diff(best)) + 1
    starts = [0, *change.tolist()]
    # a list of runs with links to both neighbours; entries of the heap are valid while their run is as they say
    runs = {a: [int(best[a]), e, p, n] for a, e, p, n in zip(starts, [*starts[1:], len(best)], [None, *starts], [*starts[1:], None])}
    heap = [(r[1] - a, a) for a, r in runs.items()]
    heapq.heapify(heap)
    while heap and len(runs) > 1:
        size, a = heapq.heappop(heap)
        run = runs.get(a)
        if run is None or run[1] - a != size:
            continue
        if size >= MIN_PASSAGE and post[a : run[1], run[0]].mean() >= MIN_CONFIDENCE:
            continue
        near = [x for x in (run[2], run[3]) if x is not None]
        run[0] = runs[max(near, key=lambda x: (post[a : run[1], runs[x][0]].sum(), runs[x][1] - x))][0]
        while run[3] is not None and runs[run[3]][0] == run[0]:
            gone = runs.pop(run[3])
            run[1], run[3] = gone[1], gone[3]
        if run[3] is not None:
            runs[run[3]][2] = a
        while run[2] is not None and runs[run[2]][0] == run[0]:
            before = runs[run[2]]
            before[1], before[3] = run[1], run[3]
            del runs[a]
            a, run = run[2], before
            if run[3] is not None:
                runs[run[3]][2] = a
        heapq.heappush(heap, (run[1] - a, a))
    return [(r[0], a, r[1], float(post[a : r[1], r[0]].mean())) for a, r in sorted(runs.items())]


def fit(docu: DataFrame, lexicon: DataFrame, id_col: str = "id", text_col: str = "text", lang_col: str = "lang") -> Field:
    """A field trained on at most ``MAX_SAMPLES`` records whose label names a language, by a hash of the id.

    Its languages are the codes that at least ``MIN_SHARE`` of these labels name.
    """
    rows = docu.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"), F.col(lang_col).alias("x"))
    rows = rows.filter((F.length(F.trim("x")) >= 2) & (F.length("t") >= 20) & (F.length("t") < 20_000))
    # only rows whose hash can be among the smallest are sorted, so tasks send the driver a few times the bound in all
    share = min(1.0, 4 * MAX_SAMPLES / max(rows.count(), 1))
    rows = rows.filter(F.xxhash64("i") <= F.lit(int(-(1 << 63) + share * ((1 << 64) - 1025))))
    rows = rows.orderBy(F.xxhash64("i"), "i").limit(MAX_SAMPLES).collect()
    data = [(r.t, label_code(r.x)) for r in sorted(rows, key=lambda r: (r.i, r.t)) if kind(text_sums(quality_fold(r.t))) is None]
    times = Counter(x for _, x in data if x)
    found = tuple(sorted(x for x, n in times.items() if n >= MIN_SHARE * sum(times.values())))
    lx: dict[str, dict[str, int]] = {}
    terms = lexicon.filter("term is not null and lang is not null").groupBy("lang", "term").agg(F.min("term_rank").alias("r"))
    for r in terms.filter((F.col("r") <= MAX_TERMS) & F.col("lang").isin(*found)).collect() if found else []:
        lx.setdefault(r.term.lower(), {})[r.lang] = r.r
    return Field(lx, found).fit(data)


def languages(docu: DataFrame, lexicon: DataFrame, id_col: str = "id", text_col: str = "text", lang_col: str = "lang", cases_only: bool = True, min_words: int = 15) -> DataFrame:
    """``id, seg_no, lang, confidence, first_word, end_word``: one row per passage, in order from 1.

    With ``cases_only`` only prose of at least ``min_words`` words whose label is missing, names another language or does not
    suffice (several passages); else every text with a word, ``und`` where it is in no language of the labels. Null, empty
    and blank texts give no row. Repeated rows are judged one by one; an empty table, or one without labels, gives an empty
    one. Whole texts are read.
    """
    field = fit(docu, lexicon, id_col, text_col, lang_col)
    shared = docu.sparkSession.sparkContext.broadcast((field.weights, field.trans, field.start, field.lexicon, field.languages, field.met))
    picked = docu.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter(F.col("text").isNotNull())

    def run(batches):
        weights, trans, start, lx, codes, met = shared.value
        own = Field({}, codes)
        own.weights, own.trans, own.start, own.lexicon, own.met = weights, trans, start, lx, met
        tagger = Tagger(own)
        for b in batches:
            texts, labels = b.column(1).to_pylist(), b.column(2).to_pylist()
            some, words = [], []
            for k, t in enumerate(texts):
                w = words_of(t) if t and codes else []
                if w:
                    some.append(k)
                    words.append(w)
            rows: list[tuple] = []
            for k, w, passages in zip(some, words, tagger.passages(words)):
                code = label_code(labels[k])
                found = [(codes[x], a, e, c) for x, a, e, c in passages]
                if not tagger.known(w):
                    found = [(UNKNOWN, 0, len(w), 0.0)]
                if cases_only:
                    # a language of no class is neither right nor wrong
                    if len(found) == 1 and found[0][0] in (code, UNKNOWN):
                        continue
                    if len(_WORD_OR_NUMBER.findall(texts[k])) < min_words or kind(text_sums(quality_fold(texts[k]))) is not None:
                        continue
                rows.extend((k, n, x, c, a, e) for n, (x, a, e, c) in enumerate(found, 1))
            cols = list(zip(*rows)) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(cols[0], pa.int32())), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()), pa.array(cols[3], pa.float64()), pa.array(cols[4], pa.int64()), pa.array(cols[5], pa.int64())],
                names=["id", "seg_no", "lang", "confidence", "first_word", "end_word"],
            )

    return picked.mapInArrow(run, "id long, seg_no long, lang string, confidence double, first_word long, end_word long")
