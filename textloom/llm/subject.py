"""p9: subject areas of each document.

A background bigram model, interpolated with its unigrams, is counted over all labelled samples. Each subject adapts it: its
probability of a word after another is the background's times an interpolation of 1, the word's rate under the subject over
its rate under the background, and the same for the pair of words, normalized per history (unigram rescaling). Rates are
shrunk towards the background, and only words and pairs that one subject holds for the most part move away from it.

A sentence is judged by its cross-entropies per token: bits saved by a subject's model against the background. It supports
every subject whose saving reaches that subject's threshold and half of the best one; ``none`` competes as a subject of its
own. Thresholds are calibrated on held-out folds, by the rule that decides about documents. Labels that the held-out votes
of their sentences contradict are left out and the models are trained again.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .consistent import consistent_text

#: Most labelled rows the models are fitted on.
MAX_SAMPLES = 20_000
#: Weights of the background, of a word's rate and of a pair's rate.
WEIGHTS = (0.6, 0.2, 0.2)
#: Weight of the pair's own frequency in the background model; the rest is the word's.
PAIR_WEIGHT = 0.5
#: Pseudo-count that pulls rates towards the background.
SHRINK = 0.25
#: A word or pair is evidence only when one subject holds this share of it; others keep the background's probability.
CONCENTRATION = 0.6
#: Folds that are held out in turn, rounds of training and cleaning, and bits per token at which a sentence votes on a label.
FOLDS, ROUNDS, VOTE = 5, 3, 0.06
#: Thresholds that calibration tries, in bits per token.
GRID = np.arange(-0.1, 0.6, 0.005)

_BOUND = re.compile(r"[.!?…]+[\"'»”)]*(?=\s|<|$)|\r?\n\s*\n|\r?\n(?=\s*[\"'«“¿¡(<–—-]?\s*[A-ZÀ-ÞĀŁŚŞŽ])|</?[a-zA-Z][^<>]{0,80}>")
_TOKEN = re.compile(r"[^\W\d_]+|\x02")


def sentences(text: str) -> list[list[str]]:
    """Words of each sentence, case kept; mark-up and blank lines end a sentence."""
    out: list[list[str]] = [[]]
    for w in _TOKEN.findall(_BOUND.sub(" \x02 ", consistent_text(text))):
        if w == "\x02":
            out.append([])
        else:
            out[-1].append(w)
    return [s for s in out if s]


class Models:
    """Cross-entropy savings of the subjects: per word, and per pair of words where the pair tells more."""

    def __init__(self, rows: list[tuple[str, str]], subjects: list[str], least: int = 2):
        self.subjects, n = subjects, len(subjects)
        docs = [sentences(t) for t, _ in rows]
        lower = {w for d in docs for s in d for w in s if w.islower()}
        words, doc, sentence, count = [], [], [], 0
        for k, d in enumerate(docs):
            for s in d:
                # a capital inside a sentence marks a name; the first word counts if it is also met in lower case
                words += [w.lower() if w.islower() or (j == 0 or w.isupper()) and w.lower() in lower else "" for j, w in enumerate(s)]
                doc += [k] * len(s)
                sentence += [count] * len(s)
                count += 1
        names = sorted(set(words) - {""})
        number = {w: k for k, w in enumerate(names)} | {"": -1}
        self.word = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        self.doc, self.sentence, self.docs = np.array(doc, np.int64), np.array(sentence, np.int64), len(rows)
        size = len(names) + 2
        before = np.concatenate([[-1], self.word[:-1]]) if len(words) else self.word
        paired = (self.word >= 0) & (before >= 0) & np.concatenate([[False], self.sentence[1:] == self.sentence[:-1]])[: len(words)]
        # words are numbered from 2 on in documents: 0 is unknown and 1 ends a sentence
        key = (before + 2) * size + self.word + 2
        self.pair_key, at = np.unique(key[paired], return_inverse=True)
        self.pair = np.full(len(words), -1)
        self.pair[paired] = at
        self.left, self.right = self.pair_key // size - 2, self.pair_key % size - 2
        self.vocab, self.size = {w: k + 2 for w, k in number.items() if w} | {"\x02": 1}, size
        if not rows:
            self.threshold = self.word_gain = self.pair_gain = np.zeros((0, n))
            return
        given = np.array([subjects.index(s) for _, s in rows], np.int64)
        labels = given.copy()
        fold = np.arange(self.docs) % FOLDS
        for _ in range(ROUNDS):
            held = np.zeros((count, n))
            for f in range(FOLDS):
                part = self._savings(self._train(labels, fold != f), fold == f, count)
                held += part
            of = np.zeros(count, np.int64)
            of[self.sentence] = self.doc
            voting = held.max(1, initial=-1.0) >= VOTE
            votes = np.zeros((self.docs, n))
            np.add.at(votes, (of[voting], held[voting].argmax(1)), 1)
            cleaned = np.where((votes.max(1) > 0) & (votes.argmax(1) == given), given, -1)
            if (cleaned == labels).all():
                break
            labels = cleaned
        self.threshold = self._calibrate(held, of, labels, least)
        word_gain, pair_gain = self._train(labels, np.ones(self.docs, bool))
        self.word_gain = np.concatenate([np.zeros((2, n)), np.nan_to_num(word_gain)])
        self.pair_gain = np.where(np.isnan(pair_gain), self.word_gain[self.right + 2], pair_gain)
        for k in ("word", "doc", "sentence", "pair", "left", "right"):
            delattr(self, k)

    def _rates(self, gram: np.ndarray, grams: int, labels: np.ndarray, use: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Rate of each gram (in samples that hold it) under each subject over its rate under all; and whether it was met."""
        n = len(self.subjects)
        live = (gram >= 0) & use[self.doc] & (labels[self.doc] >= 0)
        cell = np.unique(gram[live] * self.docs + self.doc[live])
        seen = np.bincount(cell // self.docs * n + labels[cell % self.docs], minlength=grams * n).reshape(grams, n)
        size = np.bincount(labels[use & (labels >= 0)], minlength=n)
        rate = seen / np.maximum(size, 1)
        share = rate / np.maximum(rate.sum(1, keepdims=True), 1e-12)
        total = seen.sum(1, keepdims=True)
        ratio = (share * total + SHRINK) / (total + SHRINK * n) * n
        ratio[(share.max(1, initial=0) < CONCENTRATION) | (total[:, 0] < least)] = 1.0
        return ratio, total[:, 0] > 0

    def _train(self, labels: np.ndarray, use: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bits that each subject's model saves on a word without a known pair, and on the second word of a pair; words and
        pairs that the samples in use do not hold are not numbers."""
        words, pairs = self.size - 2, len(self.pair_key)
        one, met_one = self._rates(self.word, words, labels, use, 1)
        two, met_two = self._rates(self.pair, pairs, labels, use, 2)
        a, b, c = WEIGHTS
        known = two != 1.0
        factor_one = a + (b + c) * one
        factor_two = a + b * one[self.right] + c * np.where(known.any(1, keepdims=True), two, one[self.right])
        # the background: tokens of all samples in use, pairs interpolated with words
        live = use[self.doc] & (labels[self.doc] >= 0)
        tokens = np.bincount(self.word[live & (self.word >= 0)], minlength=words)
        together = np.bincount(self.pair[live & (self.pair >= 0)], minlength=pairs)
        alone = tokens / max(tokens.sum(), 1)
        follows = np.bincount(self.left, together, words)
        own = together / np.maximum(follows[self.left], 1)
        w = np.where(follows > 0, PAIR_WEIGHT, 0.0)
        # what the factors sum to after each word, so that every subject's probabilities sum to one again
        base = alone @ factor_one
        back = alone[self.right]
        z = np.empty((words, len(self.subjects)))
        for s in range(len(self.subjects)):
            after = np.bincount(self.left, own * factor_two[:, s], words)
            moved = np.bincount(self.left, back * (factor_two[:, s] - factor_one[self.right, s]), words)
            z[:, s] = w * after + (1 - w) * (base[s] + moved)
        word_gain = np.log2(factor_one / np.maximum(base, 1e-12))
        pair_gain = np.log2(factor_two / np.maximum(z[self.left], 1e-12))
        word_gain[~met_one] = np.nan
        pair_gain[~met_two] = np.nan
        return word_gain, pair_gain

    def _savings(self, trained, held: np.ndarray, count: int) -> np.ndarray:
        """Bits per token saved on each sentence of the held-out samples, 0 elsewhere."""
        word_gain, pair_gain = trained
        live = held[self.doc] & (self.word >= 0)
        word, pair, sentence = self.word[live], self.pair[live], self.sentence[live]
        gain = word_gain[word]
        some = pair >= 0
        two = pair_gain[pair[some]]
        gain[some] = np.where(np.isnan(two), gain[some], two)
        known = ~np.isnan(gain).any(1)
        return _per_token(sentence[known], gain[known], count)

    def _calibrate(self, held, of, labels, least: int) -> np.ndarray:
        """Threshold of each subject: fewest held-out samples judged wrongly when ``least`` sentences must reach it; among
        those within one sample of the fewest, the nearest to the best threshold for all subjects together."""
        n = len(self.subjects)
        held = np.where(held >= 0.5 * held.max(1, keepdims=True), held, np.minimum(held, 0))
        wrong = np.zeros((n, len(GRID)), np.int64)
        use = labels >= 0
        for s in range(n):
            for k, t in enumerate(GRID):
                accepted = np.bincount(of[held[:, s] >= t], minlength=self.docs) >= least
                wrong[s, k] = ((accepted != (labels == s)) & use).sum()
        pooled = wrong.sum(0)
        best = np.flatnonzero(pooled == pooled.min())
        star = GRID[best[len(best) // 2]]
        return np.array([min(GRID[x <= x.min() + 1], key=lambda t: abs(t - star)) for x in wrong])

    def subjects_of(self, texts: list[str | None], least: int) -> tuple[np.ndarray, np.ndarray]:
        """``(text number, subject number)`` of texts with at least ``least`` sentences about the subject."""
        get, ids, owner = self.vocab.get, [], np.zeros(len(texts), np.int64)
        for k, t in enumerate(texts):
            if t:
                if not t.isascii():
                    t = consistent_text(t)
                part = [get(w, 0) for w in _TOKEN.findall(_BOUND.sub(" \x02 ", t).lower())]
                part.append(1)
                owner[k] = len(part)
                ids.append(np.array(part, np.int64))
        if not ids:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        x = np.concatenate(ids)
        doc = np.repeat(np.arange(len(texts)), owner)
        sentence = np.cumsum(x == 1) - (x == 1)
        key = np.concatenate([[0], x[:-1] * self.size + x[1:]])
        at = np.minimum(np.searchsorted(self.pair_key, key), max(len(self.pair_key) - 1, 0))
        paired = (self.pair_key[at] == key) & (x > 1) if len(self.pair_key) else np.zeros(len(x), bool)
        known = x > 1
        hit = np.flatnonzero(known)
        gain = self.word_gain[x[hit]]
        two = paired[hit]
        gain[two] = self.pair_gain[at[hit[two]]]
        n = int(sentence[-1]) + 1
        total = _per_token(sentence[hit], gain, n)
        ok = (total >= self.threshold) & (total >= 0.5 * total.max(1, keepdims=True))
        first = np.zeros(n, np.int64)
        first[sentence] = doc
        pick, subject = np.nonzero(ok)
        both, count = np.unique(first[pick] * len(self.subjects) + subject, return_counts=True)
        both = both[count >= least]
        return both // len(self.subjects), both % len(self.subjects)


def _per_token(sentence: np.ndarray, gain: np.ndarray, count: int) -> np.ndarray:
    tokens = np.maximum(np.bincount(sentence, minlength=count), 1)[:, None]
    return np.stack([np.bincount(sentence, gain[:, s], count) for s in range(gain.shape[1])], 1) / tokens if gain.shape[1] else np.zeros((count, 0))


def fit(samples: DataFrame, text_col: str = "text", subject_col: str = "subject") -> Models:
    """Models of the subjects of the labelled rows; case and blanks around a label do not count, null labels are left out.

    At most ``MAX_SAMPLES`` rows, by a hash of the text, are used.
    """
    label = F.lower(F.trim(F.col(subject_col)))
    rows = samples.select(F.col(text_col).alias("t"), label.alias("s")).filter(F.col("t").isNotNull() & (F.length("s") > 0))
    rows = rows.orderBy(F.xxhash64("t"), "t", "s").limit(MAX_SAMPLES).collect()
    return Models([(r.t, r.s) for r in rows], sorted({r.s for r in rows}))


def subjects(docs: DataFrame, samples: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_sentences: int = 2, none_label: str = "none") -> DataFrame:
    """``doc_id, subject``: one row for each document and subject that at least ``least_sentences`` sentences are about.

    Null, empty and blank texts, and documents about ``none_label`` only, give no row; a table without samples gives none
    at all. Repeated rows are judged one by one. Whole texts are read, whatever their length.
    """
    models = fit(samples, subject_col="subject")
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).filter(F.col("text").isNotNull())

    def run(batches):
        names = np.array(models.subjects, object)
        for b in batches:
            texts = b.column(1).to_pylist()
            d, s = models.subjects_of(texts, least_sentences) if len(names) else (np.zeros(0, np.int64),) * 2
            keep = np.array([names[k] != none_label for k in s], bool)
            d, s = d[keep], s[keep]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(d)), pa.array([names[k] for k in s], pa.string())], names=["doc_id", "subject"])

    return picked.mapInArrow(run, "doc_id long, subject string")
