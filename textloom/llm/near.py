"""p4: near-duplicate records with small edits; an exact set-similarity self-join that uses relations between sets.

1. Each record becomes the set of its distinct lower-case words (64-bit hashes). Equal sets collapse into one
   representative before anything is joined.
2. Index-level skipping. Words are ordered from rare to frequent; only the head of a set is posted. Posting lists are cut
   into blocks by word, size band and position, one with the first half of the places and one with all. A probe goes only to
   the block whose sizes and places can still reach the threshold together with its own size and place, or to none, so it
   never meets the others; inside a block a posting is skipped by the exact bound and by a 128-bit parity sketch, whose Hamming distance is a lower bound
   of the symmetric difference. Blocks of very frequent words are dealt to salts, so that no task holds a whole one.
3. Answer-level derivation. Each candidate's set is compared once with that of its smallest candidate neighbour, its
   leader. The overlap of two sets with one leader then follows exactly from their two small differences to it; only pairs
   with different leaders read whole sets.

No step drops or caps anything: blocks, positions and sketches only skip what provably misses the threshold.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.plans.materialize import materialize

from .consistent import consistent_text
from .pairs import crossed

#: Most words whose frequency is sent to the tasks (16 bytes each); the rest counts as rare and is ordered by its hash.
RANKED_WORDS = 200_000
#: Most ids whose sets are looked up by broadcast; beyond it the lookup shuffles.
BROADCAST_IDS = 500_000


#: Postings of a block from which it is dealt to several tasks.
HOT_BLOCK = 20_000
#: Words whose hash a Python worker remembers (about 100 bytes each).
REMEMBERED_WORDS = 500_000

_WORD = re.compile(r"[^\W_]+")


class _Hashes(dict):
    """Word to its 64-bit hash, computed once."""

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h


def _sets(min_words: int):
    """Arrow stage: of each text the sorted hashes of its distinct words; records of too few words give no row."""

    def run(batches):
        hashes = _Hashes()
        get = hashes.__getitem__
        for b in batches:
            ids, sets = [], []
            for k, text in enumerate(b.column(1).to_pylist()):
                if text is None or len(text) < 2 * min_words - 1:
                    continue
                words = _WORD.findall((text if text.isascii() else consistent_text(text)).lower())
                if len(words) >= min_words:
                    ids.append(k)
                    sets.append(np.sort(np.fromiter(map(get, set(words)), np.uint64).view(np.int64)))
            cuts = np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int32)
            flat = np.concatenate(sets) if sets else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(ids, pa.int32())), pa.ListArray.from_arrays(pa.array(cuts), pa.array(flat))], names=["id", "words"])

    return run


def _heads(ranks: np.ndarray, threshold: float):
    """Arrow stage: of each set its size, parity sketch and head (rare words first)."""

    def run(batches):
        order = np.argsort(ranks["word"])
        words, place = ranks["word"][order], order.astype(np.int64) + 1  # ranks come from frequent to rare
        for b in batches:
            col = b.column(1)
            lens = np.diff(col.offsets.to_numpy()).astype(np.int64)
            flat = col.flatten().to_numpy()
            doc = np.repeat(np.arange(len(lens)), lens)
            if len(words):
                at = np.minimum(np.searchsorted(words, flat), len(words) - 1)
                rank = np.where(words[at] == flat, -place[at], np.iinfo(np.int64).min)
            else:
                rank = np.full(len(flat), np.iinfo(np.int64).min)
            sort = np.lexsort((flat, rank, doc))
            flat = flat[sort]
            spread = flat.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            bits = np.left_shift(np.uint64(1), spread >> np.uint64(58))
            begin = np.concatenate([[0], np.cumsum(lens)])[:-1]
            full = lens > 0
            upper = (spread >> np.uint64(57)) & np.uint64(1) == 1
            parity = np.zeros((2, len(lens)), np.uint64)
            if full.any():
                for k in (0, 1):
                    parity[k, full] = np.bitwise_xor.reduceat(np.where(upper == k, bits, np.uint64(0)), begin[full])
            keep = np.where(full, lens - np.ceil(threshold * lens - 1e-9).astype(np.int64) + 1, 0)
            pos = np.arange(len(flat)) - np.repeat(begin, lens)
            head = flat[pos < np.repeat(keep, lens)]
            offsets = pa.array(np.concatenate([[0], np.cumsum(keep)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(lens.astype(np.int32)), *(pa.array(p.view(np.int64)) for p in parity), b.column(2), pa.ListArray.from_arrays(offsets, pa.array(head))],
                names=["id", "n", "p0", "p1", "set_key", "head"],
            )

    return run


def word_sets(docu: DataFrame, id_col: str = "id", text_col: str = "text", min_words: int = 15) -> DataFrame:
    """``id, words, set_key`` of every record of at least ``min_words`` words; null, empty and blank texts give no row."""
    picked = docu.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sets = picked.mapInArrow(_sets(min_words), "id long, words array<long>")
    return sets.withColumn("set_key", F.xxhash64("words", F.size("words")))


def _need(n_a: Column, n_b: Column, t: float) -> Column:
    """Overlap at which two sets of these sizes reach the threshold."""
    return F.ceil((n_a + n_b) * F.lit(t / (1 + t)) - 1e-9)


def near_classes(docu: DataFrame, id_col: str = "id", text_col: str = "text", threshold: float = 0.8, min_words: int = 15) -> tuple[DataFrame, DataFrame]:
    """``(members, links)``: ``members`` has ``id, rep`` for every record with a set; ``links`` has ``a < b`` and
    ``overlap, n_a, n_b``: all pairs of representatives with a Jaccard similarity of at least ``threshold``.

    Ids are taken as unique; a repeated id with one text is one record. Records of fewer than ``min_words`` words (repeats
    counted) have no set. An empty table gives two empty tables. Ties at exactly the threshold are links.
    """
    spark = docu.sparkSession
    sets = materialize(word_sets(docu, id_col, text_col, min_words), "sets")
    counts = sets.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("df")).filter("df > 1")
    ranked = counts.orderBy(F.desc("df"), "word").limit(RANKED_WORDS).toPandas()
    ranks = {"word": ranked["word"].to_numpy(np.int64)}

    heads = sets.select("id", "words", "set_key").mapInArrow(_heads(ranks, threshold), "id long, n int, p0 long, p1 long, set_key long, head array<long>")
    heads = materialize(heads, "heads")
    reps = heads.groupBy("set_key").agg(F.min(F.struct("id", "n", "p0", "p1", "head")).alias("r")).select("set_key", "r.*")
    members = heads.select("id", "set_key").join(reps.select("set_key", F.col("id").alias("rep")), "set_key").select("id", "rep").distinct()

    t, c = F.lit(threshold), threshold / (1 + threshold)
    step = -math.log(threshold)
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(step) + 1e-9).cast("int")
    probe = reps.select(F.col("id").alias("id_x"), F.col("n").alias("n_x"), F.col("p0").alias("p0_x"), F.col("p1").alias("p1_x"), band.alias("own"), F.posexplode("head").alias("i", "word"))
    # a probe reaches down to sizes of threshold * n: its own band and the one below. Of a band it needs the sizes at which
    # what is left after its own place suffices, and of those sizes the places after which enough is left
    probe = probe.select("*", F.explode(F.array("own", F.col("own") - 1)).alias("band"))
    n_x, top = F.col("n_x"), F.ceil(F.exp((F.col("band") + 1) * F.lit(step)) - 1e-9) - 1
    largest = F.least(n_x.cast("double"), top.cast("double"), F.floor((n_x - F.col("i")) / F.lit(c) - n_x + 1e-9))
    smallest = F.greatest(F.ceil(n_x * t - 1e-9), F.ceil(F.exp(F.col("band") * F.lit(step)) - 1e-9))
    last = F.floor(largest * F.lit(1 - c) - n_x * F.lit(c) + 1e-9)
    probe = probe.select("*", largest.alias("largest"), smallest.alias("smallest"), last.alias("last")).filter("largest >= smallest and last >= 0")
    # of the two lists of a word and band, one with the first half of the places and one with all, the shorter that suffices
    half = F.ceil((F.greatest(top - F.ceil(top * F.lit(2 * threshold / (1 + threshold)) - 1e-9), F.lit(0)) + 1) / 2)
    late = lambda place: (F.col(place) >= half).cast("int")
    probe = probe.select("id_x", "n_x", "p0_x", "p1_x", "i", F.xxhash64("word", "band", late("last")).alias("block"))
    # the smaller set of a pair needs only a shorter head
    short = F.col("n") - F.ceil(F.col("n") * F.lit(2 * threshold / (1 + threshold)) - 1e-9) + 1
    index = reps.select(F.col("id").alias("id_y"), F.col("n").alias("n_y"), F.col("p0").alias("p0_y"), F.col("p1").alias("p1_y"), band.alias("band"), F.posexplode(F.slice("head", 1, short.cast("int"))).alias("j", "word"))
    index = index.select("id_y", "n_y", "p0_y", "p1_y", "j", F.explode(F.transform(F.sequence(late("j"), F.lit(1)), lambda r: F.xxhash64("word", "band", r))).alias("block"))
    probe, index, keys = _dealt(probe, index)
    need = _need(F.col("n_x"), F.col("n_y"), threshold)
    hits = probe.join(index, keys).filter(
        ((F.col("n_y") < F.col("n_x")) | ((F.col("n_y") == F.col("n_x")) & (F.col("id_y") < F.col("id_x"))))
        & (F.col("n_y") >= F.col("n_x") * t - 1e-9)
        & (F.least(F.col("n_x") - F.col("i"), F.col("n_y") - F.col("j")) >= need)
        & (F.bit_count(F.col("p0_x").bitwiseXOR(F.col("p0_y"))) + F.bit_count(F.col("p1_x").bitwiseXOR(F.col("p1_y"))) <= F.col("n_x") + F.col("n_y") - 2 * need)
    )
    cand = hits.select(F.least("id_x", "id_y").alias("a"), F.greatest("id_x", "id_y").alias("b")).distinct()
    cand = materialize(cand, "candidates")
    return members, _verify(spark, sets, cand, threshold)


def _dealt(probe: DataFrame, index: DataFrame) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides with the keys to join on: postings of hot blocks dealt to salts, their probes sent to each.

    There are at most ``postings / HOT_BLOCK`` hot blocks; they are broadcast while few, else joined.
    """
    hot = index.groupBy("block").agg(F.count("*").alias("_n")).filter(F.col("_n") > HOT_BLOCK)
    hot = materialize(hot.select("block", F.ceil(F.col("_n") / F.lit(HOT_BLOCK)).cast("int").alias("_salts")), "hot-blocks")
    many = hot.count()
    if many == 0:
        return probe, index, ["block"]
    hot = F.broadcast(hot) if many <= BROADCAST_IDS else hot
    salts = F.coalesce("_salts", F.lit(1))
    index = index.join(hot, "block", "left").withColumn("salt", F.pmod(F.xxhash64("id_y"), salts).cast("int")).drop("_salts")
    probe = probe.join(hot, "block", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts")
    return probe, index, ["block", "salt"]


def _verify(spark, sets: DataFrame, cand: DataFrame, t: float) -> DataFrame:
    lead = cand.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("leader"))
    ids = cand.select(F.explode(F.array("a", "b")).alias("id")).distinct().join(lead, "id", "left").select("id", F.coalesce("leader", "id").alias("leader"))
    ids = materialize(ids, "leaders")
    small = ids.count() <= BROADCAST_IDS
    fetch = (lambda d: F.broadcast(d)) if small else (lambda d: d)
    own = materialize(sets.select("id", "words").join(fetch(ids), "id").dropDuplicates(["id"]), "candidate-sets")
    heads = own.select(F.col("id").alias("leader"), F.col("words").alias("base"))
    diff = own.join(heads, "leader").select(
        "id", "leader", F.size("base").alias("n_lead"), F.size("words").alias("n"),
        F.array_except("base", "words").alias("gone"), F.array_except("words", "base").alias("come"),
    )
    diff = materialize(diff, "differences")

    def side(k: str) -> DataFrame:
        return diff.select(*(F.col(c).alias(f"{c}_{k}") for c in diff.columns))

    both = cand.join(side("x"), cand["a"] == F.col("id_x")).join(side("y"), cand["b"] == F.col("id_y"))
    derived = both.filter("leader_x = leader_y").select(
        "a", "b",
        (F.col("n_lead_x") - F.size(F.array_union("gone_x", "gone_y")) + F.size(F.array_intersect("come_x", "come_y"))).alias("overlap"),
        F.col("n_x").alias("n_a"), F.col("n_y").alias("n_b"),
    )
    # |x ∩ y| is at most |x ∩ L_y| + |come_y| for y's leader; pairs of different leaders read the sets themselves
    rest = both.filter("leader_x <> leader_y").select("a", "b")
    rest = rest.join(own.select(F.col("id").alias("a"), F.col("words").alias("wa")), "a").join(own.select(F.col("id").alias("b"), F.col("words").alias("wb")), "b")
    rest = rest.select("a", "b", F.size(F.array_intersect("wa", "wb")).alias("overlap"), F.size("wa").alias("n_a"), F.size("wb").alias("n_b"))
    return derived.unionByName(rest).filter(F.col("overlap") >= (F.col("n_a") + F.col("n_b") - F.col("overlap")) * F.lit(t) - 1e-9)


def near_pairs(docu: DataFrame, id_col: str = "id", text_col: str = "text", threshold: float = 0.8, min_words: int = 15) -> DataFrame:
    """All pairs of records, ``id_a < id_b``, at or above the threshold; equal sets are pairs too."""
    members, links = near_classes(docu, id_col, text_col, threshold, min_words)
    members, links = materialize(members, "near-members"), materialize(links.select("a", "b"), "near-links")
    linked = links.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
    ends = members.join(linked, "rep", "left_semi")
    left = ends.select(F.col("rep").alias("a"), F.col("id").alias("x"))
    right = ends.select(F.col("rep").alias("b"), F.col("id").alias("y"))
    # members of a large class are dealt to salts; only the pairs themselves grow with its square
    across = crossed(crossed(left, links, ["a"], "x"), right, ["b"], "x").select("x", "y")
    several = members.groupBy("rep").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("rep").alias("a"))
    copies = members.select(F.col("rep").alias("a"), F.col("id").alias("x")).join(several, "a", "left_semi")
    same = crossed(copies, copies.withColumnRenamed("x", "y"), ["a"], "x").filter("x < y").select("x", "y")
    return across.unionByName(same).select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))


def near_documents(docu: DataFrame, id_col: str = "id", text_col: str = "text", threshold: float = 0.8, min_words: int = 15) -> DataFrame:
    """One row per record with a set: ``id, rep`` (smallest id with the same word set), ``n_copies`` of that set and
    ``n_links``, the number of other sets it is linked to."""
    members, links = near_classes(docu, id_col, text_col, threshold, min_words)
    sizes = members.groupBy("rep").agg(F.count("*").alias("n_copies"))
    ends = links.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count("*").alias("n_links"))
    return members.join(sizes, "rep").join(ends, "rep", "left").select("id", "rep", "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links"))
