"""Near-duplicate removal by MinHash signatures and banded lookup."""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions.words import line_count
from textloom.operators.skew import dealt
from textloom.plans.materialize import materialize

PRIME = (1 << 31) - 1
#: Documents of one bucket that one task compares with the bucket.
BUCKET = 5_000


def coefficients(perms: int) -> list[tuple[int, int]]:
    """Multiplier and shift of each permutation, by rule."""
    return [((k * 48271 + 11) % (PRIME - 1) + 1, (k * k * 69621 + 7 * k + 5) % PRIME) for k in range(perms)]


@lru_cache(maxsize=16)
def optimal_bands(threshold: float, perms: int) -> tuple[int, int]:
    """Bands and rows that minimize the sum of the areas of false positives and false negatives, equally weighted."""
    x = (np.arange(1000) + 0.5) / 1000
    best, pick = None, (1, perms)
    for bands in range(1, perms + 1):
        for rows in range(1, perms // bands + 1):
            hit = 1 - (1 - x**rows) ** bands
            error = hit[x < threshold].sum() + (1 - hit)[x >= threshold].sum()
            if best is None or error < best - 1e-12:
                best, pick = error, (bands, rows)
    return pick


def _signature_stage(perms: int):
    a, b = (np.array(x, np.int64) for x in zip(*coefficients(perms)))

    def run(batches):
        known: dict[str, int] = {}
        for batch in batches:
            rows, keep = [], []
            for k, text in enumerate(batch.column(1).to_pylist()):
                words = set(text.split()) if text else ()
                if not words:
                    continue
                if len(known) > 500_000:
                    known.clear()
                hashes = np.empty(len(words), np.int64)
                for j, w in enumerate(words):
                    h = known.get(w)
                    if h is None:
                        h = known[w] = int(hashlib.md5(w.encode("utf-8", "surrogatepass")).hexdigest()[:8], 16) % PRIME
                    hashes[j] = h
                # long texts in slices, so that the table of hashes by permutations stays small
                low = np.full(perms, PRIME, np.int64)
                for at in range(0, len(hashes), 4096):
                    np.minimum(low, ((hashes[at : at + 4096, None] * a + b) % PRIME).min(0), out=low)
                rows.append(low)
                keep.append(k)
            flat = np.concatenate(rows) if rows else np.empty(0, np.int64)
            sig = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * perms), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int32())), sig], names=["pos", "signature"])

    return run


def signatures(docs: DataFrame, pos: str = "id", text: str = "text", perms: int = 128) -> DataFrame:
    """``pos, signature``: per permutation the least hash of the text's distinct words. Texts without words have none."""
    picked = docs.select(F.col(pos).cast("long").alias("pos"), F.col(text).alias("text"))
    return picked.mapInArrow(_signature_stage(perms), "pos long, signature array<long>")


def sets(docs: DataFrame, pos: str = "id", text: str = "text", perms: int = 128) -> tuple[DataFrame, DataFrame]:
    """``(members, representatives)``: documents with equal signatures share the first of them as ``rep``; a signature's
    representative carries it on. So no number of copies makes a band any longer."""
    sig = signatures(docs, pos, text, perms).withColumn("key", F.md5(F.array_join("signature", ",")))
    sig = materialize(sig, "signatures")
    reps = sig.groupBy("key").agg(F.min(F.struct("pos", "signature")).alias("r"))
    members = sig.select("pos", "key").join(reps.select("key", F.col("r.pos").alias("rep")), "key").select("pos", "rep")
    return members, reps.select(F.col("r.pos").alias("pos"), F.col("r.signature").alias("signature"))


def candidates(reps: DataFrame, threshold: float = 0.8, perms: int = 128) -> DataFrame:
    """``i < j`` of representatives that agree in a whole band."""
    bands, rows = optimal_bands(threshold, perms)
    parts = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda k: F.struct(k.alias("band"), F.xxhash64(F.slice("signature", k * rows + 1, rows)).alias("h")))
    cut = reps.select("pos", F.explode(parts).alias("x")).select("pos", "x.band", "x.h")
    cut = materialize(cut, "bands")
    # documents of a full bucket meet one another in several tasks
    a, b, keys = dealt(cut.withColumnRenamed("pos", "i"), cut.withColumnRenamed("pos", "j"), ["band", "h"], "i", BUCKET)
    return a.join(b, keys).filter("i < j").select("i", "j").distinct()


def links(docs: DataFrame, reps: DataFrame, pos: str = "id", text: str = "text", threshold: float = 0.8, length_threshold: int = 3, perms: int = 128) -> DataFrame:
    """``i, j, similarity`` of candidates whose estimate exceeds ``length_threshold`` over the shorter length."""
    pairs = candidates(reps, threshold, perms)
    sized = reps.join(docs.select(F.col(pos).alias("pos"), F.length(text).alias("len")), "pos")
    a = sized.select(F.col("pos").alias("i"), F.col("signature").alias("sa"), F.col("len").alias("la"))
    b = sized.select(F.col("pos").alias("j"), F.col("signature").alias("sb"), F.col("len").alias("lb"))
    same = F.size(F.filter(F.zip_with("sa", "sb", lambda x, y: x == y), lambda x: x)) / F.lit(perms)
    scored = pairs.join(a, "i").join(b, "j").withColumn("similarity", same)
    return scored.filter((F.least("la", "lb") > 0) & (F.col("similarity") > F.lit(length_threshold) / F.least("la", "lb"))).select("i", "j", "similarity")


def groups(linked: DataFrame) -> DataFrame:
    """``rep, member, similarity``: each document with the later ones it is linked to, itself first. Not transitive."""
    own = linked.select("i").distinct().select(F.col("i").alias("rep"), F.col("i").alias("member"), F.lit(1.0).alias("similarity"))
    return own.unionByName(linked.select(F.col("i").alias("rep"), F.col("j").alias("member"), "similarity"))


def best_members(grouped: DataFrame, docs: DataFrame, pos: str = "id", text: str = "text") -> DataFrame:
    """``rep, best``: of each group the member with the fewest lines, the earliest on ties."""
    lines = docs.select(F.col(pos).alias("member"), line_count(F.col(text)).alias("n_lines"))
    return grouped.join(lines, "member").groupBy("rep").agg(F.min_by("member", F.struct("n_lines", "member")).alias("best"))


def near_status(docs: DataFrame, pos: str = "id", text: str = "text", threshold: float = 0.8, length_threshold: int = 3, perms: int = 128) -> DataFrame:
    """``pos, rep, status`` of every document with words: ``kept`` (in no group), ``kept_as_best``, ``near_duplicate``, or
    ``copy`` for one whose signature an earlier document has. A best member of any group stays, even if it could be removed
    in another."""
    members, reps = sets(docs, pos, text, perms)
    members, reps = materialize(members, "members"), materialize(reps, "representatives")
    linked = materialize(links(docs, reps, pos, text, threshold, length_threshold, perms), "links")
    grouped = groups(linked)
    best = best_members(grouped, docs, pos, text).select(F.col("best").alias("rep")).distinct().withColumn("is_best", F.lit(True))
    grouped_ids = grouped.select(F.col("member").alias("rep")).distinct().withColumn("in_group", F.lit(True))
    out = members.join(best, "rep", "left").join(grouped_ids, "rep", "left")
    status = F.when(F.col("pos") != F.col("rep"), "copy").when(F.col("is_best"), "kept_as_best").when(F.col("in_group"), "near_duplicate").otherwise("kept")
    return out.select("pos", "rep", status.alias("status"))


def best_first(docs: DataFrame, status: DataFrame, pos: str = "id") -> DataFrame:
    """The documents that stay, with ``place`` to write them by: best ones of their groups first, then the others in order.

    Documents without words are in no group and stay.
    """
    marked = docs.join(status.select(F.col("pos").alias(pos), F.col("status").alias("_s")), pos, "left")
    stay = marked.filter("_s is null or _s in ('kept', 'kept_as_best')")
    return stay.withColumn("place", F.struct(F.when(F.col("_s") == "kept_as_best", 0).otherwise(1).alias("rest"), F.col(pos).alias("pos"))).drop("_s")


def counters(status: DataFrame) -> DataFrame:
    """``processed, kept_docs, removed`` over :func:`near_status`."""
    stays = F.col("status").isin("kept", "kept_as_best")
    return status.agg(F.count("*").alias("processed"), F.count_if(stays).alias("kept_docs"), F.count_if(~stays).alias("removed"))


def samples(grouped: DataFrame, docs: DataFrame, pos: str = "id", text: str = "text") -> DataFrame:
    """Report of the groups: ``group_ids, best_document_id, documents`` with an array of
    ``(document_id, text, jaccard_similarity)`` in the group's order."""
    best = best_members(grouped, docs, pos, text)
    full = grouped.join(docs.select(F.col(pos).alias("member"), F.col(text).alias("text")), "member")
    order = F.struct((F.col("member") != F.col("rep")).alias("o"), F.col("member").alias("document_id"), F.col("text"), F.col("similarity").alias("jaccard_similarity"))
    rows = full.groupBy("rep").agg(F.array_sort(F.collect_list(order)).alias("rows")).join(best, "rep")
    documents = F.transform("rows", lambda x: F.struct(x["document_id"].alias("document_id"), x["text"].alias("text"), x["jaccard_similarity"].alias("jaccard_similarity")))
    return rows.select(F.col("rows.document_id").alias("group_ids"), F.col("best").alias("best_document_id"), documents.alias("documents"))


def sample_report(sampled: DataFrame, signed: DataFrame) -> DataFrame:
    """``best_document_id, report``: the groups of :func:`samples` as text, one block per group.

    In this form the similarity is that with the group's best document, two decimals; ``signed`` are :func:`signatures`.
    """
    flat = sampled.select("best_document_id", "group_ids", F.posexplode("documents").alias("k", "d"))
    a = signed.select(F.col("pos").alias("best_document_id"), F.col("signature").alias("sa"))
    b = signed.select(F.col("pos").alias("document_id"), F.col("signature").alias("sb"))
    rows = flat.select("best_document_id", "group_ids", "k", "d.document_id", "d.text").join(a, "best_document_id").join(b, "document_id")
    near = F.size(F.filter(F.zip_with("sa", "sb", lambda x, y: x == y), lambda x: x)) / F.size("sa")
    block = F.concat(F.lit("Document id: "), F.col("document_id").cast("string"), F.lit("\n"), F.col("text"), F.lit("\n\nJaccard Similarity with Best Document: "), F.format_string("%.2f", near), F.lit("\n\n"))
    joined = rows.groupBy("group_ids", "best_document_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", block.alias("t")))), lambda x: x["t"]), "").alias("t"))
    head = F.concat(F.lit("Group IDs: "), F.array_join("group_ids", ", "), F.lit("\nBest Document: "), F.col("best_document_id").cast("string"), F.lit("\n\nDocuments:\n\n"))
    return joined.select("best_document_id", F.concat(head, F.col("t"), F.lit("-" * 40 + "\n")).alias("report"))
