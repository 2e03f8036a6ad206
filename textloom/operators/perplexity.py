"""Bigram language model: counts over all documents, scores per document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.words import words
from textloom.operators.skew import small
from textloom.plans.materialize import materialize

BEGIN, END = "<s>", "</s>"
#: A pair or word that makes up this share of all pairs is frequent: at most ``1 / FREQUENT`` of either exist.
FREQUENT = 1 / 100_000


def bigrams(text: Column) -> Column:
    """Pairs of successive lower-case words with both edges; an empty text has the pair of its edges."""
    whole = F.concat(F.array(F.lit(BEGIN)), words(F.lower(text)), F.array(F.lit(END)))
    pairs = F.transform(F.array(whole), lambda w: F.zip_with(F.slice(w, 1, F.size(w) - 1), F.slice(w, 2, F.size(w) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b"))))
    return F.get(pairs, F.lit(0))


def fit(docs: DataFrame, text: str = "text") -> DataFrame:
    """``a, b, n, n_a``: how often each pair and its first word occur, over all documents. Written once."""
    rows = docs.filter(F.col(text).isNotNull()).select(F.explode(bigrams(F.col(text))).alias("g"))
    pair = materialize(rows.groupBy("g.a", "g.b").agg(F.count("*").alias("n")), "bigrams")
    first = pair.groupBy("a").agg(F.sum("n").alias("n_a"))
    return materialize(pair.join(first, "a"), "bigram-model")


def score(docs: DataFrame, model: DataFrame, id_col: str = "id", text: str = "text") -> DataFrame:
    """``id, perplexity``: ``exp`` of the mean negative log probability of the text's pairs, add-one smoothed.

    The vocabulary is the number of different words after which or as which a pair of the model occurs. Null texts have no
    score. Counts of frequent pairs, whose number :data:`FREQUENT` bounds, are broadcast; only rare pairs, of which each
    stands in few documents, are joined with a shuffle, and pairs the model lacks look up their first word the same way.
    """
    total, words_known = model.agg(F.sum("n")).first()[0] or 0, model.select(F.explode(F.array("a", "b")).alias("w")).distinct().count()
    often = F.lit(max(total * FREQUENT, 50.0))
    pairs = docs.filter(F.col(text).isNotNull()).select(F.col(id_col).alias("id"), F.explode(bigrams(F.col(text))).alias("g")).select("id", "g.a", "g.b")
    counts = model.select("a", "b", F.col("n").alias("c"), F.col("n_a").alias("c_a"))
    frequent, rare = F.broadcast(counts.filter(F.col("c") > often)), counts.filter(F.col("c") <= often)
    log_p = F.log((F.coalesce("c", F.lit(0)) + 1) / (F.coalesce("c_a", F.lit(0)) + F.lit(words_known)))

    def summed(rows: DataFrame) -> DataFrame:
        return rows.groupBy("id").agg(F.sum(log_p).alias("s"), F.count("*").alias("k"))

    other = pairs.join(frequent, ["a", "b"], "left_anti").join(rare, ["a", "b"], "left")
    firsts = model.select("a", F.col("n_a").alias("c_a")).distinct()
    if small(firsts):
        # all first words fit: one pass looks up both
        looked_up = other.join(F.broadcast(firsts.withColumnRenamed("c_a", "f_a")), "a", "left").select("id", "c", F.coalesce("c_a", "f_a").alias("c_a"))
        sums = summed(pairs.join(frequent, ["a", "b"]).select("id", "c", "c_a")).unionByName(summed(looked_up))
        return sums.groupBy("id").agg(F.exp(-F.sum("s") / F.sum("k")).alias("perplexity"))
    known = other.filter("c is not null")
    unseen = other.filter("c is null").select("id", "a")
    common, seldom = F.broadcast(firsts.filter(F.col("c_a") > often)), firsts.filter(F.col("c_a") <= often)
    missing = F.lit(None).cast("long").alias("c")
    parts = [
        pairs.join(frequent, ["a", "b"]),
        known,
        unseen.join(common, "a").select("id", missing, "c_a"),
        unseen.join(common, "a", "left_anti").join(seldom, "a", "left").select("id", missing, "c_a"),
    ]
    sums = summed(parts[0].select("id", "c", "c_a"))
    for p in parts[1:]:
        sums = sums.unionByName(summed(p.select("id", "c", "c_a")))
    return sums.groupBy("id").agg(F.exp(-F.sum("s") / F.sum("k")).alias("perplexity"))


def requested(score: bool = False, html: bool = False, text: bool = False) -> None:
    """Raises ``ValueError`` unless at least one action of the perplexity command is asked for."""
    if not (score or html or text):
        raise ValueError("no action: ask for a score, for clean HTML or for clean text")


def filter_scores(docs: DataFrame, score_col: str = "pyplexity_score", limit: float = 2000.0, remove: bool = True) -> DataFrame:
    """Adds ``status``: ``kept`` below the limit, else ``high_perplexity``; null, NaN and infinite scores are not below it."""
    low = F.coalesce((F.col(score_col) < limit) & ~F.isnan(score_col), F.lit(False))
    return docs.withColumn("status", F.when(low | F.lit(not remove), "kept").otherwise("high_perplexity"))


def latest_scores(scored: DataFrame) -> DataFrame:
    """One row per document: its newest score; of equally new ones the model and score that sort last."""
    best = scored.groupBy("id").agg(F.max(F.struct("scored_at", "model", "pyplexity_score", "text")).alias("m"))
    return best.select("id", "m.text", "m.pyplexity_score", "m.model", "m.scored_at")
