"""Benchmark decontamination as a prefix-filtered join, in DataFrame operations alone.

A window is a set of (word, offset) tokens that a document must contain whole, so its necessary prefix is one token:
the rarest word. Documents are joined with windows on that word; its position in the document fixes where the window
would have to lie, bounds drop what would stick out, and what is left is compared word by word.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import fresh, materialize

WINDOW = 13
#: What parts words, before A-Z are lower-cased.
_BREAKS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes that may be broadcast at once; larger tables of windows are joined block by block.
BROADCAST = 8 << 20


def words(text):
    """Array of a text's words in lower case, empty for null."""
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _BREAKS)
    return F.filter(parts, lambda w: w != "")


def windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """item_id, window (an array of words), of every item with words, each distinct pair once."""
    cut = items.select("item_id", words(F.col("text")).alias("w")).where("size(w) > 0")
    starts = F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - (size - 1))))
    return cut.select("item_id", "w", starts.alias("at")).select("item_id", F.slice("w", F.col("at"), size).alias("window")).distinct()


def _blocks(table: DataFrame, column: str, size) -> list[DataFrame]:
    """table in parts, by a hash of column, each small enough to broadcast."""
    total = table.agg(F.sum(size)).first()[0] or 0
    n = -(-int(total) // BROADCAST)
    return [table.where(F.pmod(F.xxhash64(column), F.lit(n)) == k) for k in range(n)]


def _rare_first(table: DataFrame, wanted: DataFrame) -> DataFrame:
    """wanted with each window's rarest word (prefix) and that word's offset; rarity is counted over all documents."""
    vocabulary = materialize(wanted.select(F.explode("window").alias("word")).distinct(), "vocabulary")
    spoken = table.select(F.explode(words(F.col("text"))).alias("word"))
    counts = None
    for block in _blocks(vocabulary, "word", F.length("word") + 32):
        part = spoken.join(F.broadcast(block), "word").groupBy("word").agg(F.count("*").alias("n"))
        counts = part if counts is None else counts.unionByName(part)
    if counts is None:
        return wanted.select("item_id", "window", F.lit("").alias("prefix"), F.lit(0).alias("offset"))
    # words that no document holds sort first: their windows can't occur
    tokens = wanted.select("item_id", "window", F.posexplode("window").alias("offset", "word")).join(counts, "word", "left")
    best = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("word"), F.col("offset"))).alias("best")
    chosen = tokens.groupBy("item_id", "window").agg(best).where("best.n > 0")
    return chosen.select("item_id", "window", F.col("best.word").alias("prefix"), F.col("best.offset").alias("offset"))


def _occurrences(table: DataFrame, wanted: DataFrame) -> DataFrame:
    """doc_id, row (a hash of the text), item_id, start and stop (words before and through) of each window found."""
    rare = materialize(_rare_first(table, wanted), "prefixes")
    spoken = table.select("doc_id", F.xxhash64("text").alias("row"), words(F.col("text")).alias("w"))
    spoken = spoken.select("doc_id", "row", "w", F.posexplode("w").alias("at", "prefix"))
    # no local rows: these would be a Python RDD, whose daemon and workers stay in every executor
    empty = table.sparkSession.range(0).selectExpr("id as doc_id", "id as row", "id as item_id", "int(id) as start", "int(id) as stop")
    for block in _blocks(rare, "prefix", F.size("window") * 32 + 64):
        start = F.col("at") - F.col("offset")
        fits = (start >= 0) & (start + F.size("window") <= F.size("w"))
        same = F.slice("w", F.greatest(F.lit(1), start + 1), F.size("window")) == F.col("window")
        pairs = spoken.join(F.broadcast(block), "prefix").where(fits).where(same)
        empty = empty.unionByName(pairs.select("doc_id", "row", F.col("item_id").cast("long").alias("item_id"), start.alias("start"), (start + F.size("window")).alias("stop")))
    return empty


def mark(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, items (item_ids as strings, sorted) and contaminated, one row per row of docs.

    A window is size successive words of an item, or all words of a shorter one; a document word inside an occurrence
    of a window is hit; contaminated means that at least a twentieth of the words are. Null and empty texts have no
    words and are clean; items without words match nothing, items that share an id count as one. Rows that share a
    doc_id are judged each by its own text; further columns are ignored; empty tables give no hits.
    """
    table = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    wanted = materialize(windows(items.select("item_id", F.col("text").cast("string").alias("text")), size), "windows")
    found = materialize(_occurrences(table, wanted), "occurrences")
    # words of the union of stretches: what each adds beyond the furthest end before it
    order = Window.partitionBy("doc_id", "row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    stretches = found.groupBy("doc_id", "row", "start").agg(F.max("stop").alias("stop"))
    before = F.coalesce(F.max("stop").over(order), F.lit(0))
    new = stretches.select("doc_id", "row", F.greatest(F.lit(0), F.col("stop") - F.greatest("start", before)).alias("new"))
    hits = new.groupBy("doc_id", "row").agg(F.sum("new").cast("long").alias("n_hit"))
    owners = found.select("doc_id", "row", F.col("item_id").cast("string").alias("item_id")).distinct()
    owners = owners.groupBy("doc_id", "row").agg(F.array_sort(F.collect_list("item_id")).alias("items"))
    own = hits.join(owners.withColumnRenamed("doc_id", "d").withColumnRenamed("row", "r"), F.expr("doc_id <=> d and row <=> r"), "left")
    own = own.select(F.col("doc_id").alias("d"), F.col("row").alias("r"), "n_hit", "items")
    base = table.select("doc_id", F.xxhash64("text").alias("row"), F.size(words(F.col("text"))).cast("long").alias("n_words"))
    out = base.join(own, F.expr("doc_id <=> d and row <=> r"), "left")
    out = out.select("doc_id", "row", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def drop_contaminated(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """The rows of docs that mark finds clean, with all their columns, whatever the names of further ones."""
    d, r = fresh(docs, "d_"), fresh(docs, "r_")
    bad = materialize(mark(docs, items, size).where("contaminated").select(F.col("doc_id").alias(d), F.col("row").alias(r)).distinct(), "contaminated")
    small = bad.count() * 64 <= BROADCAST
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(d)) & (F.xxhash64(F.col("text").cast("string")) == F.col(r))
    return docs.join(F.broadcast(bad) if small else bad, same, "left_anti")
