"""Corpus analytics: frequencies, term weights, similarity, vocabulary growth, entities over time."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import nlp, text
from ..functions.constants import ALL_STOP_WORDS, NEGATIONS, SENTIMENT, STOP_WORDS
from ..functions.text import round_half_up


def token_rows(docs: DataFrame, stop: tuple[str, ...] = ALL_STOP_WORDS) -> DataFrame:
    """(doc_id, token), one row per occurrence of a lower-case word of the stripped text, longer than two characters and no stop word."""
    plain = F.lower(text.strip_markdown(F.coalesce("text", F.lit(""))))
    rows = docs.select("doc_id", F.explode(F.split(plain, text.BREAKS)).alias("token"))
    return rows.where((F.length("token") > 2) & ~F.col("token").isin(*stop))


def tokens_per_doc(docs: DataFrame) -> DataFrame:
    listed = text.words(F.coalesce("text", F.lit("")))
    return docs.select("doc_id", F.size(listed).cast("long").alias("n_tokens"), F.size(F.array_distinct(listed)).cast("long").alias("n_distinct"))


def corpus_stats(docs: DataFrame) -> DataFrame:
    """Documents, words, distinct words, mean words and mean word length."""
    per_word = docs.select(F.explode(text.words(F.coalesce("text", F.lit("")))).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    sums = per_word.agg(F.sum("n").alias("n_words"), F.count("*").alias("n_distinct"), F.sum(F.col("n") * F.length("w")).alias("chars"))
    both = sums.crossJoin(docs.agg(F.count("*").alias("n_docs")))  # one row each
    ratio = lambda a, b: round_half_up(F.try_divide(F.col(a), F.col(b)), 1000)
    return both.select("n_docs", "n_words", "n_distinct", ratio("n_words", "n_docs").alias("mean_words"), ratio("chars", "n_words").alias("mean_length"), ratio("n_distinct", "n_words").alias("type_token"))


def top_words(docs: DataFrame, k: int = 20) -> DataFrame:
    rows = docs.select(F.explode(text.words(F.lower(F.coalesce("text", F.lit(""))))).alias("word"))
    rows = rows.where((F.length("word") > 3) & ~F.col("word").isin(*STOP_WORDS))
    return rows.groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(k)


def top_bigrams(docs: DataFrame, k: int = 15) -> DataFrame:
    """Pairs of neighbouring words, neither a stop word; pairs are joined to strings after they are counted."""
    w = F.col("w")
    listed = docs.select(text.words(F.lower(F.coalesce("text", F.lit("")))).alias("w")).where(F.size(w) > 1)
    sides = F.arrays_zip(F.slice(w, F.lit(1), F.size(w) - 1).alias("a"), F.slice(w, F.lit(2), F.size(w) - 1).alias("b"))
    pairs = listed.select(F.inline(sides)).where(~F.col("a").isin(*STOP_WORDS) & ~F.col("b").isin(*STOP_WORDS))
    counted = pairs.groupBy("a", "b").agg(F.count("*").alias("n"))
    return counted.select(F.concat_ws(" ", "a", "b").alias("bigram"), "n").orderBy(F.desc("n"), "bigram").limit(k)


def term_weights(docs: DataFrame) -> DataFrame:
    """(doc_id, token, tf, df, tfidf) with tfidf = tf * (1 + ln(N / (1 + df)))."""
    tf = token_rows(docs).groupBy("doc_id", "token").agg(F.count("*").alias("tf"))
    df = tf.groupBy("token").agg(F.count("*").alias("df"))
    n = docs.agg(F.count("*").alias("n_docs"))
    return tf.join(df, "token").crossJoin(F.broadcast(n)).select("doc_id", "token", "tf", "df", (F.col("tf") * (1 + F.log(F.col("n_docs") / (1 + F.col("df"))))).alias("tfidf"))


def top_terms(docs: DataFrame, k: int = 10) -> DataFrame:
    weight = round_half_up(F.col("tfidf"), 1000)
    ranked = term_weights(docs).select("doc_id", "token", weight.alias("tfidf"))
    order = Window.partitionBy("doc_id").orderBy(F.desc("tfidf"), "token")
    return ranked.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= k)


def similar_documents(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """(a, b, similarity) of all pairs a < b whose cosine over term weights is least or more.

    A document's terms stand from rare to common; once what follows is too short a vector for the cosine, no term there
    can be a pair's first common one. Only the terms before it propose pairs; those are then computed in full.
    """
    w = term_weights(docs).where("tfidf <> 0")
    norm = w.groupBy("doc_id").agg(F.sqrt(F.sum(F.col("tfidf") * F.col("tfidf"))).alias("norm"))
    w = w.join(norm, "doc_id").select("doc_id", "token", "df", (F.col("tfidf") / F.col("norm")).alias("x"))
    rest = Window.partitionBy("doc_id").orderBy(F.desc("df"), F.desc("token")).rowsBetween(Window.unboundedPreceding, 0)
    lead = w.withColumn("rest", F.sqrt(F.sum(F.col("x") * F.col("x")).over(rest))).where(F.col("rest") >= least - 1e-9).select("doc_id", "token")
    other = lead.select(F.col("doc_id").alias("b"), "token")
    pairs = lead.select(F.col("doc_id").alias("a"), "token").join(other, "token").where("a < b").select("a", "b").distinct()
    left = w.select(F.col("doc_id").alias("a"), "token", F.col("x").alias("x"))
    right = w.select(F.col("doc_id").alias("b"), "token", F.col("x").alias("y"))
    full = pairs.join(left, "a").join(right, ["b", "token"]).groupBy("a", "b").agg(F.sum(F.col("x") * F.col("y")).alias("s"))
    return full.select("a", "b", round_half_up(F.col("s"), 1000).alias("similarity")).where(F.col("similarity") >= least)


def similarity_matrix(docs: DataFrame) -> DataFrame:
    """(a, b, similarity) of every pair of a small archive, zeros and the diagonal included: a row a pair by definition."""
    w = term_weights(docs)
    norm = w.groupBy("doc_id").agg(F.sqrt(F.sum(F.col("tfidf") * F.col("tfidf"))).alias("norm"))
    x = w.join(norm, "doc_id").select("doc_id", "token", (F.col("tfidf") / F.col("norm")).alias("x"))
    dots = x.select(F.col("doc_id").alias("a"), "token", "x").join(x.select(F.col("doc_id").alias("b"), "token", F.col("x").alias("y")), "token").where("a < b").groupBy("a", "b").agg(F.sum(F.col("x") * F.col("y")).alias("s"))
    dots = dots.unionByName(dots.select(F.col("b").alias("a"), F.col("a").alias("b"), "s"))
    ids = docs.select("doc_id").distinct()
    grid = ids.select(F.col("doc_id").alias("a")).crossJoin(ids.select(F.col("doc_id").alias("b")))
    value = F.when(F.col("a") == F.col("b"), 1.0).otherwise(round_half_up(F.coalesce("s", F.lit(0.0)), 1000))
    return grid.join(dots, ["a", "b"], "left").select("a", "b", value.alias("similarity"))


def vocabulary_growth(docs: DataFrame, group: str | None = None) -> DataFrame:
    """New and cumulative distinct tokens in order of doc_id, overall or in each group; documents without new ones stay.

    Each token counts at its first document, so the only ordered pass is over documents. Running totals are built from
    totals of id ranges, so that no task sees all documents.
    """
    keys = [group] if group else []
    rows = docs.where(F.col(group).isNotNull()) if group else docs
    seen = rows.select(*keys, "doc_id", F.explode(text.distinct_tokens(F.coalesce("text", F.lit("")))).alias("token"))
    first = seen.groupBy(*keys, "token").agg(F.min("doc_id").alias("doc_id"))
    new = first.groupBy(*keys, "doc_id").agg(F.count("*").alias("new"))
    base = rows.select(*keys, "doc_id").join(new, [*keys, "doc_id"], "left").withColumn("new", F.coalesce("new", F.lit(0)))
    base = base.withColumn("block", F.floor(F.col("doc_id") / 4096))
    within = Window.partitionBy(*keys, "block").orderBy("doc_id").rowsBetween(Window.unboundedPreceding, 0)
    blocks = base.groupBy(*keys, "block").agg(F.sum("new").alias("n"))
    before = F.sum("n").over(Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    blocks = blocks.select(*keys, "block", before.alias("before"))
    out = base.join(blocks, [*keys, "block"])
    return out.select(*keys, "doc_id", F.col("new").alias("new_tokens"), (F.sum("new").over(within) + F.col("before")).alias("vocabulary"))


def readability(docs: DataFrame) -> DataFrame:
    plain = docs.select("doc_id", text.strip_markdown(F.coalesce("text", F.lit(""))).alias("t"))
    parts = plain.select("doc_id", F.size(text.spaced_words(F.col("t"))).alias("n_words"), F.size(text.sentences(F.col("t"))).alias("n_sentences"), text.text_syllables(F.col("t")).alias("n_syllables"))
    grade = text.reading_grade(F.col("n_words"), F.col("n_sentences"), F.col("n_syllables"))
    return parts.select("doc_id", F.col("n_words").cast("long").alias("n_words"), F.col("n_sentences").cast("long").alias("n_sentences"), F.col("n_syllables").cast("long").alias("n_syllables"), round_half_up(grade, 100).alias("readability"))


def sentence_stats(docs: DataFrame) -> DataFrame:
    """Mean, median and population deviation of words per sentence; zeros without sentences."""
    size = F.transform(text.sentences(text.strip_markdown(F.coalesce("text", F.lit("")))), lambda s: F.size(F.split(s, r"\s+")))
    rows = docs.select("doc_id", F.array_sort(size).alias("s"))
    n, s = F.size("s"), F.col("s")
    total = F.aggregate(s, F.lit(0).cast("long"), lambda a, x: a + x)
    squares = F.aggregate(s, F.lit(0).cast("long"), lambda a, x: a + x.cast("long") * x)
    mid = (F.get(s, F.floor((n - 1) / 2).cast("int")) + F.get(s, F.floor(n / 2).cast("int"))) / 2.0
    mean = total / n
    out = [F.when(n == 0, 0.0).otherwise(round_half_up(v, 100)).alias(name) for v, name in ((mean, "mean"), (mid, "median"))]
    deviation = F.when(n < 2, 0.0).otherwise(round_half_up(F.sqrt(F.greatest(F.lit(0.0), squares / n - mean * mean)), 100))
    return rows.select("doc_id", n.cast("long").alias("n_sentences"), *out, deviation.alias("stdev"))


def prose_shape(docs: DataFrame) -> DataFrame:
    t = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", round_half_up(text.question_density(text.strip_markdown(t)), 1000).alias("question_density"), round_half_up(text.list_ratio(t), 1000).alias("list_ratio"), text.opening_line(t).alias("opening"), text.paragraph_count(t).cast("long").alias("n_paragraphs"))


def sentiment(docs: DataFrame, lexicon: dict[str, int] | None = None) -> DataFrame:
    """Sum and mean over tokens of lexicon values; from the first negation on, signs turn."""
    values = SENTIMENT if lexicon is None else lexicon
    listed = text.words(F.lower(F.coalesce("text", F.lit(""))))
    table = F.create_map(*(F.lit(x) for pair in sorted(values.items()) for x in pair))
    rows = docs.select("doc_id", listed.alias("w"))
    turn = F.array_min(F.filter(F.array(*(F.nullif(F.array_position("w", n), F.lit(0)) for n in NEGATIONS)), lambda p: p.isNotNull()))
    rows = rows.select("doc_id", "w", F.coalesce(turn, F.lit(2**31 - 1).cast("long")).alias("turn"))
    scores = F.zip_with(F.col("w"), F.sequence(F.lit(1), F.greatest(F.size("w"), F.lit(1))), lambda w, k: F.coalesce(table[w], F.lit(0)) * F.when(k > F.col("turn"), -1).otherwise(1))
    total = F.aggregate(scores, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))
    rows = rows.select("doc_id", total.cast("long").alias("score"), F.size("w").alias("n"))
    return rows.select("doc_id", "score", round_half_up(F.coalesce(F.try_divide(F.col("score"), F.col("n")), F.lit(0.0)), 1000).alias("comparative"))


def content_evolution(docs: DataFrame, quarters: int = 4) -> DataFrame:
    """Documents and words in contiguous quarters of the archive by doc_id; the first ones are the fuller.

    Counts of id ranges tell which ranges hold the quarters' bounds; only those few are ordered by doc_id.
    """
    block = F.floor(F.col("doc_id") / 4096)
    sizes = docs.groupBy(block.alias("block")).agg(F.count("*").alias("n"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    size = max(1, -(-total // quarters))
    run = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, 0)  # a row for each 4,096 ids
    places = sizes.select("block", (F.sum("n").over(run) - F.col("n")).alias("before"), "n")
    holds = places.where(f"floor((before + n - 1) / {size}) > floor((before - 1) / {size})").collect()  # a row a quarter at most
    starts = {}
    for r in holds:
        for k in range(-(-r["before"] // size), (r["before"] + r["n"] - 1) // size + 1):
            first = docs.where(block == r["block"]).select("doc_id").sort("doc_id").offset(size * k - r["before"]).limit(1)
            starts[k] = first.first()["doc_id"]
    quarter = F.lit(0)
    for k in sorted(starts)[1:]:
        quarter = F.when(F.col("doc_id") >= starts[k], k).otherwise(quarter)
    rows = docs.select(quarter.cast("long").alias("quarter"), F.size(text.words(F.coalesce("text", F.lit("")))).alias("w"))
    return rows.groupBy("quarter").agg(F.count("*").alias("n_docs"), F.sum("w").alias("n_words"))


def stems(docs: DataFrame, k: int = 50) -> DataFrame:
    """Stems that several of the k most frequent words share, with those words by rank."""
    top = top_words(docs, k).withColumn("stem", nlp.stem("word"))
    grouped = top.groupBy("stem").agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("r"), "word"))).alias("w"))
    return grouped.where(F.size("w") > 1).select("stem", F.transform("w", lambda x: x["word"]).alias("words"))


def similar_terms(docs: DataFrame, targets: list[str], least: float = 0.8) -> DataFrame:
    """Vocabulary words whose Jaro-Winkler similarity with a target is over least; the targets are a short list."""
    vocabulary = docs.select(F.explode(text.words(F.lower(F.coalesce("text", F.lit(""))))).alias("word")).distinct()
    pairs = vocabulary.withColumn("target", F.explode(F.array(*map(F.lit, targets))))
    return pairs.withColumn("s", nlp.similarity("target", "word")).where(F.col("s") > least).select("target", "word", round_half_up(F.col("s"), 1000).alias("similarity"))


def keyword_counts(docs: DataFrame, found: Column, k: int) -> DataFrame:
    return docs.select(F.explode(found).alias("term")).groupBy("term").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "term").limit(k)


def document_entities(docs: DataFrame, k: int = 20) -> DataFrame:
    """Each document's k most frequent entities."""
    rows = docs.select("doc_id", F.explode(nlp.entities(F.coalesce("text", F.lit("")))).alias("entity")).groupBy("doc_id", "entity").agg(F.count("*").alias("n"))
    order = Window.partitionBy("doc_id").orderBy(F.desc("n"), "entity")
    return rows.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= k)


def entities_over_time(docs: DataFrame, k: int = 15) -> DataFrame:
    """The k entities with the highest totals over the documents' own top lists, in every document (0 where absent)."""
    per_doc = document_entities(docs)
    top = per_doc.groupBy("entity").agg(F.sum("n").alias("total")).orderBy(F.desc("total"), "entity").limit(k).select("entity")
    grid = docs.select("doc_id").crossJoin(F.broadcast(top))  # k rows a document by definition
    return grid.join(per_doc.select("doc_id", "entity", "n"), ["doc_id", "entity"], "left").select("doc_id", "entity", F.coalesce("n", F.lit(0)).alias("n"))


def dense_similarity(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, similarity): the cosine of each vector with its label's centroid, computed on whole arrays."""
    centre = vectors.groupBy("label").agg(vector_to_array(Summarizer.mean(array_to_vector(F.col("embedding").cast("array<double>")))).alias("c"))
    both = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("x")).join(centre, "label")
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda t, x: t + x)
    x, c = F.col("x"), F.col("c")
    return both.select("vec_id", "label", round_half_up(dot(x, c) / F.sqrt(dot(x, x) * dot(c, c)), 1000).alias("similarity"))


def posts_with_metadata(posts: DataFrame, metadata: DataFrame, order: str) -> DataFrame:
    """Posts with the columns of their metadata by filename; of rows that repeat a filename the last by order wins."""
    last = metadata.groupBy("filename").agg(F.max_by(F.struct(*(c for c in metadata.columns if c != "filename")), order).alias("m_"))
    return posts.join(last, "filename", "left").select(*posts.columns, *(F.col(f"m_.{c}") for c in metadata.columns if c not in ("filename", order)))


def structure_report(posts: DataFrame) -> DataFrame:
    """A row of structural metrics for each Markdown post (filename, text); posts whose names tell no date are special."""
    t = F.coalesce("text", F.lit(""))
    date = text.date_from_filename(F.col("filename"))
    special = F.when(date.isNull(), F.regexp_replace("filename", r"\.md", ""))
    words_ = F.size(text.words(text.structural_clean(t)))
    return posts.select("filename", date.alias("date"), special.alias("special"), *(c.cast("long").alias(k) for k, c in {"n_words": words_, "n_paragraphs": text.paragraph_count(t), "n_links": F.size(text.links(t)), "n_images": text.image_count(t), "n_headings": F.size(text.headings(t))}.items()))


def structure_totals(report: DataFrame) -> DataFrame:
    """Totals and means (2 places) of words over dated posts and of images over all."""
    regular = F.col("special").isNull()
    mean = lambda c: round_half_up(F.coalesce(F.avg(c), F.lit(0.0)), 100)
    return report.agg(
        F.count("*").alias("n_posts"), F.count_if(regular).alias("n_regular"), F.coalesce(F.sum(F.when(regular, F.col("n_words"))), F.lit(0)).alias("n_words"), mean(F.when(regular, F.col("n_words"))).alias("mean_words"),
        F.coalesce(F.sum("n_images"), F.lit(0)).alias("n_images"), mean("n_images").alias("mean_images"),
    )
