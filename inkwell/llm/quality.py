"""Quality rules: base counts and a hashed n-gram log-likelihood ratio between trusted and raw texts."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import U64, Words, grams, mix, releasing, slices, stretch_hashes, sums
from .sampling import agreed, rows_of
from .store import column_of, materialize, spread_by_doc

BUCKETS = 1 << 14
#: Scores are compared on this grid: GRID steps from -SPAN to SPAN.
SPAN, GRID = 8.0, 3200
_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_COUNTS = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])
_SCORED = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), ("score", pa.float64())])


def _features(words: Words, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words and word pairs, and each one's row."""
    shift = U64(64 - BUCKETS.bit_length() + 1)
    pair = grams(h, 2)
    same = words.doc[1:] == words.doc[:-1]
    return np.concatenate([(mix(h) >> shift), (pair[same] >> shift)]).astype(np.int32), np.concatenate([words.doc, words.doc[1:][same]])


@releasing
def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for piece in slices(batch):
            words = Words(piece.column("text"))
            n += np.bincount(_features(words, words.hashes())[0], minlength=BUCKETS)
    seen = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(n[seen])], schema=_COUNTS)


def _repeats(doc: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Which rows' keys occur twice or more within their document."""
    salted = mix(key ^ mix(doc.astype(U64) + U64(1)))
    order = np.argsort(salted)
    same = salted[order][1:] == salted[order][:-1]
    twice = np.zeros(len(key), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return twice


def base_counts(words: Words, h: np.ndarray) -> dict[str, np.ndarray]:
    data, offsets = words.data, words.offsets
    # lines: stretches between \n and row bounds, empty ones left out
    breaks = np.unique(np.concatenate([np.flatnonzero(data == 10), offsets - 1]))
    a, b = breaks[:-1] + 1, np.minimum(breaks[1:] + (data[np.maximum(breaks[1:], 0)] != 10 if len(data) else 0), len(data))
    a, b = a[b > a], b[b > a]
    filled = np.searchsorted(words.start, b) > np.searchsorted(words.start, a)
    a, b = a[filled], b[filled]
    owner = np.searchsorted(offsets, a, "right") - 1
    line = mix(stretch_hashes(data, a, b, words.table) ^ mix(owner.astype(U64) + U64(1)))
    _, first = np.unique(line, return_index=True)
    n_lines, n_distinct = np.bincount(owner, minlength=words.n_docs), np.bincount(owner[first], minlength=words.n_docs)
    covered = np.zeros(len(h), dtype=bool)
    if len(h) > 2:
        window = np.flatnonzero(words.doc[2:] == words.doc[:-2])
        hit = window[_repeats(words.doc[window], grams(h, 3)[window])]
        for k in range(3):
            covered[hit + k] = True
    return {
        "n_words": words.count.astype(np.int64),
        "word_chars": words.per_doc(~words.blank & ((data & 0xC0) != 0x80)),
        "n_symbols": words.per_doc(_SYMBOLS[data]),
        "n_dup_lines": (n_lines - n_distinct).astype(np.int64),
        "n_repeat_words": sums(covered, words.first),
    }


def judge(column: pa.Array, ratio: np.ndarray) -> dict[str, np.ndarray]:
    """Base counts and score of each row."""
    words = Words(column)
    h = words.hashes()
    out = base_counts(words, h)
    bucket, doc = _features(words, h)
    total = np.bincount(doc, weights=ratio[bucket], minlength=words.n_docs)
    return out | {"score": total / np.maximum(1, np.bincount(doc, minlength=words.n_docs))}


@releasing
def _score(batches: Iterator[pa.RecordBatch], ratio: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch):
            out = judge(piece.column("text"), ratio)
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), *(pa.array(out[c]) for c in _SCORED.names[1:])], schema=_SCORED)


def _counts(docs: DataFrame) -> np.ndarray:
    """Occurrences of each bucket in the texts of docs."""
    rows = docs.mapInArrow(_count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()  # BUCKETS rows at most
    out = np.zeros(BUCKETS)
    out[rows["bucket"]] = rows["n"]
    return out


def fit_ratio(docs: DataFrame, marks: DataFrame) -> np.ndarray:
    """log P(bucket | trusted) - log P(bucket | raw), smoothed by one; trusted are all documents marked 1, raw are all documents."""
    t, r = _counts(rows_of(docs, marks.where("label = 1").select("doc_id"))), _counts(docs)
    return np.log((t + 1) / (t + 1).sum()) - np.log((r + 1) / (r + 1).sum()) if t.any() else np.zeros(BUCKETS)


def fit_threshold(scored: DataFrame, marks: DataFrame) -> float:
    """The middle of the first run of grid values that best part all marked documents; errors on trusted documents count four times."""
    cell = F.floor((F.least(F.greatest(F.col("score"), F.lit(-SPAN)), F.lit(SPAN)) + SPAN) * (GRID / (2 * SPAN))).cast("int").alias("cell")
    rows = scored.where("not base_failed").join(marks, "doc_id").groupBy(cell, "label").count().toPandas()  # 2 * GRID rows at most
    below = np.zeros((2, GRID + 2))
    np.add.at(below, (rows["label"], rows["cell"] + 1), rows["count"])
    total = below.sum(axis=1)
    if not total.all():
        return -float("inf")
    share = below.cumsum(axis=1) / total[:, None]
    cost = 4 * share[1] + (1 - share[0])
    best = int(np.argmin(cost))
    rises = np.flatnonzero(cost[best:] > cost[best])
    middle = best + (int(rises[0]) - 1 if len(rises) else 0) / 2
    return -SPAN + middle * 2 * SPAN / GRID


def fit_quality(table: DataFrame, labels: DataFrame) -> tuple[DataFrame, np.ndarray, float]:
    """The scored table, the log ratios and the threshold."""
    marks = materialize(agreed(labels, "quality"), "marks")
    ratio = fit_ratio(table, marks)
    kinds = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, score double"
    scored = table.mapInArrow(partial(_score, ratio=ratio), kinds)
    scored = scored.withColumn("base_failed", F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words"))
    scored = materialize(scored, "quality")
    return scored, ratio, fit_threshold(scored, marks)


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the base counts, score, threshold, base_failed and kept for every document.

    The trusted target is all documents with quality 1, the raw corpus all documents. score is the
    mean log ratio over a document's words and word pairs, 0 without words; kept is not base_failed and score at or
    above the threshold. A null or empty text has counts of 0 and fails the base rule. Without labels of a class
    only the base rule decides; a document labelled both ways trains neither. Repeated rows are judged each by its own text; further columns are ignored.
    """
    scored, _, threshold = fit_quality(spread_by_doc(docs), labels)
    return scored.withColumn("threshold", F.lit(threshold)).withColumn("kept", ~F.col("base_failed") & (F.col("score") >= F.col("threshold")))


@releasing
def _keep(batches: Iterator[pa.RecordBatch], text: str, ratio: np.ndarray, threshold: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch, text):
            out = judge(piece.column(text), ratio)
            n = out["n_words"]
            yield piece.filter(pa.array((n >= 50) & (100 * out["n_repeat_words"] <= 50 * n) & (out["score"] >= threshold)))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that score_quality keeps, with all their columns, whatever the case of the names; nothing is shuffled."""
    _, ratio, threshold = fit_quality(spread_by_doc(docs), labels)
    return docs.mapInArrow(partial(_keep, text=column_of(docs, "text"), ratio=ratio, threshold=threshold), docs.schema)
