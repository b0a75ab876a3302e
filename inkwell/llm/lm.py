"""Language-model scores: prediction by partial matching over the bytes of whole texts, and an additive unigram base.

A text is the bytes of its words, each closed by a space, and one end. Contexts are the ORDER bytes before a symbol,
across spaces. Counts of short contexts go to all workers while they are few enough. Texts are written as packed blocks.
A block asks for each of its distinct grams (a context and its symbol) once; grams are counted and priced where those
whose contexts end in the same bytes meet; and the prices go back to the block, which adds them up along its texts. Words
of the base live in a table; a bounded head of the most frequent ones is sent to the workers, and the rest is joined.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import U64, mix, releasing, slices, sums, utf8
from .neardup import groups
from .sampling import in_fold
from .store import materialize, parallelism, spread_by_doc

ORDER = 5
#: The share of an occurrence of each distinct symbol that a context sets aside for escapes.
ESCAPE = 0.3
#: Words, and rows of counts of short contexts, sent to workers at most.
HEAD_WORDS, SHORT = 150_000, 500_000
#: Longest context whose counts may be sent.
DEEP = 3
#: Bytes of text of a block, and for each part of the trie, about.
BLOCK, PART = 4 << 20, 6 << 20
_SLICE = 1 << 24
#: The symbol that closes a word, the one that ends a text, and what fills contexts before a text.
_SPACE, _END, _FILL = 32, 10, 9


def split_words(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words, A-Z lower-cased, and each row's number of them."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(column.fill_null("")))
    words, size = lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    good = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    return words.filter(pa.array(good)), sums(good, np.concatenate([[0], np.cumsum(size)]))


@releasing
def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch, limit=_SLICE):
            words, n = split_words(piece.column("text"))
            learn = np.repeat(piece.column("learn").to_numpy(zero_copy_only=False), n).astype(np.int64)
            coded = words.dictionary_encode()
            c = np.bincount(coded.indices.to_numpy(), weights=learn, minlength=len(coded.dictionary)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([coded.dictionary, pa.array(c)], names=["word", "c"])


def _stream(words: pa.Array, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(flat, bounds): the bytes of texts of n words each, with ORDER bytes of context before and the end behind each."""
    rows = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), words)
    data, offsets = utf8(pc.binary_join(rows, " "))
    size = np.diff(offsets) + ORDER + (n > 0) + 1
    bounds = np.concatenate([[0], np.cumsum(size)])
    flat = np.full(int(bounds[-1]), _FILL, dtype=np.uint8)
    inner = np.repeat(bounds[:-1] + ORDER - offsets[:-1], np.diff(offsets))
    inner += np.arange(len(data))
    flat[inner] = data
    flat[bounds[:-1] + ORDER - 1] = _SPACE
    flat[bounds[1:][n > 0] - 2] = _SPACE
    flat[bounds[1:] - 1] = _END
    return flat, bounds


def stream_keys(words: pa.Array, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, bounds): for each symbol of texts of n words each its context and itself as one integer; a text's lie between its bounds."""
    flat, bounds = _stream(words, n)
    is_symbol = np.ones(len(flat), dtype=bool)
    for k in range(ORDER):
        is_symbol[bounds[:-1] + k] = False
    key = np.zeros(len(flat), dtype=np.int64)
    for k in range(ORDER, -1, -1):
        key <<= 8
        key[k:] |= flat[: len(flat) - k]
    return key[is_symbol], bounds - ORDER * np.arange(len(bounds))


def gram_keys(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """stream_keys of a text column."""
    return stream_keys(*split_words(column))


@releasing
def _short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often texts to learn from have each gram of DEEP context bytes."""
    for batch in batches:
        for piece in slices(batch.filter(batch.column("learn")), limit=_SLICE >> 3):
            gram, c = np.unique((gram_keys(piece.column("text"))[0] & 0xFFFFFFFF).astype(np.uint32), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(gram.astype(np.int64)), pa.array(c.astype(np.int64))], names=["gram", "c"])


def distinct(keys: np.ndarray) -> np.ndarray:
    """The distinct keys in ascending order; for integers np.unique takes many times as long, since it hashes each."""
    keys = np.sort(keys)
    return keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys


def part_of(gram: np.ndarray, parts: int, depth: int) -> np.ndarray:
    """The part of the trie that holds a gram: all whose contexts end in the same depth bytes are in one."""
    tail = ((gram >> 8) & ((1 << 8 * depth) - 1)).astype(U64)
    return (mix(tail) % U64(parts)).astype(np.int64)


def _packed(data: bytes | pa.Buffer) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _unpacked(data: bytes) -> pa.Buffer:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd")


def _planes(values: np.ndarray) -> bytes:
    """All values packed, the lowest byte of each first, then the next ones."""
    return _packed(values.view(np.uint8).reshape(len(values), -1).T.tobytes())


def _from_planes(data: bytes, kind: type) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(_unpacked(data), np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


@releasing
def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of about BLOCK bytes of text (one row at least)."""
    block = TaskContext.get().partitionId() << 36
    held, size = [], 0

    def packed() -> pa.RecordBatch:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, held[0].schema) as out:
            for piece in held:
                out.write_batch(piece)
        return pa.RecordBatch.from_arrays([pa.array([block]), pa.array([_packed(sink.getvalue())], pa.binary())], names=["block", "data"])

    for batch in batches:
        for piece in slices(batch):
            held.append(piece)
            size += len(utf8(piece.column("text"))[0])
            if size >= BLOCK:
                yield packed()
                block, held, size = block + 1, [], 0
    if held:
        yield packed()


def _texts(data: bytes) -> Iterator[pa.RecordBatch]:
    """A block's rows in runs of about 1 MB of text."""
    return iter(pa.ipc.open_stream(_unpacked(data)))


@releasing
def _ask(batches: Iterator[pa.RecordBatch], parts: int, depth: int) -> Iterator[pa.RecordBatch]:
    """Of each block and part the sorted distinct grams and how often rows to learn from have them."""
    for block, data in ((r["block"], r["data"]) for batch in batches for k in range(batch.num_rows) for r in batch.slice(k, 1).to_pylist()):
        found, counts = [], []
        for piece in _texts(data):
            key, bounds = gram_keys(piece.column("text"))
            key <<= 1
            key |= np.repeat(piece.column("learn").to_numpy(zero_copy_only=False), np.diff(bounds))
            key.sort()
            first = np.concatenate([[True], (key[1:] ^ key[:-1]) > 1]).nonzero()[0]
            counts.append(np.add.reduceat(key.astype(np.int8) & 1, first, dtype=np.int32))
            found.append(key[first] >> 1)
        gram, of = np.unique(np.concatenate(found), return_inverse=True)
        c = np.bincount(of, weights=np.concatenate(counts)).astype(np.int32)
        part = part_of(gram, parts, depth)
        order = np.argsort(part, kind="stable")
        cuts = np.concatenate([[0], np.cumsum(np.bincount(part, minlength=parts))])
        asked = [(p, order[cuts[p] : cuts[p + 1]]) for p in range(parts) if cuts[p] < cuts[p + 1]]
        columns = [pa.array([p for p, _ in asked]), pa.array([block] * len(asked)), pa.array([_planes(np.diff(gram[at], prepend=0)) for _, at in asked], pa.binary()), pa.array([_planes(c[at]) for _, at in asked], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "block", "grams", "counts"])


class Level:
    """Counts of one order: of each context its occurrences, distinct symbols, and how often those follow the next shorter one."""

    def __init__(self, order: int, gram: np.ndarray, c: np.ndarray, shorter: Level | None):
        """gram: sorted distinct grams; c: how often each occurs, 0 for those that are only asked for."""
        if not len(gram):
            gram, c = np.array([-1]), np.zeros(1)  # matches nothing
        self.order, self.gram, self.c = order, gram, c.astype(float)
        self.context, of = np.unique(gram >> 8, return_inverse=True)
        self.total = np.bincount(of, weights=self.c)
        self.distinct = np.bincount(of, weights=self.c > 0)
        follow = shorter.find(gram)[0] if shorter else np.zeros(len(gram))
        self.seen = np.bincount(of, weights=follow * (self.c > 0))

    def find(self, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(count, place of the context, whether the context is known) for the ends of longer grams."""
        gram = gram & ((1 << 8 * self.order + 8) - 1)
        at = np.minimum(np.searchsorted(self.gram, gram), len(self.gram) - 1)
        count = np.where(self.gram[at] == gram, self.c[at], 0.0)
        context = gram >> 8
        at = np.minimum(np.searchsorted(self.context, context), len(self.context) - 1)
        return count, at, self.context[at] == context


def levels_of(gram: np.ndarray, c: np.ndarray, top: int, shorter: list[Level]) -> list[Level]:
    """Levels of all orders to top, those beyond the given shorter ones from sorted distinct grams of order top and their counts."""
    tables = []
    for order in range(top, len(shorter) - 1, -1):
        tables.append((order, gram, c))
        gram, of = np.unique(gram & ((1 << 8 * order) - 1), return_inverse=True)
        c = np.bincount(of, weights=c, minlength=len(gram))
    out = list(shorter)
    for order, gram, c in reversed(tables):
        out.append(Level(order, gram, c, out[-1] if out else None))
    return out


def trie_scores(gram: np.ndarray, c: np.ndarray, short: list[Level]) -> np.ndarray:
    """log10 P(symbol | context) of sorted distinct grams and their counts, all of those that share their last len(short) context bytes.

    short: the levels of all shorter orders. A share ESCAPE of an occurrence of each distinct symbol is set aside for
    escapes; symbols that a longer context has seen are left out of shorter ones.
    """
    levels = levels_of(gram, c, ORDER, short)
    out, open_, started = np.zeros(len(gram)), np.ones(len(gram), dtype=bool), np.zeros(len(gram), dtype=bool)
    known, seen = np.zeros(len(gram)), np.zeros(len(gram))  # symbols of the longer context, and how often they follow this one
    for level in reversed(levels):
        count, at, has = level.find(gram)
        total, kinds = np.where(has, level.total[at], 0.0), np.where(has, level.distinct[at], 0.0)
        left, others = np.where(started, total - seen, total), np.where(started, kinds - known, kinds)
        live = open_ & (total > 0)
        hit = live & (count > 0)
        miss = live & ~hit & (others > 0)
        out[hit] += np.log10((count[hit] - ESCAPE) / left[hit])
        out[miss] += np.log10(ESCAPE * others[miss] / left[miss])
        started |= live
        open_ &= ~hit
        known, seen = kinds, np.where(has, level.seen[at], 0.0)
    out[open_] -= np.log10(max(1, 256 - int(levels[0].distinct.sum())))
    return out


@releasing
def _price(batches: Iterator[pa.RecordBatch], sent: Broadcast) -> Iterator[pa.RecordBatch]:
    """log10 probabilities of the grams that each block asks a part for, in the block's order."""
    short = None
    for table in groups(batches, ["part"]):
        top, gram, c = sent.value
        short = short if short is not None else levels_of(gram, c, top, [])
        asked = [np.cumsum(_from_planes(g, np.int64)) for g in table.column("grams").to_pylist()]
        cuts = np.cumsum([0, *map(len, asked)])
        gram, place = np.unique(np.concatenate(asked), return_inverse=True)
        c = np.bincount(place, weights=np.concatenate([_from_planes(x, np.int32) for x in table.column("counts").to_pylist()]))
        ppm = trie_scores(gram, c, short).astype(np.float32)
        for k, block in enumerate(table.column("block").to_pylist()):
            prices = pa.array([_planes(ppm[place[cuts[k] : cuts[k + 1]]])], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([block]), table.column("part")[k : k + 1].combine_chunks(), prices], names=["block", "part", "data"])


def fit_short(table: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """(order, grams, counts) of the longest contexts up to DEEP that have SHORT rows at most; 65,536 rows are always sent."""
    counted = materialize(table.mapInArrow(_short, "gram long, c long").groupBy("gram").agg(F.sum("c").alias("c")), "short")
    for order in range(DEEP, 0, -1):
        own = counted.groupBy(F.col("gram").bitwiseAND((1 << 8 * order + 8) - 1).alias("gram")).agg(F.sum("c").alias("c")) if order < DEEP else counted
        if order == 1 or own.count() <= SHORT:
            rows = own.orderBy("gram").toPandas()  # SHORT rows at most
            return order, rows["gram"].to_numpy(np.int64), rows["c"].to_numpy(float)
    raise AssertionError


@releasing
def _score_docs(batches: Iterator[pa.RecordBatch], head: Broadcast, scale: float, parts: int, depth: int) -> Iterator[pa.RecordBatch]:
    words_, c_ = head.value
    base_ = np.log10((c_ + 0.1) / scale)
    row = TaskContext.get().partitionId() << 36
    for table in groups(batches, ["block"]):
        answers = dict(zip(*(table.column(k).to_pylist() for k in ("part", "data")), strict=True))
        held, found = [], []
        for piece in _texts(answers.pop(None)):
            words, n = split_words(piece.column("text"))
            key, ends = stream_keys(words, n)
            grams = pa.array(key).dictionary_encode()  # a block's keys together would take much memory
            del key
            found.append(grams.dictionary.to_numpy())
            coded = words.dictionary_encode()
            place = pc.index_in(coded.dictionary, value_set=words_)
            known = place.is_valid().to_numpy(zero_copy_only=False)
            at = place.fill_null(0).to_numpy(zero_copy_only=False)
            code = coded.indices.to_numpy()
            bounds = np.concatenate([[0], np.cumsum(n)])
            of = lambda v, known=known, at=at, code=code, bounds=bounds: sums((np.where(known, v[at], 0) if len(v) else np.zeros(len(known)))[code], bounds)
            rest = ~known[code]
            left = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sums(rest, bounds))]).astype(np.int32)), words.filter(pa.array(rest)))
            own = [pa.array(np.arange(row, row + len(n))), piece.column("doc_id"), piece.column("learn"), pa.array(n.astype(np.int64)), pa.array(of(c_ > 0).astype(np.int64)), pa.array(of(base_).astype(float)), left]
            held.append((grams.indices.to_numpy(), ends, own))
            row += len(n)
        gram = distinct(np.concatenate(found))
        ppm = np.empty(len(gram))
        ppm[np.argsort(part_of(gram, parts, depth), kind="stable")] = np.concatenate([_from_planes(answers[p], np.float32) for p in sorted(answers)])
        for asked, (at, ends, own) in zip(found, held, strict=True):
            order = np.argsort(asked)
            of_asked = np.empty(len(asked))
            of_asked[order] = ppm[np.searchsorted(gram, asked[order])]
            price = np.add.reduceat(of_asked[at], ends[:-1])
            yield pa.RecordBatch.from_arrays([*own, pa.array(price)], names=["row", "doc_id", "learn", "n", "known", "base", "rest", "ppm"])


def _head(table: DataFrame, bound: int) -> DataFrame:
    """The rows with the highest c, all with more than some count, bound at most."""
    cell = F.floor(F.log2(F.col("c") + 1) * 16).cast("int").alias("cell")
    cells = sorted(table.where("c > 0").groupBy(cell).count().collect(), reverse=True)  # a few hundred rows
    least, total = float("inf"), 0
    for r in cells:
        total += r["count"]
        if total > bound:
            break
        least = r["cell"]
    return table.where("c > 0").where(F.floor(F.log2(F.col("c") + 1) * 16) >= F.lit(least)) if cells and least < float("inf") else table.where("false")


def score_texts(docs: DataFrame, folds: int = 10, held_out: int = 0) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10 probabilities) of each row of docs.

    Rows whose crc32(doc_id as text) mod folds is held_out are scored but not learnt from; a null doc_id is learnt from.
    Null and empty texts are the end alone. Repeated rows count each; further columns are ignored. Without training
    rows every symbol costs log10(256) and train_tokens is 0.
    """
    spark = docs.sparkSession
    learn = (~in_fold(F.col("doc_id"), folds, held_out)).alias("learn")
    table = spread_by_doc(docs).select("doc_id", "text", learn)
    ends, size = table.agg(F.coalesce(F.sum(F.col("learn").cast("long")), F.lit(0)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    counted = table.mapInArrow(_count, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))
    vocabulary = materialize(counted, "words")
    n, v = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0)).first()
    n, v = n + ends, v + (ends > 0)
    # the trie
    short = fit_short(table)
    depth, shared = short[0] + 1, spark.sparkContext.broadcast(short)
    blocks, parts = max(parallelism(spark), size // BLOCK), max(parallelism(spark), size // PART)
    texts = materialize(table.mapInArrow(_pack, "block long, data binary"), "texts")
    asked = texts.mapInArrow(partial(_ask, parts=parts, depth=depth), "part long, block long, grams binary, counts binary")
    prices = asked.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(partial(_price, sent=shared), "block long, part long, data binary")
    # documents
    top = _head(vocabulary, HEAD_WORDS).toPandas()
    sent = spark.sparkContext.broadcast((pa.array(top["word"], pa.string()), top["c"].to_numpy(np.int64)))
    scale = n + 0.1 * (v + 1)
    both = texts.unionByName(prices, allowMissingColumns=True).repartition(blocks, "block").sortWithinPartitions("block")
    first = both.mapInArrow(partial(_score_docs, head=sent, scale=scale, parts=parts, depth=depth), "row long, doc_id long, learn boolean, n long, known long, base double, rest array<string>, ppm double")
    first = materialize(first, "scores")
    more = first.select("row", F.explode("rest").alias("word")).join(vocabulary, "word").groupBy("row")
    more = more.agg(F.sum(F.log10((F.col("c") + 0.1) / scale)).alias("base2"), F.count_if(F.col("c") > 0).alias("known2"))
    out = first.drop("rest").join(more, "row", "left")
    return out.select(
        "doc_id",
        (~F.col("learn")).alias("held_out"),
        (F.col("n") + 1).alias("n_tokens"),
        (F.col("known") + F.coalesce("known2", F.lit(0)) + int(ends > 0)).alias("n_known"),
        F.lit(int(n)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("base2", F.lit(0.0)) + float(np.log10((ends + 0.1) / scale))).alias("base_score"),
        F.col("ppm").alias("score"),
    )
