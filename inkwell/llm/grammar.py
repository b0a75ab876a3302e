"""Token ids in binary shards, compressed by a grammar of repeated pairs that allows random access."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .arrays import releasing, slices
from .encoding import encoder, ragged, tokenizer_path
from .store import parallelism, spread_by_doc

END = 0
#: Ids of a shard, at least (a shard holds whole documents).
SHARD = 1 << 20
#: Shards up to whose number their starts are broadcast; more are joined by a shuffle.
BROADCAST = 500_000
#: Pairs replaced in one pass over a shard at most (others wait for the next), and how often a pair occurs at least.
PAIRS, LEAST = 8192, 8
_BITS = 20
#: Places from which on pairs are counted exactly.
_FEW = 1 << 15
SHARDS = "part int, shard int, n_ids long, first_rule int, rule_counts array<int>, rules binary, rule_lengths binary, doc_ids array<bigint>, doc_symbols array<int>, doc_n_ids array<bigint>, symbols binary"
_SHARDS = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("n_ids", pa.int64()), ("first_rule", pa.int32()), ("rule_counts", pa.list_(pa.int32())), ("rules", pa.binary()), ("rule_lengths", pa.binary()), ("doc_ids", pa.list_(pa.int64())), ("doc_symbols", pa.list_(pa.int32())), ("doc_n_ids", pa.list_(pa.int64())), ("symbols", pa.binary())])


def _hashed(s: np.ndarray, places: np.ndarray, least: int, pairs: int, turn: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(heads, at, which, live) by a hashed count of the pairs at places: a place for one pair of each of the most frequent slots,
    where these pairs stand, which of them stands there, and where pairs stand whose slot is frequent at all.

    The hash changes from turn to turn, so that pairs which shared a slot part.
    """
    left, right = np.uint32(0x9E3779B1 + 2 * turn & 0xFFFFFFFF), np.uint32(0x85EBCA77 + 6 * turn & 0xFFFFFFFF)
    if 4 * len(places) > len(s):  # whole arrays are faster than their parts
        slot = (((s[:-1] * left) ^ (s[1:] * right)) >> np.uint32(32 - _BITS))[places].astype(np.int64)
    else:
        slot = (((s[places] * left) ^ (s[places + 1] * right)) >> np.uint32(32 - _BITS)).astype(np.int64)
    count = np.bincount(slot, minlength=1 << _BITS)
    frequent = count >= least
    often = np.flatnonzero(frequent)
    kept = np.flatnonzero(frequent[slot])
    live, slot = places[kept], slot[kept]
    if len(often) > pairs:
        some = count[often]
        often = often[some >= np.partition(some, -pairs)[-pairs]][:pairs]
    number = np.full(1 << _BITS, -1, dtype=np.int32)
    number[often] = np.arange(len(often))
    which = number[slot]
    own = np.flatnonzero(which >= 0)
    at, which = live[own], which[own]
    heads = np.empty(len(often), dtype=np.int64)
    heads[which[::-1]] = at[::-1]
    hit = s[at] == s[heads][which]
    hit &= s[at + 1] == s[heads + 1][which]
    hit = np.flatnonzero(hit)
    return heads, at[hit], which[hit], live


def _counted(s: np.ndarray, places: np.ndarray, after: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """As _hashed, by an exact count of the pairs at places and after: the heads are the most frequent pairs of which none can overlap another."""
    key = s[places].astype(np.uint64) << np.uint64(32) | s[after]
    order = np.argsort(key, kind="stable")
    cuts = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]]))
    n = np.diff(np.append(cuts, len(key)))
    good = np.flatnonzero(n >= least)
    good = good[np.argsort(-n[good], kind="stable")]
    where = order[ragged(cuts[good], n[good])]
    which = np.repeat(np.arange(len(good)), n[good])
    first = order[cuts[good]]
    lefts, rights, chosen = set(), set(), []
    for k, x, y in zip(range(len(first)), s[places[first]].tolist(), s[after[first]].tolist(), strict=True):
        if x not in rights and y not in lefts and x != y:
            chosen.append(k)
            lefts.add(x)
            rights.add(y)
    up = np.argsort(where)
    where, which = where[up], which[up]
    number = np.full(len(good), -1)
    chosen = chosen or list(range(len(good)))  # pairs of equal symbols overlap themselves alone
    number[chosen] = np.arange(len(chosen))
    own = number[which] >= 0
    return places[first[chosen]], places[where[own]], number[which[own]], places[where]


def _apart(at: np.ndarray, which: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of occurrences that overlap every second; after: the place behind each of at."""
    follows = np.flatnonzero(at[1:] == after[:-1]) + 1
    if not len(follows):
        return at, which
    opens = np.ones(len(follows), dtype=bool)  # what follows the first of a run
    opens[1:] = follows[1:] != follows[:-1] + 1
    begin = np.flatnonzero(opens)
    size = np.diff(np.append(begin, len(follows)))
    free = np.ones(len(at), dtype=bool)
    free[follows[(np.arange(len(follows)) - np.repeat(begin, size)) & 1 == 0]] = False
    free = np.flatnonzero(free)
    return at[free], which[free]


def _used(key: np.ndarray, at: np.ndarray, which: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs, as integers in ascending order, that have least occurrences, and those occurrences."""
    used = np.flatnonzero(np.bincount(which, minlength=len(key)) >= least)
    used = used[np.argsort(key[used])]
    renumber = np.full(len(key), -1, dtype=np.int64)
    renumber[used] = np.arange(len(used))
    which = renumber[which]
    if len(used) == len(key):
        return key[used], at, which
    own = np.flatnonzero(which >= 0)
    return key[used], at[own], which[own]


def _rule(key: np.ndarray) -> np.ndarray:
    return np.stack([key >> np.uint64(32), key & np.uint64(0xFFFFFFFF)], axis=1).astype(np.uint32)


def compress(ids: np.ndarray, ends: np.ndarray, first_rule: int, rounds: int | None = None, pairs: int = PAIRS, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(symbols, ends in symbols, rules of each round) for a run of documents that end before each of ends.

    Each round counts pairs of neighbours, takes the most frequent, gives each a nonterminal and replaces their
    occurrences from the left; of overlapping ones every second stays. No pair spans two documents. A pair that was not
    frequent can't become so unless it has a new nonterminal, so later rounds count only at places of frequent pairs and
    next to the last replacements. It ends when an exact count finds no pair least times (apart from overlapping
    occurrences of pairs of equal symbols), or after rounds if they are given. Once places are few, rounds touch these
    alone: replaced symbols are skipped by links until the end.
    """
    s, rules, base = ids.astype(np.uint32), [], first_rule
    last = np.zeros(len(s), dtype=bool)
    last[ends.astype(np.int64) - 1] = True
    places = np.flatnonzero(~last)
    exact, turn = False, 0
    while len(places) > _FEW and (rounds is None or turn < rounds):
        heads, at, which, live = _counted(s, places, places + 1, least) if exact else _hashed(s, places, least, pairs, turn)
        turn += 1
        at, which = _apart(at, which, at + 1)
        key, at, which = _used(s[heads].astype(np.uint64) << np.uint64(32) | s[heads + 1], at, which, least)
        if not len(key):
            places = places[:0] if exact else live
            exact = True
            continue
        exact = False
        s[at] = (base + which).astype(np.uint32)
        last[at] = last[at + 1]
        near = np.zeros(len(s), dtype=bool)
        near[live] = near[at] = True
        near[np.maximum(at - 1, 0)] = True
        stays = np.ones(len(s), dtype=bool)
        stays[at + 1] = False
        stays = np.flatnonzero(stays)
        s, last = s[stays], last[stays]
        places = np.flatnonzero(near[stays] & ~last)
        rules.append(_rule(key))
        base += len(key)
    after, before = np.arange(1, len(s) + 1), np.arange(-1, len(s))
    stays = np.ones(len(s), dtype=bool)
    while len(places) >= least and (rounds is None or turn < rounds):
        heads, at, which, live = _counted(s, places, after[places], least)
        turn += 1
        at, which = _apart(at, which, after[at])
        key, at, which = _used(s[heads].astype(np.uint64) << np.uint64(32) | s[after[heads]], at, which, least)
        if not len(key):
            break
        s[at] = (base + which).astype(np.uint32)
        gone = after[at]
        last[at], stays[gone] = last[gone], False
        after[at] = after[gone]
        before[after[gone]] = at
        near = np.sort(np.concatenate([live, at, np.maximum(before[at], 0)]))
        near = near[np.concatenate([[True], near[1:] != near[:-1]])]
        places = near[stays[near] & ~last[near]]
        rules.append(_rule(key))
        base += len(key)
    return s[stays], np.flatnonzero(last[stays]) + 1, rules


@cache
def _single(n: int) -> list[bytes]:
    """Ids below n, four bytes each."""
    return [i.to_bytes(4, "little") for i in range(n)]


def expand(symbols: np.ndarray, rules: np.ndarray, first_rule: int) -> np.ndarray:
    """The ids that symbols stand for: each rule is expanded once, then all symbols by one gather."""
    below = list(_single(first_rule))
    for x, y in rules.tolist():  # a rule's pair is older than the rule
        below.append(below[x] + below[y])
    out = pa.array(below, pa.large_binary()).take(pa.array(symbols.astype(np.int32)))
    return np.frombuffer(out.buffers()[2] or b"", dtype="<u4")


def rule_lengths(rules: list[np.ndarray], first_rule: int) -> np.ndarray:
    """How many ids each rule stands for; rules of a round only use older ones."""
    out = np.ones(sum(map(len, rules)), dtype=np.int64)
    to = 0
    for pairs in rules:
        size = np.concatenate([[1], out[:to]])  # an id's length, then those of the rules so far
        out[to : to + len(pairs)] = size[np.maximum(pairs.astype(np.int64) - first_rule + 1, 0)].sum(axis=1)
        to += len(pairs)
    return out


def _narrow(symbols: np.ndarray) -> bytes:
    """Three bytes a symbol."""
    return np.ascontiguousarray(symbols.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3]).tobytes()


def _wide(packed: bytes) -> np.ndarray:
    out = np.zeros((len(packed) // 3, 4), dtype=np.uint8)
    out[:, :3] = np.frombuffer(packed, dtype=np.uint8).reshape(-1, 3)
    return out.reshape(-1).view("<u4")


@releasing
def _write(batches: Iterator[pa.RecordBatch], path: str, end: int) -> Iterator[pa.RecordBatch]:
    part, shard = TaskContext.get().partitionId(), 0
    first_rule = encoder(path).tokenizer.get_vocab_size()
    held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
    n_held = 0

    def flush() -> pa.RecordBatch:
        nonlocal held, n_held, shard
        doc_ids = pa.concat_arrays([d for d, _, _ in held])
        n = np.concatenate([np.diff(bounds) for _, _, bounds in held])
        symbols, ends, rules = compress(np.concatenate([ids for _, ids, _ in held]), np.cumsum(n), first_rule)
        flat = np.concatenate([*rules, np.zeros((0, 2), np.uint32)]).astype("<u4")
        row = (part, shard, int(n.sum()), first_rule, [len(r) for r in rules], flat.tobytes(), rule_lengths(rules, first_rule).astype("<u4").tobytes(), doc_ids.to_pylist(), np.diff(ends, prepend=0).tolist(), n.tolist(), _narrow(symbols))
        held, n_held, shard = [], 0, shard + 1
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, _SHARDS.types, strict=True)], schema=_SHARDS)

    for batch in batches:
        for piece in slices(batch, limit=1 << 22):
            ids, bounds = encoder(path).flat(piece.column("text"), end)
            held.append((piece.column("doc_id"), ids, bounds))
            n_held += len(ids)
            if n_held >= SHARD:
                yield flush()
    if held:
        yield flush()


def write_ids(docs: DataFrame, folder: str, path: str | None = None, end: int = END) -> None:
    """Writes the ids of all documents, each closed by end, in ascending order of doc_id, to a new folder.

    One row of a Parquet file is a shard: whole documents, their grammar's rules with expansion lengths, three bytes
    a symbol, and each document's symbols and ids. Null texts are the end id alone; rows that share a doc_id are all
    written, ordered by text; a null doc_id comes first. Further columns are ignored.
    """
    table = spread_by_doc(docs)
    table = table.repartitionByRange(parallelism(table.sparkSession), "doc_id").sortWithinPartitions("doc_id", "text")
    table.mapInArrow(partial(_write, path=path or tokenizer_path(), end=end), SHARDS).write.parquet(folder)


@releasing
def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            rules = np.frombuffer(r["rules"], dtype="<u4").reshape(-1, 2)
            ids = pa.py_buffer(expand(_wide(r["symbols"]), rules, r["first_rule"]))
            n = np.array(r["doc_n_ids"], dtype=np.int64)
            to = np.cumsum(n)
            bounds = pa.py_buffer(np.concatenate([[0], 4 * to]))
            cut = pa.Array.from_buffers(pa.large_binary(), len(n), [None, bounds, ids])
            table = pa.RecordBatch.from_arrays([pa.array(r["doc_ids"], pa.int64()), pa.array(r["first_id"] + to - n), pa.array(n), cut], names=["doc_id", "start", "n_tokens", "ids"])
            for a in range(0, len(n), 512):
                piece = table.slice(a, 512)
                yield piece.set_column(3, "ids", piece.column("ids").cast(pa.binary()))


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids (little-endian unsigned 32-bit) from a folder."""
    shards = spark.read.schema(SHARDS).parquet(folder)
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))  # a row for each partition written
    first = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    sizes = shards.select("part", "shard", "n_ids").join(first, "part")
    within = F.sum("n_ids").over(Window.partitionBy("part").orderBy("shard")) - F.col("n_ids")
    starts = sizes.select("part", "shard", (F.col("before") + within).alias("first_id"))
    starts = F.broadcast(starts) if shards.count() <= BROADCAST else starts
    return shards.join(starts, ["part", "shard"]).mapInArrow(_read, "doc_id long, start long, n_tokens long, ids binary")


def decode_range(shard: dict, start: int, length: int) -> np.ndarray:
    """Ids start to start + length of a shard's row; only the symbols that cover them are expanded."""
    rules = np.frombuffer(shard["rules"], dtype="<u4").reshape(-1, 2)
    lengths = np.frombuffer(shard["rule_lengths"], dtype="<u4").astype(np.int64)
    symbols, first = _wide(shard["symbols"]), shard["first_rule"]
    size = np.ones(len(symbols), dtype=np.int64)
    size[symbols >= first] = lengths[symbols[symbols >= first] - first]
    to = np.cumsum(size)
    a = int(np.searchsorted(to, start, "right"))
    b = int(np.searchsorted(to, start + length, "left")) + 1
    skip = start - (int(to[a - 1]) if a else 0)
    return expand(symbols[a:b], rules, first)[skip : skip + length]
