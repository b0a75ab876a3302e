"""Near duplicates: MinHash bands propose, signature batches prune by Bayes, full shingle sets confirm."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import U64, Words, mix, releasing, shingle_sets, slices
from .store import fresh, materialize, parallelism, spread_by_doc

BANDS, ROWS = 30, 4
#: Signature values compared at a time, and the posterior chance of a link below which a pair is dropped.
BATCH, MISS = 24, 1e-6
#: Documents on either side of a block, and shingles on a side.
BLOCK, WIDE, SHINGLES = 256, 1024, 1 << 19
#: Ids that are broadcast to pick out texts; more are joined by a shuffle.
BROADCAST = 500_000
#: Links that are joined to components by one union-find; more take star contractions.
LINKS = 500_000
#: Parts into which each bucket is split where its members meet its pivot.
SALT = 8
_N = BANDS * ROWS
_MULTIPLY = mix(np.arange(1, _N + 1, dtype=U64)) | U64(1)
_ADD = mix(np.arange(1001, _N + 1001, dtype=U64))
_SIGNED = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("n_shingles", pa.int64()), ("set_hi", pa.int64()), ("set_lo", pa.int64()), ("signature", pa.binary()), ("bands", pa.list_(pa.int64()))])
SIGNED = "doc_id long, row long, n_shingles long, set_hi long, set_lo long, signature binary, bands array<bigint>"


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """A row of minima for each nonempty set: 32-bit values, hash functions of multiply-add-shift kind."""
    out = np.full((len(sets), _N), 0xFFFFFFFF, dtype=np.uint32)
    i = 0
    while i < len(sets):
        j, size = i, 0
        while j < len(sets) and (j == i or size + len(sets[j]) <= 1 << 14):
            size += len(sets[j])
            j += 1
        own = [k for k in range(i, j) if len(sets[k])]
        if own:
            flat = np.concatenate([sets[k] for k in own])
            first = np.cumsum([0, *(len(sets[k]) for k in own[:-1])])
            for f in range(_N):
                out[own, f] = np.minimum.reduceat(((flat * _MULTIPLY[f] + _ADD[f]) >> U64(32)).astype(np.uint32), first)
        i = j
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    key = np.tile(np.arange(BANDS, dtype=U64), (len(signature), 1))
    for r in range(ROWS):
        key = mix(key * U64(0x9E3779B97F4A7C15) + signature[:, r::ROWS].astype(U64))
    return key.view(np.int64)


def _prints(sets: list[np.ndarray]) -> np.ndarray:
    """128 bits of each set, as two columns."""
    return np.array([np.frombuffer(hashlib.blake2b(s, digest_size=16).digest(), np.int64) for s in sets]).reshape(-1, 2)


@releasing
def _sign(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch):
            sets = shingle_sets(Words(piece.column("text"), lower=True), n)
            signature = signatures(sets)
            prints = _prints(sets)
            size = np.array([len(s) for s in sets], dtype=np.int64)
            short = np.ascontiguousarray((signature & 0xFFFF).astype(np.uint16))
            bands = pa.ListArray.from_arrays(np.arange(0, len(sets) * BANDS + 1, BANDS, dtype=np.int32), band_keys(signature).reshape(-1))
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("row"), pa.array(size), pa.array(prints[:, 0].copy()), pa.array(prints[:, 1].copy()), pa.array([r.tobytes() for r in short], pa.binary()), bands], schema=_SIGNED)


def least_matches(threshold: float, miss: float = MISS) -> np.ndarray:
    """For each multiple of BATCH values compared, the fewest matches whose posterior P(similarity >= threshold), from a flat prior, is miss or more."""
    s = (np.arange(20_000) + 0.5) / 20_000
    out = []
    for n in range(BATCH, _N + 1, BATCH):
        for m in range(n + 1):
            log = m * np.log(s) + (n - m) * np.log1p(-s)
            weight = np.exp(log - log.max())
            if weight[s >= threshold].sum() / weight.sum() >= miss:
                out.append(m)
                break
        else:
            out.append(n)
    return np.array(out)


def likely(a: np.ndarray, b: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Which pairs of signature rows stay after every batch."""
    alive, matches = np.arange(len(a)), np.zeros(len(a), dtype=np.int64)
    for k, need in enumerate(least):
        part = slice(k * BATCH, (k + 1) * BATCH)
        matches[alive] += (a[alive, part] == b[alive, part]).sum(axis=1)
        alive = alive[matches[alive] >= need]
    return alive


def _signs(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, _N)


@releasing
def _prune(batches: Iterator[pa.RecordBatch], least: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            yield batch.select(["a", "b"]).take(pa.array(likely(_signs(batch.column("sig_a")), _signs(batch.column("sig_b")), least)))


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal long keys, which the rows are sorted by."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in keys], axis=1)
        cuts = [0, *(np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1).tolist(), len(values)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            key = tuple(values[a].tolist())
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)


class Forest:
    """Union-find over positions; what it keeps of many links is a forest."""

    def __init__(self, n: int):
        self.parent = list(range(n))
        self.kept: list[tuple[int, int]] = []

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def add(self, x: int, y: int) -> None:
        a, b = self.root(x), self.root(y)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
            self.kept.append((x, y))


def _pairs(nodes: np.ndarray, forest: Forest) -> pa.RecordBatch:
    kept = np.array(forest.kept, dtype=np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(nodes[kept[:, 0]]), pa.array(nodes[kept[:, 1]])], names=["a", "b"])


@releasing
def _compare(batches: Iterator[pa.RecordBatch], least: np.ndarray) -> Iterator[pa.RecordBatch]:
    """In each block of a bucket a forest of the likely pairs of a member of its left side and one of another label on its right."""
    for table in groups(batches, ["band", "i", "j"]):
        nodes, labels, left = (table.column(c).to_numpy() for c in ("node", "label", "left"))
        signs, forest, right = _signs(table.column("signature").combine_chunks()), Forest(len(nodes)), np.flatnonzero(~left)
        for x in np.flatnonzero(left).tolist():
            others = right[labels[right] != labels[x]]
            others = others[(signs[others, :BATCH] == signs[x, :BATCH]).sum(axis=1) >= least[0]]
            for y in others[likely(np.broadcast_to(signs[x], (len(others), _N)), signs[others], least)].tolist():
                forest.add(x, y)
        if forest.kept:
            yield _pairs(nodes, forest)


@releasing
def _set_rows(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch):
            sets = shingle_sets(Words(piece.column("text"), lower=True), n)
            prints = _prints(sets)
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(prints[:, 0].copy()), pa.array(prints[:, 1].copy()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["least", "set_hi", "set_lo", "shingles"])


@releasing
def _confirm(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """In each block of full sets a forest of the exact links of its left side, found over an inverted list of shingles."""
    for table in groups(batches, ["label", "i", "j"]):
        nodes, subs, left = (table.column(c).to_numpy() for c in ("node", "sub", "left"))
        sets = [np.frombuffer(b, U64) for b in table.column("shingles").to_pylist()]
        size = np.array([len(s) for s in sets])
        flat = np.concatenate(sets)
        number = np.unique(flat, return_inverse=True)[1]
        owner = np.repeat(np.arange(len(sets)), size)
        order = np.argsort(number, kind="stable")
        posting, first = owner[order], np.searchsorted(number[order], np.arange(number.max(initial=-1) + 2))
        ends, forest = np.cumsum(size), Forest(len(sets))
        for x in np.flatnonzero(left).tolist():
            own = number[ends[x] - size[x] : ends[x]]
            at, n = first[own], first[own + 1] - first[own]
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            both = np.bincount(posting[np.repeat(at, n) + step], minlength=len(sets))
            for y in np.flatnonzero((100 * both >= percent * (size[x] + size - both)) & (both > 0) & (subs != subs[x])).tolist():
                forest.add(x, y)
        if forest.kept:
            yield _pairs(nodes, forest)


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of links (a, b) and the least node reachable from each: roots hook onto lesser ones, then all paths are halved to their end."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    parent = np.arange(len(nodes))
    while len(x):
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
        while (parent[parent] != parent).any():
            parent = parent[parent]
        x, y = parent[x], parent[y]
        x, y = x[x != y], y[x != y]
    return nodes, nodes[parent]


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of each node but the least of its component: the least node reachable over undirected edges (a, b).

    At most LINKS edges come to the driver, 16 bytes each; more go through alternating star contractions.
    """
    if edges.count() <= LINKS:
        rows = edges.select("a", "b").toArrow()
        node, label = roots(rows["a"].to_numpy(), rows["b"].to_numpy())
        found = pa.table({"node": node[node != label], "label": label[node != label]})
        return materialize(edges.sparkSession.createDataFrame(found, "node long, label long"), "labels")
    now = materialize(edges.where("a != b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(), "edges")
    while True:
        # large star: larger neighbours move to the least of the neighbourhood
        both = now.unionByName(now.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m"))
        large = both.join(least, "v").where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u"))
        # small star: smaller neighbours and the node itself move to the least of them
        large = materialize(large.distinct(), "edges")
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        moved = large.join(least, "v")
        small = moved.where("u != m").select(F.col("u").alias("v"), F.col("m").alias("u")).unionByName(least.select("v", F.col("m").alias("u")))
        after = materialize(small.distinct(), "edges")
        # done when every node has one, itself unpointed, label
        heads = after.select(F.col("u").alias("v")).distinct()
        loose = after.groupBy("v").count().where("count > 1").select("v").unionByName(after.join(heads, "v", "left_semi").select("v"))
        if loose.isEmpty():
            return after.select(F.col("v").alias("node"), F.col("u").alias("label"))
        now = after


def _spread(rows: DataFrame, key: str, counts: DataFrame) -> DataFrame:
    """Blocks of a left and a right side: the left rows once for each right block, all rows on the right once for each left block.

    counts: for each key the numbers of left and right blocks, n_left and n_right.
    """
    rows = rows.join(counts, key)
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    left = rows.where("left").withColumn("i", own("n_left")).withColumn("j", each("n_right"))
    right = rows.withColumn("left", F.lit(False)).withColumn("j", own("n_right")).withColumn("i", each("n_left"))
    return left.unionByName(right).drop("n_left", "n_right").withColumns({c: F.col(c).cast("long") for c in "ij"})


def _checked(rows: DataFrame, percent: int, parts: int) -> DataFrame:
    """The exact links (a, b) found in blocks (label, i, j) of rows (node, sub, left, shingles)."""
    rows = rows.select("label", "i", "j", "node", "sub", "left", "shingles")
    rows = rows.repartition(parts, "label", "i", "j").sortWithinPartitions("label", "i", "j", "node")
    return materialize(rows.mapInArrow(partial(_confirm, percent=percent), "a long, b long"), "links")


def _blocks(n, size, wide: int):
    """How many blocks hold n documents with size shingles."""
    return F.greatest(F.lit(1), F.ceil(n / wide), F.ceil(size / SHINGLES)).cast("int")


def _dealt(labels: DataFrame) -> DataFrame:
    """labels (node, label, size) with the number n of their component's blocks and each node's block i.

    Components of several blocks are few, one for BLOCK nodes or SHINGLES shingles at most, and are broadcast.
    """
    wide = labels.groupBy("label").agg(_blocks(F.count("*"), F.sum("size"), BLOCK).alias("n")).where("n > 1")
    dealt = labels.join(F.broadcast(wide), "label", "left").withColumn("n", F.coalesce("n", F.lit(1)))
    return dealt.withColumn("i", F.pmod(F.xxhash64("node"), F.col("n")).cast("long"))


def _exact_links(sets: DataFrame, percent: int, parts: int) -> DataFrame:
    """Links (a, b) whose components are those of all links within the components of likely pairs, from their sets (node, label, size, n, i, shingles).

    First each block of a component by itself, then the heads of what these found between blocks, and at last what is
    still apart from the component's own head against all others. Small components need the first step only, and
    their sets move for it alone.
    """
    links = _checked(sets.withColumns({"j": F.col("i"), "sub": F.col("node"), "left": F.lit(True)}), percent, parts)
    wide = sets.where("n > 1").select("label", "node", "size")
    if wide.isEmpty():
        return links
    shingles = sets.where("n > 1").select("node", "shingles")
    for last in (False, True):
        found = components(links).withColumnRenamed("label", "sub")
        now = wide.join(found, "node", "left").withColumn("sub", F.coalesce("sub", "node"))
        if last:
            home = now.where("node = label").select("label", F.col("sub").alias("home"))
            now = now.join(F.broadcast(home), "label").withColumn("left", F.expr("sub <> home")).drop("home")
        else:
            now = now.where("node = sub").withColumn("left", F.lit(True))
        on_left = F.count_if("left"), F.sum(F.when(F.col("left"), F.col("size")).otherwise(0))
        counts = now.groupBy("label").agg(F.count_if("left").alias("apart"), F.min("sub").alias("low"), F.max("sub").alias("high"), _blocks(*on_left, BLOCK).alias("n_left"), _blocks(F.count("*"), F.sum("size"), WIDE).alias("n_right"))
        counts = counts.where("apart > 0 and low < high").select("label", "n_left", "n_right")
        cells = _spread(now, "label", F.broadcast(counts))
        links = materialize(links.unionByName(_checked(cells.join(shingles, "node"), percent, parts)), "links")
    return links


def _link(docs: DataFrame, words: int, percent: int, miss: float) -> DataFrame:
    """doc_id, row (a hash of the text), n_shingles and component_id of each row; see link_documents."""
    table = spread_by_doc(docs).withColumn("row", F.xxhash64("text"))
    parts = parallelism(table.sparkSession)
    signed = materialize(table.mapInArrow(partial(_sign, n=words), SIGNED), "signed")
    some = signed.where("n_shingles > 0 and doc_id is not null")
    keys = ["set_hi", "set_lo"]
    classes = some.groupBy(*keys).agg(F.min("doc_id").alias("least"), *(F.first(c).alias(c) for c in ("signature", "bands", "n_shingles")))
    classes = materialize(classes, "classes")
    # a class is named by its least doc_id; where classes share that, all but one get a name of their own
    twice = classes.groupBy("least").agg(F.count("*").alias("n"), F.min("set_hi").alias("first_")).where("n > 1").select("least", "first_")
    shared = not twice.isEmpty()
    if shared:
        other = F.coalesce(F.col("set_hi") != F.col("first_"), F.lit(False))
        classes = materialize(classes.join(twice, "least", "left").withColumn("node", F.when(other, F.xxhash64("least", *keys)).otherwise(F.col("least"))).drop("first_"), "classes")
    else:
        classes = classes.withColumn("node", F.col("least"))
    signs = classes.select("node", "signature")
    # each bucket's pivot is its least node; buckets are split where they meet it
    member = classes.select("node", F.explode("bands").alias("band")).withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALT)))
    pivots = member.groupBy("band").agg(F.min("node").alias("pivot"), F.max("node").alias("hi")).where("pivot < hi").select("band", "pivot")
    split = lambda t: t.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALT - 1).cast("long"))))
    member = materialize(member.join(split(pivots), ["band", "salt"]), "members")
    least = least_matches(percent / 100, miss)
    pairs = member.where("node != pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    pairs = pairs.join(signs.select(F.col("node").alias("b"), F.col("signature").alias("sig_b")), "b").join(signs.select(F.col("node").alias("a"), F.col("signature").alias("sig_a")), "a")
    stars = materialize(pairs.select("a", "b", "sig_a", "sig_b").mapInArrow(partial(_prune, least=least), "a long, b long"), "stars")
    labels = components(stars)
    # what is apart from the pivot against the whole bucket, in blocks
    named = member.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    of_pivot = named.where("node = pivot").select("band", F.col("label").alias("home"))
    named = named.select("band", "salt", "node", "label").join(split(of_pivot), ["band", "salt"]).withColumn("left", F.expr("label != home"))
    named = materialize(named.select("band", "node", "label", "left"), "named")
    counts = named.groupBy("band").agg(F.count_if("left").alias("apart"), F.ceil(F.count_if("left") / BLOCK).cast("int").alias("n_left"), F.ceil(F.count("*") / WIDE).cast("int").alias("n_right"))
    counts = counts.where("apart > 0").drop("apart")
    rows = _spread(named, "band", counts).join(signs, "node").select("band", "i", "j", "node", "label", "left", "signature")
    rows = rows.repartition(parts, "band", "i", "j").sortWithinPartitions("band", "i", "j", "node")
    more = materialize(rows.mapInArrow(partial(_compare, least=least), "a long, b long").distinct(), "compared")
    labels = components(stars.unionByName(more))
    # components of likely pairs on full sets; each set is built once
    heads = labels.select("label", F.col("label").alias("node")).distinct()
    labels = materialize(labels.select("label", "node").unionByName(heads).join(classes.select("node", "least", *keys, F.col("n_shingles").alias("size")), "node"), "likely")
    dealt = _dealt(labels)
    ids = labels.select(F.col("least").alias("doc_id")).distinct()
    ids = F.broadcast(ids) if ids.count() <= BROADCAST else ids
    sets = table.join(ids, "doc_id", "left_semi").select("doc_id", "text").mapInArrow(partial(_set_rows, n=words), "least long, set_hi long, set_lo long, shingles binary")
    sets = dealt.join(sets, ["least", *keys])
    sets = materialize(sets.select("node", "label", "size", "n", "i", "shingles"), "sets")
    sets = materialize(sets.dropDuplicates(["node"]), "sets") if sets.count() > labels.count() else sets  # rows that repeat a doc_id and text
    labels = components(_exact_links(sets, percent, parts))
    placed = classes.select(*keys, "node", "least").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    if shared:
        first = placed.groupBy("label").agg(F.min("least").alias("component_id"))
        placed = placed.join(first, "label").select(*keys, "component_id")
    else:
        placed = placed.select(*keys, F.col("label").alias("component_id"))
    linked = some.select("doc_id", "row", "n_shingles", *keys).join(placed, keys, "left").drop(*keys)
    alone = signed.where("n_shingles = 0 or doc_id is null").select("doc_id", "row", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def link_documents(docs: DataFrame, words: int = 5, percent: int = 80, miss: float = MISS) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of docs.

    Words are what lies between ASCII white space, A-Z lower-cased; a document's set holds its distinct shingles of
    so many words. Two documents are linked if their sets' intersection is at least percent hundredths of the union;
    component_id is the least doc_id reachable. A shorter text is one shingle; null and empty texts have none and stand
    alone. Rows with the same set form one class that takes part once. Rows that share a doc_id are placed each by
    its own text; a null doc_id with words takes no part in links and stands alone; further columns are ignored.
    miss is the posterior chance of a link below which signatures drop a pair.

    Links come in three steps, none of which emits the pairs of a group. Each band's bucket compares its members with
    one pivot by signatures. Buckets that then hold several components compare in blocks what is apart from the
    pivot. Components of likely pairs are checked in blocks on full sets; each block returns a forest of its links.
    """
    return _link(docs, words, percent, miss).drop("row")


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row of docs for each component, with all its columns, whatever the names of further ones.

    It is a row whose doc_id is the least of its component; of rows that repeat such a doc_id and text one stays.
    Null and empty texts all stay.
    """
    linked = materialize(_link(docs, words, percent, MISS), "linked")
    d, r = fresh(docs, "gone_"), fresh(docs, "text_")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(d)) & (F.xxhash64(F.col("text").cast("string")) == F.col(r))
    named = lambda t: t.select(F.col("doc_id").alias(d), F.col("row").alias(r)).distinct()
    out = docs.join(named(linked.where("not kept")), same, "left_anti")
    again = linked.where("kept and n_shingles > 0 and doc_id is not null").groupBy("doc_id", "row").count().where("count > 1")
    if again.isEmpty():
        return out
    again = named(again)
    return out.join(again, same, "left_anti").unionByName(out.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"]))
