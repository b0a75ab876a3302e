import hashlib
import re
import timeit
import zlib
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from inkwell.llm import chat, decontaminate, encoding, grammar, langid, lm, neardup, packing, pii, quality, queries, sampling, toxicity

LONG = " ".join(f"w{k % 977}" for k in range(30_000))
ODD = [(1, None), (2, ""), (3, "   \n "), (4, "a b"), (5, LONG), (5, LONG), (6, LONG), (None, "x y z"), (7, "Ünï ###\\ </turn> <|endoftext|>  a@b.co")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string").withColumn("lang", F.lit("en")).withColumn("n", F.lit(1)).withColumn("signature", F.lit("x"))


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(4, 1, 0), (5, 0, 1), (6, 1, 1)], "doc_id long, quality int, toxic int")


def test_odd_rows_everywhere(spark, odd, labels):
    n = len(ODD)
    bench = spark.createDataFrame([(1, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13 w14"), (2, None), (3, "")], "item_id long, text string")
    for frame in (odd, odd.limit(0)):
        want = n if frame is odd else 0
        assert quality.score_quality(frame, labels).count() == want
        assert pii.find_pii(frame).count() == want
        assert pii.mask_pii(frame).count() == want
        linked = neardup.link_documents(frame).collect()
        assert len(linked) == want
        assert lm.score_texts(frame).count() == want
        assert toxicity.score_toxicity(frame, labels).count() == want
        assert langid.identify(frame).count() == want
        marked = decontaminate.mark(frame, bench).collect()
        assert len(marked) == want
        assert packing.pack_documents(frame).agg(F.count_distinct("start", "doc_id")).first() is not None
        if want:
            by = {(r["doc_id"], r["n_shingles"]): r for r in linked}
            assert all(r["component_id"] == 5 for k, r in by.items() if k[0] in (5, 6))
            assert by[1, 0]["component_id"] == 1 and by[2, 0]["kept"]
            assert {r["doc_id"] for r in marked if r["n_hit"]} == {5, 6}


def test_quality_counts_match_plain_python(spark):
    text = "a b c\na b c\n\n$x a b c | z\na b c"
    got = quality.score_quality(spark.createDataFrame([(1, text)], "doc_id long, text string"), spark.createDataFrame([], "doc_id long, quality int, toxic int")).first()
    assert (got["n_words"], got["word_chars"], got["n_symbols"], got["n_dup_lines"], got["n_repeat_words"]) == (15, 16, 2, 2, 15 - 3)


@pytest.fixture(scope="module")
def many_labels(spark, tmp_path_factory):
    """25,000 documents labelled good, of which few have a text; those that have come last in the order of hashed ids."""
    ids = spark.range(25_000).select(F.col("id").alias("doc_id"))
    last = [r["doc_id"] for r in ids.orderBy(F.xxhash64("doc_id").desc(), F.col("doc_id").desc()).limit(40).collect()]
    rng = np.random.default_rng(22)
    text = lambda mark: " ".join(rng.permutation([f"{mark}{k}" for k in range(60)]))
    rows = [(k, text("g")) for k in last] + [(30_000 + k, text("b")) for k in range(20)]
    folder = tmp_path_factory.mktemp("many")
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(folder / "documents.parquet"))
    bad = spark.range(30_000, 30_020).select(F.col("id").alias("doc_id"), F.lit(0).alias("quality"))
    ids.withColumn("quality", F.lit(1)).unionByName(bad).withColumn("toxic", F.lit(0)).write.parquet(str(folder / "labels.parquet"))
    return str(folder), set(last)


@pytest.mark.parametrize("shuffled", [False, True])
def test_quality_learns_from_all_labelled_documents(spark, monkeypatch, many_labels, shuffled):
    if shuffled:
        monkeypatch.setattr(sampling, "BROADCAST", 0)
    folder, good = many_labels
    assert {r["doc_id"] for r in queries.op1_quality_rules(spark, folder).where("kept").collect()} == good


def test_pipeline_keeps_by_all_labelled_documents(spark, many_labels):
    import corpus_pipeline

    folder, good = many_labels
    docs = spark.read.parquet(folder + "/documents.parquet")
    assert {r["doc_id"] for r in corpus_pipeline.STAGES[0][1](spark, docs, folder).collect()} == good


def test_pii_base_spans_are_the_patterns():
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    good = {"email": lambda m: True, "ip": lambda m: all(int(x) <= 255 for x in m.split(".")), "card": lambda m: 13 <= len(re.sub("[^0-9]", "", m)) <= 19 and pii.luhn(re.sub("[^0-9]", "", m)), "phone": lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15}
    rng = np.random.default_rng(1)
    parts = np.array(["4539148803436467", "@", "a.b", "+1 (262) 555-3752", "1.2.3.4", "299.1.", " ", ".", "-", "0", "é", "/"])
    for _ in range(4000):
        text = "".join(rng.choice(parts, rng.integers(1, 10)))
        want = [(k, m.start(), m.end()) for k, p in patterns.items() for m in re.finditer(p, text) if good[k](m[0])]
        assert [s for s in pii.find_spans(text) if s[0] in pii.BASE_KINDS] == want, text
    assert pii.mask('key password=b7db7aa4a5 and a@b.co') == "key password=<SECRET> and <EMAIL>"


def test_pii_spans_of_any_length():
    assert pii.mask("password=" + "a1" * 320 + " end") == "password=<SECRET> end"
    assert pii.mask("account number: " + "12345" * 10 + " x") == "account number: <ACCOUNT> x"
    assert pii.mask("see verylongscheme+tcp://host/x.") == "see <URL>."
    said = ["ghp_" + "a1B2" * 9, "sk-" + "x9" * 12, "eyJhbGci.eyJzdWIi.abcdefgh", "AKIA" + "A1" * 8, "-----BEGIN RSA PRIVATE KEY-----\nab+/=\n-----END RSA PRIVATE KEY-----"]
    for secret in said:
        assert pii.mask(f"is {secret} it") == "is <SECRET> it" or secret.startswith("-----"), secret
    assert pii.mask(f"is {said[-1]} it") == "is <SECRET> it" and pii.mask("risk-free-and-long-compound-words") == "risk-free-and-long-compound-words"
    long = "1" * 300_000 + "a@" * 1000 + "://" * 1000 + "+1 " * 1000
    assert [s for s in pii.find_spans(long) if s[0] == "card"] == []


def test_pii_query_digests_its_spans(spark, tmp_path):
    texts = ["mail a@b.co, x.y@c.de or 1.2.3.4", None, "", "call +1 (262) 555-3752, card 4539 1488 0343 6467, password=b7db7aa4a5", "299.1.1.1 é 10.0.0.1"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in queries.op2_pii(spark, str(tmp_path)).collect()}
    for k, text in enumerate(texts):
        spans = pii.find_spans(text)
        said = [f"{kind}:{a}:{b}" for kind, a, b in spans]
        base = [x for x in said if x.split(":")[0] in pii.BASE_KINDS]
        assert [got[k][f"n_{kind}"] for kind in pii.BASE_KINDS] == [sum(s[0] == kind for s in spans) for kind in pii.BASE_KINDS]
        assert got[k]["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest() and got[k]["spans"] == ",".join(said)
    assert [got[0]["n_email"], got[0]["n_ip"], got[3]["n_card"], got[3]["n_phone"], got[4]["n_ip"]] == [2, 1, 1, 1, 1]


def _components(texts, words, percent):
    """The least index reachable from each text, by all pairs."""
    cut = [t.split() for t in texts]
    sets = [set(zip(*(w[k:] for k in range(words)))) if len(w) >= words else ({tuple(w)} if w else set()) for w in cut]
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    return label


def _near_texts(rng, n):
    base = [f"v{k}" for k in range(120)]
    texts = []
    for k in range(n):
        w = list(base) if k % 2 else [f"u{k // 6}_{j}" for j in range(90)]
        for at in rng.integers(0, len(w), rng.integers(0, 6)):
            w[at] = f"x{k}_{at}"
        texts.append(" ".join(w))
    return texts


@pytest.mark.parametrize("small", [False, True])
def test_near_duplicates_against_all_pairs(spark, monkeypatch, small):
    if small:  # components of many blocks
        for name, value in (("BLOCK", 4), ("WIDE", 6), ("SHINGLES", 900)):
            monkeypatch.setattr(neardup, name, value)
    texts = _near_texts(np.random.default_rng(2), 60)
    got = neardup.link_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 3, 85)
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == dict(enumerate(_components(texts, 3, 85)))


@pytest.mark.parametrize("links", [None, 0])
def test_components_of_few_and_of_many_links(spark, monkeypatch, links):
    written = []
    monkeypatch.setattr(neardup, "materialize", lambda df, name, f=neardup.materialize: written.append(name) or f(df, name))
    if links is not None:  # star contractions
        monkeypatch.setattr(neardup, "LINKS", links, raising=False)
    rng = np.random.default_rng(23)
    ids = rng.permutation(10_000)[:600].astype(int).tolist()
    pairs = [*zip(ids[:100], ids[1:101]), *((ids[a], ids[b]) for a, b in rng.integers(101, 600, (300, 2)).tolist()), (ids[0], ids[0])]
    label = {k: k for pair in pairs for k in pair}
    for a, b in pairs:
        old, new = max(label[a], label[b]), min(label[a], label[b])
        label = {k: new if v == old else v for k, v in label.items()}
    got = neardup.components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert {r["node"]: r["label"] for r in got} == {k: v for k, v in label.items() if k != v}
    assert links is not None or len(written) <= 1
    assert neardup.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_sets_of_small_components_move_once(spark, monkeypatch):
    plans = []
    said = lambda df, name: plans.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
    monkeypatch.setattr(neardup, "materialize", lambda df, name, f=neardup.materialize: said(df, name) or f(df, name))
    texts = _near_texts(np.random.default_rng(4), 12)
    neardup.link_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 3, 85).collect()
    links = [plan for name, plan in plans if name == "links"]
    assert len(links) == 1 and "Join" not in links[0]


def test_rows_that_share_an_id_are_placed_by_their_texts(spark):
    texts = _near_texts(np.random.default_rng(3), 4)
    one, other, alone = texts[1], texts[3], "nothing of the kind is said anywhere else here"
    rows = [(3, one), (5, other), (5, alone), (7, "q w e r t y u i"), (7, "q w e r t y u i"), (8, None), (8, None), (9, alone + " indeed so")]
    docs = spark.createDataFrame(rows, "Doc_ID long, Text string").withColumn("gone_", F.lit(1)).withColumn("row", F.lit(2)).withColumn("text_", F.lit(3))
    got = sorted((r["doc_id"], r["component_id"], r["kept"]) for r in neardup.link_documents(docs, 3, 60).collect())
    assert got == [(3, 3, True), (5, 3, False), (5, 5, True), (7, 7, True), (7, 7, True), (8, 8, True), (8, 8, True), (9, 5, False)]
    kept = neardup.keep_one(docs, 3, 60)
    assert kept.columns == docs.columns
    assert sorted((r["Doc_ID"], r["Text"] or "") for r in kept.collect()) == [(3, one), (5, alone), (7, "q w e r t y u i"), (8, ""), (8, "")]


def test_many_equal_rows_of_one_id(spark):
    rows = spark.range(3000).select(F.lit(5).cast("long").alias("doc_id"), F.lit("a b c d e f g h i j").alias("text"))
    docs = rows.unionByName(spark.createDataFrame([(2, "a b c d e f g h i k")], "doc_id long, text string"))
    got = neardup.link_documents(docs, 3, 50).groupBy("doc_id", "component_id").count().collect()
    assert sorted(tuple(r) for r in got) == [(2, 2, 1), (5, 2, 3000)]


def test_encoding_is_the_tokenizers():
    e = encoding.Encoder(encoding.tokenizer_path())
    rng = np.random.default_rng(3)
    parts = np.array(["a", "the ", " ", "\n", "  ", "\t", "!", "12", "é", "<|endoftext|>", "'s ", "ab, ", "Cd.! "])
    texts = ["".join(rng.choice(parts, rng.integers(0, 25))) for _ in range(3000)]
    assert e.encode(texts) == e.whole(texts)


def test_parts_are_usable_as_each_alone():
    rng = np.random.default_rng(33)
    bits = ["", "\n", "\t", "\x1c", "\x85", "\u2003", "a", "é", "日", ".", "\x00"]
    parts = ["".join(rng.choice(bits, rng.integers(0, 4))) for _ in range(3000)]
    assert encoding._usables(encoding.pa.array(parts)).tolist() == [encoding._usable(p) for p in parts]


def test_encoder_on_runs_of_white_space_with_a_short_memory():
    rng = np.random.default_rng(8)
    bits = [" ", " ", "\n", "\n", "\t", "\u2003", "a", "be", "é", "22", ".", "!!", "###", "'s", "\x1c", "日本", "\x00"]
    e = encoding.Encoder(encoding.tokenizer_path(), remembered=500)
    for _ in range(40):
        texts = ["".join(rng.choice(bits, rng.integers(0, 15))) for _ in range(100)]
        assert e.encode(texts) == e.whole(texts)


def test_encoder_keeps_parts_that_come_again_in_little_memory(monkeypatch):
    e = encoding.Encoder(encoding.tokenizer_path(), remembered=90_000)
    learned = []
    monkeypatch.setattr(e, "learn", lambda new, learn=e.learn: learned.append(new) or learn(new))
    often = " ".join(f"often{k}" for k in range(200))
    for k in range(30):
        rare = " ".join(f"rare{k}x{i}" for i in range(400))
        texts = [rare] if k % 3 else [rare, often]
        assert e.encode(texts) == e.whole(texts)
        assert e.memory.nbytes() < 150_000
    assert sum("often7" in new for new in learned) == 1


def test_token_files_round_trip(spark, odd, tmp_path):
    grammar.write_ids(odd, str(tmp_path / "ids"))
    rows = sorted(grammar.read_ids(spark, str(tmp_path / "ids")).collect(), key=lambda r: r["start"])
    at = 0
    for r in rows:
        assert r["start"] == at and r["n_tokens"] * 4 == len(r["ids"]) and r["ids"][-4:] == bytes(4)
        at += r["n_tokens"]
    want = sorted(zlib.crc32(b + bytes(4)) for b in encoding.Encoder(encoding.tokenizer_path()).whole([t or "" for _, t in ODD]))
    assert sorted(zlib.crc32(r["ids"]) for r in rows) == want
    shard = max(spark.read.parquet(str(tmp_path / "ids")).collect(), key=lambda r: r["n_ids"]).asDict()
    whole = grammar.decode_range(shard, 0, shard["n_ids"])
    assert (grammar.decode_range(shard, 5, shard["n_ids"] - 9) == whole[5:-4]).all()


def test_grammar_leaves_no_frequent_pair():
    rng = np.random.default_rng(13)
    phrase = rng.integers(0, 50, 300)
    ids = np.concatenate([*(phrase[rng.integers(0, 200) :] for _ in range(60)), np.full(40, 7)]).astype(np.uint32)
    ends = np.unique(np.append(rng.integers(1, len(ids), 20), len(ids)))
    symbols, to, rules = grammar.compress(ids, ends, 100)
    assert (grammar.expand(symbols, np.concatenate(rules), 100) == ids).all() and len(symbols) < len(ids) / 5
    bounds = [0, *to.tolist()]
    pairs: dict[tuple[int, int], int] = {}
    for a, b in zip(bounds, bounds[1:]):
        own = symbols[a:b].tolist()
        for p in zip(own, own[1:]):
            pairs[p] = pairs.get(p, 0) + 1
    assert all(n < grammar.LEAST for (x, y), n in pairs.items() if x != y)


def test_grammar_rounds_of_few_places_are_cheap():
    """Documents of one id each have no pairs; the rounds over the last one must not go through all of them again."""
    rng = np.random.default_rng(31)
    ids = np.concatenate([rng.integers(0, 1 << 24, 2_000_000), *[rng.integers(0, 1 << 24, 3000)] * 9]).astype(np.uint32)
    ends = np.append(np.arange(1, 2_000_001), len(ids))
    symbols, to, rules = grammar.compress(ids, ends, 1 << 24)
    assert len(rules) > 8 and len(to) == len(ends) and len(symbols) < 2_000_000 + 3 * 9
    took = lambda rounds: min(timeit.repeat(lambda: grammar.compress(ids, ends, 1 << 24, rounds), number=1, repeat=3))
    assert took(None) < 2 * took(1)


def test_overlapping_occurrences_are_replaced_from_the_left():
    rng = np.random.default_rng(32)
    for _ in range(100):
        at = np.flatnonzero(rng.random(40) < 0.7)
        want: list[int] = []
        for x in at.tolist():
            if not want or want[-1] != x - 1:
                want.append(x)
        assert grammar._apart(at, at, at + 1)[0].tolist() == want


def test_packed_pieces_hold_all_ids(spark, odd):
    pieces = packing.pack_documents(odd).collect()
    documents: dict[tuple, list] = {}
    sequences: dict[int, list] = {}
    for r in pieces:
        assert len(r["ids"]) == 4 * r["length"] and r["sequence_tokens"] <= packing.WINDOW
        documents.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
    code = encoding.Encoder(encoding.tokenizer_path())
    want = sorted(((i if i is not None else -1), code.whole([t or ""])[0] + packing.END.to_bytes(4, "little")) for i, t in ODD)
    got = []
    for (doc_id, n), rows in documents.items():
        copies = sum(r["length"] for r in rows) // n
        starts = sorted((r["start"], r["ids"]) for r in rows)
        if copies == 1:
            got.append((-1 if doc_id is None else doc_id, b"".join(x for _, x in starts)))
        else:  # equal rows are cut each in its own way
            got += [(doc_id, next(x for i, x in want if i == doc_id))] * copies
    assert sorted(got) == want
    for rows in sequences.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert {r["sequence_tokens"] for r in rows} == {at} and len({r["step_id"] for r in rows}) == 1
        assert rows[0]["window"] == (at if at & (at - 1) == 0 else packing.WINDOW)
    totals = [2048, 2048, 1024, 512, 512, 2048]
    groups = packing.balance(totals, 4096)
    load = [sum(t for t, g in zip(totals, groups) if g == k) for k in set(groups)]
    assert max(load) - min(load) <= 2048 and sum(load) == sum(totals)


def test_packing_holds_no_batch_that_it_has_read(monkeypatch, tmp_path):
    monkeypatch.setattr(packing, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    monkeypatch.setattr(packing, "BUFFER", 1 << 40)
    batch = pa.record_batch({"doc_id": [1, 2], "text": ["word " * 200_000 + "end"] * 2})
    size, held = batch.nbytes, []
    with pa.OSFile(str(tmp_path / "in"), "wb") as out, pa.ipc.new_stream(out, batch.schema) as writer:
        for _ in range(4):
            writer.write_batch(batch)
    del batch

    def batches():
        with pa.OSFile(str(tmp_path / "in")) as source:
            reader = pa.ipc.open_stream(source)
            for _ in range(4):
                held.append(pa.total_allocated_bytes())
                yield reader.read_next_batch()

    rows = [r for out in packing._pack(batches(), encoding.tokenizer_path(), packing.END) for r in out.to_pylist()]
    assert sum(r["length"] for r in rows) == 8 * 200_002 and {r["doc_id"] for r in rows} == {1, 2}
    assert max(held) - held[0] < size / 2


def test_packing_covers_without_padding():
    rng = np.random.default_rng(4)
    for _ in range(60):
        lengths = rng.integers(1, 5000, rng.integers(0, 40)).tolist()
        spans: dict[int, list[tuple[int, int]]] = {k: [] for k in range(len(lengths))}
        for s in packing.pack(lengths):
            total = sum(p[2] for p in s)
            assert total <= packing.WINDOW and total & (total - 1) == 0
            for doc, start, length in s:
                spans[doc].append((start, length))
        for doc, parts in spans.items():
            at = 0
            for start, length in sorted(parts):
                assert start == at
                at += length
            assert at == lengths[doc]


def test_chat_round_trip(spark):
    turns = [(1, 0, None, None), (1, 1, "assistant", "a\\####<|x|>\\\\### <turn></turn>[INST]\\"), (2, 0, "user", "\\### Assistant: </turn> ok"), (2, 1, "assistant", "")]
    rows = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    for r in chat.parse_chats(chat.format_chats(rows)).collect():
        want = [(role or "", text or "") for c, _, role, text in turns if c == r["conv_id"]]
        assert [(t["role"], t["text"]) for t in r["turns"]] == want
        assert r["loss_text"] == "".join(t for role, t in want if role == "assistant")
    assert all(x not in chat.escape("####<turn></turn><|[INST]") for x in ("###", "<turn>", "</turn>", "<|", "[INST]"))


def _ppm(texts, order, escape):
    """Plain prediction by partial matching: log10 of each text, from contexts in dictionaries."""
    from collections import Counter, defaultdict

    said = [b"".join(w.encode() + b" " for w in re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({k: k + 32 for k in range(65, 91)}))) + b"\n" for t in texts]
    full = [b"\t" * (order - 1) + b" " + x for x in said]
    follow = [defaultdict(Counter) for _ in range(order + 1)]
    for x in full:
        for at in range(order, len(x)):
            for k in range(order + 1):
                follow[k][x[at - k : at]][x[at]] += 1

    def price(context, symbol):
        out, gone = 1.0, set()
        for k in range(order, -1, -1):
            counts = {s: n for s, n in follow[k][context[len(context) - k :]].items() if s not in gone}
            if not follow[k][context[len(context) - k :]]:
                continue
            total = sum(counts.values())
            if symbol in counts:
                return out * (counts[symbol] - escape) / total
            if counts:
                out *= escape * len(counts) / total
            gone |= set(counts)
        return out / max(1, 256 - len(follow[0][b""]))

    return [sum(np.log10(price(x[at - order : at], x[at])) for at in range(order, len(x))) for x in full], price


def test_trie_probabilities_sum_to_one():
    _, price = _ppm(["abab", "abc", "b"], 3, 0.3)
    for context in (b"\t\t ", b" ab", b"zzz", b"bab"):
        assert abs(sum(price(context, s) for s in range(256)) - 1) < 1e-9


@pytest.mark.parametrize("short", [500_000, 0])
def test_language_model_scores_whole_texts(spark, monkeypatch, short):
    """Against dictionaries of contexts, with long and with short contexts sent; the same words in another order cost more."""
    monkeypatch.setattr(lm, "SHORT", short)
    rng = np.random.default_rng(9)
    phrase = "the quick brown fox jumps over a lazy dog"
    mixed = " ".join(rng.permutation(phrase.split()))
    texts = [phrase] * 6 + [mixed, " ".join(rng.choice(["aa", "bé", "c", "Dd"], 400)), "", None, " x\n Y "]
    got = {r["doc_id"]: r for r in lm.score_texts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), held_out=10).collect()}
    want, _ = _ppm(texts, lm.ORDER, lm.ESCAPE)
    for k in range(len(texts)):
        assert abs(got[k]["score"] - want[k]) < 1e-3
    assert got[6]["base_score"] == pytest.approx(got[0]["base_score"]) and got[6]["score"] < got[0]["score"] - 1


def test_grams_are_told_apart_at_about_the_cost_of_a_sort():
    rng = np.random.default_rng(4)
    keys = rng.integers(0, 1 << 47, 50_000)[rng.integers(0, 50_000, 1_000_000)]
    for some in (keys, keys[:1], keys[:0]):
        assert lm.distinct(some).tolist() == sorted(set(some.tolist()))
    took = lambda f: min(timeit.repeat(lambda: f(keys), number=1, repeat=5))
    assert took(lm.distinct) < 5 * took(np.sort)


def test_language_model_base_counts(spark):
    rng = np.random.default_rng(12)
    texts = [" ".join(rng.choice(["Ab", "ab", "c", "é", "x1", "\tq"], rng.integers(0, 30))) for _ in range(60)] + [None, "", "never seen"]
    rows = [(k, t) for k, t in enumerate(texts)]
    got = {r["doc_id"]: r for r in lm.score_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    cut = {k: re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower()) + ["\n"] for k, t in rows}
    out = {k: zlib.crc32(str(k).encode()) % 10 == 0 for k in cut}
    from collections import Counter

    c = Counter(w for k, words in cut.items() if not out[k] for w in words)
    n, v = sum(c.values()), len(c)
    for k, words in cut.items():
        assert (got[k]["held_out"], got[k]["n_tokens"], got[k]["n_known"], got[k]["train_tokens"]) == (out[k], len(words), sum(c[w] > 0 for w in words), n)
        assert got[k]["base_score"] == pytest.approx(sum(np.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words))


def _edits(a, b):
    """Insertions, deletions, replacements and swaps of neighbours between a and b."""
    d = [[i + j if i * j == 0 else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def test_lexicon_finds_the_nearest_of_all_terms():
    rng = np.random.default_rng(6)

    def word(least, most, letters):
        return "".join(rng.choice(list(letters), rng.integers(least, most)))

    terms = {word(3, 12, "abcd"): 1.0 for _ in range(50)} | {word(4, 8, "abcd") + "*": 1.0 for _ in range(8)}
    lex = toxicity.Lexicon(terms)

    def near(x):
        found = []
        for t in terms:
            bare = t.rstrip("*")
            d = _edits(x, t) if bare == t else min(_edits(x[:k], bare) for k in range(len(x)))
            if d <= toxicity.errors(len(bare)):
                found.append((d, t))
        return min(found)[::-1] if found else None

    for _ in range(800):
        x = word(3, 13, "abcde") if rng.random() < 0.5 else str(rng.choice(list(terms))).rstrip("*")
        for _ in range(rng.integers(0, 3)):
            k = int(rng.integers(0, len(x)))
            x = (x[:k] + x[k + 1 :], x[:k] + "x" + x[k:], x[:k] + "a" + x[k + 1 :], x[:k] + x[k : k + 2][::-1] + x[k + 2 :])[rng.integers(0, 4)] or "a"
        assert lex.match(x) == near(x), x


def test_misspelt_terms_are_met():
    lex = toxicity.Lexicon({t: 3.0 for t in ("moron", "idiot", "loser", "clown", "trash", "stupid", "disgust*")})
    for word, term in {"mron": "moron", "idot": "idiot", "losr": "loser", "clwn": "clown", "trsh": "trash", "idoit": "idiot", "stuipd": "stupid", "disgsuting": "disgust*", "dsgusted": "disgust*"}.items():
        assert lex.match(word) == (term, 1), word
    assert lex.match("idiot") == ("idiot", 0) and lex.match("lantern") is None and lex.match("disg") is None
    assert toxicity.features("an id1ot", lex)[2] > 0 and toxicity.features("a l0ser!", lex)[2] > 0
    plain, quoted = toxicity.features("you are an idiot", lex), toxicity.features('they said "you are an idiot" to me', lex)
    assert plain[0] > 0 and plain[3] == 0 and quoted[0] == 0 and quoted[3] > 0 and plain[4] == quoted[4]
    assert toxicity.features("stop!idiot", lex)[:3] == toxicity.features("stop idiot", lex)[:3] and not any(toxicity.features("a v1rtue", lex))


def test_gradients_match_differences():
    rng = np.random.default_rng(5)
    p = {f"e{s}": rng.normal(0, 0.3, (48, 256)) for s in "fb"} | {f"u{s}": rng.normal(0, 0.3, (48, 16)) for s in "fb"} | {"v": rng.normal(0, 0.3, (2, 16)), "c": np.zeros((2, 1))}
    bytes_, real = langid.pad([b"abc", b"xyz", b"ab"])
    langs = np.array([0, 1, 0])
    for side in "fb":

        def loss(side=side):
            prob = langid.label(p, langid.run_gru(p, side, bytes_, real)[0])
            return -np.log(prob[:, langs, np.arange(3)])[real].sum()

        f, saved = langid.run_gru(p, side, bytes_, real, True)
        d = langid.label(p, f)
        d[:, langs, np.arange(3)] -= 1
        d *= real[:, None, :]
        grad = {k: np.zeros_like(x) for k, x in p.items()}
        langid._back(p, side, bytes_, real, saved, p["v"].T @ d, grad)
        for name, at in (("u" + side, (7, 3)), ("u" + side, (40, 2)), ("e" + side, (20, ord("b")))):
            p[name][at] += 1e-5
            up = loss()
            p[name][at] -= 2e-5
            down = loss()
            p[name][at] += 1e-5
            assert abs((up - down) / 2e-5 - grad[name][at]) < 1e-4


def test_windows_read_what_the_whole_text_says(monkeypatch):
    """Sums over windows are those of one reading, up to what margins leave; order of words counts."""
    rng = np.random.default_rng(6)
    p = {f"e{s}": rng.normal(0, 0.5, (48, 256)).astype(np.float32) for s in "fb"} | {f"u{s}": rng.normal(0, 0.2, (48, 16)).astype(np.float32) for s in "fb"} | {"v": rng.normal(0, 1, (3, 32)).astype(np.float32), "c": np.zeros((3, 1), np.float32)}
    import pyarrow as pa

    texts = pa.array(["".join(rng.choice(list("abé .,\n1"), 700)), "", "1 2", "ab " * 300, "x"])
    got = langid.text_sums(p, *langid.utf8(texts))
    monkeypatch.setattr(langid, "READ", 10_000)
    whole = langid.text_sums(p, *langid.utf8(texts))
    assert np.abs(got - whole).max() < 0.5 and np.allclose(got.sum(axis=1), whole.sum(axis=1), atol=0.01)
    assert np.allclose(whole.sum(axis=1), [sum(c.isalpha() * len(c.encode()) for c in t) for t in texts.to_pylist()], atol=0.05)
    turned = langid.text_sums(p, *langid.utf8(pa.array(["ab cd ef", "ef cd ab"])))
    assert np.abs(turned[0] - turned[1]).max() > 1e-4


def test_windows_are_read_without_keeping_states(monkeypatch):
    """op5_language: sums are those of the states that training sees, for texts around a window's size; no block of states is kept."""
    import tracemalloc

    import pyarrow as pa

    rng = np.random.default_rng(8)
    p = {f"e{s}": rng.normal(0, 0.6, (48, 256)).astype(np.float32) for s in "fb"} | {f"u{s}": rng.normal(0, 0.5, (48, 16)).astype(np.float32) for s in "fb"} | {"v": rng.normal(0, 1, (3, 32)).astype(np.float32), "c": rng.normal(0, 1, (3, 1)).astype(np.float32)}
    p["ef"][:32, ord("b")], p["eb"][:32, ord("b")] = 100, -100  # open and closed gates
    read, margin = langid.READ, langid.MARGIN
    sizes = [0, 1, 2, margin, read - 1, read, read + 1, read + margin, read + margin + 1, 2 * read, 5 * read + 3, 0, 7]
    texts = ["".join(rng.choice(list("abxyz .,1"), n)) for n in sizes] + ["éñ ß" * 70]
    want = np.zeros((len(texts), 3))
    for k, text in enumerate(t.encode() for t in texts):
        for a in range(0, len(text), read):
            low, end = max(0, a - margin), min(len(text), a + read)
            bytes_, real = langid.pad([text[low : end + margin]])
            prob = langid.label(p, np.concatenate([langid.run_gru(p, s, bytes_, real)[0] for s in "fb"], axis=1))[:, :, 0]
            want[k] += sum(prob[t - low] for t in range(a, end) if langid._SPELLS[text[t]])
    for lanes in (1, 3, langid.LANES):
        monkeypatch.setattr(langid, "LANES", lanes)
        assert np.allclose(langid.text_sums(p, *langid.utf8(pa.array(texts))), want, atol=1e-3)
    long = langid.utf8(pa.array(["some words " * (langid.LANES * read // 11)]))
    tracemalloc.start()
    langid.text_sums(p, *long)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16 << 20, peak


def test_language_scores_do_not_depend_on_partitions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    a, b = ({r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(d).collect()} for d in (docs.coalesce(1), docs.repartition(16)))
    assert {k: v[0] for k, v in a.items()} == {k: v[0] for k, v in b.items()} and all(abs(a[k][1] - b[k][1]) < 1e-6 for k in a)


def test_held_out_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.join(langid.identify(docs), "doc_id").where("held_out and lang is not null and lang_pred <> 'und'").groupBy("lang").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("share")).collect()
    assert len(rows) > 1 and all(r["share"] >= 0.95 for r in rows), rows


def test_toxicity_of_disputed_and_repeated_rows(spark):
    clean, bad = "a fine day by the sea", "you moron you idiot"
    rows = [(k, bad if k % 2 else clean) for k in range(40)] + [(40, bad), (40, clean), (None, bad), (41, None)]
    labels = [(k, k % 2) for k in range(40)] + [(40, 1), (40, 0), (39, 0)]
    docs = spark.createDataFrame(rows, "Doc_ID long, Text string").withColumn("y", F.lit(1)).withColumn("exact", F.lit(1))
    got = toxicity.score_toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert len(got) == len(rows) and all(r["held_out"] is not None for r in got)
    assert all(r["predicted"] == r["doc_id"] % 2 for r in got if r["doc_id"] is not None and r["doc_id"] < 40)


def test_stages_take_any_columns_and_empty_tables(spark, tmp_path):
    """The pipeline's stages on odd names, nulls and nothing; a run's rows against plain steps."""
    import corpus_pipeline

    words = [f"w{k}" for k in range(80)]
    rng = np.random.default_rng(21)
    texts = [" ".join(rng.permutation(words)) for _ in range(6)]
    item = " ".join(f"bench{k}" for k in range(14))
    texts += [texts[0], texts[1] + " mail a@b.co", "too short", None, texts[2] + " " + item]
    spark.createDataFrame(list(enumerate(texts)), "Doc_ID long, Text string").withColumn("d_", F.lit(1)).withColumn("r_", F.lit(2)).withColumn("gone_", F.lit(3)).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns, name
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0, name
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    # 6 is a copy of 0, 7 a near copy of 1, 8 and 9 are too short, 10 holds a benchmark passage and nearly all of 2
    assert {r["doc_id"] for r in pieces} == {0, 1, 2, 3, 4, 5}
    code = encoding.Encoder(encoding.tokenizer_path())
    for r in pieces:
        ids = code.whole([texts[r["doc_id"]]])[0] + packing.END.to_bytes(4, "little")
        assert r["ids_crc32"] == zlib.crc32(ids[4 * r["start"] : 4 * (r["start"] + r["length"])]) and r["doc_tokens"] == len(ids) // 4


def test_decontamination_starts_no_python(spark):
    table = spark.range(1).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"))
    wanted = decontaminate.windows(table.select(F.col("doc_id").alias("item_id"), "text"), 2)
    found = decontaminate._occurrences(table, wanted)
    assert [c for _, c in found.dtypes] == ["bigint", "bigint", "bigint", "int", "int"]
    assert "ExistingRDD" not in found._jdf.queryExecution().toString() and found.count() == 2
