"""Language identification by a bidirectional gated recurrent network over bytes, trained here in numpy.

The network reads whole texts, across words: in windows of READ bytes, each with MARGIN bytes on either side that only
bring up the states of the direction that comes from there. It labels every byte; a document's probabilities are the
means over the bytes of its letters. Training keeps all states; reading takes them over a byte at a time and keeps labels.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrays import releasing, slices, sums, utf8
from .sampling import in_fold
from .store import named, spread_by_doc

#: Training documents of each language at most; windows taken from each, evenly over its text, and their bytes.
SAMPLE, WINDOWS, LEARN = 400, 8, 64
#: Bytes read by a window, and on either side of it.
READ, MARGIN = 160, 16
#: States a direction, windows a training step, steps and rate.
HIDDEN, BATCH, STEPS, RATE = 16, 192, 300, 0.015
#: Windows read together.
LANES = 1024
_LETTER = r"\p{L}"
#: Bytes of ASCII letters and of longer characters.
_SPELLS = np.zeros(256, dtype=bool)
_SPELLS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True

Params = dict[str, np.ndarray]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.tanh(np.multiply(x, 0.5, out=x), out=x)
    x += 1
    x *= 0.5
    return x


def run_gru(p: Params, side: str, bytes_: np.ndarray, real: np.ndarray | None, keep: bool = False) -> tuple[np.ndarray, list]:
    """States after each byte (time, HIDDEN, window) of one direction; padding (not real) leaves a state as it is."""
    steps, n = bytes_.shape
    table, u = p["e" + side], p["u" + side]
    h = np.zeros((HIDDEN, n), dtype=table.dtype)
    out, saved = np.zeros((steps, HIDDEN, n), dtype=table.dtype), []
    for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
        x, y = table.take(bytes_[t], axis=1), u @ h
        x[: 2 * HIDDEN] += y[: 2 * HIDDEN]
        zr = _sigmoid(x[: 2 * HIDDEN])
        z, r = zr[:HIDDEN], zr[HIDDEN:]
        yc = y[2 * HIDDEN :]
        c = x[2 * HIDDEN :]
        c += r * yc
        np.tanh(c, out=c)
        new = c + z * (h - c)
        if real is not None and not real[t].all():
            new = np.where(real[t], new, h)
        if keep:
            saved.append((t, h, z, r, c, yc))
        h = out[t] = new
    return out, saved


def _back(p: Params, side: str, bytes_: np.ndarray, real: np.ndarray, saved: list, d_out: np.ndarray, grad: Params) -> None:
    """Backpropagation through time of one direction."""
    u, d_h = p["u" + side], np.zeros_like(d_out[0])
    for t, h, z, r, c, yc in reversed(saved):
        d = d_h + d_out[t]
        d_new = np.where(real[t], d, 0)
        d_c = d_new * (1 - z) * (1 - c * c)
        d_z = d_new * (h - c) * z * (1 - z)
        d_r = d_c * yc * r * (1 - r)
        d_x = np.concatenate([d_z, d_r, d_c])
        d_y = np.concatenate([d_z, d_r, d_c * r])
        hot = np.zeros((256, bytes_.shape[1]), dtype=d_x.dtype)
        hot[bytes_[t], np.arange(bytes_.shape[1])] = 1
        grad["e" + side] += d_x @ hot.T
        grad["u" + side] += d_y @ h.T
        d_h = np.where(real[t], d_new * z + u.T @ d_y, d)


def train(windows: list[bytes], langs: np.ndarray, n_langs: int, seed: int = 7) -> Params:
    """Parameters from stretches of text and the number of each one's language."""
    rng = np.random.default_rng(seed)
    p: Params = {f"e{s}": rng.normal(0, 0.3, (3 * HIDDEN, 256)) for s in "fb"} | {f"u{s}": rng.normal(0, 0.25, (3 * HIDDEN, HIDDEN)) for s in "fb"}
    p |= {"v": rng.normal(0, 0.2, (n_langs, 2 * HIDDEN)), "c": np.zeros((n_langs, 1))}
    p = {k: v.astype(np.float32) for k, v in p.items()}
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    by_lang = [np.flatnonzero(langs == k) for k in range(n_langs)]
    for step in range(1, STEPS + 1):
        own = np.concatenate([rng.choice(ids, -(-BATCH // n_langs)) for ids in by_lang])
        bytes_, real = pad([windows[i] for i in own])
        f, saved_f = run_gru(p, "f", bytes_, real, True)
        b, saved_b = run_gru(p, "b", bytes_, real, True)
        both = np.concatenate([f, b], axis=1)
        d = label(p, both)
        d[:, langs[own], np.arange(len(own))] -= 1
        d *= (real / real.sum())[:, None, :].astype(d.dtype)
        grad = {k: np.zeros_like(v) for k, v in p.items()}
        grad["v"], grad["c"] = np.einsum("tkn,thn->kh", d, both, optimize=True), d.sum(axis=(0, 2))[:, None]
        d_both = p["v"].T @ d
        _back(p, "f", bytes_, real, saved_f, d_both[:, :HIDDEN], grad)
        _back(p, "b", bytes_, real, saved_b, d_both[:, HIDDEN:], grad)
        rate = RATE * min(1, 2 * (1 - step / (STEPS + 1)))
        for k in p:
            first[k] += 0.1 * (grad[k] - first[k])
            second[k] += 0.01 * (grad[k] ** 2 - second[k])
            p[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return p


def label(p: Params, states: np.ndarray) -> np.ndarray:
    """Probabilities of the languages (time, language, window) at every position."""
    x = p["v"] @ states + p["c"]
    x = np.exp(x - x.max(axis=1, keepdims=True))
    x /= x.sum(axis=1, keepdims=True)
    return x


def pad(windows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    size = np.array([len(w) for w in windows])
    bytes_ = np.zeros((len(windows), max(1, size.max(initial=0))), dtype=np.uint8)
    real = np.arange(bytes_.shape[1]) < size[:, None]
    bytes_[real] = np.frombuffer(b"".join(windows), np.uint8)
    return np.ascontiguousarray(bytes_.T), np.ascontiguousarray(real.T)


def _halves(p: Params) -> dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of each direction the rows of its bytes (gate, byte, HIDDEN), weights (gate, HIDDEN, HIDDEN) and share of the labels, as _step takes them."""
    out = {}
    for k, side in enumerate("fb"):
        table, u = (p[w + side].reshape(3, HIDDEN, -1).transpose(0, 2, 1).copy() for w in "eu")
        table[:2] *= -1
        u[:2] *= -1
        out[side] = table, u, p["v"][:, k * HIDDEN : (k + 1) * HIDDEN].copy()
    return out


def _step(table: np.ndarray, u: np.ndarray, at: np.ndarray, h: np.ndarray, room: np.ndarray) -> None:
    """Takes the states h (window, HIDDEN) over one byte each, as run_gru does; room is scratch for two arrays a gate."""
    x, y = room[: 6 * h.size].reshape(2, 3, *h.shape)
    table.take(at, axis=1, out=x, mode="clip")
    np.matmul(h, u, out=y)
    gates, c, yc = x[:2], x[2], y[2]
    gates += y[:2]
    np.exp(gates, out=gates)
    gates += 1  # the inverse of z and r
    yc /= gates[1]
    c += yc
    np.tanh(c, out=c)
    h -= c
    h /= gates[0]
    h += c


def _window_sums(p: Params, halves: dict, data: np.ndarray, start: np.ndarray, size: np.ndarray, margins: dict[str, np.ndarray], room: np.ndarray) -> np.ndarray:
    """Sums of the letter-byte probabilities (window, language) of windows in ascending order of size.

    A direction reads the margin that it comes from, not the other one; windows still read at a byte are the last ones.
    """
    steps, n = int(size[-1]), len(size)
    t = np.arange(steps)
    read = data[np.minimum(start + t[:, None], len(data) - 1)]
    first = np.searchsorted(size, t, "right")
    x = np.zeros((steps, len(p["c"]), n), dtype=p["c"].dtype)
    for side, (table, u, v) in halves.items():
        h = np.zeros((n, HIDDEN), dtype=u.dtype)
        some = np.flatnonzero(margins[side])
        if len(some):
            margin, up = margins[side][some], np.zeros((len(some), HIDDEN), dtype=u.dtype)
            edge = start[some] if side == "f" else start[some] + size[some] - 1
            for d in range(int(margin.max()), 0, -1):
                real = margin >= d
                _step(table, u, data[np.where(real, edge - d if side == "f" else edge + d, 0)], up, room)
                if not real.all():
                    up *= real[:, None]
            h[some] = up
        for k in t.tolist() if side == "f" else t[::-1].tolist():
            own = h[first[k] :]
            _step(table, u, read[k, first[k] :], own, room)
            x[k, :, first[k] :] += v @ own.T
    x += p["c"]
    x -= x.max(axis=1, keepdims=True)
    np.exp(x, out=x)
    x *= ((_SPELLS[read] & (t[:, None] < size)) / x.sum(axis=1))[:, None]
    return x.sum(axis=0).T


def text_sums(p: Params, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of each text's letter-byte probabilities, a row a text."""
    n = -(-np.diff(offsets) // READ)
    of = np.repeat(np.arange(len(n)), n)
    start = offsets[:-1][of] + READ * (np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n))
    end = np.minimum(start + READ, offsets[1:][of])
    before, after = np.minimum(MARGIN, start - offsets[:-1][of]), np.minimum(MARGIN, offsets[1:][of] - end)
    out = np.zeros((len(n), len(p["c"])))
    halves, room = _halves(p), np.empty(6 * HIDDEN * LANES, dtype=p["uf"].dtype)
    order = np.argsort(end - start, kind="stable")
    with np.errstate(over="ignore"):  # a closed gate's inverse may be infinite
        for k in range(0, len(order), LANES):
            own = order[k : k + LANES]
            np.add.at(out, of[own], _window_sums(p, halves, data, start[own], (end - start)[own], {"f": before[own], "b": after[own]}, room))
    return out


@releasing
def _predict(batches: Iterator[pa.RecordBatch], p: Params | None, langs: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch):
            text = pc.utf8_lower(piece.column("text").fill_null(""))
            lettered = pc.match_substring_regex(text, _LETTER).to_numpy(zero_copy_only=False)
            pooled = text_sums(p, *utf8(text)) if p is not None else np.zeros((len(text), 1))
            pooled /= np.maximum(1e-12, pooled.sum(axis=1, keepdims=True))
            best = pooled.argmax(axis=1)
            good = lettered & (pooled.max(axis=1) > 0)
            names = [langs[k] if g and langs else "und" for k, g in zip(best.tolist(), good.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(names, pa.string()), pa.array(np.where(good, np.minimum(1.0, pooled.max(axis=1)), 0.0))], names=["doc_id", "lang_pred", "score"])


@releasing
def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each text up to WINDOWS stretches of LEARN bytes, evenly over it."""
    for batch in batches:
        for piece in slices(batch):
            cut = []
            for data in pc.utf8_lower(piece.column("text")).cast(pa.binary()).to_pylist():
                k = max(1, min(WINDOWS, len(data) // LEARN))
                starts = [i * max(0, len(data) - LEARN) // max(1, k - 1) for i in range(k)]
                cut.append([data[a : a + LEARN] for a in starts])
            yield pa.RecordBatch.from_arrays([piece.column("lang"), piece.column("place"), pa.array(cut, pa.list_(pa.binary()))], names=["lang", "place", "cut"])


def fit(docs: DataFrame, learn) -> tuple[Params | None, list[str]]:
    """A network and its languages from a bounded sample: for each language the rows with the least hashes of id and text.

    Equal rows count once. The sample is the same however the rows are dealt.
    """
    rows = docs.where(learn & F.col("lang").isNotNull() & F.col("text").rlike(_LETTER))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # a row a language
    langs = sorted(counts)
    if not langs:
        return None, []
    share = F.create_map(*(F.lit(x) for lang in langs for x in (lang, min(1.0, 2.0 * SAMPLE / counts[lang]))))
    place = F.xxhash64("doc_id", "text")
    some = rows.select("lang", "text", place.alias("place")).where(F.col("place") / 2.0**64 + 0.5 <= share[F.col("lang")])
    least = Window.partitionBy("lang").orderBy("place")  # about twice SAMPLE rows a language
    some = some.dropDuplicates(["lang", "place"]).withColumn("k", F.row_number().over(least)).where(F.col("k") <= SAMPLE)
    cut = some.select("lang", "place", "text").mapInArrow(_stretches, "lang string, place long, cut array<binary>").orderBy("lang", "place").collect()
    taken = [(bytes(w), langs.index(r["lang"])) for r in cut for w in r["cut"]]
    return train([w for w, _ in taken], np.array([k for _, k in taken]), len(langs)), langs


def identify(docs: DataFrame, folds: int = 4, held_out: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred and score (the pooled probability of lang_pred) of each row of docs.

    Rows whose crc32(doc_id as text) mod folds is held_out are not learnt from; a null doc_id is in no fold and learnt
    from. A null text, or one without a letter, is und with score 0, as is every text if there is nothing to learn from.
    Repeated rows are judged each; further columns are ignored; an empty table gives an empty one.
    """
    out = in_fold(F.col("doc_id"), folds, held_out)
    p, langs = fit(docs.select(named(docs, "doc_id", "long"), named(docs, "lang", "string"), named(docs, "text", "string")), ~out)
    found = spread_by_doc(docs).mapInArrow(partial(_predict, p=p, langs=langs), "doc_id long, lang_pred string, score double")
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score")
