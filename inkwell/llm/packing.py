"""Hierarchical multi-length packing of encoded documents into training windows."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .arrays import release, releasing, slices
from .encoding import encoder, tokenizer_path
from .store import spread_by_doc

WINDOW, END = 2048, 1
TIERS = (256, 512, 1024, 2048)
#: Tokens packed together, at least; what a worker holds in memory is about this much.
BUFFER = 1 << 20
#: Bytes of text encoded at once.
SLICE = 1 << 20
#: Tokens of a step group.
STEP = 1 << 16
PIECES = "doc_id long, start long, ids binary, length long, doc_tokens long, sequence_id long, offset long, sequence_tokens long, window int, step_id long"
_PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary()), *((c, pa.int64()) for c in ("length", "doc_tokens", "sequence_id", "offset", "sequence_tokens")), ("window", pa.int32()), ("step_id", pa.int64())])

Piece = tuple[int, int, int]  # document's index, start, length


def pack(lengths: list[int], window: int = WINDOW, tiers: tuple[int, ...] = TIERS) -> list[list[Piece]]:
    """Sequences of pieces that hold every position of documents of the given lengths once.

    Whole windows are cut off each document first. A remainder goes to the smallest tier that holds it. Tiers are
    packed from the longest: each opens a window with its longest remainder, fills the gap with the longest fitting
    remainders of shorter tiers, and closes it with a stretch cut from the next one. What is left at the end is cut
    at powers of two, so that no sequence needs padding.
    """
    out: list[list[Piece]] = []
    shelves: list[list[tuple[int, int, int]]] = [[] for _ in tiers]  # (length, document, start), ascending

    def shelve(doc: int, start: int, length: int) -> None:
        if length:
            shelf = next(k for k, t in enumerate(tiers) if length <= t)
            heapq.heappush(shelves[shelf], (-length, doc, start))

    for doc, n in enumerate(lengths):
        for start in range(0, n - n % window, window):
            out.append([(doc, start, window)])
        shelve(doc, n - n % window, n % window)
    left: list[Piece] = []
    for k in reversed(range(len(tiers))):
        size = tiers[k]
        while shelves[k]:
            sequence, room = [], size
            while room:
                # the longest remainder that fits heads one of the shelves; a shelf whose head is too long is cut
                fits = [s for s in shelves[: k + 1] if s and -s[0][0] <= room]
                some = fits or [s for s in shelves[: k + 1] if s]
                if not some:
                    break
                length, doc, start = heapq.heappop(some[-1] if fits else some[0])
                take = min(-length, room)
                sequence.append((doc, start, take))
                shelve(doc, start + take, -length - take)
                room -= take
            if room:
                left += sequence
            else:
                out.append(sequence)
    while left:
        room = 1 << (sum(p[2] for p in left).bit_length() - 1)
        sequence = []
        while room:
            doc, start, length = left.pop(0)
            take = min(length, room)
            sequence.append((doc, start, take))
            if take < length:
                left.insert(0, (doc, start + take, length - take))
            room -= take
        out.append(sequence)
    return out


def balance(totals: list[int], step: int = STEP) -> list[int]:
    """A step group for each sequence, longest first to the emptiest group."""
    groups = [(0, k) for k in range(max(1, -(-sum(totals) // step)))]
    out = [0] * len(totals)
    for i in sorted(range(len(totals)), key=lambda i: (-totals[i], i)):
        load, k = heapq.heappop(groups)
        out[i] = k
        heapq.heappush(groups, (load + totals[i], k))
    return out


def _joined(held: list[tuple[pa.Array, np.ndarray, np.ndarray]]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """doc_ids, ids and bounds of all held runs as one."""
    sizes = np.concatenate([np.diff(bounds) for _, _, bounds in held])
    return pa.concat_arrays([d for d, _, _ in held]), np.concatenate([ids for _, ids, _ in held]), np.concatenate([[0], np.cumsum(sizes)])


def _rows(doc_ids: pa.Array, ids: np.ndarray, bounds: np.ndarray, sequences: list[list[Piece]], first: int, first_step: int) -> tuple[pa.RecordBatch, int]:
    """A row for each piece, and the number of step groups; sequences are numbered from first, groups from first_step."""
    doc, start, length = np.array([p for s in sequences for p in s], dtype=np.int64).reshape(-1, 3).T
    count = np.array([len(s) for s in sequences])
    begins = np.cumsum(count) - count
    totals = np.add.reduceat(length, begins)
    steps = np.array(balance(totals.tolist()))
    offset = np.cumsum(length) - length
    own = lambda v: np.repeat(v, count)
    size = np.where(totals & (totals - 1) == 0, totals, WINDOW)
    cut = pa.py_buffer(np.concatenate([[0], np.cumsum(4 * length)]).astype(np.int32))
    pieces = pa.Array.from_buffers(pa.binary(), len(doc), [None, cut, pa.py_buffer(np.concatenate([ids[a : a + n] for a, n in zip((bounds[doc] + start).tolist(), length.tolist(), strict=True)]))])
    columns = [doc_ids.take(pa.array(doc)), start, pieces, length, np.diff(bounds)[doc], own(first + np.arange(len(count))), offset - own(offset[begins]), own(totals), own(size).astype(np.int32), own(first_step + steps)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=_PIECES), 1 + int(steps.max(initial=0))


@releasing
def _pack(batches: Iterator[pa.RecordBatch], path: str, end: int) -> Iterator[pa.RecordBatch]:
    code = encoder(path)
    part = TaskContext.get().partitionId() << 40
    n_sequences = n_steps = n_held = 0
    held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []

    def flush() -> pa.RecordBatch:
        nonlocal held, n_held, n_sequences, n_steps
        doc_ids, ids, bounds = _joined(held)
        sequences = pack(np.diff(bounds).tolist())
        out, steps = _rows(doc_ids, ids, bounds, sequences, part + n_sequences, part + n_steps)
        n_sequences, n_steps = n_sequences + len(sequences), n_steps + steps
        held, n_held = [], 0
        return out

    for batch in batches:
        for piece in slices(batch, limit=SLICE):
            ids, bounds = code.flat(piece.column("text"), end)
            # taken, the doc_ids are a copy: a slice would keep its whole batch, texts too
            held.append((piece.column("doc_id").take(pa.array(np.arange(len(piece)))), ids, bounds))
            n_held += len(ids)
            del piece, ids, bounds
            if n_held >= BUFFER:
                yield flush()
            release()
        del batch  # else it stays while the next one is read
    if held:
        yield flush()


def pack_documents(docs: DataFrame, path: str | None = None, end: int = END) -> DataFrame:
    """One row per piece of an encoded document: where it starts there, its ids, and its sequence, offset and step group.

    Each partition packs its own documents, so nothing is shuffled and only a partition's last buffer leaves short
    sequences. Null and empty texts are the end id alone. Repeated rows are packed each; further columns are ignored;
    an empty table gives no pieces.
    """
    return spread_by_doc(docs).mapInArrow(partial(_pack, path=path or tokenizer_path(), end=end), PIECES)
