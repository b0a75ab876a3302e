"""Chat formatting at token level: segments are encoded apart, reserved ids spliced in, masks built by prefix sums."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .arrays import releasing
from .encoding import as_ids, encoder, token_bytes, tokenizer_path
from .store import named, parallelism

#: Fixed values of the template: the control strings, each with an id of its own above the vocabulary.
OPEN, HEAD, CLOSE = "<turn>", "\n", "</turn>\n"
#: What no content may show: its first character gets a backslash behind it. Backslashes are doubled.
_CONTROL = re.compile(r"\\|<(?=/?turn>)|#(?=##)|<(?=\|)|\[(?=/?INST\])")
_ESCAPED = re.compile(r"\\(.)", re.S)
FORMATTED = "conv_id long, n_turns long, formatted string, ids binary, loss_mask binary"
_FORMATTED = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("formatted", pa.string()), ("ids", pa.binary()), ("loss_mask", pa.binary())])
TURNS = "conv_id long, n_turns long, turns array<struct<role:string,text:string>>, loss_text string, formatted string"
_TURNS = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))), ("loss_text", pa.string()), ("formatted", pa.string())])


def escape(text: str) -> str:
    """text in which no control string occurs."""
    return _CONTROL.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    """The text that escape was given: a backslash goes, what follows it stays."""
    return _ESCAPED.sub(r"\1", text)


def assemble(turns: list[tuple[str, str]], path: str, learn: str = "assistant") -> tuple[str, np.ndarray, np.ndarray]:
    """(formatted text, ids, loss mask) of a conversation; the mask covers the contents of turns whose role is learn."""
    code = encoder(path)
    first = code.tokenizer.get_vocab_size()
    spliced = [np.array([first + k], dtype="<u4") for k in range(3)]
    encoded = [as_ids(b) for b in code.encode([escape(x) for turn in turns for x in turn])]
    text, segments, flags = [], [], []
    for k, (role, content) in enumerate(turns):
        text += [OPEN, escape(role), HEAD, escape(content), CLOSE]
        segments += [spliced[0], encoded[2 * k], spliced[1], encoded[2 * k + 1], spliced[2]]
        flags += [0, 0, 0, int(role == learn), 0]
    ends = np.cumsum([len(s) for s in segments])
    change = np.zeros(int(ends[-1]) + 1 if len(ends) else 1, dtype=np.int64)
    np.add.at(change, np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else [], flags)
    np.add.at(change, ends, np.negative(flags))
    ids = np.concatenate(segments) if segments else np.zeros(0, "<u4")
    return "".join(text), ids, np.cumsum(change)[: len(ids)].astype(np.uint8)


def parse(ids: np.ndarray, mask: np.ndarray, path: str) -> tuple[list[tuple[str, str]], list[str]]:
    """(turns, texts under the mask) from ids alone."""
    table = token_bytes(path)
    first = encoder(path).tokenizer.get_vocab_size()
    marks = np.flatnonzero(ids >= first)
    text = lambda part: unescape(b"".join([table[i] for i in part.tolist()]).decode())
    turns = []
    for a, b, c in marks.reshape(-1, 3).tolist():
        turns.append((text(ids[a + 1 : b]), text(ids[b + 1 : c])))
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return turns, [text(ids[a:b]) for a, b in edges.reshape(-1, 2).tolist()]


@releasing
def _format(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    now, turns, rows = None, [], []
    size = 0

    def close() -> None:
        nonlocal size
        if turns:
            text, ids, mask = assemble(turns, path)
            rows.append((now, len(turns), text, ids.tobytes(), mask.tobytes()))
            size += len(text)
        turns.clear()

    def flush() -> pa.RecordBatch:
        nonlocal rows, size
        out = pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), _FORMATTED.types, strict=True)], schema=_FORMATTED)
        rows, size = [], 0
        return out

    started = False
    for batch in batches:
        for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
            if not started or conv != now:
                close()
                now, started = conv, True
                if size > 1 << 21:
                    yield flush()
            turns.append((role or "", text or ""))
    close()
    if rows:
        yield flush()


def format_chats(conversations: DataFrame, path: str | None = None) -> DataFrame:
    """conv_id, n_turns, formatted text, ids and loss mask (a byte an id) of every conversation.

    Turns stand by turn, ties by role and text. A null role or text is empty; rows with a null conv_id form one
    conversation; further columns are ignored. Tasks hold one conversation at a time.
    """
    rows = conversations.select(named(conversations, "conv_id", "long"), named(conversations, "turn", "long"), named(conversations, "role", "string"), named(conversations, "text", "string"))
    rows = rows.repartition(parallelism(rows.sparkSession), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return rows.mapInArrow(partial(_format, path=path or tokenizer_path()), FORMATTED)


@releasing
def _parse(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part, turns, loss = batch.slice(at, 256), [], []
            for ids, mask in zip(part.column("ids").to_pylist(), part.column("loss_mask").to_pylist(), strict=True):
                said, learnt = parse(as_ids(ids), np.frombuffer(mask, np.uint8), path)
                turns.append([{"role": r, "text": t} for r, t in said])
                loss.append("".join(learnt))
            yield pa.RecordBatch.from_arrays([part.column("conv_id"), part.column("n_turns"), pa.array(turns, _TURNS.types[2]), pa.array(loss), part.column("formatted")], schema=_TURNS)


def parse_chats(formatted: DataFrame, path: str | None = None) -> DataFrame:
    """conv_id, n_turns, turns, loss_text and formatted, with roles and texts as they were before formatting."""
    return formatted.mapInArrow(partial(_parse, path=path or tokenizer_path()), TURNS)
