"""Encoding whole texts with a public byte-level tokenizer, each distinct stretch between spaces encoded once.

The byte-level pattern always starts a new stretch at a space or line break before a non-space, and a line break there
is a stretch of its own, so a text cut there encodes to the concatenation of its parts. Texts with other runs of white
space or with white space at an end, where that need not hold, are encoded whole. Cutting, finding a batch's distinct
parts and putting their ids together are array operations; Python sees a part only when it is not remembered.
"""

from __future__ import annotations

import os
from array import array
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

from tokenizers import Tokenizer  # noqa: E402

from .arrays import PLAIN, PROOF, U64, stretch_hashes, utf8  # noqa: E402

DEFAULT = "byte_bpe_50k.json"
#: Bytes of memory for remembered parts in each Python worker; beyond it only those met again since they came or the last time
#: stay, and if these are more than half, only those met again in the latest batch.
REMEMBERED = 48 << 20
#: Parts encoded as one text, and texts given to the tokenizer at once.
TOGETHER, AT_ONCE = 64, 256
#: The byte-level vocabulary's character for a space.
_SPACED = chr(256 + 32)
#: Marks that always start a new stretch behind a letter.
_MARKS = ".,;:!?%$#*&|"


def tokenizer_path(name: str = DEFAULT) -> str:
    return public_tokenizers.path(name)


def _usable(part: str) -> bool:
    """Whether a part begins with a non-space, behind a line break at most."""
    return bool(part) and not part[0].isspace() or part[:1] == "\n" and part != "\n" and not part[1].isspace()


#: ASCII bytes that are no white space, to Python's str.isspace.
_FILLED = np.array([b < 128 and not chr(b).isspace() for b in range(256)])


def _usables(said: pa.Array) -> np.ndarray:
    """_usable of each part; where ASCII decides, no part is made a Python object."""
    data, at = utf8(said)
    size = np.diff(at)
    data = np.concatenate([data, np.full(2, 32, np.uint8)])
    first, second = data[at[:-1]], data[at[:-1] + 1]
    out = (size > 0) & _FILLED[first] | (size > 1) & (first == 10) & _FILLED[second]
    rest = np.flatnonzero(~out & (size > 0))
    out[rest] = [_usable(p) for p in said.take(pa.array(rest)).to_pylist()]
    return out


def _packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


def ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The positions of stretches of given starts and sizes, one stretch behind another."""
    out = np.repeat(start - (np.cumsum(size) - size), size)
    out += np.arange(len(out))
    return out


class Memory:
    """Ids of parts under two 64-bit hashes of each, in arrays sorted by the first: some 30 bytes a part."""

    def __init__(self):
        self.key, self.proof = np.zeros(0, U64), np.zeros(0, U64)
        self.start, self.size, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, "<u4")
        self.met = np.zeros(0, bool)

    def find(self, key: np.ndarray, proof: np.ndarray) -> np.ndarray:
        """Where each part stands; -1 for unknown ones."""
        if not len(self.key):
            return np.full(len(key), -1)
        order = np.argsort(key)  # neighbours are looked up near each other
        key = key[order]
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        out = np.empty(len(key), dtype=np.int64)
        out[order] = np.where((self.key[at] == key) & (self.proof[at] == proof[order]), at, -1)
        return out

    def add(self, key: np.ndarray, proof: np.ndarray, ids: np.ndarray, size: np.ndarray, place: np.ndarray) -> None:
        """Remembers parts; place, where other parts stand, is moved along."""
        start = len(self.ids) + np.cumsum(size) - size
        key, own = np.unique(key, return_index=True)
        at = np.searchsorted(self.key, key)
        place += np.searchsorted(at, place, "right")
        self.key, self.proof = np.insert(self.key, at, key), np.insert(self.proof, at, proof[own])
        self.start, self.size = np.insert(self.start, at, start[own]), np.insert(self.size, at, size[own])
        self.met = np.insert(self.met, at, False)
        self.ids = np.concatenate([self.ids, ids])

    def keep(self, at: np.ndarray) -> None:
        """Forgets all but the parts at these places."""
        at = np.unique(at)
        self.ids = self.ids[ragged(self.start[at], self.size[at])]
        self.key, self.proof, self.size = self.key[at], self.proof[at], self.size[at]
        self.start = np.cumsum(self.size, dtype=np.int64) - self.size
        self.met = np.zeros(len(at), bool)

    def nbytes(self) -> int:
        return 29 * len(self.key) + 4 * len(self.ids)


class Encoder:
    """Texts to little-endian unsigned 32-bit ids."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        self.tokenizer = Tokenizer.from_file(path)
        self.remembered = remembered
        self.memory = Memory()
        # ids whose bytes begin with a space
        self.opens = np.array([(self.tokenizer.id_to_token(i) or "")[:1] == _SPACED for i in range(self.tokenizer.get_vocab_size())])

    def whole(self, texts: list[str]) -> list[bytes]:
        runs = (texts[k : k + AT_ONCE] for k in range(0, len(texts), AT_ONCE))  # encodings are much larger than their ids
        return [_packed(e.ids) for run in runs for e in self.tokenizer.encode_batch_fast(run, add_special_tokens=False)]

    def spaced(self, parts: list[str]) -> list[bytes]:
        """The ids of each part behind a space. Parts hold no space, so in a text of many each begins at an id that opens with one."""
        out: list[bytes] = []
        groups = [parts[k : k + TOGETHER] for k in range(0, len(parts), TOGETHER)]
        for k in range(0, len(groups), AT_ONCE):
            some = groups[k : k + AT_ONCE]
            for group, packed in zip(some, self.whole([" " + " ".join(g) for g in some]), strict=True):
                at = (4 * np.flatnonzero(self.opens[as_ids(packed)])).tolist()
                if len(at) == len(group) and at[0] == 0:
                    out += [packed[a:b] for a, b in zip(at, [*at[1:], len(packed)], strict=True)]
                else:
                    out += self.whole([" " + p for p in group])
        return out

    def learn(self, new: list[str]) -> list[bytes]:
        """The ids of distinct parts behind a space; a part that opens with a line break replaces the space by it."""
        out: list[bytes] = [b""] * len(new)
        broken, plain, ends = [], {}, {}
        spaced, marked = [], []  # (place, which one of plain) and (place, which of plain, which of ends)
        for k, p in enumerate(new):
            if p[0] == "\n":
                broken.append(k)
            elif p[-1] in _MARKS and (core := p.rstrip(_MARKS)).isalpha():
                # letters and the marks behind them never share a stretch, so both are encoded apart
                marked.append((k, plain.setdefault(core, len(plain)), ends.setdefault(p[len(core) :], len(ends))))
            else:
                spaced.append((k, plain.setdefault(p, len(plain))))
        if broken:
            lead = self.whole(["\n"])[0]
            for k, ids in zip(broken, self.whole([new[k][1:] for k in broken]), strict=True):
                out[k] = lead + ids
        words = self.spaced(list(plain))
        marks = self.whole(list(ends))
        for k, word in spaced:
            out[k] = words[word]
        for k, word, end in marked:
            out[k] = words[word] + marks[end]
        return out

    def flat(self, texts: pa.Array | list[str | None], end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds): the ids of all texts, each closed by end if that is given; a text's lie between its bounds. A null has none."""
        column = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        if not len(column):
            return np.zeros(0, "<u4"), np.zeros(1, np.int64)
        # a line break before each text makes its first part one like others; that break's id is cut off again
        cut = pc.split_pattern(pc.replace_substring(pc.binary_join_element_wise("\n", column, ""), "\n", " \n"), " ")
        bounds = cut.offsets.to_numpy().astype(np.int64)
        coded = cut.flatten().dictionary_encode()
        del cut
        code = coded.indices.to_numpy()
        parts = coded.dictionary
        data, at = utf8(parts)
        key = stretch_hashes(data, at[:-1], at[1:], PLAIN)
        proof = stretch_hashes(data, at[:-1], at[1:], PROOF)
        place = self.memory.find(key, proof)
        self.memory.met[place[place >= 0]] = True
        if self.memory.nbytes() > self.remembered:
            latest = np.zeros(len(self.memory.key), bool)
            latest[place[place >= 0]] = True
            again = np.flatnonzero(self.memory.met)
            self.memory.keep(again)
            if 2 * self.memory.nbytes() > self.remembered:
                self.memory.keep(np.flatnonzero(latest[again]))
            place = self.memory.find(key, proof)
        new = np.flatnonzero(place < 0)
        said = parts.take(pa.array(new))
        usable = _usables(said)
        odd_part = np.zeros(len(parts), dtype=bool)
        odd_part[new[~usable]] = True
        if usable.any():
            ids = self.learn(said.filter(pa.array(usable)).to_pylist())
            own = new[usable]
            old = place[place >= 0]
            self.memory.add(key[own], proof[own], as_ids(b"".join(ids)), np.fromiter(map(len, ids), np.int32, len(ids)) // 4, old)
            place[place >= 0] = old
            place[own] = self.memory.find(key[own], proof[own])
        known = place >= 0
        start, size = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        start[known], size[known] = self.memory.start[place[known]], self.memory.size[place[known]]
        first, last = bounds[:-1], bounds[1:]
        odd = np.add.reduceat(odd_part[code], first, dtype=np.int64) > 1  # what is before a text's break is empty
        skip = len(self.whole(["\n"])[0]) // 4
        # parts' ids stand behind one another, without the break's that opens a text's first part
        begin, n = start[code], size[code]
        begin[first + 1] += skip
        n[first + 1] -= skip
        n[np.repeat(odd, last - first)] = 0
        n_text = np.add.reduceat(n, first)
        rest = np.flatnonzero(odd).tolist()
        wholes = [as_ids(b) for b in self.whole(column.take(pa.array(rest, pa.int64())).to_pylist())]
        n_text[rest] = [len(w) for w in wholes]
        to = np.concatenate([[0], np.cumsum(n_text + int(end is not None))])
        out = np.empty(int(to[-1]), "<u4")
        fill = np.ones(len(out), dtype=bool)
        if end is not None:
            out[to[1:] - 1] = end
            fill[to[1:] - 1] = False
        for k, ids in zip(rest, wholes, strict=True):
            out[to[k] : to[k] + len(ids)] = ids
            fill[to[k] : to[k] + len(ids)] = False
        out[fill] = self.memory.ids[ragged(begin, n)]
        return out, to

    def encode(self, texts: pa.Array | list[str | None]) -> list[bytes]:
        """The ids of each text as bytes; a null has none."""
        ids, bounds = self.flat(texts)
        return [ids[a:b].tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


@cache
def encoder(path: str, remembered: int = REMEMBERED) -> Encoder:
    """One for each worker process, tokenizer and size of memory."""
    return Encoder(path, remembered)


@cache
def token_bytes(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    of = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}
    tokenizer = Tokenizer.from_file(path)
    names = (tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size()))
    return [bytes(of[c] for c in name) if all(c in of for c in name) else name.encode() for name in names]


def as_ids(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, dtype="<u4")
