"""Toxicity: a lexicon learnt from labels, kept as a trie, met by Levenshtein automata of the texts' words."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import releasing, slices
from .sampling import in_fold, labelled_ids, member
from .store import materialize, spread_by_doc

#: Labelled documents of each class that the model is fitted on, at most. With the least support it bounds the lexicon too.
SAMPLE = 20_000
#: Lengths of the word beginnings that may be learnt as stems.
STEMS = (4, 5, 6, 7)
#: Words remembered by a worker and states of an automaton, at most; beyond it the memory starts anew.
REMEMBERED, STATES = 300_000, 100_000
_WORD = re.compile(r"[^\W\d_]+")
#: Words with digits or marks between their letters.
_MIXED = re.compile(r"(?<![^\W\d_])[^\W\d_]++(?:[\d@$!*_]++[^\W\d_]++)+")
#: Marks and words about a quotation.
_QUOTES = re.compile("[\"“”„«»]")
_CUES = frozenset("quote quoted said says called zitat sagte nannte cita dijo citation dit".split())
_FEATURES = ("exact", "stem", "misspelt", "quoted", "terms")


@releasing
def _terms(batches: Iterator[pa.RecordBatch], toxic: np.ndarray, clean: np.ndarray) -> Iterator[pa.RecordBatch]:
    counts = {True: Counter(), False: Counter()}
    for batch in batches:
        ids = batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
        bad = member(ids, toxic)
        chosen = np.flatnonzero((bad | member(ids, clean)) & batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False))
        for k in chosen.tolist():
            words = set(_WORD.findall((batch.column("text")[k].as_py() or "").lower()))
            counts[bool(bad[k])].update(words.union(*({w[:n] + "*" for w in words if len(w) > n} for n in STEMS)))
    names = list(counts[True].keys() | counts[False].keys())
    yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *(pa.array([counts[k][t] for t in names], pa.int64()) for k in (True, False))], names=["term", "bad", "good"])


def fit_lexicon(table: DataFrame, toxic: np.ndarray, clean: np.ndarray) -> dict[str, float]:
    """Terms (a stem ends in *) with the log of how much likelier a toxic document holds them."""
    least = max(4, len(toxic) // 400)
    found = table.mapInArrow(partial(_terms, toxic=toxic, clean=clean), "term string, bad long, good long")
    odds = F.log((F.col("bad") + 0.5) / (len(toxic) + 1)) - F.log((F.col("good") + 0.5) / (len(clean) + 1))
    found = found.groupBy("term").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).withColumn("odds", odds)
    rows = {r["term"]: (r["bad"], r["odds"]) for r in found.where((F.col("bad") >= least) & (F.col("odds") >= 3)).collect()}
    return merged(rows)


def merged(rows: dict[str, tuple[int, float]]) -> dict[str, float]:
    """Terms and their odds without what others say already: a stem stays if it says more than any one word that it begins and
    no shorter stem stays; a word stays if no stem covers it."""
    words = [t for t in rows if not t.endswith("*")]
    most: dict[str, int] = {}  # beginning -> support of its most frequent longer word
    for w in words:
        for n in STEMS:
            most[w[:n]] = max(rows[w][0], most.get(w[:n], 0))
    stems: set[str] = set()
    covered = lambda t: any(t[:n] in stems for n in STEMS if n <= len(t))
    for t in sorted((t[:-1] for t in rows if t.endswith("*")), key=lambda t: (len(t), t)):
        if 2 * most.get(t, 0) <= rows[t + "*"][0] and not covered(t):
            stems.add(t)
    chosen = sorted(t + "*" for t in stems) + sorted(w for w in words if not covered(w))
    return {t: float(rows[t][1]) for t in chosen}


def errors(length: int) -> int:
    """Edits that a term of some length bears."""
    return 0 if length < 5 else 1 if length < 9 else 2


class Automaton:
    """The Levenshtein automata of all terms over their trie, made deterministic state by state as words are read.

    A state holds, for each trie node that is near enough, the least distance between the characters read and the
    node's path; besides (node, x), a swap of neighbours that x completes, and (node, None), a stem that the word goes on
    from. Swapped neighbours are one edit, a term's length alone gives its edits, and stems accept words that begin with
    them. Words that share a beginning, or whose beginnings leave the same nodes, share states.
    """

    def __init__(self, terms: list[str]):
        self.below: list[dict[str, int]] = [{}]
        self.ends: dict[int, tuple[str, int]] = {}  # node -> (term, edits that it bears)
        self.stems: dict[int, tuple[str, int]] = {}
        room: dict[int, int] = {}  # node -> most edits that a term below it bears
        for term in terms:
            bare = term.removesuffix("*")
            nodes, bears = self.path(bare), errors(len(bare))
            (self.ends if bare == term else self.stems)[nodes[-1]] = (term, bears)
            for node in nodes:
                room[node] = max(bears, room.get(node, 0))
        self.room = [room.get(k, 0) for k in range(len(self.below))]
        self.restart()

    def path(self, term: str) -> list[int]:
        """The nodes from the root to a term's, made where they are missing."""
        nodes = [0]
        for ch in term:
            below = self.below[nodes[-1]]
            if ch not in below:
                below[ch] = len(self.below)
                self.below.append({})
            nodes.append(below[ch])
        return nodes

    def restart(self) -> None:
        self.number: dict[frozenset, int] = {}
        self.nodes: list[list[tuple[int, int]]] = []
        self.next: list[dict[str, int]] = []
        self.best: list[tuple[int, str] | None] = []
        self.state({0: 0})

    def state(self, near: dict) -> int:
        near = {k: d for k, d in near.items() if d <= self.room[k if isinstance(k, int) else k[0]]}
        todo = [k for k in near if isinstance(k, int)]
        for node in todo:
            d = near[node] + 1
            for child in self.below[node].values():
                if d <= self.room[child] and near.get(child, d + 1) > d:
                    near[child] = d
                    todo.append(child)
        if not near:
            return -1
        key = frozenset(near.items())
        if key not in self.number:
            self.number[key] = len(self.nodes)
            self.nodes.append(list(near.items()))
            self.next.append({})
            found = [(d, *(self.ends.get(k, ("", -1)) if isinstance(k, int) else self.stems[k[0]] if k[1] is None else ("", -1))) for k, d in near.items()]
            self.best.append(min(((d, term) for d, term, bears in found if d <= bears), default=None))
        return self.number[key]

    def step(self, at: int, ch: str) -> int:
        near: dict = {}

        def put(key: int | tuple, d: int) -> None:
            near[key] = min(d, near.get(key, d))

        for key, d in self.nodes[at]:
            if not isinstance(key, int):
                if key[1] is None:
                    put(key, d)
                elif key[1] == ch:
                    put(key[0], d)
                continue
            if key in self.stems and d <= self.stems[key][1]:
                put((key, None), d)
            put(key, d + 1)
            for x, child in self.below[key].items():
                put(child, d + (x != ch))
                if x != ch and ch in self.below[child]:
                    put((self.below[child][ch], x), d + 1)
        to = self.next[at][ch] = self.state(near)
        return to

    def match(self, word: str) -> tuple[int, str] | None:
        """(distance, term) of the nearest term, the first by name of equally near ones."""
        if len(self.nodes) > STATES:
            self.restart()
        at, steps = 0, self.next
        for ch in word:
            to = steps[at].get(ch)
            at = self.step(at, ch) if to is None else to
            if at < 0:
                return None
        return self.best[at]


class Lexicon:
    """Terms and the words that have met them."""

    def __init__(self, terms: dict[str, float]):
        self.terms = terms
        self.automaton = Automaton(list(terms))
        self.known: dict[str, tuple[str, int] | None] = {}

    def match(self, word: str) -> tuple[str, int] | None:
        """The nearest term, the first by name of equally near ones, and its distance."""
        best = self.automaton.match(word)
        return (best[1], best[0]) if best else None

    def look(self, words: list[str]) -> list[tuple[str, int] | None]:
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        for w in set(words).difference(known):
            known[w] = self.match(w) if len(w) > 2 else None
        return list(map(known.__getitem__, words))


@lru_cache(maxsize=1)
def lexicon_of(terms: tuple[tuple[str, float], ...]) -> Lexicon:
    """One for a worker's tasks in turn, so that states are made once."""
    return Lexicon(dict(terms))


def quotes(text: str, start: int, end: int) -> bool:
    """Whether a hit lies within quotation marks, or close behind a word about speech and one mark."""
    before, after = text[max(0, start - 60) : start], text[end : end + 60]
    opened = len(_QUOTES.findall(before)) % 2 == 1
    said = not _CUES.isdisjoint(_WORD.findall(before.lower())[-4:])
    return bool(_QUOTES.search(after)) and opened or said and bool(_QUOTES.search(before + after))


def features(text: str, lexicon: Lexicon) -> tuple[float, ...]:
    low = text.lower()
    words = _WORD.findall(low)
    hits = [(k, m) for k, m in enumerate(lexicon.look(words)) if m]
    mixed = list(_MIXED.finditer(low))
    also = [(x.span(), m) for x, m in zip(mixed, lexicon.look([x[0] for x in mixed]), strict=True) if m]
    if not hits and not also:
        return (0.0,) * len(_FEATURES)
    spans = {k: m.span() for k, m in enumerate(_WORD.finditer(low))} if hits else {}
    hits = [(spans[k], m) for k, m in hits]
    # a mixed word counts unless a part of it has
    hits += [(span, m) for span, m in also if not any(span[0] <= a < span[1] for (a, _), _ in hits)]
    out = dict.fromkeys(_FEATURES, 0.0)
    for span, (term, distance) in hits:
        if quotes(low, *span):
            out["quoted"] += 1
        else:
            out["misspelt" if distance else "stem" if term.endswith("*") else "exact"] += lexicon.terms[term] / (1 + distance)
    out["terms"] = len({m[0] for _, m in hits})
    return tuple(float(np.log1p(out[f])) for f in _FEATURES)


@releasing
def _features(batches: Iterator[pa.RecordBatch], terms: dict[str, float]) -> Iterator[pa.RecordBatch]:
    lexicon = lexicon_of(tuple(terms.items()))
    for batch in batches:
        for piece in slices(batch):
            rows = [features(t or "", lexicon) for t in piece.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), *(pa.array(c, pa.float64()) for c in zip(*rows, strict=True))], names=["doc_id", *_FEATURES])


def fit_weights(x: np.ndarray, y: np.ndarray, steps: int = 40, ridge: float = 1e-2) -> np.ndarray:
    """Logistic regression with the intercept first, by Newton's method; classes weigh the same."""
    x = np.hstack([np.ones((len(x), 1)), x])
    if not len(y) or y.min() == y.max():
        return np.concatenate([[4.0 if len(y) and y[0] else -4.0], np.zeros(x.shape[1] - 1)])
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * len(y) / 100 * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (weight * (y - p)) - ridge * len(y) / 100 * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def score_toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (1 from 0.5) of each row of docs.

    The lexicon and weights are fitted on bounded samples of toxic and other labelled rows outside the held-out fold.
    Null and empty texts have no hits and get the score of such texts. Repeated rows are scored each; rows with a null
    doc_id are scored but never learnt from, and so is a document labelled both ways; rows that share a doc_id are learnt from
    by their mean; further columns are ignored; without labels every score is low.
    """
    table = spread_by_doc(docs)
    toxic, clean = (labelled_ids(labels, "toxic", value, SAMPLE, ~in_fold(F.col("doc_id"), folds, held_out)) for value in (1, 0))
    terms = fit_lexicon(table, toxic, clean) if len(toxic) else {}
    kinds = ", ".join(f"{f} double" for f in _FEATURES)
    rows = materialize(table.mapInArrow(partial(_features, terms=terms), f"doc_id long, {kinds}"), "toxicity")
    marks = [(int(i), k) for k, ids in ((1.0, toxic), (0.0, clean)) for i in ids]
    marks = table.sparkSession.createDataFrame(marks, "doc_id long, y double")  # 2 * SAMPLE rows at most
    known = rows.join(F.broadcast(marks), "doc_id").groupBy("doc_id", "y").agg(*(F.avg(f).alias(f) for f in _FEATURES)).orderBy("doc_id").toPandas()
    w = fit_weights(known[list(_FEATURES)].to_numpy(float), known["y"].to_numpy(float))
    linear = sum((F.col(f) * float(v) for f, v in zip(_FEATURES, w[1:], strict=True)), F.lit(float(w[0])))
    score = (1 / (1 + F.exp(-linear))).alias("score")
    return rows.select("doc_id", in_fold(F.col("doc_id"), folds, held_out).alias("held_out"), score).withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))
