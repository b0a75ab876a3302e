"""Personal data by anchor expansion: an Aho-Corasick automaton finds anchors, local parsers expand and check them."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache, partial

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from .arrays import releasing, slices
from .store import column_of, spread_by_doc

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "account", "iban", "secret", "url")
#: Words that announce an identifier, by the kind of what follows.
CUES = {
    "account": ("account", "acct", "konto", "cuenta", "compte", "ssn", "passport"),
    "iban": ("iban",),
    "secret": ("password", "passwd", "pwd", "token", "secret", "api_key", "apikey", "api-key"),
}
_SCHEME = frozenset("abcdefghijklmnopqrstuvwxyz0123456789+.-")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_URL = re.compile(r"://[^\s\"'<>|\\^`{}]+")
_WWW = re.compile(r"www\.[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+(?:[/?#][^\s\"'<>|\\^`{}]*)?")
_ACCOUNT = re.compile(r"(?:[ _-]?(?:number|nummer|no|nr|id))?\.?[ ]?[:=#]?[ ]?([A-Z]{0,4}[0-9](?:-?[0-9]){5,})(?![A-Za-z0-9])", re.I)
_IBAN = re.compile(r"[ ]?[:=#]?[ ]?([A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]){11,30})(?![A-Za-z0-9])")
_ASSIGNED = re.compile(r"[\"']?[ ]{0,2}[:=][ ]{0,2}[\"']?([^\s\"',;]{6,})")
#: How secrets that announce themselves begin (in lower case), and what they look like.
TOKENS = {
    "akia": r"AKIA[0-9A-Z]{16}(?![0-9A-Za-z])",
    **{f"gh{k}_": rf"gh{k}_[A-Za-z0-9]{{16,}}" for k in "pousr"},
    "github_pat_": r"github_pat_[A-Za-z0-9_]{16,}",
    "sk-": r"(?<![A-Za-z0-9])sk-[A-Za-z0-9_-]{16,}",
    "xox": r"(?<![A-Za-z0-9])xox[abprs]-[A-Za-z0-9-]{10,}",
    "eyj": r"(?<![A-Za-z0-9])eyJ[A-Za-z0-9_-]{4,}\.[A-Za-z0-9_-]{4,}\.[A-Za-z0-9_-]{4,}",
    "-----begin": r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*(?:-----END [A-Z ]*PRIVATE KEY-----)?",
}
_TOKENS = {k: re.compile(v) for k, v in TOKENS.items()}
_ASCII_LOWER = {i: i + 32 for i in range(65, 91)}
SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


@cache
def anchors() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for mark in ("@", "+", "://", "www.", *"0123456789"):
        found.add_word(mark, ("digit" if mark.isdigit() else mark, len(mark)))
    for kind, words in CUES.items():
        for word in words:
            found.add_word(word, (kind, len(word)))
    for word in TOKENS:
        found.add_word(word, (word, len(word)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        twice = int(d) * (1 + k % 2)
        total += twice - 9 * (twice > 9)
    return total % 10 == 0


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def _iban(text: str) -> bool:
    plain = text.replace(" ", "")
    return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def find_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind and start.

    The four base kinds match leftmost and without overlap within their kind; a match that fails its check is
    passed over whole. Further kinds never remove a base span.
    """
    if not text:
        return []
    low = text.lower()
    low = low if len(low) == len(text) else text.translate(_ASCII_LOWER)
    at = dict.fromkeys(KINDS, 0)  # where each kind's last match ended
    run_end = 0
    spans: dict[str, list[tuple[int, int]]] = {}

    def take(kind: str, start: int, end: int, good: bool = True) -> None:
        at[kind] = end
        if good:
            spans.setdefault(kind, []).append((start, end))

    for last, (mark, size) in anchors().iter(low):
        start = last - size + 1
        if mark == "digit":
            if start >= at["card"] and (m := _CARD.match(text, start)):
                digits = re.sub("[ -]", "", m[0]) if len(m[0]) < 64 else ""
                take("card", start, m.end(), 13 <= len(digits) <= 19 and luhn(digits))
            if start >= run_end:  # the first digit of a run
                m = _IP.match(text, start) if start >= at["ip"] else None
                if m:
                    take("ip", start, m.end(), all(map(_byte, m[0].split("."))))
                    run_end = m.end()
                else:
                    run_end = start + 1
                    while run_end < len(text) and "0" <= text[run_end] <= "9":
                        run_end += 1
        elif mark == "@":
            if start >= at["email"] and (m := _DOMAIN.match(text, start)):
                left = start
                while left > at["email"] and text[left - 1] in _LOCAL:
                    left -= 1
                if left < start:
                    take("email", left, m.end())
        elif mark == "+":
            if start >= at["phone"] and (m := _PHONE.match(text, start)):
                take("phone", start, m.end(), 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15)
        elif mark == "://":
            left = start
            while left > at["url"] and low[left - 1] in _SCHEME:
                left -= 1
            while left < start and not "a" <= low[left] <= "z":
                left += 1
            if left < start and (m := _URL.match(text, start)):
                end = m.end() - len(m[0]) + len(m[0].rstrip(".,;:!?)]"))
                if end > start + 3:
                    take("url", left, end)
        elif mark == "www.":
            if start >= at["url"] and (start == 0 or not text[start - 1].isalnum()) and (m := _WWW.match(low, start)):
                take("url", start, start + len(m[0].rstrip(".,;:!?)]")))
        elif mark == "account":
            if (m := _ACCOUNT.match(text, last + 1)) and m.start(1) >= at["account"]:
                take("account", *m.span(1))
        elif mark == "iban":
            if (m := _IBAN.match(text, last + 1)) and m.start(1) >= at["iban"]:
                take("iban", *m.span(1), _iban(m[1]))
        elif mark in _TOKENS:
            if start >= at["secret"] and (m := _TOKENS[mark].match(text, start)):
                take("secret", *m.span())
        elif start >= at["secret"]:
            if (m := _ASSIGNED.match(text, last + 1)) and any(c.isdigit() for c in m[1]):
                take("secret", *m.span(1))
    return [(kind, a, b) for kind in KINDS for a, b in spans.get(kind, ())]


@releasing
def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch):
            found = [[{"kind": k, "start": a, "end": b} for k, a, b in find_spans(t)] for t in piece.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(found, _SPANS)], names=["doc_id", "spans"])


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id and spans (kind, start, end in code points; end exclusive) of every document.

    A null or empty text has no spans. Spans of different kinds may overlap. Repeated rows give repeated results;
    further columns are ignored; an empty table gives an empty one.
    """
    return spread_by_doc(docs).mapInArrow(_find, f"doc_id long, spans {SPANS}")


def mask(text: str | None) -> str | None:
    """text with each stretch that spans cover replaced by its first kind in angle brackets."""
    spans = sorted((a, b, k) for k, a, b in find_spans(text))
    if not spans:
        return text
    out, at = [], 0
    for a, b, kind in spans:
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join(out) + text[at:]


@releasing
def _mask(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch, text):
            k = piece.schema.get_field_index(text)
            texts = pa.array(map(mask, piece.column(k).to_pylist()), piece.schema.field(k).type)
            yield piece.set_column(k, piece.schema.field(k), texts)


def mask_pii(docs: DataFrame) -> DataFrame:
    """docs with the personal data in text replaced; every row and column stays, null texts stay null; names match in any case."""
    return docs.mapInArrow(partial(_mask, text=column_of(docs, "text")), docs.schema)
