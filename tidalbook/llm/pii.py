"""Personal data: patterns propose spans, checksums confirm them, context scores them.

Kinds, in the order in which equal starts are listed: email, ip, card, phone
(the base kinds), then iban and secret, which the method adds. Matches of a kind
are leftmost and do not overlap; different kinds may overlap.

=======  =========================================================  ==============================
kind     proposed by                                                confirmed by
=======  =========================================================  ==============================
email    local part, ``@``, host of two labels or more              nothing more
ip       four dotted numbers                                        each part is at most 255
card     digits, each may follow one space or hyphen                12 to 19 digits and Luhn
phone    ``+`` with digits, spaces, brackets, dots, hyphens         9 to 15 digits
iban     two letters, two digits, capitals and digits, cut at the    15 to 34 characters and mod-97
         country's length
secret   20 or more letters, digits and ``+/_-`` in one run          digits and letters, 3 bits a character
=======  =========================================================  ==============================

A span that its check refutes is dropped, without trying a shorter one. The
score of a span starts from how sure pattern and checksum are and gains or
loses with context words within 40 code points: ``call me`` before a phone,
``version`` before an ip. Base spans stay whatever their score is; added ones
need MIN_SCORE, so context decides: an iban beside ``serial`` is dropped, and a
random run is a secret only beside words such as ``token`` or ``password``.

Spans are counted in code points, end exclusive. Each text is searched whole,
in map-only tasks, with one text in hand at a time.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidalbook.llm._shared import row_slices

KINDS = ("email", "ip", "card", "phone", "iban", "secret")
BASE_KINDS = KINDS[:4]
CONTEXT = 40
MIN_SCORE = 0.5

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
#: A number is taken whole or not at all, so a long run of digits is looked at once.
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}")
SECRET = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}")
LETTER = re.compile(r"[A-Za-z]")
SECRET_BITS = 3.0
DIGIT = re.compile(r"[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")

# Characters of an IBAN by country.
IBAN_LENGTHS = dict(
    AD=24, AE=23, AL=28, AT=20, AZ=28, BA=20, BE=16, BG=22, BH=22, BR=29, CH=21, CR=22, CY=28, CZ=24, DE=22, DK=18, DO=28, EE=20, ES=24, FI=18, FO=18, FR=27, GB=22, GE=22, GI=23, GL=18, GR=27,
    GT=28, HR=21, HU=28, IE=22, IL=23, IQ=23, IS=26, IT=27, JO=30, KW=30, KZ=20, LB=28, LI=21, LT=20, LU=20, LV=21, MC=27, MD=24, ME=22, MK=19, MR=27, MT=31, MU=30, NL=18, NO=15, PK=24, PL=28,
    PS=29, PT=25, QA=29, RO=24, RS=22, SA=24, SE=24, SI=19, SK=24, SM=27, TN=24, TR=26, UA=29, VA=22, VG=24, XK=20,
)

#: Words near a span: those that speak for it and those that speak against it.
CONTEXT_WORDS = {
    "email": (("mail", "email", "contact", "write", "correo", "courriel"), ("example", "noreply")),
    "ip": (("ip", "address", "host", "server", "login"), ("version", "release", "section", "build")),
    "card": (("card", "visa", "credit", "pay", "karte", "tarjeta", "carte"), ("order", "isbn", "tracking")),
    "phone": (("call", "phone", "tel", "mobile", "fax", "telefon"), ("version", "score")),
    "iban": (("iban", "bank", "account", "transfer", "konto", "cuenta", "compte"), ("serial", "part")),
    "secret": (("apikey", "credential", "credentials", "key", "passwd", "password", "pwd", "secret", "token"), ("checksum", "commit", "digest", "md5", "sha", "uuid")),
}
BASE_SCORE = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.6, "secret": 0.4}
CONTEXT_STEP = 0.2
_WORD = re.compile(r"[^\W\d_]+")


class Span(NamedTuple):
    start: int
    rank: int
    end: int
    score: float

    def __str__(self) -> str:
        return f"{KINDS[self.rank]}:{self.start}:{self.end}"


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _card(text: str) -> bool:
    digits = NOT_DIGIT.sub("", text)
    return 12 <= len(digits) <= 19 and luhn(digits)


def _iban(text: str) -> bool:
    packed = text.replace(" ", "")
    return 15 <= len(packed) <= 34 and mod97(packed)


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """Matches of IBAN, cut at the length that the country has; they end before a character that is no letter or digit."""
    after = 0
    while found := IBAN.search(text, after):
        start, end = found.span()
        size = IBAN_LENGTHS.get(text[start : start + 2], 34)
        packed = 0
        for at in range(start, end):
            packed += text[at] != " "
            if packed == size:
                end = at + 1
                break
        after = end
        if not text[end : end + 1].isalnum():
            yield start, end


def _secret(text: str) -> bool:
    if not DIGIT.search(text) or not LETTER.search(text):
        return False
    return -sum(n / len(text) * math.log2(n / len(text)) for n in Counter(text).values()) >= SECRET_BITS


#: kind -> (a character that every match has or None for a digit, pattern, check)
FINDERS = {
    "email": ("@", EMAIL, lambda m: True),
    "ip": (".", IP, lambda m: all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.split("."))),
    "card": (None, CARD, _card),
    "phone": ("+", PHONE, lambda m: 9 <= len(NOT_DIGIT.sub("", m)) <= 15),
    "iban": (None, IBAN, _iban),
    "secret": (None, SECRET, _secret),
}


def score(kind: str, text: str, start: int, end: int) -> float:
    """From 0 to 1: the kind's own certainty, moved by the words around the span."""
    near = f"{text[max(0, start - CONTEXT) : start]} {text[end : end + CONTEXT]}".lower()
    around = set(_WORD.findall(near))
    for_it, against = CONTEXT_WORDS[kind]
    moved = BASE_SCORE[kind] + CONTEXT_STEP * (not around.isdisjoint(for_it)) - CONTEXT_STEP * (not around.isdisjoint(against))
    return round(min(max(moved, 0.0), 1.0), 3)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of EMAIL. A local part ends at an @, so each run before one is tried once."""
    after = 0
    while (at := text.find("@", after)) >= 0:
        start = at
        while start > after and (text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "._%+-")):
            start -= 1
        found = EMAIL.match(text, start) if start < at else None
        if found:
            yield start, found.end()
        after = found.end() if found else at + 1


def find_spans(text: str | None) -> list[Span]:
    """All spans of one text, by start, then kind."""
    text = text or ""
    found: list[Span] = []
    digits = DIGIT.search(text) is not None
    for rank, kind in enumerate(KINDS):
        sign, pattern, check = FINDERS[kind]
        if sign not in text if sign else not digits:
            continue
        if kind != "email" and not digits:
            continue
        places = _emails(text) if kind == "email" else _ibans(text) if kind == "iban" else ((m.start(), m.end()) for m in pattern.finditer(text))
        for start, end in places:
            if check(text[start:end]):
                sure = score(kind, text, start, end)
                if kind in BASE_KINDS or sure >= MIN_SCORE:
                    found.append(Span(start, rank, end, sure))
    return sorted(found)


SCHEMA = "doc_id bigint, " + "".join(f"n_{k} bigint, " for k in KINDS) + "base_sha256 string, spans string, scores array<double>"


def find_pii(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): counts, spans and their scores.

    spans: ``kind:start:end``, comma-joined; scores: one for each. base_sha256
    is the SHA-256 of the base kinds' spans, joined likewise. Null and empty
    texts have no spans. Repeated rows each keep a row; a null doc_id stays.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in row_slices(batches):
            counts: list[list[int]] = [[] for _ in KINDS]
            digests, joined, scores = [], [], []
            for text in part.column(1).to_pylist():
                spans = find_spans(text)
                for rank, column in enumerate(counts):
                    column.append(sum(s.rank == rank for s in spans))
                base = ",".join(str(s) for s in spans if s.rank < len(BASE_KINDS))
                digests.append(hashlib.sha256(base.encode()).hexdigest())
                joined.append(",".join(map(str, spans)))
                scores.append([s.score for s in spans])
            columns = [part.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(joined, pa.string()), pa.array(scores, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "scores"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, SCHEMA)
