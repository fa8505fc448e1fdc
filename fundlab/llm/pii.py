"""Personal data and secrets: patterns propose spans, checksums or entropy confirm them, nearby words adjust a score.

Edge cases: a null text counts as empty and has no spans; an empty table gives
an empty result; repeated rows are each scanned; columns besides the text are
passed through by ``redact`` and ignored by ``find``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"
#: Kinds in the order that breaks ties between spans with the same start.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "secret")
BASE_KINDS = KINDS[:4]
#: Scores before context, and the least score of a kind that is not a base kind.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.7, "ssn": 0.3, "secret": 0.3}
KEEP_FROM = 0.6
CONTEXT_CHARS, CONTEXT_GAIN = 48, 0.35
CONTEXT = {
    "email": ("mail", "contact", "contacto", "kontakt"),
    "ip": ("ip", "host", "server", "address", "addr"),
    "card": ("card", "visa", "mastercard", "credit", "carte", "karte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "tél", "teléfono"),
    "iban": ("iban", "bank", "account", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social", "security", "taxpayer"),
    "secret": ("token", "secret", "password", "passwd", "pwd", "apikey", "api_key", "key", "access_key", "auth", "authorization", "bearer", "credential", "credentials"),
}
AGAINST = {"ip": ("version", "release", "section"), "card": ("order", "invoice", "isbn"), "ssn": ("order", "part"), "iban": ("order", "serial", "part"), "secret": ("commit", "checksum", "sha1", "sha256", "md5", "revision")}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# From a digit run's first digit only: a later start in the same run cannot match either.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
#: Secrets: runs of key characters; those with a known prefix need no context.
_RUN = re.compile(r"[A-Za-z0-9_/+=-]{20,}+")
_PREFIXED = re.compile(r"(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,})")
#: Bits for each character that a random key has at least (a random hex string of 40 has about 3.7).
KEY_BITS = 3.0
_WORD = re.compile(r"\w+")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """The check of ISO 13616: the country and check digits move to the end, letters count from 10."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def key_bits(run: str) -> float:
    """Shannon entropy of a run's characters, in bits for each; 0 for a run without both letters and digits."""
    if not (_DIGIT.search(run) and any(c.isalpha() for c in run)):
        return 0.0
    return -sum(n / len(run) * math.log2(n / len(run)) for n in Counter(run).values())


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches found from each @, in time linear in the text."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
            at = text.find("@", done)
        else:
            done = at + 1
            at = text.find("@", done)


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def candidates(text: str) -> Iterator[tuple[str, int, int]]:
    """Spans whose pattern and validator both hold."""
    if "@" in text:
        for start, end in _emails(text):
            yield "email", start, end
    if not _DIGIT.search(text):
        return
    for m in _IP.finditer(text):
        if all(map(_octet, m.groups())):
            yield "ip", *m.span()
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            yield "card", *m.span()
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_digits(m[0])) <= 15:
                yield "phone", *m.span()
    for m in _IBAN.finditer(text):
        code = m[0].replace(" ", "")
        if 15 <= len(code) <= 34 and mod97(code):
            yield "iban", *m.span()
    if "-" in text:
        for m in _SSN.finditer(text):
            yield "ssn", *m.span()
    for m in _RUN.finditer(text):
        if key_bits(m[0]) >= KEY_BITS:
            yield "secret", *m.span()


def score(text: str, kind: str, start: int, end: int) -> float:
    """The kind's prior, raised or lowered by words just before and after the span."""
    near = text[max(0, start - CONTEXT_CHARS) : start] + " " + text[end : end + CONTEXT_CHARS // 2]
    seen = set(_WORD.findall(near.lower()))
    value = 0.9 if kind == "secret" and _PREFIXED.fullmatch(text, start, end) else PRIOR[kind]
    value += CONTEXT_GAIN * bool(seen.intersection(CONTEXT.get(kind, ())))
    value -= CONTEXT_GAIN * bool(seen.intersection(AGAINST.get(kind, ())))
    return round(min(1.0, max(0.0, value)), 4)


def spans_of(text: str | None) -> list[tuple[str, int, int, float]]:
    """Every base span, and those of the other kinds that score enough, by start then kind."""
    found = [(kind, start, end, score(text, kind, start, end)) for kind, start, end in candidates(text or "")]
    found = [x for x in found if x[0] in BASE_KINDS or x[3] >= KEEP_FROM]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def mask(text: str, spans: list[tuple[str, int, int, float]]) -> str:
    """Each span becomes <KIND>; overlapping spans become one, named by the first."""
    out, done = [], 0
    for kind, start, end, _ in spans:
        if start >= done:
            out += [text[done:start], f"<{kind.upper()}>"]
        done = max(done, end)
    return "".join(out) + text[done:]


def _spans(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: [dict(zip(("kind", "start", "end", "score"), x, strict=True)) for x in spans_of(t)])


def _masked(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: t if t is None else mask(t, spans_of(t)))


def spans(text: Column) -> Column:
    """Spans of personal data in a text column (code points, end exclusive)."""
    return F.pandas_udf(_spans, SPANS)(text)


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with every span in ``text`` replaced by <KIND>; a null text stays null."""
    return docs.withColumn(text, F.pandas_udf(_masked, "string")(F.col(text)))
