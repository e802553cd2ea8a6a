"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

Positions are code points, ends exclusive. Every search is linear in the length of the text, also
over very long runs of one character.
"""

from __future__ import annotations

import hashlib
import ipaddress
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perilframe.llm.common import free_columns, give_back

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ipv6", "local_phone", "national_id", "secret", "private_key")
#: A span beyond the base ones is reported from this score on.
THRESHOLD = 0.6
#: Characters on either side in which context words count.
CONTEXT = 40

_LOCAL = "".join(map(chr, (*range(65, 91), *range(97, 123), *range(48, 58)))) + "._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# No number starts inside a run of digits: the run's own start would match as well.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_IPV6 = re.compile(r"(?<![0-9A-Za-z:.])[0-9A-Fa-f:.]{3,45}(?![0-9A-Za-z:])")
_LOCAL_PHONE = re.compile(r"(?<![0-9A-Za-z+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[-.\x20])[0-9]{3}[-.\x20][0-9]{4}(?![0-9A-Za-z-])")
_SSN = re.compile(r"(?<![0-9A-Za-z-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9A-Za-z-])")
_DNI = re.compile(r"(?<![0-9A-Za-z])([XYZ]?[0-9]{7,8})-?([A-Z])(?![0-9A-Za-z])")
_NIR = re.compile(r"(?<![0-9A-Za-z])[12]\x20?[0-9]{2}\x20?[0-9]{2}\x20?[0-9]{2}\x20?[0-9]{3}\x20?[0-9]{3}\x20?[0-9]{2}(?![0-9A-Za-z])")
_TAX_ID = re.compile(r"(?<![0-9A-Za-z.-])[1-9][0-9](?:\x20?[0-9]{3}){3}(?![0-9A-Za-z])")
# A name of a credential, a sign of assignment, and the value.
_ASSIGNED = re.compile(
    r"(?i)(?:api|access|secret|private|auth)[_-]?(?:key|token)|token|secret|passw(?:or)?d|pwd|credential")
_VALUE = re.compile(r"[A-Za-z0-9_-]{0,20}[\"']?\x20?(?:=|:|=>|:=)\x20?[\"']?([A-Za-z0-9+/=_.~!@#$%^&*-]{6,256})")
# How keys of widespread services begin, and their length.
_PREFIXED = re.compile(
    r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|ASIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|AIza[0-9A-Za-z_-]{35}"
    r"|xox[abprs]-[0-9A-Za-z-]{10,72}|sk-[A-Za-z0-9_-]{20,100}|eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+)")
_PEM = re.compile(r"-----BEGIN ([A-Z ]{0,30})PRIVATE KEY-----")
_DNI_LETTERS = "TRWAGMYFPDXBNJZSQVHLCKE"
#: Bits per character that a value without a telling name or prefix must have.
ENTROPY = 2.5
_DIGIT = re.compile("[0-9]")
_NOT_DIGITS = re.compile("[^0-9]+")

_FOR = {
    "email": re.compile(r"(?i)mail|contact|write|reach"),
    "ip": re.compile(r"(?i)\bip\b|address|host|server"),
    "card": re.compile(r"(?i)card|visa|credit|payment"),
    "phone": re.compile(r"(?i)phone|call|tel|mobile|fax"),
    "iban": re.compile(r"(?i)iban|bank|account|transfer"),
    "ipv6": re.compile(r"(?i)\bip|address|host|server"),
    "local_phone": re.compile(r"(?i)phone|call|tel|mobile|fax|cell|contact"),
    "national_id": re.compile(r"(?i)ssn|social|security|national|tax|steuer|dni|nie\b|nif|insee|identit|passport|\bid\b"),
    "secret": re.compile(r"(?i)key|token|secret|passw|pwd|credential|auth"),
    "private_key": re.compile(r"(?i)key|pem|ssh|tls|cert"),
}
_AGAINST = re.compile(r"(?i)version|order|invoice|serial|isbn|example|sample")
#: Score of a confirmed span before its context: how seldom chance passes the check.
_PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "ipv6": 0.8, "local_phone": 0.5,
          "national_id": 0.5, "secret": 0.8, "private_key": 1.0}

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def mod97(iban: str) -> bool:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Around each @: the run of local characters before it and a dotted name after it."""
    done = at = 0
    while (at := text.find("@", at)) >= 0:
        before = text[done:at]
        start = done + len(before.rstrip(_LOCAL))
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
        done = at = found.end() if found else at + 1


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for found in _IP.finditer(text):
        parts = (p.lstrip("0") for p in found[0].split("."))
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in parts):
            yield found.span()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for found in _CARD.finditer(text):
        digits = _NOT_DIGITS.sub("", found[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield found.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for found in _PHONE.finditer(text):
        if 9 <= len(_NOT_DIGITS.sub("", found[0])) <= 15:
            yield found.span()


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """The longest prefix of a match that the check digits confirm."""
    for found in _IBAN.finditer(text):
        for end in range(found.end(), found.start() + 14, -1):
            if text[end - 1] != " " and not (end < found.end() and text[end] not in " "):
                compact = text[found.start() : end].replace(" ", "")
                if len(compact) >= 15 and mod97(compact):
                    yield found.start(), end
                    break


def entropy(text: str) -> float:
    """Bits per character."""
    return -sum(n / len(text) * math.log2(n / len(text)) for n in Counter(text).values())


def iso7064(digits: str) -> bool:
    """Check digit of mod 11, 10."""
    rest = 10
    for digit in digits[:-1]:
        rest = (rest + int(digit)) % 10 or 10
        rest = rest * 2 % 11
    return (11 - rest) % 10 == int(digits[-1])


def _ipv6(text: str) -> Iterator[tuple[int, int]]:
    for found in _IPV6.finditer(text):
        name = found[0].rstrip(".")
        if name.count(":") >= 2 and re.search("[0-9A-Fa-f]", name):
            try:
                ipaddress.IPv6Address(name)
            except ValueError:
                continue
            yield found.start(), found.start() + len(name)


def _local_phones(text: str) -> Iterator[tuple[int, int]]:
    """Area and exchange do not start with 0 or 1."""
    for found in _LOCAL_PHONE.finditer(text):
        digits = _NOT_DIGITS.sub("", found[0])
        if digits[0] > "1" and digits[3] > "1":
            yield found.span()


def _national_ids(text: str) -> Iterator[tuple[int, int]]:
    for found in _SSN.finditer(text):
        area, group, serial = found.groups()
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield found.span()
    for found in _DNI.finditer(text):
        number = found[1].translate(str.maketrans("XYZ", "012"))
        if len(found[1]) == 8 and _DNI_LETTERS[int(number) % 23] == found[2]:
            yield found.span()
    for found in _NIR.finditer(text):
        digits = _NOT_DIGITS.sub("", found[0])
        if 97 - int(digits[:13]) % 97 == int(digits[13:]):
            yield found.span()
    for found in _TAX_ID.finditer(text):
        digits = _NOT_DIGITS.sub("", found[0])
        if max(Counter(digits[:10]).values()) in (2, 3) and iso7064(digits):
            yield found.span()


def _secrets(text: str) -> Iterator[tuple[int, int]]:
    """Values given to a credential's name that do not look like words, and keys by their prefix."""
    done = 0
    for found in _ASSIGNED.finditer(text):
        value = _VALUE.match(text, found.end()) if found.start() >= done else None
        if not value:
            continue
        start, end = value.span(1)
        end = start + len(text[start:end].rstrip(".!$&#%*"))
        body = text[start:end]
        mixed = bool(re.search("[0-9]", body)) and bool(re.search("[A-Za-z]", body))
        if len(body) >= 6 and mixed and entropy(body) >= ENTROPY:
            yield start, end
            done = end
    for found in _PREFIXED.finditer(text):
        if entropy(found[0]) >= ENTROPY:
            yield found.span()


def _private_keys(text: str) -> Iterator[tuple[int, int]]:
    """From the first line of a key to its last, or the first alone where there is no last."""
    for found in _PEM.finditer(text):
        last = f"-----END {found[1]}PRIVATE KEY-----"
        end = text.find(last, found.end(), found.end() + 10_000)
        yield found.start(), end + len(last) if end >= 0 else found.end()


def score(kind: str, start: int, end: int, text: str) -> float:
    """0 to 1: the kind's prior, moved by words before and after the span."""
    near = f"{text[max(0, start - CONTEXT):start]} {text[end:end + CONTEXT]}"
    moved = 0.15 * bool(_FOR[kind].search(near)) - 0.35 * bool(_AGAINST.search(near))
    return min(1.0, max(0.0, _PRIOR[kind] + moved))


def find(text: str | None) -> list[tuple[str, int, int, float]]:
    """All spans (kind, start, end, score) by kind, then start; null is an empty text. Base kinds
    are kept whatever their score, the others from THRESHOLD on."""
    text = text or ""
    spans: list[tuple[str, int, int]] = [("email", *s) for s in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for kind, search in (("ip", _ips), ("card", _cards), ("phone", _phones), ("iban", _ibans),
                             ("ipv6", _ipv6), ("local_phone", _local_phones), ("national_id", _national_ids),
                             ("secret", _secrets)):
            spans += ((kind, *s) for s in sorted(set(search(text))))
    if "-----BEGIN" in text:
        spans += (("private_key", *s) for s in _private_keys(text))
    scored = [(*s, score(*s, text)) for s in spans]
    return [s for s in scored if s[0] in BASE_KINDS or s[3] >= THRESHOLD]


def joined(spans: list) -> str:
    return ",".join(f"{s[0]}:{s[1]}:{s[2]}" for s in spans)


def redact(text: str | None, spans: list) -> str | None:
    """The text with each span, or run of overlapping spans, replaced by the first one's kind."""
    if not spans:
        return text
    out, done = [], 0
    for kind, start, end, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


_FOUND = (
    "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, "
    "scores array<double>, redacted string"
)


def _rows(text: pa.Array) -> pa.Array:
    rows = []
    for value in text.to_pylist():
        spans = find(value)
        base = [s for s in spans if s[0] in BASE_KINDS]
        counts = {f"n_{k}": sum(s[0] == k for s in base) for k in BASE_KINDS}
        rows.append(counts | {
            "base_sha256": hashlib.sha256(joined(base).encode()).hexdigest(),
            "spans": joined(spans),
            "scores": [s[3] for s in spans],
            "redacted": redact(value, spans) if spans else None,
        })
    kinds = [(f"n_{k}", pa.int64()) for k in BASE_KINDS]
    made = pa.array(rows, pa.struct([*kinds, ("base_sha256", pa.string()), ("spans", pa.string()),
                                     ("scores", pa.list_(pa.float64())), ("redacted", pa.string())]))
    give_back()
    return made


ADDED = ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "scores", "redacted")


def detect(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with counts per base kind, spans, their scores and the redacted text.

    Works row by row without a shuffle. A null or empty text has no spans and stays as it is;
    repeated rows are treated alike; columns named as the added ones are replaced.
    """
    kept = free_columns(docs, *(a for a in ADDED if a.lower() != text.lower()), "_pii")
    found = kept.withColumn("_pii", F.arrow_udf(_rows, _FOUND)(F.col(f"`{text}`")))
    columns = [F.col(f"_pii.{a}").alias(a) for a in ADDED if a != "redacted"]
    redacted = F.coalesce("_pii.redacted", f"`{text}`").alias("redacted")
    return found.select(*(F.col(f"`{c}`") for c in kept.columns), *columns, redacted)
