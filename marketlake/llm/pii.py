"""Personal data: patterns propose spans, checksums confirm them, context words adjust their score.

Base kinds (email, ip, card, phone) follow fixed patterns and tests and are always reported. Three more kinds
are proposed and kept if their score reaches `least`: iban (mod-97 confirms it), ssn and local_phone (digits
in the usual grouping, confirmed by nearby words only). Where capitals or digits follow an iban, the longest run of whole groups that the checksum
confirms is taken, and the search goes on behind it. A score starts at the kind's prior, a passed checksum
and each near context word raise it, up to 1. Proposals that overlap a base span are left out.

A null text is empty and has no spans; offsets are code points, the end exclusive. Each row is treated on its
own, so repeated rows give repeated results. Other columns are ignored by `find` and kept by `redact`.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import small_batches

BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "ssn", "local_phone")
#: Context words of each kind, in several languages.
CONTEXT = {
    "email": {"email", "mail", "e-mail", "correo", "contact", "courriel"},
    "ip": {"ip", "host", "server", "address", "adresse"},
    "card": {"card", "visa", "mastercard", "credit", "karte", "carte", "tarjeta"},
    "phone": {"phone", "tel", "call", "mobile", "telefon", "téléphone", "teléfono"},
    "iban": {"iban", "account", "bank", "konto", "compte", "cuenta"},
    "ssn": {"ssn", "social", "security", "taxpayer"},
    "local_phone": {"phone", "tel", "call", "mobile", "fax", "telefon", "téléphone", "teléfono"},
}
#: Score before any evidence; with a passed checksum; for each context word.
PRIOR = {"email": 0.8, "ip": 0.6, "card": 0.4, "phone": 0.6, "iban": 0.3, "ssn": 0.3, "local_phone": 0.3}
CONFIRMED = 0.5
NEAR = 0.3
#: Characters before and after a span where context words count.
REACH = 48

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DIGIT = re.compile(r"[0-9]")
#: A match begins where a run of digits does and takes whole runs, so no run is read again from its middle.
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
#: Fewest characters of an iban without its spaces.
SHORTEST = 15
SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
LOCAL_PHONE = re.compile(r"(?<![0-9+(-])(?:\([0-9]{3}\) ?|[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}(?![0-9-])")
WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)*")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(d * 2 - 9 * (d > 4) for d in map(int, digits[-2::-2]))) % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def ibans(text: str) -> list[tuple[int, int]]:
    """From each place that can begin one, the longest run of whole groups that passes mod-97."""
    found, at = [], 0
    while m := IBAN.search(text, at):
        start, end = m.span()
        at = start + 4
        while end > start and len(iban := text[start:end].replace(" ", "")) >= SHORTEST:
            if mod97(iban):
                found.append((start, end))
                at = end
                break
            end = text.rfind(" ", start, end)
    return found


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from each @ backwards: long runs of letters cost nothing."""
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := EMAIL.match(text, start)):
            found.append(m.span())
            done = m.end()
        at = text.find("@", max(at + 1, done))
    return found


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base spans by kind, then place."""
    spans = [("email", *s) for s in emails(text)]
    if not DIGIT.search(text):
        return spans
    for m in IP.finditer(text):
        if all(len(p := part.lstrip("0")) < 4 and int(p or 0) <= 255 for part in m[0].split(".")):
            spans.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(digits := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(digits):
            spans.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(DIGIT.findall(m[0])) <= 15:
                spans.append(("phone", *m.span()))
    return spans


def _score(text: str, kind: str, start: int, end: int, confirmed: bool) -> float:
    near = f"{text[max(0, start - REACH) : start]} {text[end : end + REACH]}".lower()
    words = CONTEXT[kind].intersection(WORD.findall(near))
    return min(1.0, PRIOR[kind] + CONFIRMED * confirmed + NEAR * len(words))


def all_spans(text: str, least: float) -> list[tuple[str, int, int, float]]:
    """Base spans and the added ones whose score is at least `least`, with scores."""
    base = base_spans(text)
    out = [(kind, s, e, _score(text, kind, s, e, kind == "card")) for kind, s, e in base]
    taken = sorted((s, e) for _, s, e in base)
    starts, reached = [s for s, _ in taken], list(accumulate((e for _, e in taken), max))
    if not DIGIT.search(text):
        return out
    proposed = [("iban", *s) for s in ibans(text)]
    proposed += [(kind, *m.span()) for kind, pattern in zip(ADDED[1:], (SSN, LOCAL_PHONE), strict=True) for m in pattern.finditer(text)]
    for kind, start, end in proposed:
        score = _score(text, kind, start, end, kind == "iban")
        before = bisect_left(starts, end)
        if score >= least and not (before and reached[before - 1] > start):
            out.append((kind, start, end, score))
    return out


def redacted(text: str, spans: list[tuple[str, int, int, float]]) -> str:
    """The text with a tag in place of each span; overlapping spans share the tag of the first."""
    parts, done = [], 0
    for kind, start, end, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= done:
            parts += [text[done:start], f"<{kind.upper()}>"]
        done = max(done, end)
    return "".join([*parts, text[done:]])


def find(docs: DataFrame, least: float = 0.6) -> DataFrame:
    """doc_id, base counts, digest of the base spans, all spans (kind:start:end) and their scores."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, spans, scores = [], [], [], []
            for text in batch["text"].to_pylist():
                found = all_spans(text, least)
                named = [f"{k}:{s}:{e}" for k, s, e, _ in found]
                base = [n for n, f in zip(named, found, strict=True) if f[0] in BASE]
                counts.append([sum(f[0] == kind for f in found) for kind in BASE])
                digests.append(hashlib.sha256(",".join(base).encode()).hexdigest())
                spans.append(",".join(named))
                scores.append([f[3] for f in found])
            columns = [batch["doc_id"], *(pa.array([c[k] for c in counts], pa.int64()) for k in range(4))]
            columns += [pa.array(digests, pa.string()), pa.array(spans, pa.string()), pa.array(scores, pa.list_(pa.float64()))]
            yield pa.record_batch(columns, [f.name for f in schema])

    small_batches(docs.sparkSession)
    schema = [pa.field(n, pa.null()) for n in ("doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans", "scores")]
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        look, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, scores array<double>"
    )


def redact(docs: DataFrame, least: float = 0.6) -> DataFrame:
    """`docs` with personal data in `text` replaced by tags, n_chars set anew; rows without text stay as they are."""

    columns = docs.columns
    small_batches(docs.sparkSession)

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = columns.index("text")
        for batch in batches:
            new = [t if t is None else redacted(t, all_spans(t, least)) for t in batch["text"].to_pylist()]
            yield batch.set_column(place, "text", pa.array(new, pa.string()))

    out = docs.mapInArrow(replace, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out
