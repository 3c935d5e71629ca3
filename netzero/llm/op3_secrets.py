"""Secret scan: fixed patterns plus sliding-window entropy of candidate strings.

Base kinds (leftmost, non-overlapping, whole text): ``assign`` (a key word, an
equals sign or colon, a value of 8 or more characters), ``access`` (16 or more
characters), ``hex`` (32 or more).  A match that is too short is dropped after
matching, so it still uses up its characters.

Entropy kinds: candidates are maximal runs over the alphabet of a character
class (``entropy_hex``, ``entropy_base64``) that hold a digit and a letter.  A
window slides over each; its character counts, and with them the sum of
``c * log2(c)``, change by one character out and one in, so a step costs the
same whatever the window.  Windows whose Shannon entropy reaches the class's
threshold are merged into spans.  A candidate that the allow list knows as a
whole (identifiers, digests with a fixed layout, joined words) gives no entropy
span.  A placeholder word takes out the windows near it only: those within
``NEAR`` characters on the same side of an equals sign, or, where the word is
one of the names joined before a value, those that touch it.  Base spans
always stay.

Offsets are code points, end exclusive.  Edge cases: null and empty texts have
no spans; repeated rows and null ids are scanned like others; extra columns are
ignored; an empty table gives an empty result.  A text is scanned whole, in
one piece; batches are cut by characters, so memory follows the longest text.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import sized_chunks, table

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.ASCII)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN_MIN = 8
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_MIN = 16
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")  # maximal runs, of which the short ones go
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64")
BASE_KINDS = KINDS[:3]
BATCH_CHARS = 1 << 22


@dataclass(frozen=True)
class EntropyClass:
    """A character class: its candidates, window length and threshold in bits."""
    kind: str
    candidates: re.Pattern
    window: int
    bits: float


CLASSES = (
    EntropyClass("entropy_hex", re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{20,}+"), 20, 2.9),
    EntropyClass("entropy_base64", re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"), 20, 3.7),
)

#: Candidates that are no secrets, matched whole.
ALLOW = (
    re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"),  # UUID
    re.compile(r"sha(1|224|256|384|512)-[A-Za-z0-9+/=]+"),  # subresource integrity
    re.compile(r"[A-Za-z]+([_/-][A-Za-z]+)*([_/-]?[0-9]{1,4})?"),  # words, paths, numbered names
    re.compile(r"[0-9_=+/-]+"),  # numbers, dates, rulers
)
#: Words of placeholders, and how far around them nothing is a secret; fillers keep one case, so that few random strings hold them.
PLACEHOLDER = re.compile(r"(?i:example|sample|placeholder|changeme|dummy)|x{4,}|X{4,}|0{7,}|1234567")
NEAR = 32

_XLOGX = [0.0] + [c * math.log2(c) for c in range(1, 257)]


def entropy_spans(s: str, window: int, bits: float) -> list[tuple[int, int, float]]:
    """Merged (start, end, highest entropy) of the windows of ``s`` whose
    Shannon entropy is at least ``bits``."""
    if len(s) < window:
        return []
    counts: dict[str, int] = {}
    total, out = 0.0, []
    log_w, x = math.log2(window), _XLOGX
    for i, ch in enumerate(s):
        c = counts.get(ch, 0)
        counts[ch] = c + 1
        total += x[c + 1] - x[c]
        if i >= window:
            old = s[i - window]
            c = counts[old]
            counts[old] = c - 1
            total += x[c - 1] - x[c]
        if i >= window - 1:
            h = log_w - total / window
            if h >= bits - 1e-9:
                start = i - window + 1
                if out and start <= out[-1][1]:
                    out[-1] = (out[-1][0], i + 1, max(out[-1][2], h))
                else:
                    out.append((start, i + 1, h))
    return out


def allowed(candidate: str) -> bool:
    return any(p.fullmatch(candidate) for p in ALLOW)


def beside_placeholders(s: str) -> list[tuple[int, int]]:
    """The stretches of a candidate that no placeholder word takes out."""
    out, pos = [], 0
    for m in PLACEHOLDER.finditer(s):
        a, b = m.span()
        name = m[0][0].isalpha() and (a == 0 or s[a - 1] in "_=/-") and b + 1 < len(s) and s[b] in "_-"
        if not name:
            end = s.find("=", b)
            a, b = max(a - NEAR, s.rfind("=", 0, a) + 1), min(b + NEAR, len(s) if end < 0 else end)
        if a > pos:
            out.append((pos, a))
        pos = max(pos, b)
    return [*out, (pos, len(s))]


def _mixed(s: str) -> bool:
    return any(c.isdigit() for c in s) and any(c.isalpha() for c in s)


def scan(text: str | None, classes: tuple[EntropyClass, ...] = CLASSES) -> list[tuple[str, int, int, float | None]]:
    """(kind, start, end, entropy) by start, then kind; entropy null for base kinds."""
    t = text or ""
    out: list[tuple[str, int, int, float | None]] = []
    low = t.lower()
    if any(w in low for w in ASSIGN_WORDS):
        out += [("assign", *m.span(), None) for m in ASSIGN.finditer(t) if len(m[2]) >= ASSIGN_MIN]
    out += [("access", *m.span(), None) for m in ACCESS.finditer(t) if len(m[0]) >= ACCESS_MIN]
    out += [("hex", *m.span(), None) for m in HEX.finditer(t)]
    for k in classes:
        for m in k.candidates.finditer(t):
            if _mixed(m[0]) and not allowed(m[0]):
                out += [(k.kind, m.start() + i + a, m.start() + i + b, h) for i, j in beside_placeholders(m[0])
                        for a, b, h in entropy_spans(m[0][i:j], k.window, k.bits)]
    return sorted(out, key=lambda r: (r[1], KINDS.index(r[0]), r[2]))


SPAN_TYPE = "array<struct<kind:string,start:int,end:int,entropy:double>>"


def find_secrets(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, found): the spans of every row."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in sized_chunks(frames, "text", BATCH_CHARS):
            found = [[dict(zip(("kind", "start", "end", "entropy"), r)) for r in scan(t)] for t in f["text"]]
            yield pd.DataFrame({"doc_id": f["doc_id"], "found": found})

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInPandas(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, found {SPAN_TYPE}")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("found", lambda x: x["kind"] == k)).cast("long")
    base = F.filter("found", lambda x: x["kind"].isin(*BASE_KINDS))
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in KINDS],
                        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans"))
