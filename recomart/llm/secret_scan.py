"""Secret scan with multipart credential linking.

Base findings stand alone: assignments of a secret-like name, access key ids and
long hex strings. The other parts of a credential are weak by themselves: account
names (``identifier``), random-looking strings (``secret``) and service addresses
(``endpoint``). They are reported only when complementary parts meet in one scope, a
stretch of text between blank lines, however long it is and however far apart they lie in it:

* an access key id or an identifier with its secret: a secret in the scope of an access key
  id is complete; a plain identifier needs a secret and an endpoint in its scope;
* the parts of complete credentials are reported, other weak parts are not.

The interval join takes scopes as the sorted intervals: every part finds its scope by binary search,
and what a scope holds of each kind tells which parts are complete, so no pairs are formed. A
text is one row, so nothing is shuffled.

A random-looking string has 16 or more characters, letters and digits, and none of them in more than a quarter of
the places; one of a single letter case has ten different characters at least and two separate runs
of digits besides, which tells it from words with a number.

Positions are code points, ends exclusive. Defined results: a NULL or empty text
has no spans; repeated rows get equal results; an empty table gives no rows; a very long text is
searched whole, in memory proportional to it; spans that begin together are listed in the order of their
kinds; further columns play no part, whatever their names.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .bpe import slices

KINDS = ("assign", "access", "hex", "identifier", "secret", "endpoint")
BASE = KINDS[:3]
# ASCII: with it, "either case" means A-Z and a-z only.
ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
# Whole runs of at least the length asked for: the same spans as all runs without the short ones.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
IDENTIFIER = re.compile(
    r"""(?i:user(?:_?name)?|login|account(?:_?id)?|client_?id|access_?key_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]{3,})""",
    re.ASCII)
SECRET = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{16,}={0,2}(?![A-Za-z0-9+/_=-])")
BREAK = re.compile(r"\n[ \t\r]*\n")
ENDPOINT = re.compile(r"""(?i:https?|s3|ftp|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\s"'<>]+""", re.ASCII)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the findings that stand alone."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return out


def looks_random(s: str) -> bool:
    """Letters and digits, no character too often; see the module for strings of one letter case."""
    digits, upper, lower = re.findall("[0-9]+", s), re.search("[A-Z]", s), re.search("[a-z]", s)
    if not digits or not (upper or lower):
        return False
    kinds = set(s)
    if not (upper and lower) and (len(kinds) < 10 or len(digits) < 2):
        return False
    return max(map(s.count, kinds)) <= max(2, len(s) // 4)


def overlap(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each interval of ``a`` whether one of ``b`` (disjoint, sorted) overlaps it."""
    if not len(a) or not len(b):
        return np.zeros(len(a), dtype=bool)
    at = np.searchsorted(b[:, 1], a[:, 0], side="right")
    return (at < len(b)) & (b[np.minimum(at, len(b) - 1), 0] < a[:, 1])


def weak_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Parts of complete multipart credentials beside the base findings."""
    access = [(s, e) for s, k, e in base if k == 1]
    names = [m.span() for m in IDENTIFIER.finditer(text)]
    if not access and not names:
        return []
    places = [m.span() for m in ENDPOINT.finditer(text)] if "://" in text else []
    if not access and not places:
        return []
    loose = [m.span() for m in SECRET.finditer(text) if looks_random(m.group())]
    strong = [(s, e) for s, k, e in base if k != 1]
    breaks = np.array([m.end() for m in BREAK.finditer(text)], dtype=np.int64)
    taken = _array(_disjoint([(s, e) for s, _, e in base]))

    def within(spans, free: bool = False):
        """(spans, their scopes); ``free``: only those that overlap no base finding."""
        x = _array(spans)
        x = x[~overlap(x, taken)] if free else x
        return x, np.searchsorted(breaks, x[:, 0], side="right")

    def holds(scopes):
        return np.bincount(scopes, minlength=len(breaks) + 1) > 0

    (n, n_in), (q, q_in), (p, p_in) = within(names, True), within(loose, True), within(places)
    has_access, has_place = holds(within(access)[1]), holds(p_in)
    has_secret = holds(np.concatenate((q_in, within(strong)[1])))      # loose, or an assignment or hex string
    whole = holds(n_in) & has_secret & has_place                       # an identifier with its secret and endpoint
    reported = ((n, n_in, 3, whole), (q, q_in, 4, whole | has_access), (p, p_in, 5, whole | has_access & has_secret))
    return [(s, kind, e) for spans, scope, kind, good in reported for s, e in spans[good[scope]].tolist()]


def _array(spans: list) -> np.ndarray:
    return np.array(spans, dtype=np.int64).reshape(-1, 2)


def _disjoint(spans: list) -> list:
    """Sorted spans with overlapping ones merged."""
    out: list = []
    for s, e in sorted(spans):
        if out and s < out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def listing(spans: list[tuple[int, int, int]]) -> str:
    """kind:start:end, by start, then kind in the order of KINDS."""
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def find(text: str | None) -> tuple[list, list]:
    """(base spans, all spans) of one text."""
    if not text:
        return [], []
    base = base_spans(text)
    return base, base + weak_spans(text, base)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_assign, n_access, n_hex, base_sha256, spans, n_weak."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    names = ["id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_weak"]

    def run(batches):
        for batch in batches:
            for b in slices(batch, "text"):
                rows = []
                for text in b.column("text").to_pylist():
                    base, both = find(text)
                    n = [sum(1 for x in base if x[1] == k) for k in range(3)]
                    rows.append((*n, hashlib.sha256(listing(base).encode()).hexdigest(), listing(both), len(both) - len(base)))
                cols = list(zip(*rows))
                types = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), *[pa.array(c, t) for c, t in zip(cols, types)]], names)

    return C.map_arrow(src, run, f"id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, "
                               "spans string, n_weak long")


def redact(text: str | None) -> str | None:
    """The text with every reported span replaced by its kind in angle brackets (overlapping spans as one)."""
    _, spans = find(text)
    if not spans:
        return text
    out, at = [], 0
    first = {}
    for s, k, e in sorted(spans):
        first.setdefault(s, k)
    for s, e in _disjoint([(s, e) for s, _, e in spans]):
        out += [text[at:s], f"<{KINDS[first[s]]}>"]
        at = e
    return "".join(out) + text[at:]


def redacted(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with secrets masked in the text; rows, order of columns and all other values stay."""

    def run(batches):
        for batch in batches:
            for b in slices(batch, text_col):
                i = b.schema.get_field_index(text_col)
                text = pa.array([redact(t) for t in b.column(i).to_pylist()], b.schema.field(i).type)
                yield pa.RecordBatch.from_arrays([*b.columns[:i], text, *b.columns[i + 1:]], b.schema.names)

    return C.map_arrow(docs, run, docs.schema)
