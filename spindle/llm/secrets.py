"""Secret scans: patterns, and password guess costs for credential values.

Base kinds: ``assign`` (a credential name, ``:`` or ``=``, a value of 6 or
more characters), ``access`` (cloud key ids) and ``hex`` (24 or more hex
digits), leftmost and non-overlapping within each kind; a match that is too
short uses up its text all the same.

The method adds ``guess`` spans: the value after a wider set of credential
names is segmented by dynamic programming into dictionary words, dates,
repeats, keyboard walks and brute-force spans so that the base-2 logarithm
of the guesses is least.  It is a secret if that is ``min_bits`` or more and,
unless it is ``SURE_BITS`` or more, at least ``RATE`` for each character:
short random values pass, words that the dictionary lacks do not.

Everything looks at UTF-8 bytes (the patterns are ASCII); offsets are
turned into code points, end exclusive.

Edge cases: null text is empty and has no spans (their digest is that of the
empty string).  Long values are not cut: the programme stops only once no
continuation can be cheaper than ``min_bits``.  Spans that start together
are in the order of KINDS.  Repeated rows get equal results.
"""

from __future__ import annotations

import hashlib
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from spindle.llm.common import documents, map_text, slices
from spindle.llm.registry import query

KINDS = ("assign", "access", "hex", "guess")
#: Six to eight random characters cost 26 to 40 bits; dictionary-made values of that length under 22.
MIN_BITS = 26.0
RATE, SURE_BITS = 3.0, 60.0

# The base patterns (on bytes whose A-Z are lower case, but for ACCESS).
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{24,}")
ASSIGN_NAMES = (b"passw", b"secret", b"token", b"api")

# A name is looked at whole and once (it cannot begin inside a name, and no count limits it), so the search stays linear.
CONTEXT = re.compile(
    rb"""(?<![a-z0-9_-])(?=[a-z0-9_-]*?(?:password|passwd|passphrase|pwd|secret|token|credentials?|bearer|api[_-]?key|access[_-]?key|private[_-]?key))"""
    rb"""[a-z0-9_-]++["']?[ \t]*+(?:=>|[:=]|\bis\b)[ \t]*+["'`]?([^\s"'`,;<>()]{6,})""")
CONTEXT_NAMES = (b"passw", b"passphrase", b"pwd", b"secret", b"token", b"credential", b"bearer", b"api", b"access", b"private")

# Common words of passwords and documentation, most common first.
WORDS = """password admin welcome letmein master login dragon monkey qwerty football baseball shadow sunshine princess
example changeme secret default test user guest root hello love summer winter spring autumn monday friday charlie
michael jordan hunter soccer killer pepper freedom whatever computer internet server service access private public
token key none null true false undefined your value string here placeholder redacted""".split()
RANK = {w: k + 1 for k, w in enumerate(WORDS)}
LONGEST_WORD = max(map(len, WORDS))
LEET = str.maketrans("013457@$", "oieastas")
WALKS = ("qwertyuiop", "asdfghjkl", "zxcvbnm", "1234567890", "abcdefghijklmnopqrstuvwxyz", "0123456789")
NEXT = {(a, b) for row in WALKS for a, b in zip(row, row[1:], strict=False)} | {(b, a) for row in WALKS for a, b in zip(row, row[1:], strict=False)}
DATE = re.compile(r"(?:19|20)\d\d(?:([-/.]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01]))?|(?:0[1-9]|[12]\d|3[01])([-/.])(?:0[1-9]|1[0-2])\2(?:19|20)\d\d")
VOWELS = set("aeiouy")
LONGEST = 40  # at least the longest word or date; repeats and walks have no limit


def char_bits(prev: str, c: str) -> float:
    """Bits of a character that has to be guessed; a lower-case letter after
    one of the other sort, vowel or consonant, is taken as text of some
    language."""
    if c.islower():
        return 2.5 if prev.isalpha() and (prev.lower() in VOWELS) != (c in VOWELS) else 3.75 if prev.isalpha() else math.log2(26)
    return math.log2(10) if c.isdigit() else math.log2(26) if c.isupper() else 5.0


def guess_bits(value: str, enough: float = math.inf) -> float:
    """Least log2 guesses over all segmentations, or any number from
    ``enough`` on if there can be no cheaper one."""
    n, low = len(value), value.lower()
    plain = low.translate(LEET)
    best = [math.inf] * (n + 1)
    best[0] = 0.0
    runs = [(True, 1, []), *((False, width, []) for width in (1, 2, 3, 4))]  # (start, cost before it, cost of a unit)
    for i in range(n):
        here = best[i] + (1.0 if i else 0.0)

        def offer(end: int, bits: float, here=here) -> None:
            if here + bits < best[end]:
                best[end] = here + bits

        prev = value[i - 1] if i else " "
        best[i + 1] = min(best[i + 1], best[i] + char_bits(prev, value[i]))
        for end in range(i + 3, min(n, i + LONGEST_WORD) + 1):
            for text, extra in ((low, 0.0), (plain, 2.0)):
                if text[i:end] in RANK:
                    shifted = 0.0 if value[i:end].islower() else 1.0
                    offer(end, math.log2(RANK[text[i:end]] + 1) + extra + shifted)
        if value[i].isdigit() and (m := DATE.match(value, i)):
            offer(m.end(), math.log2(200) if m.end() - i == 4 else math.log2(200 * 365) + 2)
            offer(i + 4, math.log2(200)) if m.group()[:2] in ("19", "20") else None
        # repeats and walks of any length: the starts that are open, less those that an earlier one undercuts at every end
        e, ahead = i + 1, math.inf
        for walk, width, live in runs:
            if i >= width and not ((low[i - 1], low[i]) in NEXT if walk else value[i] == value[i - width]):
                live[:] = [x for x in live if x[0] > i - width]
            c = i - width  # this start now ends where the earlier ones end
            for _, own, _ in [x for x in live if x[0] == c]:
                if any(j < c and (c - j) % width == 0 and cost + math.log2((c - j) / width + 2) <= own + 1.0 for j, cost, _ in live):
                    live[:] = [x for x in live if x[0] != c]
            live.append((i, here, math.log2(len(WALKS) * 10) if walk else sum(char_bits(" ", x) for x in value[i:i + width])))
            for j, cost, unit in live:
                bits = cost + unit + math.log2(max((e - j) / width, 2))
                ahead = min(ahead, bits)
                if (e - j) % width == 0 and e - j >= max(3, 2 * width):
                    best[e] = min(best[e], bits)
        if i >= LONGEST and (least := min(*best[i - LONGEST + 1:i + 2], ahead)) >= enough:
            return least
    return best[n]


def is_secret(value: str, min_bits: float = MIN_BITS) -> bool:
    sure = max(min_bits, SURE_BITS)
    bits = guess_bits(value, sure)
    return bits >= sure or (bits >= min_bits and bits >= RATE * len(value))


def find_secrets(text: str | None, min_bits: float = MIN_BITS) -> list[tuple[int, int, int, int]]:
    """(start, number of the kind, end, start of the value) of every span, in order."""
    raw = (text or "").encode()
    low = raw.lower()
    found = []
    if any(n in low for n in ASSIGN_NAMES):
        found += [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(low) if m.end(2) - m.start(2) >= 6]
    if b"AKIA" in raw:
        found += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(raw) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(raw)]
    if any(n in low for n in CONTEXT_NAMES):
        for m in CONTEXT.finditer(low):
            value = raw[m.start(1):m.end(1)].decode("utf-8", "replace").rstrip(".!?:")
            if len(value) >= 6 and is_secret(value, min_bits):
                end = m.start(1) + len(value.encode())
                found.append((m.start(1), 3, min(end, m.end(1)), m.start(1)))
    found.sort()
    if found and len(raw) != len(text):
        point = {p: len(raw[:p].decode()) for row in found for p in (row[0], row[2], row[3])}
        found = [(point[a], k, point[b], point[v]) for a, k, b, v in found]
    return found


def scan_secrets(docs: DataFrame, *, min_bits: float = MIN_BITS) -> DataFrame:
    """Counts, digest and list of the spans of each document."""
    fields = [T.StructField(n, T.LongType()) for n in ("n_assign", "n_access", "n_hex", "n_guess")]
    fields += [T.StructField(n, T.StringType()) for n in ("base_sha256", "spans")]

    def make():
        def scan(texts: pa.Array):
            rows = []
            for text in texts.to_pylist():
                spans = find_secrets(text, min_bits)
                named = [f"{KINDS[k]}:{a}:{b}" for a, k, b, _ in spans]
                base = ",".join(s for s, row in zip(named, spans, strict=True) if row[1] < 3)
                counts = [sum(row[1] == k for row in spans) for k in range(4)]
                rows.append((*counts, hashlib.sha256(base.encode()).hexdigest(), ",".join(named)))
            return [pa.array([r[i] for r in rows], pa.int64() if i < 4 else pa.string()) for i in range(6)]

        return scan

    return map_text(docs, fields, make)


def redact(docs: DataFrame, *, marker: str = "[SECRET]", min_bits: float = MIN_BITS) -> DataFrame:
    """All documents with all their columns; in ``text`` the value of every
    span (overlapping ones together) is replaced by ``marker``."""
    columns = docs.columns
    schema = T.StructType([docs.schema[c] for c in columns])

    def hide(text):
        spans = find_secrets(text, min_bits)
        if not spans:
            return text
        out, at = [], 0
        for start, end in sorted((v, b) for _, _, b, v in spans):
            if end <= at:
                continue
            if start >= at:
                out += [text[at:start], marker]
            at = end
        return "".join([*out, text[at:]])

    def run(batches):
        for whole in batches:
            for part in slices(whole, "text"):
                texts = pa.array(map(hide, part.column("text").to_pylist()), part.schema.field("text").type)
                cols = [texts if c == "text" else part.column(c) for c in columns]
                yield pa.RecordBatch.from_arrays(cols, names=columns)

    return docs.mapInArrow(run, schema)


@query("op2_secret_scan")
def op2_secret_scan(spark, sf_dir):
    return scan_secrets(documents(spark, sf_dir))
