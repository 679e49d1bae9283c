"""Secret spans: fixed patterns, and a randomness test battery over the remaining long tokens.

A candidate is a run of code signs with a letter and a digit that no pattern span touches. An
equals sign ends a run; a run that no alphabet holds is cut at its separators. Its encoding is
the smallest alphabet that holds it. Three tests of "drawn at random from that
alphabet" are made on its symbol values: chi-squared uniformity over bins of at least five
expected symbols, runs above and below the middle, and lag-one serial correlation. Their
Bonferroni-combined p-value says how surely the token has structure.

Structure is then declared under false-discovery control, separately for each length class,
since short tokens give the tests little power: the Benjamini-Hochberg threshold of a class
comes from its p-value histogram over all documents. Tokens that keep the random hypothesis
become spans of kind ``random``.

Null texts count as empty and have no spans. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamline.llm.shared import text_or_empty, written
from loamline.llm.token_store import slices

KINDS = ("assign", "access", "hex", "random")
# The patterns of the contract (fixed values).
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_ASSIGNED, LEAST_ACCESS = 6, 20
_SIGNS_OF_ASSIGN = ("passw", "secret", "token", "api")

LEAST_RANDOM = 20
# An equals sign is padding, or stands between a name and its value: it ends a token.
RANDOM = re.compile(r"[A-Za-z0-9+/_-]{%d,}" % LEAST_RANDOM)
#: Ways to cut a run that no alphabet holds, from the finest.
SEPARATORS = tuple(re.compile(r"[^%s]+" % signs) for signs in ("+/_-", "_-", "+/"))
#: p-value from which a piece looks random when the ways are compared.
LIKELY = 0.01
_DIGITS, _LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
_UPPER = _LOWER.upper()
#: Alphabets from the smallest to the largest.
ALPHABETS = {
    "hex": _DIGITS + "abcdef", "HEX": _DIGITS + "ABCDEF", "base32": _UPPER + "234567",
    "base36": _DIGITS + _LOWER, "BASE36": _DIGITS + _UPPER, "base62": _DIGITS + _UPPER + _LOWER,
    "base64": _UPPER + _LOWER + _DIGITS + "+/", "base64url": _UPPER + _LOWER + _DIGITS + "-_",
}
_HOLDS = {name: frozenset(signs) for name, signs in ALPHABETS.items()}
_VALUES = {name: {s: i for i, s in enumerate(signs)} for name, signs in ALPHABETS.items()}
#: Lower ends of the length classes, and the share of wrongly declared structure allowed.
LENGTH_CLASSES = (20, 28, 40, 64, 128)
FALSE_SHARE = 0.05
#: p-values are counted in steps of a tenth of a decade.
STEPS, LEAST_STEP = 10, 300


def encoding(token: str) -> str | None:
    """The smallest alphabet that holds the token; None without a letter or a digit."""
    signs = set(token)
    if not signs & _HOLDS["base36"] & set(_DIGITS) or not any(s.isalpha() for s in signs):
        return None
    return next((name for name, held in _HOLDS.items() if signs <= held), None)


def _normal_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def chi_squared_p(values: list[int], size: int) -> float:
    """Upper tail of the uniformity statistic, by the cube-root normal approximation."""
    bins = max(2, min(size, len(values) // 5))
    counts = [0] * bins
    for v in values:
        counts[v * bins // size] += 1
    # Bins of an alphabet that does not divide evenly hold unequal numbers of signs.
    held = [0] * bins
    for v in range(size):
        held[v * bins // size] += 1
    statistic = sum((c - len(values) * h / size) ** 2 / (len(values) * h / size) for c, h in zip(counts, held))
    free = bins - 1
    middle = 1 - 2 / (9 * free)
    return _normal_tail(((statistic / free) ** (1 / 3) - middle) / math.sqrt(2 / (9 * free)))


def runs_p(values: list[int], size: int) -> float:
    """Two-sided Wald-Wolfowitz test of runs below and above the middle of the alphabet."""
    sides = [2 * v >= size for v in values]
    high = sum(sides)
    low = len(sides) - high
    if not high or not low:
        return 2.0 ** (1 - len(sides))
    n = high + low
    runs = 1 + sum(a != b for a, b in zip(sides, sides[1:]))
    mean = 2 * high * low / n + 1
    spread = (mean - 1) * (mean - 2) / (n - 1)
    return min(1.0, 2 * _normal_tail(abs(runs - mean) / math.sqrt(spread))) if spread > 0 else 1.0


def serial_p(values: list[int]) -> float:
    """Two-sided test of the lag-one correlation; its mean under randomness is -1/n."""
    n = len(values)
    mean = sum(values) / n
    off = [v - mean for v in values]
    total = sum(x * x for x in off)
    if not total:
        return 0.0
    r = sum(a * b for a, b in zip(off, off[1:])) / total
    return min(1.0, 2 * _normal_tail(abs(r + 1 / n) * math.sqrt(n)))


def structure_p(token: str, name: str) -> float:
    """Combined p-value of the three tests."""
    values = [_VALUES[name][s] for s in token]
    size = len(ALPHABETS[name])
    return min(1.0, 3 * min(chi_squared_p(values, size), runs_p(values, size), serial_p(values)))


def pattern_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns, in order."""
    found = []
    low = text.lower()
    if any(sign in low for sign in _SIGNS_OF_ASSIGN):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGNED]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _tested(token: str) -> float | None:
    name = encoding(token)
    return structure_p(token, name) if name else None


def pieces(run: str) -> list[tuple[int, int, float]]:
    """(start, end, p-value) of the tokens of a run of code signs.

    A run that an alphabet holds is one token. Another is cut at all separators, at ``-`` and
    ``_``, or at ``+`` and ``/``, whichever leaves most signs that look random, then most signs.
    """
    if not (any(s in run for s in "-_") and any(s in run for s in "+/")):
        p = _tested(run)
        return [] if p is None else [(0, len(run), p)]
    best, most = [], (0, 0)
    for pattern in SEPARATORS:
        cut = [(m.start(), m.end(), _tested(m[0])) for m in pattern.finditer(run) if len(m[0]) >= LEAST_RANDOM]
        cut = [c for c in cut if c[2] is not None]
        score = (sum(e - s for s, e, p in cut if p >= LIKELY), sum(e - s for s, e, _ in cut))
        if score > most:
            best, most = cut, score
    return best


def candidates(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
    """(start, end, length class, p step) of the tokens to test, apart from ``spans``."""
    out, at, reach = [], 0, 0
    for m in RANDOM.finditer(text):
        for first, last, p in pieces(m[0]):
            start, end = m.start() + first, m.start() + last
            while at < len(spans) and spans[at][0] < end:
                reach = max(reach, spans[at][2])
                at += 1
            if reach > start:
                continue
            step = LEAST_STEP if p <= 0 else min(LEAST_STEP, int(-math.log10(p) * STEPS))
            size = sum(end - start >= low for low in LENGTH_CLASSES) - 1
            out.append((start, end, size, step))
    return out


_SPAN = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("stop", pa.int64())])
_TOKEN = pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("size", pa.int32()), ("step", pa.int32())])
_FOUND = (
    "id long, spans array<struct<start:long,kind:int,stop:long>>, "
    "tokens array<struct<start:long,stop:long,size:int,step:int>>"
)


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, texts in slices(batches):
        spans = [pattern_spans(t) for t in texts]
        tokens = [candidates(t, s) for t, s in zip(texts, spans)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()),
                pa.array([[dict(zip(("start", "kind", "stop"), s)) for s in row] for row in spans], pa.list_(_SPAN)),
                pa.array([[dict(zip(("start", "stop", "size", "step"), t)) for t in row] for row in tokens], pa.list_(_TOKEN)),
            ],
            names=["id", "spans", "tokens"],
        )


def thresholds(found: DataFrame, share: float = FALSE_SHARE) -> list[int]:
    """For each length class the least p step that declares structure (Benjamini-Hochberg).

    The histogram has at most ``len(LENGTH_CLASSES) * (LEAST_STEP + 1)`` rows.
    """
    counted = found.select(F.explode("tokens").alias("t")).groupBy("t.size", "t.step").agg(F.count("*").alias("n"))
    table: dict[int, dict[int, int]] = {}
    for r in counted.collect():
        table.setdefault(r["size"], {})[r["step"]] = r["n"]
    out = []
    for size in range(len(LENGTH_CLASSES)):
        steps = table.get(size, {})
        total, sure, least = sum(steps.values()), 0, LEAST_STEP + 1
        for step in sorted(steps, reverse=True):
            sure += steps[step]
            # The greatest p-value of the step is the one that begins it.
            if 10 ** (-step / STEPS) * total <= share * sure:
                least = step
        out.append(least)
    return out


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    text = F.transform(
        spans,
        lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string")),
    )
    return F.array_join(text, ",")


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: id, n_assign, n_access, n_hex, n_random, base_spans and spans, both
    as ``kind:start:end`` joined by commas, in order of start, then of the kinds."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("body"))
    found = written(rows.mapInArrow(_search, _FOUND), "secrets")
    limit = F.array(*[F.lit(t) for t in thresholds(found)])
    random = F.transform(
        F.filter("tokens", lambda t: t["step"] < F.element_at(limit, t["size"] + 1)),
        lambda t: F.struct(t["start"].alias("start"), F.lit(3).alias("kind"), t["stop"].alias("stop")),
    )

    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "id", *[count(i).alias(f"n_{KINDS[i]}") for i in range(3)], F.size(random).cast("long").alias("n_random"),
        _listed(F.col("spans")).alias("base_spans"),
        _listed(F.sort_array(F.concat("spans", random))).alias("spans"),
    )
