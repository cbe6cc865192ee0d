"""Secret scans: known shapes, and strings that pass a battery of randomness tests."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import frugal

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}")
#: The parts of a candidate between signs that may also join words, as in paths and names.
SEGMENT = re.compile(r"[A-Za-z0-9+]{20,}={0,2}")
KINDS = ("assign", "access", "hex", "random")
_HINTS = ("passw", "secret", "token", "api")

#: Alphabets an identifier may be written in, the narrowest first. A string has the first that holds all its characters.
ENCODINGS = {
    "decimal": "0123456789",
    "hex": "0123456789abcdef",
    "upper hex": "0123456789ABCDEF",
    "lower": "abcdefghijklmnopqrstuvwxyz",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "lower and digits": "0123456789abcdefghijklmnopqrstuvwxyz",
    "upper and digits": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "letters": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base62": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64 for addresses": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}
#: Digits alone are numbers, with nothing to tell a secret from an amount.
_SKIPPED = {"decimal"}
_SETS = {name: frozenset(chars) for name, chars in ENCODINGS.items()}
_PLACES = {name: {c: k for k, c in enumerate(chars)} for name, chars in ENCODINGS.items()}

#: A string is thrown out if the battery rejects randomness at this level.
NOT_RANDOM = 0.01
#: Share of false discoveries allowed among the strings of a length class.
FALSE_SHARE = 0.001
#: Length classes, each with a control of its own: short strings give weaker evidence.
LENGTHS = (20, 28, 40, 64)
_STEPS, _DEEPEST = 10, 300


def _tail(z: float) -> float:
    """Probability above z of the standard normal distribution."""
    return 0.5 * math.erfc(z / math.sqrt(2))


def _chi_tail(x: float, k: int) -> float:
    """Probability above x of chi-squared with k degrees of freedom (cube-root normal approximation)."""
    return _tail(((x / k) ** (1 / 3) - (1 - 2 / (9 * k))) / math.sqrt(2 / (9 * k)))


def encoding_of(string: str) -> str | None:
    """The narrowest alphabet that holds the string; final padding doesn't count."""
    chars = set(string.rstrip("="))
    return next((name for name, held in _SETS.items() if chars <= held), None)


def battery(string: str, encoding: str) -> float:
    """Probability that a random string of this alphabet looks as irregular, over three tests.

    Chi-squared uniformity over as many equal cells of the alphabet as leave five characters in
    each, runs above and below the alphabet's middle, and serial correlation; the least of the three
    counts threefold.
    """
    place, size = _PLACES[encoding], len(ENCODINGS[encoding])
    at = np.array([place[c] for c in string.rstrip("=")], dtype=float)
    n = len(at)
    cells = max(2, min(size, n // 5))
    found = np.bincount((at * cells // size).astype(int), minlength=cells)
    wanted = n * np.bincount((np.arange(size) * cells // size).astype(int), minlength=cells) / size
    uniform = _chi_tail(float(((found - wanted) ** 2 / wanted).sum()), cells - 1)
    high = at * 2 >= size
    a, b = int(high.sum()), int(n - high.sum())
    runs = 1 + int((high[1:] != high[:-1]).sum())
    if a and b:
        mean = 1 + 2 * a * b / n
        spread = math.sqrt(max((mean - 1) * (mean - 2) / (n - 1), 1e-9))
        runs_p = 2 * _tail(abs(runs - mean) / spread)
    else:
        runs_p = 0.0
    centred = at - at.mean()
    power = float((centred**2).sum())
    serial = float((centred[1:] * centred[:-1]).sum()) / power if power else 1.0
    serial_p = 2 * _tail(abs(serial + 1 / n) * math.sqrt(n))
    return min(1.0, 3 * min(uniform, runs_p, serial_p))


@dataclass(frozen=True)
class Model:
    """What the corpus says about ordinary strings: for each encoding how likely each character is
    in text, as the score of a character and the mean and spread of that score in ordinary text;
    and, once known, the p-value that each length class allows."""

    scores: dict[str, dict[str, float]]
    moments: dict[str, tuple[float, float]]
    allowed: tuple[float, ...] = ()

    def ordinary(self, string: str, encoding: str) -> float:
        """Probability that ordinary characters make a string that looks as evenly drawn."""
        score, (mean, spread) = self.scores[encoding], self.moments[encoding]
        body = string.rstrip("=")
        total = sum(score[c] for c in body)
        return _tail((total - len(body) * mean) / (math.sqrt(len(body)) * spread))

    def p_value(self, string: str) -> float | None:
        """Evidence that a string is no ordinary text, or None if the battery says it isn't random."""
        encoding = encoding_of(string)
        if encoding is None or encoding in _SKIPPED or battery(string, encoding) < NOT_RANDOM:
            return None
        return self.ordinary(string, encoding)


def length_class(length: int) -> int:
    return sum(length >= least for least in LENGTHS) - 1


def _depth(p: float) -> int:
    return min(_DEEPEST, int(-_STEPS * math.log10(max(p, 1e-300))))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("text").cast("string").alias("text")).where("text is not null")


def character_model(docs: DataFrame) -> Model:
    """Character frequencies over all texts: at most 256 sums reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(256, np.int64)
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()):
                sums += np.bincount(np.frombuffer(text.as_py(), np.uint8), minlength=256)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(256)), pa.array(sums)], ["code", "n"])

    rows = _texts(docs).mapInArrow(frugal(run), "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).collect()
    counts = {chr(r["code"]): r["n"] for r in rows}
    scores, moments = {}, {}
    for name, chars in ENCODINGS.items():
        total = sum(counts.get(c, 0) + 1 for c in chars)
        share = {c: (counts.get(c, 0) + 1) / total for c in chars}
        scores[name] = {c: math.log(1 / len(chars) / share[c]) for c in chars}
        mean = sum(share[c] * scores[name][c] for c in chars)
        moments[name] = (mean, math.sqrt(max(1e-6, sum(share[c] * (scores[name][c] - mean) ** 2 for c in chars))))
    return Model(scores, moments)


def candidates(text: str) -> Iterator[list[tuple[int, int]]]:
    """Places of the strings to test: each list has a whole run, then its segments of 20 or more
    characters between ``/``, ``-`` and ``_``, if there are such signs."""
    for match in CANDIDATE.finditer(text):
        start, end = match.span()
        parts = [part.span() for part in SEGMENT.finditer(text, start, end)]
        yield [(start, end), *(part for part in parts if part != (start, end))]


def with_discovery_control(docs: DataFrame, model: Model) -> Model:
    """Benjamini-Hochberg over all different candidates of all texts, for each length class by itself.

    p-values are counted in steps of a tenth of a decade, so what reaches the driver is bounded, and
    each counts as the upper end of its step.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = {text[a:b] for text in batch.column(0).to_pylist() for places in candidates(text) for a, b in places}
            rows = []
            for string in seen:
                p = model.p_value(string)
                mark = int.from_bytes(hashlib.blake2b(string.encode(), digest_size=8).digest(), "little", signed=True)
                rows.append((mark, length_class(len(string.rstrip("="))), _depth(1.0 if p is None else p)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], pa.int64()) for k in range(3)], ["mark", "kind", "step"]
            )

    # A string counts once however often it stands in texts.
    each = _texts(docs).mapInArrow(frugal(run), "mark long, kind long, step long").distinct()
    rows = each.groupBy("kind", "step").agg(F.count("*").alias("n")).collect()
    allowed = []
    for kind in range(len(LENGTHS)):
        own = sorted(((r["step"], r["n"]) for r in rows if r["kind"] == kind), reverse=True)
        total, sofar, most = sum(n for _, n in own), 0, 0.0
        for step, n in own:
            sofar += n
            p = 10 ** (-step / _STEPS)
            if step and p <= FALSE_SHARE * sofar / total:
                most = p
        allowed.append(most)
    return Model(model.scores, model.moments, tuple(allowed))


def fitted(docs: DataFrame) -> Model:
    return with_discovery_control(docs, character_model(docs))


def spans_of(text: str, model: Model) -> list[tuple[int, int, str]]:
    """All spans (start, end, kind), sorted by start and kind. ``random`` spans never overlap others."""
    base = []
    lower = text.lower() if text.isascii() else text.casefold()
    if any(h in lower for h in _HINTS):
        base += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    if "AKIA" in text:
        base += [(*m.span(), "access") for m in ACCESS.finditer(text) if len(m.group()) >= 20]
    base += [(*m.span(), "hex") for m in HEX.finditer(text)]
    more = []
    for places in candidates(text):
        for start, end in places:
            # Of a run that is a secret, the segments need no test.
            if any(s < end and start < e for s, e, _ in [*base, *more[-1:]]):
                continue
            string = text[start:end]
            p = model.p_value(string)
            if p is not None and p <= model.allowed[length_class(len(string.rstrip("=")))]:
                more.append((start, end, "random"))
    return sorted(base + more, key=lambda s: (s[0], KINDS.index(s[2])))


def found(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``doc_id`` and ``found``: (kind, start, end) of every secret of every row, in code points.

    Known shapes: assignments, access keys, long hex; and ``random``: strings of 20 or more
    characters that the battery takes for random and that are too even for ordinary text under the
    false-discovery control. Runs with ``/``, ``-`` or ``_`` are tested whole, then each of their segments;
    strings of decimals are not tested, a number being no less random than a secret. A null or empty text has none. Repeated rows and null ids are kept,
    other columns ignored; an empty table gives an empty one.
    """
    model = model or fitted(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            spans = [
                [{"kind": k, "start": s, "end": e} for s, e, k in spans_of(text or "", model)]
                for text in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], ["doc_id", "found"])

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).mapInArrow(frugal(run), "doc_id long, found array<struct<kind:string,start:bigint,end:bigint>>")


def redacted(docs: DataFrame, model: Model | None = None, mark: str = "[SECRET]") -> DataFrame:
    """All rows and columns of ``docs``, with every secret of ``text`` replaced by ``mark``; ``n_chars``,
    where there is one, follows the changed texts."""
    model = model or fitted(docs)

    def replaced(text: str | None) -> str | None:
        spans = spans_of(text, model) if text else []
        if not spans:
            return text
        out, at = [], 0
        for start, end, _ in spans:
            if start >= at:
                out += [text[at:start], mark]
            at = max(at, end)
        return "".join([*out, text[at:]])

    names = docs.columns
    where = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([replaced(t) for t in batch.column(where).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays(
                [texts if k == where else c for k, c in enumerate(batch.columns)], names
            )

    changed = docs.withColumn("text", F.col("text").cast("string"))
    out = changed.mapInArrow(frugal(run), changed.schema)
    if "n_chars" not in docs.columns:
        return out
    kind = docs.schema["n_chars"].dataType
    return out.withColumn("n_chars", F.when(F.col("text").contains(mark), F.length("text")).otherwise(F.col("n_chars")).cast(kind))


def digest(rows: DataFrame) -> DataFrame:
    """The counts and the hash of the base spans, and all spans as text, of what :func:`found` gives."""

    def written(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
        )

    def number(kind: str):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("found", lambda s: s["kind"] != "random")
    return rows.select(
        "doc_id",
        number("assign").alias("n_assign"),
        number("access").alias("n_access"),
        number("hex").alias("n_hex"),
        F.sha2(written(base), 256).alias("base_sha256"),
        written(F.col("found")).alias("spans"),
        number("random").alias("n_random"),
    )
