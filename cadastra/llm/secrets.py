"""Secrets by pattern, and by a battery of randomness tests on long tokens.

Every token of 20 or more key characters is tested for being random in the encoding its characters
suggest; where all together fit no encoding, names and paths are parted from the key. The tests are
chi-squared uniformity over the alphabet, the runs test around its middle, lag-one serial correlation
and, for digits beside letters of one case, changes between the two. The p-values are combined into
one. Within each class of encoding and length, the tokens that are *not* random are the discoveries of
a Benjamini-Hochberg step at ``rate``, so at most that share of those dismissed are random. What is not
dismissed is reported. Letters of one case alone are tested only at lengths that give the battery the
power to dismiss ordinary words.

The p-values of all documents are gathered as counts in a fixed grid per class, a bounded table. Texts
are read twice and never shuffled.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("assign", "access", "hex", "random")
_ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# Runs are greedy and whole, so asking for 32 characters is the same as dropping shorter runs.
_HEX = re.compile(r"[0-9a-f]{32,}")
_SHORTEST = 20
_TOKEN = re.compile(rf"[A-Za-z0-9+/_=-]{{{_SHORTEST},}}")
# Padding stays with its part only at the end of a run; elsewhere '=' parts a name from its value.
_VALUE = re.compile(r"[^=]+(?:=+\Z)?")
_PARTS = (re.compile(r"[^+/]+"), re.compile(r"[^_-]+"))

# Alphabets in order of preference: the first that holds all characters is taken.
ALPHABETS = {
    "decimal": "0123456789",
    "hex": "0123456789abcdef",
    "hex_upper": "0123456789ABCDEF",
    "lower": "abcdefghijklmnopqrstuvwxyz",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
    "mixed": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_",
}
_PLACE = {name: {letter: at for at, letter in enumerate(alphabet)} for name, alphabet in ALPHABETS.items()}
# Chance that two letters of ordinary prose agree: how far prose is from uniform in an alphabet.
_PROSE_AGREEMENT = 0.065
_HEX_AGREEMENT = 0.2
# Share of digits in the alphabets that hold them beside letters of one case.
_DIGIT_SHARE = {"base32": 6 / 32, "base36": 10 / 36}
_GRID = 0.25
_DEEPEST = 48
RATE = 0.01


def _tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def encoding_of(token: str) -> str | None:
    """The first alphabet that holds the token without its padding; None if there is none."""
    letters = set(token.rstrip("="))
    return next((name for name, places in _PLACE.items() if letters <= places.keys()), None)


def battery(token: str, encoding: str) -> float:
    """Combined p-value of the token being uniform and independent over its alphabet."""
    places = _PLACE[encoding]
    body = [places[letter] for letter in token.rstrip("=")]
    size, kinds = len(body), len(places)
    if size < 2:
        return 1.0
    expected = size / kinds
    chi = sum((n - expected) ** 2 for n in Counter(body).values()) / expected
    chi += (kinds - len(set(body))) * expected
    # The statistic's exact mean and variance; a cube root makes its tail nearly normal.
    mean, variance = kinds - 1, 2 * (kinds - 1) * (size - 1) / size
    freedom = 2 * mean * mean / variance
    scaled = (chi / mean) ** (1 / 3)
    uniform = _tail((scaled - (1 - 2 / (9 * freedom))) / math.sqrt(2 / (9 * freedom)))
    high = [2 * place >= kinds for place in body]
    ones = sum(high)
    runs = 1.0
    if 0 < ones < size:
        mean_runs = 1 + 2 * ones * (size - ones) / size
        spread = (mean_runs - 1) * (mean_runs - 2) / (size - 1)
        if spread > 0:
            found = 1 + sum(a != b for a, b in zip(high, high[1:]))
            runs = 2 * _tail(abs(found - mean_runs) / math.sqrt(spread))
    middle = sum(body) / size
    power = sum((x - middle) ** 2 for x in body)
    serial = 0.0
    if power:
        r = sum((a - middle) * (b - middle) for a, b in zip(body, body[1:])) / power
        serial = 2 * _tail(abs(r + 1 / size) * math.sqrt(size))
    tests = [uniform, runs, serial]
    if encoding in _DIGIT_SHARE:
        # Words with a number in them change between letters and digits less often than chance does.
        share = _DIGIT_SHARE[encoding]
        both = share * (1 - share)
        spread = (size - 1) * 2 * both * (1 - 2 * both) + 2 * (size - 2) * (both - 4 * both * both)
        changes = sum(a.isdigit() != b.isdigit() for a, b in zip(token, token[1:size]))
        tests.append(_tail(((size - 1) * 2 * both - changes - 0.5) / math.sqrt(spread)))
    # Fisher: minus twice the sum of logs is chi-squared with two degrees of freedom for each test.
    half = -sum(math.log(max(p, 1e-300)) for p in tests)
    return math.exp(-half) * sum(half**k / math.factorial(k) for k in range(len(tests))) if half < 700 else 0.0


def least_length(encoding: str) -> int | None:
    """Shortest token on which chi-squared dismisses prose 19 times of 20; None if it never should."""
    if encoding == "decimal":
        return None  # numbers are uniform and no secrets
    kinds = len(ALPHABETS[encoding])
    agreement = _HEX_AGREEMENT if encoding.startswith("hex") else _PROSE_AGREEMENT
    excess = kinds * agreement - 1
    for size in range(20, 1000):
        shift = excess * size
        if shift >= 2.33 * math.sqrt(2 * (kinds - 1)) + 1.65 * math.sqrt(2 * (kinds - 1) + 4 * shift):
            return size
    return None


_LEAST = {name: least_length(name) for name in ALPHABETS}


def _testable(token: str, encoding: str) -> bool:
    """Whether not being dismissed says anything: of letters alone, as words are, only long tokens do."""
    least = _LEAST[encoding]
    return least is not None and (len(token) >= least or encoding in _DIGIT_SHARE and not token.rstrip("=").isalpha())


def parts_of(run: str) -> list[tuple[int, int, str]]:
    """(start, end, encoding) of what is tested of a run of key characters, each of 20 or more.

    A run is parted at inner '='. A part with letters of both base64 alphabets is parted at those of
    the one and of the other, as either may join names to a key, so parts of the two may overlap; one that
    has no long part is tested whole over all letters.
    """
    found = []
    for value in _VALUE.finditer(run):
        start, end = value.span()
        if end - start < _SHORTEST:
            continue
        encoding = encoding_of(value[0])
        if encoding != "mixed":
            found.append((start, end, encoding))
            continue
        inner = {
            (part.start() + start, part.end() + start): encoding_of(part[0])
            for pattern in _PARTS for part in pattern.finditer(value[0]) if part.end() - part.start() >= _SHORTEST
        }
        found += [(*span, of) for span, of in sorted(inner.items())] or [(start, end, encoding)]
    return found


def _length_class(size: int) -> int:
    """Lengths by powers of the square root of two."""
    return int(2 * math.log2(size))


def tested_tokens(text: str) -> list[tuple[int, int, str, int, float]]:
    """(start, end, encoding, length class, p-value) of each long token in code points."""
    found = []
    for match in _TOKEN.finditer(text):
        for start, end, encoding in parts_of(match[0]):
            token = match[0][start:end]
            if _testable(token, encoding):
                at = match.start() + start
                found.append((at, at + len(token), encoding, _length_class(len(token)), battery(token, encoding)))
    return found


def dismissal_levels(docs: DataFrame, text: str = "text", rate: float = RATE) -> dict[tuple[str, int], float]:
    """Per class of encoding and length, the p-value up to which a token is dismissed as not random.

    All documents are counted. The grid holds at most 9 encodings, some 40 length classes and 49 steps.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for value in batch.column(0):
                for _, _, encoding, size, p in tested_tokens(value.as_py() or ""):
                    seen[encoding, size, min(_DEEPEST, int(-math.log10(max(p, 1e-300)) / _GRID))] += 1
        keys = list(seen)
        yield pa.RecordBatch.from_pydict({
            "encoding": pa.array([k[0] for k in keys], pa.string()),
            "size": pa.array([k[1] for k in keys], pa.int32()),
            "step": pa.array([k[2] for k in keys], pa.int32()),
            "n": pa.array([seen[k] for k in keys], pa.int64()),
        })

    counts = docs.select(text).mapInArrow(count, "encoding string, size int, step int, n long")
    rows = counts.groupBy("encoding", "size", "step").agg(F.sum("n").alias("n")).collect()
    classes: dict[tuple[str, int], Counter] = {}
    for row in rows:
        classes.setdefault((row["encoding"], row["size"]), Counter())[row["step"]] += row["n"]
    levels = {}
    for key, steps in classes.items():
        total, below, level = sum(steps.values()), 0, 0.0
        for step in range(_DEEPEST, 0, -1):
            below += steps[step]
            # Everything counted so far has a p-value of at most this edge of the grid.
            edge = 10 ** (-_GRID * step)
            if below and total * edge <= rate * below:
                level = edge
        levels[key] = level
    return levels


def secret_spans(text: str, levels: dict[tuple[str, int], float]) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all secrets by start and kind; random tokens only outside the others.

    A class without a level was not counted: its token is judged alone, which dismisses it at ``RATE``.
    """
    lowered = text.lower()
    base = []
    if any(word in lowered for word in _KEYWORDS):
        base += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        base += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    tokens = tested_tokens(text)
    # 32 hexadecimal digits lie in a long token, though not always in one that is tested.
    if tokens or _TOKEN.search(text):
        base += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    found, random = sorted(base), []
    starts, reach = [s for s, _, _ in found], list(accumulate((e for _, e, _ in found), max))
    for start, end, encoding, size, p in tokens:
        if p <= levels.get((encoding, size), RATE):
            continue
        before = bisect_left(starts, end)
        if before and reach[before - 1] > start:
            continue
        if random and random[-1][1] > start:  # parts of one run, cut in two ways
            start, end = random[-1][0], max(end, random.pop()[1])
        random.append((start, end, "random"))
    return sorted(found + random, key=lambda span: (span[0], KINDS.index(span[2])))


def scan_secrets(docs: DataFrame, text: str = "text", rate: float = RATE) -> DataFrame:
    """(doc_id, spans array<struct<start, end, kind>>) of every whole text, in code points, end exclusive.

    A null text counts as empty. Every row gives a row, also one without spans; repeated rows and null
    ids included. Other columns are not read.
    """
    levels = dismissal_levels(docs, text, rate)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                [{"start": s, "end": e, "kind": k} for s, e, k in secret_spans(value.as_py() or "", levels)]
                for value in batch.column(1)
            ]
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], ["doc_id", "spans"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text).mapInArrow(
        scan, f"doc_id {id_type}, spans array<struct<start: int, end: int, kind: string>>"
    )


def mask(text: str, spans: list[tuple[int, int, str]], by: str) -> str:
    """The text with each run of overlapping spans replaced once."""
    parts, at = [], 0
    for start, end, _ in spans:
        if start >= at:
            parts += [text[at:start], by]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def mask_secrets(docs: DataFrame, text: str = "text", length: str | None = "n_chars", by: str = "[secret]",
                 rate: float = RATE) -> DataFrame:
    """The rows of ``docs``, each secret in the text replaced and the length column, if any, set anew.

    Rows without secrets, null texts included, come back unchanged.
    """
    levels = dismissal_levels(docs, text, rate)
    lengths = length if length in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns))
            texts = batch.column(text).to_pylist()
            spans = [secret_spans(value, levels) if value else [] for value in texts]
            if any(spans):
                masked = [mask(v, s, by) if s else v for v, s in zip(texts, spans)]
                columns[text] = pa.array(masked, batch.schema.field(text).type)
                if lengths:
                    old = batch.column(lengths).to_pylist()
                    columns[lengths] = pa.array(
                        [len(m) if s else n for m, s, n in zip(masked, spans, old)],
                        batch.schema.field(lengths).type,
                    )
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return docs.mapInArrow(run, T.StructType(docs.schema.fields))


def digests(found: DataFrame) -> DataFrame:
    """Per document: counts of the base kinds, the digest of the base spans, all spans as text."""
    listed = F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    base = F.transform(
        F.filter("spans", lambda s: s["kind"] != "random"),
        lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]),
    )

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", *[count(kind).alias(f"n_{kind}") for kind in KINDS[:3]],
        F.sha2(F.concat_ws(",", base), 256).alias("base_sha256"),
        F.concat_ws(",", listed).alias("spans"),
        count("random").alias("n_random"),
    )
