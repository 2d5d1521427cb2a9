"""Secrets in texts: fixed patterns, and strings that a battery of randomness tests singles out.

Fixed patterns give the base spans (assign, access, hex). Beside them every maximal run of
encoding characters that no base span touches is a candidate. '=' is padding at the end of
a run and ends a part elsewhere (NAME=value). A part that mixes '+' or '/' with '-' or '_'
has no encoding: its longest stretches without the one or the other two, and those without
'/', '-' and '_', are candidates instead. Of reported ones those within another are left out.

- Its encoding is the smallest alphabet that holds it (ALPHABETS).
- Battery: chi-squared test of uniform use of the alphabet, runs test about the alphabet's
  middle, serial correlation of neighbours. The least of the three p-values is the battery's
  value; a candidate below BATTERY is out, as no random string.
- The battery's p-value against ordinary text: the share of ordinary strings of the class of
  length whose value is as high. These are made of all texts of the corpus, their letters and
  digits without what stands between, cut into strings of the least length of each class.
  Longer ordinary strings look less random, so a long candidate needs less than a short one.
- A second p-value against ordinary text: how probable so many changes between letters and
  digits are in a string of that length, at the rate at which they occur in the corpus beside
  base spans and candidates. (Changes of case say less: names of many words have them, too.)
- Both together are a candidate's evidence. Within each class of lengths, over the whole
  corpus, the step-up rule keeps the expected share of ordinary strings among the reported
  ones within FDR. It needs only histograms of bounded size.

Runs of fewer than LEAST_CHARS characters are no candidates: LEAST_CHARS is a parameter of the
method, as the base patterns' least lengths are. Longer ones are tested as a whole, whatever
their length, and so are texts.

Places are code points, ends are exclusive. Defined cases: a null text is an empty one and
gives no span; the digest of no spans is that of the empty string; repeated rows each give
their row; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from poiloom.llm.common import own_names, small_batches, stored

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
#: Parts of a candidate; '=' belongs to the last one only. Then stretches of a part that no alphabet holds.
PART = re.compile(r"[A-Za-z0-9+/_-]+(?:=+\Z)?")
STRETCHES = tuple(re.compile(rf"[A-Za-z0-9{more}]+(?:=+\Z)?") for more in ("+/", "_-", "+"))
#: Part of each of ASSIGN's words, in lower case: a text without any of them has no assignment.
HINTS = ("passw", "secret", "token", "api")
#: Fewest characters of group 2 of ASSIGN, and of the shortest other match.
ASSIGN_CHARS, LEAST_CHARS = 6, 20
KINDS = ("assign", "access", "hex", "random")
#: A battery test rejects below this p-value.
BATTERY = 0.001
#: Expected share of ordinary strings among the reported ones.
FDR = 0.001
#: Upper ends of the classes of lengths, and the least length of each.
LENGTHS = (24, 32, 48, 64, 128)
SHORTEST = (20, 25, 33, 49, 65, 129)
#: p-values are counted by -log10 in steps of 1 / STEPS, up to STEPS * DECADES of them; the battery's up to STEPS * BATTERY_DECADES.
STEPS, DECADES, BATTERY_DECADES = 10, 60, 6

LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: Alphabets of encodings, each in its order: base 16, 32, 36 in either case, 58, 62, 64 in both forms. Smaller ones stand first.
ALPHABETS = (
    DIGITS + "abcdef",
    DIGITS + "ABCDEF",
    LOWER + "234567",
    UPPER + "234567",
    DIGITS + LOWER,
    DIGITS + UPPER,
    "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz",
    UPPER + LOWER + DIGITS,
    UPPER + LOWER + DIGITS + "+/",
    UPPER + LOWER + DIGITS + "-_",
)
#: By byte, a bit for each alphabet that has it; by alphabet and byte, its place there.
HOLDS = np.array([sum(1 << k for k, a in enumerate(ALPHABETS) if chr(b) in a) for b in range(256)], dtype=np.uint16)
PLACES = np.array([[max(a.find(chr(b)), 0) for b in range(256)] for a in ALPHABETS], dtype=np.int16)
#: Class of each byte: 1 letter, 2 digit, 0 anything else.
CLASSES = bytes(1 if chr(b) in LOWER + UPPER else 2 if chr(b) in DIGITS else 0 for b in range(256))
NO_LETTER = bytes(b for b in range(256) if not CLASSES[b])
#: What a batch adds to the corpus's counts: changes between letter and digit, neighbours, candidates that the battery rejects by class of length,
#: and ordinary strings by class of length and the battery's value.
VALUES = STEPS * BATTERY_DECADES + 1
SEEN = 2 + len(SHORTEST) + len(SHORTEST) * VALUES

CANDIDATE_TYPE = "array<struct<`start`:bigint,`end`:bigint,n:int,battery:int,changes:int,neighbours:int>>"
FIELDS = ("start", "end", "n", "battery", "changes", "neighbours")
SPAN_TYPE = "array<struct<kind:int,`start`:bigint,`end`:bigint>>"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed patterns, by start, then kind."""
    found = []
    low = text.lower()
    if any(h in low for h in HINTS):
        found += [(0, *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_CHARS]
    if max(map(len, text.encode().split()), default=0) >= LEAST_CHARS:
        found += [(1, *m.span()) for m in ACCESS.finditer(text)]
        found += [(2, *m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], s[0]))


def normal_tail(z: np.ndarray) -> np.ndarray:
    """P(Z >= z)."""
    return np.array([0.5 * math.erfc(x / math.sqrt(2)) for x in z.tolist()])


def battery(rows: np.ndarray) -> np.ndarray:
    """The least p-value of the tests that each row of bytes is random in its encoding; 0 if no alphabet holds it."""
    found = np.zeros(len(rows))
    holds = np.bitwise_and.reduce(HOLDS[rows], axis=1)
    n = rows.shape[1]
    for k, alphabet in enumerate(ALPHABETS):
        at = np.flatnonzero((holds & -holds.astype(np.int32)) == 1 << k)
        if len(at):
            found[at] = tests(PLACES[k][rows[at]].astype(np.int64), len(alphabet), n)
    return found


def tests(value: np.ndarray, size: int, n: int) -> np.ndarray:
    """Least p-value of the three tests, for rows of n places in an alphabet of size."""
    total = len(value)
    counts = np.bincount((np.arange(total)[:, None] * size + value).ravel(), minlength=total * size).reshape(total, size)
    square = (counts.astype(float) ** 2).sum(axis=1) * size / n - n
    uniform = normal_tail((square - (size - 1)) / math.sqrt(2 * (size - 1) * (n - 1) / n))
    high = value >= size // 2
    ups = high.sum(axis=1).astype(float)
    mean = 2 * ups * (n - ups) / n + 1
    spread = (mean - 1) * (mean - 2) / (n - 1)
    runs = 1 + (high[:, 1:] != high[:, :-1]).sum(axis=1)
    usable = spread > 0
    runs_p = np.zeros(total)
    runs_p[usable] = 2 * normal_tail(np.abs(runs - mean)[usable] / np.sqrt(spread[usable]))
    off = value - value.mean(axis=1, keepdims=True)
    scale = (off**2).sum(axis=1)
    serial = np.where(scale > 0, (off[:, 1:] * off[:, :-1]).sum(axis=1) / np.where(scale > 0, scale, 1), 1.0)
    serial_p = 2 * normal_tail(np.abs(serial + 1 / n) * math.sqrt(n))
    return np.minimum(np.minimum(uniform, runs_p), serial_p)


def battery_step(p: np.ndarray) -> np.ndarray:
    """-log10 of the battery's value in whole steps, the last one for all beyond."""
    return np.minimum(-np.log10(np.maximum(p, 1e-300)) * STEPS, VALUES - 1).astype(np.int64)


def ordinary(raw: bytes) -> np.ndarray:
    """How many ordinary strings of each class of length have each value of the battery."""
    found = np.zeros((len(SHORTEST), VALUES), dtype=np.int64)
    letters = np.frombuffer(raw.translate(None, NO_LETTER), dtype=np.uint8)
    turn = sum(SHORTEST)
    for i in range(0, len(letters) - turn + 1, 1024 * turn):
        rows = letters[i : i + 1024 * turn]
        rows = rows[: len(rows) // turn * turn].reshape(-1, turn)
        at = 0
        for k, n in enumerate(SHORTEST):
            found[k] += np.bincount(battery_step(battery(rows[:, at : at + n])), minlength=VALUES)
            at += n
    return found


def parts(run: str) -> list[tuple[int, int]]:
    """Places in a run of encoding characters of what is tested, by start, the longer one first."""
    found = set()
    for m in PART.finditer(run):
        mixed = not {"+", "/"}.isdisjoint(m[0]) and not {"-", "_"}.isdisjoint(m[0])
        stretches = [x.span() for p in STRETCHES for x in p.finditer(m[0])] if mixed else [(0, len(m[0]))]
        found.update((m.start() + a, m.start() + b) for a, b in stretches if b - a >= LEAST_CHARS)
    return sorted(found, key=lambda s: (s[0], -s[1]))


def candidates(text: str, base: list[tuple[int, int, int]]) -> tuple[list[tuple[int, ...]], np.ndarray]:
    """FIELDS of candidates that pass the battery, and how many don't by class of length."""
    found, failed = [], np.zeros(len(SHORTEST), dtype=np.int64)
    for m in CANDIDATE.finditer(text):
        for a, b in parts(m[0]):
            start, end = m.start() + a, m.start() + b
            raw = m[0][a:b].rstrip("=").encode()
            if any(s < end and start < e for _, s, e in base) or len(raw) < LEAST_CHARS - 2:
                continue
            p = battery(np.frombuffer(raw, dtype=np.uint8)[None, :])
            if p[0] < BATTERY:
                failed[length_class(len(raw))] += 1
                continue
            found.append((start, end, len(raw), int(battery_step(p)[0]), *class_changes(raw)))
    return found, failed


def class_changes(raw: bytes) -> tuple[int, int]:
    """Neighbours of which one is a letter and one a digit, and all neighbours of letters and digits."""
    c = np.frombuffer(raw.translate(CLASSES), dtype=np.uint8)
    both = (c[1:] > 0) & (c[:-1] > 0)
    return int((both & ((c[1:] == 2) != (c[:-1] == 2))).sum()), int(both.sum())


def scan(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, base spans and candidates of each row; in the first row of a batch what its texts add to the corpus's rates."""
    small_batches(docs.sparkSession)
    d = own_names(docs, key, "text")
    schema = f"`{key}` {d.schema[key].dataType.simpleString()}, base {SPAN_TYPE}, found {CANDIDATE_TYPE}, seen array<bigint>"
    base_type = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))
    found_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("n", pa.int32()), ("battery", pa.int32()), ("changes", pa.int32()), ("neighbours", pa.int32())]))

    def look(batches):
        for batch in batches:
            base, found = [], []
            changes, failed = np.zeros(2, dtype=np.int64), np.zeros(len(SHORTEST), dtype=np.int64)
            texts = []
            for text in batch.column(1):
                text = text.as_py() or ""
                own = base_spans(text)
                raw = text.encode()
                texts.append(raw)
                base.append([dict(zip(("kind", "start", "end"), s, strict=True)) for s in own])
                long = max(map(len, raw.split()), default=0) >= LEAST_CHARS
                passed, not_passed = candidates(text, own) if long else ([], 0)
                failed += not_passed
                found.append([dict(zip(FIELDS, c, strict=True)) for c in passed])
                if raw:
                    changes += class_changes(raw)
                    # what may be a secret itself is no ordinary text
                    last = 0
                    for start, end in sorted([x[1:3] for x in own] + [x[:2] for x in passed], key=lambda x: (x[0], -x[1])):
                        if start >= last:
                            changes -= class_changes(text[start:end].encode())
                            last = end
            counts = [*changes.tolist(), *failed.tolist(), *ordinary(b"".join(texts)).ravel().tolist()]
            seen = [counts, *[None] * (batch.num_rows - 1)] if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(base, base_type), pa.array(found, found_type), pa.array(seen, pa.list_(pa.int64()))], names=[key, "base", "found", "seen"])

    return d.mapInArrow(look, schema)


def rates(scanned: DataFrame) -> tuple[float, list[int], list[list[float]]]:
    """Of the corpus: how often neighbours are a letter and a digit, rejected candidates by class of length, and shares of ordinary
    strings by class of length whose value of the battery is as high as each."""
    rows = scanned.where("seen is not null").select(F.posexplode("seen").alias("i", "n")).groupBy("i").agg(F.sum("n").alias("n")).collect()
    seen = np.zeros(SEEN, dtype=np.int64)
    for r in rows:
        seen[r["i"]] = r["n"]
    classes = len(SHORTEST)
    counts = seen[2 + classes :].reshape(classes, VALUES)
    shares = (np.cumsum(counts, axis=1) + 1) / (counts.sum(axis=1, keepdims=True) + 1)
    return float((seen[0] + 1) / (seen[1] + 2)), seen[2 : 2 + classes].tolist(), shares.tolist()


def binomial_tail(hits: int, trials: int, p: float) -> float:
    """The natural logarithm of P(X >= hits)."""
    if hits <= trials * p:
        return 0.0
    log = math.lgamma(trials + 1) - math.lgamma(hits + 1) - math.lgamma(trials - hits + 1) + hits * math.log(p) + (trials - hits) * math.log1p(-p)
    total = term = 1.0
    for k in range(hits, trials):  # terms fall faster than a geometric series, as hits is above the mean
        term *= (trials - k) / (k + 1) * p / (1 - p)
        total += term
        if term < 1e-12 * total:
            break
    return min(0.0, log + math.log(total))


def evidence(n: int, step: int, changes: int, neighbours: int, change: float, shares: list[list[float]]) -> float:
    """-log10 of the p-value against ordinary text, battery and class changes together, in steps of 1 / STEPS rounded down."""
    random = shares[length_class(n)][step]
    log = -math.log(max(random, 1e-300)) - binomial_tail(changes, neighbours, change)
    # two p-values together: P(product <= theirs) = product * (1 + log), for independent ones
    return math.floor(max(0.0, log - math.log1p(log)) / math.log(10) * STEPS) / STEPS


def length_class(n: int) -> int:
    return sum(n > x for x in LENGTHS)


def thresholds(scanned: DataFrame, change: float, failed: list[int], shares: list[list[float]]) -> dict[int, float]:
    """Least evidence of a reported candidate, by class of length."""
    c = scanned.where("size(found) > 0").select(F.explode("found").alias("c")).select("c.*")
    names = ["cls", "step", "n"]

    def count(batches):
        for batch in batches:
            own: dict = {}
            for r in batch.to_pylist():
                e = evidence(r["n"], r["battery"], r["changes"], r["neighbours"], change, shares)
                k = length_class(r["n"]), min(int(e * STEPS + 0.5), STEPS * DECADES)
                own[k] = own.get(k, 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in own], pa.int32()), pa.array([k[1] for k in own], pa.int32()), pa.array(list(own.values()), pa.int64())], names=names)

    rows = c.mapInArrow(count, "cls int, step int, n long").groupBy("cls", "step").agg(F.sum("n").alias("n")).collect()
    # rejected candidates are tested ones, too, with a p-value of 1
    return step_up([(r["cls"], r["step"], r["n"]) for r in rows] + [(k, 0, n) for k, n in enumerate(failed) if n])


def step_up(rows: list[tuple[int, int, int]]) -> dict[int, float]:
    """The largest set of steps with p-value * candidates / reported <= FDR, by class of length."""
    found: dict[int, float] = {}
    for cls in {r[0] for r in rows}:
        own = sorted(((s, n) for c, s, n in rows if c == cls), reverse=True)
        total, reported = sum(n for _, n in own), 0
        for step, n in own:
            reported += n
            if 10 ** (-step / STEPS) * total / reported <= FDR:
                found[cls] = step / STEPS
    return found


def digest(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def reported(base: list[Row], found: list[Row], known: tuple[float, list[list[float]]], least: dict[int, float]) -> list[tuple[int, int, int]]:
    """Base spans and those candidates whose evidence is enough, by start, then kind."""
    spans = [(b["kind"], b["start"], b["end"]) for b in base]
    last = 0
    for c in sorted(found, key=lambda c: (c["start"], -c["end"])):
        need = least.get(length_class(c["n"]))
        # one that ends no later than an earlier one stands within it
        if c["end"] > last and need is not None and evidence(c["n"], c["battery"], c["changes"], c["neighbours"], *known) >= need:
            spans.append((3, c["start"], c["end"]))
            last = c["end"]
    return sorted(spans, key=lambda s: (s[1], s[0]))


def learn(scanned: DataFrame) -> tuple[tuple[float, list[list[float]]], dict[int, float]]:
    """What reporting needs from the whole corpus."""
    change, failed, shares = rates(scanned)
    return (change, shares), thresholds(scanned, change, failed, shares)


def find_secrets(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, n_assign, n_access, n_hex, base_sha256, spans, n_random of every document."""
    scanned = stored(scan(docs, key), "secrets")
    known, least = learn(scanned)
    schema = f"`{key}` {scanned.schema[key].dataType.simpleString()}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long"

    def report(batches):
        for batch in batches:
            out = []
            for base, found in zip(batch.column("base").to_pylist(), batch.column("found").to_pylist(), strict=True):
                spans = reported(base, found, known, least)
                own = [s for s in spans if s[0] < 3]
                n = [sum(s[0] == k for s in spans) for k in range(4)]
                out.append((*n[:3], hashlib.sha256(digest(own).encode()).hexdigest(), digest(spans), n[3]))
            columns = [pa.array(x, t) for x, t in zip(zip(*out, strict=True) if out else [[]] * 6, [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(key), *columns], names=[key, "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random"])

    return scanned.select(key, "base", "found").mapInArrow(report, schema)


def redact(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    """text with each stretch of overlapping spans replaced by mark."""
    out, at = [], 0
    for _, start, end in spans:
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], mark]
        at = end
    return "".join([*out, text[at:]])


def redacted_documents(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """docs with every reported span of text replaced by mark, and n_chars that of the new text where there is one.

    The corpus's thresholds come from a first look at the texts; a second one applies them,
    so texts are read twice and never shuffled.
    """
    known, least = learn(stored(scan(docs), "secrets"))
    at = docs.columns.index("text")
    count = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def clean(batches):
        for batch in batches:
            new = []
            for text in batch.column(at).to_pylist():
                if text:
                    base = base_spans(text)
                    found = [dict(zip(FIELDS, c, strict=True)) for c in candidates(text, base)[0]] if max(map(len, text.encode().split()), default=0) >= LEAST_CHARS else []
                    spans = reported([dict(zip(("kind", "start", "end"), b, strict=True)) for b in base], found, known, least)
                    text = redact(text, spans, mark) if spans else text
                new.append(text)
            columns = list(batch.columns)
            if count is not None:
                columns[count] = pa.array([None if t is None else len(t) for t in new], pa.int64()).cast(columns[count].type)
            columns[at] = pa.array(new, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(clean, docs.schema)
