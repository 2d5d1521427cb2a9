"""Quality rules whose cutoffs are certified on labelled documents.

Each document has a few plain counts, and rules made of them: a rule's value is a whole
number, high when the text looks bad. A fixed base rule comes first. For what passes it,
cutoffs are learnt from labels, by stratum (language):

- Labelled documents are split in two by a hash of their text, so that copies stand on one
  side. The first half's good documents give a path of cutoffs for every rule, from lenient to
  strict: level k cuts off at most the share k / LEVELS of ALLOWED by each rule. A rule is used
  in a stratum if, at the path's end, it rejects bad documents more often than ALLOWED, by the
  exact binomial lower bound.
- The second half is the holdout. Along the path, the good documents that any rule would
  reject are counted; the exact binomial upper bound of their share, at the confidence
  1 - ERROR / strata, must stay within ALLOWED. The walk stops at the first level that
  fails, so levels need no further correction; the division by the number of strata
  corrects for the strata.
- Of the certified levels the most lenient one is taken that rejects nearly as many bad
  documents of the first half as the strictest certified one does.

A stratum with too few labels certifies no level: there only the base rule rejects. With
probability 1 - ERROR, no stratum loses more than the share ALLOWED of its good documents
to the learnt rules. Rules' values have no upper end; histograms, paths and levels stay in
tables, one row of bounded size by stratum in the end, and the driver sees their number.

Defined cases: a null text has no words and fails the base rule; a null stratum is a
stratum of its own; a document without label takes part in no count; documents labelled
more than once count once for each label; a text of any length is counted as a whole;
an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from poiloom.llm import words as W
from poiloom.llm.common import own_names, small_batches, stored

#: The base rule.
LEAST_WORDS, REPEAT_WINDOW, MOST_REPEATED = 10, 5, 20
SYMBOLS = b"#*$%&|<>"
BLANK = b" \t\n\r\x0b\x0c"
#: Share of good documents that may be lost, and the probability that more are.
ALLOWED, ERROR = 0.01, 0.05
LEVELS = 20
#: Confidence that a rule that is used rejects the bad more often than ALLOWED.
USEFUL = 0.95
#: A more lenient level is taken if it rejects this share of what the strictest certified one does.
NEARLY = 0.98

#: What is counted in a text; then a hash of it, by which labelled documents are split.
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stutter")
HASH = "_text_hash"


def rules() -> dict[str, Column]:
    """Whole numbers, high for bad texts."""

    def share(part: str, whole: str, of: int) -> Column:
        # floor(a / b) of doubles differs from whole-number division only far beyond these sizes
        return F.when(F.col(whole) > 0, F.floor(F.col(part) * of / F.col(whole))).otherwise(0)

    length = share("word_chars", "n_words", 100)
    found = {
        "symbols": share("n_symbols", "word_chars", 1000),
        "stutter": share("n_stutter", "n_words", 1000),
        "dup_lines": share("n_dup_lines", "n_lines", 1000),
        "repeats": share("n_repeat_words", "n_words", 1000),
        "long_words": length,
        "short_words": -length,
    }
    return {k: v.cast("long") for k, v in found.items()}


def counts_of(texts: list[str | None]) -> list[np.ndarray]:
    """COUNTS and HASH of each text."""
    from xxhash import xxh3_64_digest

    same_texts = np.frombuffer(b"".join(xxh3_64_digest((t or "").encode()) for t in texts), dtype="<i8")
    lists, chars, symbols, dups, lines = [], [], [], [], []
    for text in texts:
        raw = text.encode() if text else b""
        ws = raw.split()
        joined = b"".join(ws)
        kept = [x for x in raw.split(b"\n") if x and not x.isspace()] if raw else []
        lists.append(ws)
        chars.append(len(joined) if text is None or text.isascii() else len(joined.decode()))
        symbols.append(len(joined) - len(joined.translate(None, SYMBOLS)))
        dups.append(len(kept) - len(set(kept)))
        lines.append(len(kept))
    n = np.array([len(x) for x in lists], dtype=np.int64)
    begin = W.starts(n)
    h = W.hashes(w for ws in lists for w in ws)
    doc = np.repeat(np.arange(len(n)), n)
    repeats = np.zeros(len(n), dtype=np.int64)
    if len(h) >= REPEAT_WINDOW:
        whole = W.inside(begin, REPEAT_WINDOW)
        at = np.flatnonzero(whole)
        # a window counts as the same only within its text: the text's number is mixed in
        keys = W.windows(h, REPEAT_WINDOW)[at] + W.mixed(doc[at].astype(np.uint64) + W.ODD)
        again = at[W.repeated(keys)]
        repeats = np.bincount(doc[W.covered(again, REPEAT_WINDOW, len(h))], minlength=len(n))
    same = np.flatnonzero((h[1:] == h[:-1]) & (doc[1:] == doc[:-1])) if len(h) > 1 else np.zeros(0, dtype=np.int64)
    stutter = np.bincount(doc[same], minlength=len(n)) if len(n) else n
    return [n, *(np.array(x, dtype=np.int64) for x in (chars, symbols, dups)), repeats.astype(np.int64), np.array(lines, dtype=np.int64), stutter.astype(np.int64), same_texts.copy()]


def with_counts(docs: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """The keep columns of docs, COUNTS and HASH of its text, one row per document."""
    small_batches(docs.sparkSession)
    d = own_names(docs, *keep, *([] if text in keep else [text]))
    at = d.columns.index(text)
    schema = ", ".join(f"`{c}` {d.schema[c].dataType.simpleString()}" for c in keep) + "".join(f", {c} long" for c in (*COUNTS, HASH))

    def count(batches):
        for batch in batches:
            found = counts_of(batch.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), *map(pa.array, found)], names=[*keep, *COUNTS, HASH])

    return d.mapInArrow(count, schema)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def upper_bound(failures: int, trials: int, error: float) -> float:
    """The exact binomial upper bound of a share: the largest p with P(X <= failures) >= error."""
    if trials == 0 or failures >= trials:
        return 1.0

    def tail(p: float) -> float:
        if p <= 0:
            return 1.0
        term = trials * math.log1p(-p)
        total, k = math.exp(term), 0
        while k < failures:
            k += 1
            term += math.log((trials - k + 1) / k) + math.log(p) - math.log1p(-p)
            total += math.exp(term)
        return total

    low, high = failures / trials, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if mid < 1 and tail(mid) >= error else (low, mid)
    return high


def lower_bound(failures: int, trials: int, error: float) -> float:
    """The exact binomial lower bound of a share."""
    return 1 - upper_bound(trials - failures, trials, error)


def paths_of(values: DataFrame, stratum: str) -> DataFrame:
    """Each stratum's paths of cutoffs (reject above), null for a rule that isn't used.

    values: stratum, rule, value, _label of the first half's labelled documents.
    """
    key = [stratum, "rule"]
    hist = values.groupBy(*key, "value").agg(F.sum("_label").alias("good"), F.sum(1 - F.col("_label")).alias("bad"))
    above = Window.partitionBy(*key).orderBy(F.desc("value")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*key)
    seen = hist.withColumns({"good_above": F.coalesce(F.sum("good").over(above), F.lit(0)), "bad_above": F.coalesce(F.sum("bad").over(above), F.lit(0)), "n_good": F.sum("good").over(whole), "n_bad": F.sum("bad").over(whole)})
    # a level's cutoff is the lowest value above which no more good documents lie than it allows
    path = F.array(*[F.min(F.when(F.col("good_above") <= F.col("n_good") * (ALLOWED * k / LEVELS), F.col("value"))) for k in range(LEVELS)])
    last = F.min_by("bad_above", F.when(F.col("good_above") <= F.col("n_good") * (ALLOWED * (LEVELS - 1) / LEVELS), F.col("value")))
    found = seen.groupBy(*key).agg(path.alias("path"), last.alias("lost"), F.first("n_good").alias("n_good"), F.first("n_bad").alias("n_bad"))
    kind = hist.schema[stratum].dataType.simpleString()

    def useful(batches):
        for batch in batches:
            ok = [bool(g and b and lower_bound(x, b, 1 - USEFUL) > ALLOWED) for x, g, b in zip(*(batch.column(c).to_pylist() for c in ("lost", "n_good", "n_bad")), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(stratum), batch.column("rule"), batch.column("path")], names=["_stratum", "rule", "path"]).filter(pa.array(ok))

    used = found.mapInArrow(useful, f"_stratum {kind}, rule int, path array<bigint>")
    every = values.select(F.col(stratum).alias("_stratum")).distinct()
    columns = [F.max(F.when(F.col("rule") == i, F.col("path"))).alias(f"_path_{r}") for i, r in enumerate(rules_names())]
    return every.join(used.withColumnRenamed("_stratum", "_own"), F.col("_stratum").eqNullSafe(F.col("_own")), "left").groupBy("_stratum").agg(*columns)


def rules_names() -> tuple[str, ...]:
    return ("symbols", "stutter", "dup_lines", "repeats", "long_words", "short_words")


def level_of(paths: dict[str, str]) -> Column:
    """The most lenient level at which some rule rejects: 0 to LEVELS - 1, LEVELS if none does."""

    def first(rule: str, path: str) -> Column:
        passed = F.size(F.filter(F.col(path), lambda cutoff: F.col(rule) > cutoff))
        return F.when(F.col(path).isNotNull(), F.lit(LEVELS) - passed).otherwise(F.lit(LEVELS))

    return F.least(*[first(r, c) for r, c in paths.items()])


def ruled(counted: DataFrame) -> DataFrame:
    return counted.withColumn("base_failed", base_failed()).withColumns(rules())


def leveled(d: DataFrame, paths: DataFrame, stratum: str) -> DataFrame:
    columns = {r: f"_path_{r}" for r in rules_names()}
    return d.join(paths, F.col(stratum).eqNullSafe(F.col("_stratum")), "left").withColumn("level", level_of(columns)).drop("_stratum", *columns.values())


def learn(counted: DataFrame, labels: DataFrame, key: str = "doc_id", stratum: str = "lang", label: str = "quality") -> tuple[DataFrame, DataFrame]:
    """Each stratum's paths of cutoffs and its certified level, as stored tables.

    counted: a stored table with COUNTS, HASH, key and stratum. labels: key and label (1 good, 0 bad).
    """
    own = labels.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_label")).where("_label in (0, 1) and _key is not null")
    first = F.pmod(F.xxhash64(F.lit(7), F.col(HASH)), F.lit(2)) == 0
    labelled = stored(ruled(counted).where(~F.col("base_failed")).join(own, F.col(key) == F.col("_key")).withColumn("_first", first).select(stratum, "_label", "_first", *rules_names()), "labelled")
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("rule"), F.col(r).alias("value")) for i, r in enumerate(rules_names())]))
    values = labelled.where("_first").select(stratum, "_label", pairs.alias("x")).select(stratum, "_label", "x.rule", "x.value")
    paths = stored(paths_of(values, stratum), "paths")
    seen = leveled(labelled, paths, stratum).groupBy(stratum, "_first", "_label", "level").agg(F.count(F.lit(1)).alias("n"))
    strata = stored(seen.groupBy(stratum).agg(F.collect_list(F.struct("_first", "_label", "level", "n")).alias("seen")), "levels")
    total = strata.count()

    def certify(batches):
        for batch in batches:
            cut = [choose([(r["_first"], r["_label"], r["level"], r["n"]) for r in seen], total) for seen in batch.column("seen").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(stratum), pa.array(cut, pa.int32())], names=["_of", "cut_level"])

    return paths, stored(strata.mapInArrow(certify, f"_of {counted.schema[stratum].dataType.simpleString()}, cut_level int").where("cut_level is not null"), "cuts")


def judged(counted: DataFrame, learnt: tuple[DataFrame, DataFrame], stratum: str = "lang") -> DataFrame:
    """counted with base_failed, level, cut_level and kept."""
    paths, cuts = learnt
    found = leveled(ruled(counted), paths, stratum).join(cuts, F.col(stratum).eqNullSafe(F.col("_of")), "left").drop("_of", *rules_names())
    return found.withColumn("kept", ~F.col("base_failed") & (F.col("cut_level").isNull() | (F.col("level") > F.col("cut_level"))))


def choose(seen: list[tuple], strata: int) -> int | None:
    """The certified level of a stratum, from counts by (first half, label, level); None if there is none."""
    count = np.zeros((2, 2, LEVELS + 1), dtype=np.int64)
    for first, label, level, n in seen:
        count[int(first), label, level] += n
    good, bad = count[0, 1], count[1, 0]
    certified = -1
    for k in range(LEVELS):
        if upper_bound(int(good[: k + 1].sum()), int(good.sum()), ERROR / strata) > ALLOWED:
            break
        certified = k
    if certified < 0:
        return None
    gain = np.cumsum(bad)
    return int(np.argmax(gain >= NEARLY * gain[certified]))


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, COUNTS, base_failed, level, cut_level, kept of every document."""
    counted = stored(with_counts(docs, "doc_id", "lang"), "counts")
    return judged(counted, learn(counted, labels)).drop("lang", HASH)


def kept_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are kept, with docs' columns.

    Cutoffs come from a first look at the texts; a second one applies them, so texts are read
    twice and never shuffled.
    """
    learnt = learn(stored(with_counts(docs, "doc_id", "lang"), "counts"), labels)
    own = {c: f"_c{i}" for i, c in enumerate(docs.columns)}  # docs may have columns of the same names as counts
    renamed = docs.toDF(*own.values())
    return judged(with_counts(renamed, *own.values(), text=own["text"]), learnt, own["lang"]).where("kept").select(*[F.col(v).alias(c) for c, v in own.items()])
