"""A query for each operator over places made from documents, and the SQL that gives the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poiloom.functions import text as T
from poiloom.functions.fuzzy import token_set_score
from poiloom.functions.geo import haversine
from poiloom.functions.hours import DAYS, night_only, weekly_hours
from poiloom.operators import dedup as D
from poiloom.operators import steps as S
from poiloom.operators.spatial import radius_pairs
from poiloom.plans.audit import percentage, tracked
from poiloom.plans.run import clean
from poiloom.sources.packs import GLOBAL_KEYWORDS

#: Patterns, keywords and protecting words that some of the places' names have; keywords with a point count as patterns.
CHAINS = (r"\bretion\b", r"\banat\b", r"\bel\s?le\b", r"\beau[rx]e")
KEYWORDS = ("Eauou", "ouch", "thinor", "dans.", "rele", "anlere", "aux la", "Erin.")
KEEP = ("Leque", "reresh", "oivieau")
BAD_WORDS = ("tionaux", "outionvi", "reanon ", "anatre")
TRACKED = ("ouch", "el le", "retion")

_HOURS = ((11, 6, 16, 14), (7, 8, 5, 12), (5, 18, 6, 23), (13, 9, 3, 17), (3, 10, 12, 20), (17, 19, 4, 1), (2, 21, 3, 2))


def _hours_sql(row: str, day: str, closed: int, start: int, span: int, end: int) -> str:
    opens = f"lpad(CAST({start} + {row} % {span} AS STRING), 2, '0')"
    closes = f"lpad(CAST(({end} + {row} % {span}) % 24 AS STRING), 2, '0')"
    return f"CASE WHEN {row} % {closed} = 0 THEN 'Not available' ELSE concat({opens}, ':00-', {closes}, ':30') END AS {day}_hours"


def _places_sql(table: str, row: str, name: str, x: str, y: str) -> str:
    """Places from the rows of a table: every 2000 are a town of a square kilometre, in which they stand by x (0 to 29) and y (0 to 30)."""
    town = f"CAST(floor({row} / 2000) AS BIGINT)"
    return f"""SELECT {row} AS row_id, CAST({row} AS STRING) AS dataplor_id, {name} AS name,
  CAST(CASE WHEN {row} % 41 = 0 THEN NULL ELSE 19.4 + {x} * 0.0003 + ({row} % 3) * 0.00005 + ({town} % 900) * 0.02 END AS DOUBLE) AS latitude,
  CAST(CASE WHEN {row} % 41 = 0 THEN NULL ELSE -99.1 + {y} * 0.0003 + CAST(floor({row} / 1800000) AS BIGINT) * 0.02 END AS DOUBLE) AS longitude,
  CASE WHEN {row} % 13 = 0 THEN NULL ELSE concat('P', CAST({town} AS STRING), '-', CAST(CAST(floor({x} / 6) AS BIGINT) AS STRING), '-', CAST(CAST(floor({y} / 6) AS BIGINT) AS STRING)) END AS parent_location,
  CASE WHEN {row} % 17 = 0 THEN 'True' WHEN {row} % 19 = 0 THEN 'true' WHEN {row} % 23 = 0 THEN 'False' END AS identified_as_chain,
  {", ".join(_hours_sql(row, d, *h) for d, h in zip(DAYS, _HOURS, strict=True))}
FROM {table}"""


#: A place for each document, its name the whole text; texts of some lengths stand together.
PLACES = _places_sql("documents", "doc_id", "text", "(length(text) % 30)", "((length(text) * 13) % 31)")
#: A shop for each part, with names of the usual length: for what compares names letter by letter.
SHOPS = _places_sql("part", "p_partkey", "concat_ws(' ', p_name, p_brand, p_type)", "((p_partkey * 7) % 30)", "((p_partkey * 13 + CAST(floor(p_partkey / 30) AS BIGINT) * 5) % 31)")
SHOP_CHAINS = (r"\bhot\s?rod\b", r"\bbrand#7\b")
SHOP_KEYWORDS = ("Gizmo Brand#1", "old ring", "Widget.*")
SHOP_KEEP = ("economy",)

_NORMAL = "regexp_replace(upper(strip_accents(replace(name, 'ß', 'ss'))), '^\\s+|\\s+$', '', 'g')"
_WITH = f"WITH places AS ({PLACES}), named AS (SELECT *, {_NORMAL} AS name_normalized FROM places)"
_EDGE = r"[^\p{L}\p{M}\p{N}_]"


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _bounded(pattern: str) -> str:
    """A pattern with \\b at its ends, for an engine whose \\b knows ASCII only."""
    if pattern.startswith(r"\b"):
        pattern = f"(?:^|{_EDGE})" + pattern[2:]
    if pattern.endswith(r"\b"):
        pattern = pattern[:-2] + f"(?:$|{_EDGE})"
    return pattern


_CHAIN_SQL = f"regexp_matches(lower(name_normalized), {_quoted('|'.join(f'(?:{_bounded(p)})' for p in CHAINS))})"
_FLAG_SQL = "coalesce(lower(identified_as_chain), '') = 'true'"
# the places' names transliterate by their accents alone
_LOW = "regexp_replace(strip_accents(replace(lower(name), 'ß', 'ss')), '^\\s+|\\s+$', '', 'g')"
_GLOBAL_SQL, _KEYWORD_SQL = ("(" + " OR ".join(f"contains({_LOW}, {_quoted(k)})" for k in words) + ")" for words in (GLOBAL_KEYWORDS, (*GLOBAL_KEYWORDS, *BAD_WORDS)))


def _clock_sql(x: str) -> str:
    return f"(CAST(substr({x}, 1, 2) AS DOUBLE) + CAST(substr({x}, 4, 2) AS DOUBLE) / 60.0)"


def _day_sql(d: str) -> tuple[str, str]:
    h = f"{d}_hours"
    o, c = _clock_sql(f"substr({h}, 1, 5)"), _clock_sql(f"substr({h}, 7, 5)")
    known = f"{h} <> 'Not available' AND {h} <> '00:00-00:00'"
    length = f"CASE WHEN {c} < {o} THEN 24.0 - {o} + {c} ELSE {c} - {o} END"
    return f"CASE WHEN {known} AND {length} > 0 THEN {length} END", f"CASE WHEN {known} THEN {o} END"


_DAYS_SQL = [_day_sql(d) for d in DAYS]
_TOTAL_SQL = f"CASE WHEN coalesce({', '.join(a for a, _ in _DAYS_SQL)}) IS NOT NULL THEN {' + '.join(f'coalesce({a}, 0.0)' for a, _ in _DAYS_SQL)} END"
_FIRST_SQL = f"least({', '.join(b for _, b in _DAYS_SQL)})"
_HOURS_SQL = f"hours AS (SELECT row_id, round({_TOTAL_SQL}, 6) AS weekly_hours, {_FIRST_SQL} >= 19 AS night_only FROM places)"


def _distance_sql(a1: str, o1: str, a2: str, o2: str) -> str:
    s = f"pow(sin((radians({a1}) - radians({a2})) / 2), 2) + cos(radians({a1})) * cos(radians({a2})) * pow(sin((radians({o1}) - radians({o2})) / 2), 2)"
    return f"CASE WHEN {a1} IS NOT NULL AND {a2} IS NOT NULL THEN 2.0 * 6371000.0 * asin(sqrt(least(greatest({s}, 0.0), 1.0))) END"


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return spark.sql(PLACES.replace("FROM documents", "FROM {documents}"), documents=docs)


def shops(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_name", "p_brand", "p_type")
    return spark.sql(SHOPS.replace("FROM part", "FROM {part}"), part=parts)


def named(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.normalize_names(places(spark, sf_dir))


def normalize_names(spark, sf_dir):
    return named(spark, sf_dir).select("row_id", "name_normalized")


def exact_duplicates(spark, sf_dir):
    """The first step with its own key; equal names of copies are moved to one place."""
    p = places(spark, sf_dir).withColumns({"latitude": F.round("latitude", 3), "longitude": F.round("longitude", 3)})
    return S.normalize_and_dedup(p).rows.select("row_id", F.coalesce("drop_reason", F.lit("kept")).alias("drop_reason"))


def dedup_keep_any(spark, sf_dir):
    """Which row of a key stays is open, so only the keys are told."""
    return D.deduplicate(named(spark, sf_dir), ["name_normalized", "parent_location"], "any").select("name_normalized", "parent_location")


def strict_source_flag(spark, sf_dir):
    return S.remove_chains(named(spark, sf_dir), [r"\bqqqq\b"], strict_flag=True).dropped.select("row_id", "drop_reason")


def geo_cluster_dedup(spark, sf_dir):
    return S.geo_dedup(places(spark, sf_dir), 50, scope="cluster").kept.select("row_id", "name")


def _dedup(keep: str) -> Callable:
    def query(spark, sf_dir):
        return D.deduplicate(named(spark, sf_dir), ["name_normalized", "parent_location"], keep).select("row_id", "name_normalized", "parent_location")

    return query


def chain_regex_filter(spark, sf_dir):
    return S.remove_chains(named(spark, sf_dir).drop("identified_as_chain"), CHAINS).kept.select("row_id", "name_normalized")


def name_frequency_filter(spark, sf_dir):
    return S.remove_chains(named(spark, sf_dir).drop("identified_as_chain"), [r"\bqqqq\b"], filter_duplicates=True, max_appearances=2).kept.select("row_id", "name_normalized")


def source_flag_filter(spark, sf_dir):
    return places(spark, sf_dir).where(~S.source_flag(places(spark, sf_dir))).select("row_id", "identified_as_chain")


def drop_reason_cascade(spark, sf_dir):
    rows = S.remove_chains(named(spark, sf_dir), CHAINS, filter_duplicates=True, max_appearances=2).rows
    return rows.groupBy(F.coalesce("drop_reason", F.lit("kept")).alias("drop_reason")).agg(F.count(F.lit(1)).alias("records"))


def global_keyword_filter(spark, sf_dir):
    return places(spark, sf_dir).where(~S.global_keyword(keywords=(*GLOBAL_KEYWORDS, *BAD_WORDS))).select("row_id", "name")


def _days():
    return [F.col(f"{d}_hours") for d in DAYS]


def weekly_hours_query(spark, sf_dir):
    return places(spark, sf_dir).select("row_id", F.round(weekly_hours(_days()), 6).alias("weekly_hours"))


def night_only_query(spark, sf_dir):
    return places(spark, sf_dir).select("row_id", night_only(_days(), 19).alias("night_only"))


def hours_filter(spark, sf_dir):
    return places(spark, sf_dir).where(~S.hours_failed(45)).select("row_id")


def haversine_to_centroid(spark, sf_dir):
    p = places(spark, sf_dir).where("parent_location is not null")
    centres = p.groupBy("parent_location").agg(F.avg("latitude").alias("lat"), F.avg("longitude").alias("lon"))
    d = haversine(F.col("latitude"), F.col("longitude"), F.col("lat"), F.col("lon"))
    return p.join(centres, "parent_location").select("row_id", F.round(d, 3).alias("metres"))


def crowded_property(spark, sf_dir):
    return S.crowded_property(places(spark, sf_dir)).kept.select("row_id", "parent_location")


def radius_pairs_query(spark, sf_dir):
    p = places(spark, sf_dir).where("latitude is not null")
    return radius_pairs(p, 40.0).select("i", "j", F.round("distance", 3).alias("metres"))


def geo_name_dedup(spark, sf_dir):
    return S.geo_dedup(places(spark, sf_dir), 50).kept.select("row_id", "name")


def keep_word_mask(spark, sf_dir):
    return places(spark, sf_dir).select("row_id", T.matches(F.col("name"), T.FLAGS + "|".join(map(T.re.escape, KEEP))).alias("keep_word"))


def detect_keyword(spark, sf_dir):
    return places(spark, sf_dir).select("row_id", T.first_keyword(F.col("name"), KEYWORDS).alias("keyword"))


def final_keyword_exclusion(spark, sf_dir):
    return S.final_keywords(places(spark, sf_dir), KEYWORDS, KEEP).dropped.select("row_id", "drop_reason")


def _before_after(spark, sf_dir):
    before = named(spark, sf_dir)
    return before, S.remove_chains(before.drop("identified_as_chain"), CHAINS).kept


def exact_dropped_rows(spark, sf_dir):
    return D.exact_drops(*_before_after(spark, sf_dir)).select("row_id")


def legacy_dropped_rows(spark, sf_dir):
    return D.legacy_drops(*_before_after(spark, sf_dir)).select("row_id")


def step_top5_dropped(spark, sf_dir):
    before, after = _before_after(spark, sf_dir)
    return D.top_dropped(D.report_drops(before, after))


def tracked_item_audit(spark, sf_dir):
    rows = S.remove_chains(named(spark, sf_dir), CHAINS).rows
    return tracked(rows, list(TRACKED), "name_normalized").withColumn("drop_reason", F.coalesce("drop_reason", F.lit("kept")))


def step_metrics(spark, sf_dir):
    before, after = _before_after(spark, sf_dir)
    n = before.agg(F.count(F.lit(1)).alias("before"))
    m = after.agg(F.count(F.lit(1)).alias("after"))
    both = n.withColumn("k", F.lit(1)).join(m.withColumn("k", F.lit(1)), "k")
    share = F.when(F.col("before") > 0, (F.col("before") - F.col("after")) / F.col("before") * 100).otherwise(F.lit(percentage(0, 0)))
    return both.select((F.col("before") - F.col("after")).alias("dropped_count"), F.col("after").alias("remaining_count"), F.round(share, 2).alias("percent"))


def token_set_similarity(spark, sf_dir):
    p = shops(spark, sf_dir).where("latitude is not null").withColumn("n", T.keyword_name(F.col("name")))
    return radius_pairs(p, 40.0, carry=("n",)).select("i", "j", F.round(token_set_score("n_i", "n_j"), 4).alias("score"))


def fuzzy_spatial_dedup(spark, sf_dir):
    return S.hours_and_fuzzy(shops(spark, sf_dir)).rows.select("row_id", F.coalesce("drop_reason", F.lit("kept")).alias("drop_reason"))


def csv_round_trip(spark, sf_dir):
    from poiloom.sources.io import read_csv, write_csv
    from poiloom.sources.tables import shared_dir

    out = write_csv(places(spark, sf_dir).select("row_id", F.col("row_id").alias("place"), "name", "latitude", "longitude", "monday_hours"), f"{shared_dir(spark)}/poiloom/places-{uuid.uuid4().hex}.csv")
    back = read_csv(spark, out)
    return back.select(F.col("place").cast("long").alias("place"), "name", F.round("latitude", 6).alias("latitude"), F.round("longitude", 6).alias("longitude"), "monday_hours")


def full_pipeline(spark, sf_dir):
    return clean(shops(spark, sf_dir), SHOP_CHAINS, SHOP_KEYWORDS).select("row_id", "name", "name_normalized", "latitude", "longitude", "parent_location")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        normalize_names, chain_regex_filter, name_frequency_filter, source_flag_filter, drop_reason_cascade, global_keyword_filter, hours_filter, haversine_to_centroid, crowded_property, geo_name_dedup,
        keep_word_mask, detect_keyword, final_keyword_exclusion, exact_dropped_rows, legacy_dropped_rows, step_top5_dropped, tracked_item_audit, step_metrics, token_set_similarity, fuzzy_spatial_dedup,
        csv_round_trip, full_pipeline, exact_duplicates, dedup_keep_any, strict_source_flag, geo_cluster_dedup,
    )
    named_ = {"weekly_hours": weekly_hours_query, "night_only": night_only_query, "radius_pairs": radius_pairs_query}
    return {f.__name__: f for f in own} | named_ | {f"dedup_keep_{k}": _dedup(k) for k in ("first", "last", "none")}


_SHOPS_WITH = f"WITH RECURSIVE places AS ({SHOPS}), low AS (SELECT *, {_LOW} AS n FROM places)"
# the longest common subsequence, a row of lengths for each letter of b; then words in common and apart
_LCS = """list_reduce([list_transform(range(0, length(a) + 1), lambda x: 0)] || list_transform(str_split(b, ''), lambda c: [ord(c)]),
  lambda last, c: list_reduce([[0]] || list_transform(range(1, length(a) + 1), lambda k: [k]),
    lambda row, k: list_append(row, CASE WHEN ord(substr(a, k[1], 1)) = c[1] THEN last[k[1]] + 1 ELSE greatest(row[k[1]], last[k[1] + 1]) END)))[-1]"""
_WORDED = "worded AS (SELECT *, list_sort(list_distinct(list_filter(str_split(n, ' '), lambda w: w <> ''))) AS ws FROM low)"


def _words_sql(words: str, other: str, common: bool) -> str:
    return f"array_to_string(list_filter({words}, lambda w: {'' if common else 'NOT '}list_contains({other}, w)), ' ')"


#: Similarity of the pairs in near (i, j, wa, wb).
_SCORED = f"""scored AS (SELECT i, j, CASE WHEN len(wa) = 0 OR len(wb) = 0 THEN 0.0 WHEN shared > 0 AND (na = 0 OR nb = 0) THEN 100.0
    ELSE greatest(100.0 - 100.0 * (na + nb - 2 * lcs) / (2 * (shared + gap) + na + nb), CASE WHEN shared > 0 THEN 100.0 - 100.0 * (gap + na) / (2 * shared + gap + na) ELSE 0.0 END,
      CASE WHEN shared > 0 THEN 100.0 - 100.0 * (gap + nb) / (2 * shared + gap + nb) ELSE 0.0 END) END AS score
    FROM (SELECT *, length(a) AS na, length(b) AS nb, CASE WHEN shared > 0 THEN 1 ELSE 0 END AS gap, CASE WHEN a = '' OR b = '' THEN 0 ELSE {_LCS} END AS lcs
      FROM (SELECT *, {_words_sql("wa", "wb", False)} AS a, {_words_sql("wb", "wa", False)} AS b, length({_words_sql("wa", "wb", True)}) AS shared FROM near)))"""


def _settled_sql(edges: str) -> str:
    """state: verdict 1 (kept) or -1 (suppressed by a kept earlier row) of every row in edges (i, j), step by step."""
    return f"""state AS (SELECT 0 AS step, row_id, 0 AS verdict FROM (SELECT DISTINCT i AS row_id FROM {edges} UNION SELECT DISTINCT j FROM {edges})
          UNION ALL SELECT step + 1, s.row_id, CASE WHEN s.verdict <> 0 THEN s.verdict
            WHEN EXISTS (SELECT 1 FROM {edges} n JOIN state t ON t.row_id = n.i WHERE n.j = s.row_id AND t.verdict = 1) THEN -1
            WHEN NOT EXISTS (SELECT 1 FROM {edges} n JOIN state t ON t.row_id = n.i WHERE n.j = s.row_id AND t.verdict >= 0) THEN 1 ELSE 0 END
          FROM state s WHERE step < 200 AND EXISTS (SELECT 1 FROM state WHERE verdict = 0))"""


def oracle_sql() -> dict[str, str]:
    over = "OVER (PARTITION BY name_normalized, parent_location"
    columns = "SELECT row_id, name_normalized, parent_location FROM"
    freq = "count(*) OVER (PARTITION BY name_normalized)"
    kept = f"kept AS (SELECT * FROM named WHERE NOT coalesce({_CHAIN_SQL}, false))"
    common = [c for c in ("dataplor_id", "name", "name_normalized", "latitude", "longitude", "parent_location", *(f"{d}_hours" for d in DAYS))]
    same = " AND ".join(f"k.{c} = n.{c}" for c in common)
    reason = f"CASE WHEN {_CHAIN_SQL} THEN '1_Regex_Chain' WHEN times > 2 THEN '2_Too_Many_Duplicates_(>2)' WHEN {_FLAG_SQL} THEN '3_Flagged_As_Chain_In_Source' ELSE 'kept' END"
    audit_reason = f"CASE WHEN {_CHAIN_SQL} THEN '1_Regex_Chain' WHEN {_FLAG_SQL} THEN '3_Flagged_As_Chain_In_Source' ELSE 'kept' END"
    centre = "centres AS (SELECT parent_location, count(latitude) AS n, avg(latitude) AS lat, avg(longitude) AS lon FROM places WHERE parent_location IS NOT NULL GROUP BY 1)"
    metres = _distance_sql("p.latitude", "p.longitude", "c.lat", "c.lon")
    pair = _distance_sql("a.latitude", "a.longitude", "b.latitude", "b.longitude")
    spatial = "trim(regexp_replace(strip_accents(replace(lower(name), 'ß', 'ss')), '\\s+', ' ', 'g'))"
    detect = "CASE " + " ".join(f"WHEN contains(lower(name), {_quoted(k.lower())}) THEN {_quoted(k)}" for k in KEYWORDS) + " END"
    listed = "|".join(f"(?:^|{_EDGE})" + k.lower().replace(" ", r"\s*") for k in KEYWORDS)
    safe = "(" + " OR ".join(f"contains(lower(name), {_quoted(k.lower())})" for k in KEEP) + ")"
    texts = ", ".join(f"({_quoted(t)})" for t in TRACKED)
    return {
        "normalize_names": f"{_WITH} SELECT row_id, name_normalized FROM named",
        "exact_duplicates": f"{_WITH} SELECT row_id, CASE WHEN n > 1 THEN 'Exact_Duplicate' ELSE 'kept' END AS drop_reason FROM (SELECT row_id, row_number() OVER (PARTITION BY name_normalized, round(latitude, 3), round(longitude, 3) ORDER BY row_id) AS n FROM named)",
        "token_set_similarity": f"{_SHOPS_WITH}, {_WORDED}, near AS (SELECT a.row_id AS i, b.row_id AS j, a.ws AS wa, b.ws AS wb FROM worded a JOIN worded b ON a.row_id < b.row_id WHERE {pair} <= 40.0), {_SCORED} "
        "SELECT i, j, round(score, 4) AS score FROM scored",
        "fuzzy_spatial_dedup": f"{_SHOPS_WITH}, {_HOURS_SQL}, judged AS (SELECT p.row_id, CASE WHEN coalesce({_GLOBAL_SQL}, false) THEN '1_Global_Keywords' WHEN coalesce(night_only, false) OR weekly_hours IS NULL OR weekly_hours < 20 THEN '2_Hours_Filter' END AS reason "
        f"FROM places p JOIN hours h ON p.row_id = h.row_id), {_WORDED}, open_ AS (SELECT w.* FROM worded w JOIN judged g ON w.row_id = g.row_id WHERE g.reason IS NULL AND name IS NOT NULL), "
        f"near AS (SELECT a.row_id AS i, b.row_id AS j, a.ws AS wa, b.ws AS wb FROM open_ a JOIN open_ b ON a.row_id < b.row_id WHERE {pair} <= 100.0), {_SCORED}, edges AS MATERIALIZED (SELECT i, j FROM scored WHERE score >= 80), {_settled_sql('edges')} "
        "SELECT row_id, coalesce(reason, CASE WHEN row_id IN (SELECT row_id FROM state WHERE verdict = -1) THEN '3_Fuzzy_Dedup' END, 'kept') AS drop_reason FROM judged",
        "dedup_keep_any": f"{_WITH} SELECT DISTINCT name_normalized, parent_location FROM named",
        "strict_source_flag": f"{_WITH} SELECT row_id, '3_Flagged_As_Chain_In_Source' AS drop_reason FROM places WHERE identified_as_chain = 'True'",
        "geo_cluster_dedup": f"{_WITH}, keyed AS (SELECT *, {spatial} AS k FROM places), near AS MATERIALIZED (SELECT a.row_id AS i, b.row_id AS j FROM keyed a JOIN keyed b ON a.k IS NOT DISTINCT FROM b.k AND a.row_id < b.row_id WHERE {pair} <= 50.0), ".replace("WITH", "WITH RECURSIVE", 1)
        + f"{_settled_sql('near')}, gone AS (SELECT DISTINCT p.dataplor_id FROM state s JOIN places p ON p.row_id = s.row_id WHERE s.verdict = -1) SELECT row_id, name FROM places WHERE dataplor_id NOT IN (SELECT dataplor_id FROM gone)",
        "dedup_keep_first": f"{_WITH} {columns} (SELECT *, row_number() {over} ORDER BY row_id) AS n FROM named) WHERE n = 1",
        "dedup_keep_last": f"{_WITH} {columns} (SELECT *, row_number() {over} ORDER BY row_id DESC) AS n FROM named) WHERE n = 1",
        "dedup_keep_none": f"{_WITH} {columns} (SELECT *, count(*) {over}) AS n FROM named) WHERE n = 1",
        "chain_regex_filter": f"{_WITH}, {kept} SELECT row_id, name_normalized FROM kept",
        "name_frequency_filter": f"{_WITH} SELECT row_id, name_normalized FROM (SELECT *, {freq} AS n FROM named) WHERE name_normalized IS NULL OR n <= 2",
        "source_flag_filter": f"{_WITH} SELECT row_id, identified_as_chain FROM places WHERE NOT {_FLAG_SQL}",
        "drop_reason_cascade": f"{_WITH} SELECT {reason} AS drop_reason, count(*) AS records FROM (SELECT *, {freq} AS times FROM named) GROUP BY 1",
        "global_keyword_filter": f"{_WITH} SELECT row_id, name FROM places WHERE NOT coalesce({_KEYWORD_SQL}, false)",
        "weekly_hours": f"{_WITH}, {_HOURS_SQL} SELECT row_id, weekly_hours FROM hours",
        "night_only": f"{_WITH}, {_HOURS_SQL} SELECT row_id, night_only FROM hours",
        "hours_filter": f"{_WITH}, {_HOURS_SQL} SELECT row_id FROM hours WHERE NOT (coalesce(night_only, false) OR weekly_hours IS NULL OR weekly_hours < 45)",
        "haversine_to_centroid": f"{_WITH}, {centre} SELECT p.row_id, round({metres}, 3) AS metres FROM places p JOIN centres c ON p.parent_location = c.parent_location",
        "crowded_property": f"{_WITH}, {centre}, near AS (SELECT p.*, coalesce(c.n >= 4 AND {metres} <= 100.0, false) AS dense FROM places p LEFT JOIN centres c ON p.parent_location = c.parent_location), "
        "crowd AS (SELECT *, sum(CAST(dense AS INT)) OVER (PARTITION BY parent_location) AS n FROM near) SELECT row_id, parent_location FROM crowd WHERE NOT (dense AND n >= 4)",
        "radius_pairs": f"{_WITH} SELECT a.row_id AS i, b.row_id AS j, round({pair}, 3) AS metres FROM places a JOIN places b ON a.row_id < b.row_id WHERE {pair} <= 40.0",
        "geo_name_dedup": f"{_WITH}, keyed AS (SELECT *, {spatial} AS k FROM places), near AS (SELECT DISTINCT a.row_id, a.k FROM keyed a JOIN keyed b ON a.k IS NOT DISTINCT FROM b.k AND a.row_id <> b.row_id "
        f"WHERE {pair} <= 50.0), gone AS (SELECT row_id FROM (SELECT *, min(row_id) OVER (PARTITION BY k) AS lead FROM near) WHERE row_id > lead) SELECT row_id, name FROM places WHERE row_id NOT IN (SELECT row_id FROM gone)",
        "keep_word_mask": f"{_WITH} SELECT row_id, coalesce({safe}, false) AS keep_word FROM places",
        "detect_keyword": f"{_WITH} SELECT row_id, {detect} AS keyword FROM places",
        "final_keyword_exclusion": f"{_WITH} SELECT row_id, '1_Final_Regex_Keyword_(' || {detect} || ')' AS drop_reason FROM places WHERE {detect} IS NOT NULL AND regexp_matches(lower(name), {_quoted(listed)}) AND NOT {safe}",
        "exact_dropped_rows": f"{_WITH}, {kept} SELECT row_id FROM named WHERE row_id NOT IN (SELECT row_id FROM kept)",
        "legacy_dropped_rows": f"{_WITH}, {kept} SELECT row_id FROM named n WHERE NOT EXISTS (SELECT 1 FROM kept k WHERE {same})",
        "step_top5_dropped": f"{_WITH}, {kept} SELECT name, count(*) AS freq FROM named n WHERE NOT EXISTS (SELECT 1 FROM kept k WHERE k.name = n.name AND k.latitude = n.latitude AND k.longitude = n.longitude) "
        "GROUP BY name ORDER BY freq DESC, name LIMIT 5",
        "tracked_item_audit": f"{_WITH}, texts(text) AS (VALUES {texts}) SELECT text, {audit_reason} AS drop_reason, count(*) AS records FROM named JOIN texts ON contains(lower(name_normalized), text) GROUP BY 1, 2",
        "step_metrics": f"{_WITH}, {kept}, n AS (SELECT (SELECT count(*) FROM named) AS b, (SELECT count(*) FROM kept) AS a) SELECT b - a AS dropped_count, a AS remaining_count, round((b - a) / b * 100, 2) AS percent FROM n",
        "csv_round_trip": f"{_WITH} SELECT row_id AS place, name, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude, monday_hours FROM places",
    }
