import collections
import math
from pathlib import Path

import pytest

from poiloom.operators import steps as S
from poiloom.plans import audit as A
from poiloom.plans import queries as Q
from poiloom.plans.run import run_pipeline
from poiloom.sources import config, io, packs

DATA = "/root/testdata/sf0.001"


def normal(v):
    return repr(round(v, 6) + 0.0) if isinstance(v, float) else repr(v)


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_equals_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "part"):
        con.sql(f"create view {table} as select * from '{DATA}/{table}.parquet'")
    df = Q.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    own = collections.Counter(tuple(map(normal, r)) for r in df.select(*columns).collect())
    sql = con.sql(Q.oracle_sql()[name])
    assert sorted(sql.columns) == columns
    assert own == collections.Counter(tuple(map(normal, r)) for r in sql.select(", ".join(columns)).fetchall())


def test_full_pipeline_is_a_subset(spark):
    all_ids = {r[0] for r in Q.shops(spark, DATA).select("row_id").collect()}
    kept = [r[0] for r in Q.full_pipeline(spark, DATA).select("row_id").collect()]
    assert len(kept) == len(set(kept)) and set(kept) < all_ids and kept


def test_csv(spark, tmp_path):
    df = spark.createDataFrame([(0, 'a "q", b', 1.5, None), (1, "line\nbreak ", None, "NA"), (2, "nan", 2.0, "True")], "row_id long, name string, latitude double, flag string")
    path = io.write_csv(df, f"{tmp_path}/x.csv")
    raw = Path(path).read_bytes()
    assert raw.startswith(io.BOM + b"name,latitude,flag\n")
    back = io.read_csv(spark, path).orderBy("row_id").drop("row_id").collect()
    assert [tuple(r) for r in back] == [('a "q", b', 1.5, None), ("line\nbreak ", None, None), (None, 2.0, "True")]


def test_types_and_folders(spark, tmp_path):
    rows = [(i, f"n{i}", str(i * 3), "1.5" if i % 2 else "NA", "true", "007", None) for i in range(50)]
    df = spark.createDataFrame(rows, "row_id long, name string, a string, b string, c string, d string, e string").repartition(3)
    path = io.write_csv(df, f"{tmp_path}/folder", single=False)
    assert len(list(Path(path).glob("part-*"))) >= 1
    back = io.read_csv(spark, path, infer=True, line_breaks=False)
    assert dict(back.dtypes) == {"name": "string", "a": "bigint", "b": "double", "c": "boolean", "d": "string", "e": "string", "row_id": "bigint"}
    assert sorted((r["name"], r.a, r.b, r.c) for r in back.collect()) == sorted((r[1], int(r[2]), 1.5 if r[3] != "NA" else None, True) for r in rows)
    assert io.inferred(spark.createDataFrame([(1,)], "x long")).dtypes == [("x", "bigint")]


def test_run(spark, tmp_path):
    Path(tmp_path, "packs").mkdir()
    Path(tmp_path, "packs", "patterns_cr.txt").write_text("# chains\n\\bretion\\b\n", encoding="utf-8")
    Path(tmp_path, "packs", "blacklist.py").write_text("OTHER = ['x']\nWORDS = [\n    'Ouch',\n    r'Erin',  # and more\n    'Z Z',\n]\nraise SystemExit\n", encoding="utf-8")
    Path(tmp_path, "config.yaml").write_text("pipeline_settings: {active_country: CR}\npaths: {data_dir: data, raw_data: raw.csv, output_data: out.csv, packs: packs}\n", encoding="utf-8")
    io.write_csv(Q.places(spark, DATA), f"{tmp_path}/raw.csv")
    settings = config.load(f"{tmp_path}/config.yaml")
    assert settings.country == "cr"
    metrics = run_pipeline(spark, settings, modules=(1, 99, 2, 3, 4, 5, 6), items=["retion", "zzzz"], prune=False)
    assert len(metrics) == 6
    for before, after in zip(metrics, metrics[1:], strict=False):
        assert before.remaining_count == after.remaining_count + after.dropped_count
    assert Path(settings.output_data).read_bytes().startswith(io.BOM)
    assert io.read_csv(spark, settings.output_data).count() == metrics[-1].remaining_count
    assert len(list(Path(settings.data_dir, "processed").glob("*.csv"))) == 6
    assert list(Path(settings.data_dir, "dropped").glob("02_*.csv"))
    text = next(Path(settings.data_dir, "audit").glob("*.txt")).read_text(encoding="utf-8")
    assert "DROPPED: [1_Regex_Chain]" in text and "'zzzz': COMPLETELY DROPPED" in text
    assert "Module 6" in next(Path(tmp_path, "reports").glob("*.html")).read_text(encoding="utf-8")


def test_audit_prunes(spark):
    rows = spark.createDataFrame([("Casa Sol", None), ("CASA Luna", "why"), ("Rio", None)], "name string, drop_reason string")
    left, text = A.audit(S.StepResult(rows), ["casa", "rio", "mar"], "step")
    assert left == ["rio", "mar"] and "SURVIVED: passed this filter (1 records)" in text and "[why] (1 records" in text
    assert A.audit(S.StepResult(rows), ["casa"], "step", prune=False)[0] == ["casa"]
    assert A.audit(S.StepResult(rows), ["mar"], "step") == (["mar"], None)
    assert A.percentage(1, 0) == 0.0 and math.isclose(A.percentage(1, 3), 100 / 3)


def test_report_escapes(tmp_path):
    page = A.html_report([A.StepMetrics("a<b", 1, 2, [("<x>", 3)])], f"{tmp_path}/data").read_text(encoding="utf-8")
    assert "<x>" not in page and "&lt;x&gt;" in page and "a<b" not in page


def test_packs(tmp_path):
    assert len(packs.chain_patterns("mx")) == len(packs.MX_CHAINS)
    with pytest.raises(ValueError):
        packs.blacklist(None)
    with pytest.raises(ValueError):
        packs.chain_patterns("cr", str(tmp_path))
    Path(tmp_path, "blacklist.txt").write_text("# a comment\n#NAME?\n\nx y\n", encoding="utf-8")
    assert packs.blacklist(str(tmp_path)) == ["#NAME?", "x y"]


def test_streaming(spark, tmp_path):
    from poiloom.streaming.stateless import clean_rows

    Q.places(spark, DATA).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(spark.read.parquet(f"{tmp_path}/in").schema).parquet(f"{tmp_path}/in")
    q = clean_rows(stream, Q.CHAINS, Q.KEYWORDS).writeStream.format("memory").queryName("cleaned").option("checkpointLocation", f"{tmp_path}/c").start()
    q.processAllAvailable()
    q.stop()
    want = clean_rows(spark.read.parquet(f"{tmp_path}/in"), Q.CHAINS, Q.KEYWORDS).groupBy("drop_reason").count().collect()
    assert sorted(map(str, spark.table("cleaned").groupBy("drop_reason").count().collect())) == sorted(map(str, want))


def test_entry():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())


def test_pairs_are_joined_by_shuffle(spark):
    """However small the files look, the points and their cells aren't sent through the driver."""
    df = Q.token_set_similarity(spark, DATA)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "SortMergeJoin" in plan
    assert df.count() > 0
