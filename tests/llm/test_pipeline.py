import re
import shutil
import subprocess
import sys
from pathlib import Path

import corpus_pipeline

from poiloom.llm import queries as Q
from poiloom.llm import common
from poiloom.llm.mixing import targets

ROOT = Path(__file__).resolve().parents[2]


def test_stages(spark, docs, tmp_path):
    """Each stage works on all its predecessor kept, and its decisions take effect."""
    own = docs.select("doc_id", "text", "lang", "source", "n_chars")
    own.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, 1)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    seen, current = [], spark.read.parquet(f"{tmp_path}/documents.parquet")
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, current, str(tmp_path)).write.parquet(f"{tmp_path}/{i}")
        current = spark.read.parquet(f"{tmp_path}/{i}")
        seen.append(current.collect())
        if i < 4:
            assert current.columns == own.columns
    quality, unique, clean, mixed, packed = seen
    texts = {r.doc_id: r.text or "" for r in own.collect()}
    assert all(len(r.text.encode().split()) >= 10 for r in quality) and len(quality) < len(texts)
    assert len({r.text for r in unique}) == len(unique) < len(quality)
    assert [r.doc_id for r in sorted(clean)] == [r.doc_id for r in sorted(unique)]
    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in clean}
    total: dict = {}
    for r in clean:
        total[r.source] = total.get(r.source, 0) + size[r.doc_id]
    for r in targets(spark.createDataFrame([(*x, 1) for x in total.items()], "name string, source_size long, rows long")).collect():
        got = sum(size[x.doc_id] for x in mixed if x.source == r["name"])
        assert abs(got - r.target) <= 3 * max(size[x.doc_id] for x in clean if x.source == r["name"])
    assert sum(r.piece == 0 for r in packed) == len(mixed)
    again = corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "piece", "start", "length", "ids_crc32").collect()
    assert sorted(map(tuple, again)) == sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed)


def test_queries_are_there():
    assert sorted(int(re.match(r"op(\d+)_", k)[1]) for k in Q.queries()) == list(range(1, 11))
    assert set(Q.oracle_sql()) <= set(Q.queries())


def test_odd_rows(spark, rows, tmp_path):
    """Null ids, repeated rows, equal ids, null texts and a long text through all stages; then an empty table. Stages' own tables go."""
    long = " ".join(f"w{i}" for i in range(100_000))
    odd = [(None, "a text without any id that has more than ten words in it", "en", "a", 3), (None, None, None, None, None), (5000, long, "en", "b", len(long))]
    odd += [(5001, "one of two rows that are equal throughout, which count as one document", "de", "a", 1)] * 2
    odd += [(5002, f"rows of equal ids with other texts: this is number {i} of them, and more words {i}{i}", "de", None, 1) for i in range(2)]
    own = [r for r in rows if r[0] < 140] + odd
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for n, part in enumerate((own, [])):
        folder = f"{tmp_path}/{n}"
        spark.createDataFrame(part, schema).repartition(2).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(0, 1), (None, 1), (7, 0)], "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
        mark = common.table_mark()
        got = corpus_pipeline.run(spark, folder).collect()
        left = [p for p in common._written[mark:] if Path(p).exists()]
        assert len([p for p in left if "source-mixing" in p]) == 1 and not any(x in p for p in left for x in ("near-duplicates", "signatures", "secrets", "counts"))
    assert got == []
    current = spark.createDataFrame(own, schema)
    for _, stage in corpus_pipeline.STAGES[:2]:
        current = spark.createDataFrame(stage(spark, current, f"{tmp_path}/0").collect(), schema)
    kept = [(r.doc_id, r.text) for r in current.collect()]
    assert sorted(r[1] for r in kept if r[0] in (None, 5001, 5002)) == sorted({r[1] for r in odd if r[1] and r[0] != 5000})
    assert (5000, long) in kept


def test_the_rest_does_without(tmp_path):
    """As after the deletion of the two folders and of corpus_pipeline.py."""
    gone = shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__")
    shutil.copytree(ROOT, f"{tmp_path}/rest", ignore=gone)
    code = "import __spark_entry__ as e; assert e.queries() and e.oracle_sql() and not any(k.startswith('op') or k == 'pipeline' for k in e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=f"{tmp_path}/rest", check=True, timeout=120)
    for p in (ROOT / "poiloom").rglob("*.py"):
        assert "llm" in p.parts or "poiloom.llm" not in p.read_text().replace("``poiloom.llm``", "")
