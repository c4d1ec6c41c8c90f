"""Registered queries, the pipeline, and the library without this subpackage."""

import os
import shutil
import subprocess
import sys

import pytest

import corpus_pipeline
from tessera.llm.queries import ORACLES, QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"
sys.path.insert(0, os.path.join(ROOT, "tools"))


def test_names():
    import __spark_entry__ as e

    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(e.queries()) and set(ORACLES) <= set(e.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    want = con.execute(ORACLES[name])
    cols = sorted(df.columns)
    names = [d[0] for d in want.description]
    rows = sorted(repr(tuple(r[names.index(c)] for c in cols)) for r in want.fetchall())
    assert sorted(repr(tuple(r[c] for c in cols)) for r in df.select(*cols).collect()) == rows and rows


def test_pipeline_stages(spark, odd, none):
    from tessera.llm.decontam import ItemIndex
    from tessera.llm.simhash import fingerprint
    from .test_simhash import groups
    from .test_tokens import check_packing

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    scores = {n: {r["doc_id"]: r["score"] for r in QUERIES[n](spark, SF).collect()} for n in ("op1_quality_rules", "op8_toxicity")}
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = {d for d in text if scores["op8_toxicity"][d] < 0.5}
    out = stages["toxicity"](spark, docs, SF)
    assert out.columns == docs.columns and {r["doc_id"] for r in out.collect()} == kept
    kept = {d for d in text if scores["op1_quality_rules"][d] >= 0.3}
    out = stages["quality"](spark, docs, SF)
    assert out.columns == docs.columns and {r["doc_id"] for r in out.collect()} == kept
    kept = {c for *_, c in groups([(d, fingerprint(t)) for d, t in text.items()], 2)}
    out = stages["simhash"](spark, docs, SF)
    assert out.columns == docs.columns and {r["doc_id"] for r in out.collect()} == kept
    index = ItemIndex([(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()])
    kept = {d for d, t in text.items() if not index.hits(t)}
    out = stages["decontamination"](spark, docs, SF)
    assert out.columns == docs.columns and {r["doc_id"] for r in out.collect()} == kept
    check_packing(stages["packing"](spark, docs, SF).collect(), list(text.items()))
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF).collect() == []
        result = stage(spark, odd, SF)
        assert result.collect() and (name == "packing" or result.columns == odd.columns)


def test_pipeline_runs(spark):
    from .test_tokens import check_packing

    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = corpus_pipeline.run(spark, SF).collect()
    left = {r["doc_id"] for r in out}
    assert 0 < len(left) < len(docs)
    check_packing(out, [(d, docs[d]) for d in left])


def test_library_without_the_subpackage(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=lambda d, names: {n for n in names if n in (".git", "llm", "corpus_pipeline.py", "__pycache__", "spark-warehouse")})
    code = "import __spark_entry__ as e; q = e.queries(); assert 'pipeline' not in q and not any(x.startswith('op1') for x in q); e.oracle_sql(); print(len(q))"
    env = {**os.environ, "PYTHONPATH": str(copy)}
    got = subprocess.run([sys.executable, "-c", code], cwd=copy, env=env, capture_output=True, text=True)
    assert got.returncode == 0, got.stderr
