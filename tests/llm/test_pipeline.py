"""The pipeline's stages on the smallest tables and on odd documents, and life without the subpackage."""

from __future__ import annotations

import shutil
import subprocess
import sys
from collections import Counter
from pathlib import Path

import pytest
from pyspark.errors import PySparkException

import __spark_entry__
import corpus_pipeline
from checks.compare import connect, spark_rows, sql_rows
from paylake import session
from paylake.llm import catalog, line_templates, ordering, stages, toxicity

ROOT = Path(__file__).resolve().parents[2]
SMALL = "/root/testdata/sf0.001"


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_queries_are_registered():
    names = __spark_entry__.queries().keys()
    assert {f"op{n}" for n in range(1, 14)} <= {name.split("_")[0] for name in names}
    assert "pipeline" in names and set(catalog.SQL) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", catalog.SQL)
def test_queries_equal_their_sql(spark, name):
    names, expected = sql_rows(connect(SMALL), catalog.SQL[name])
    found = catalog.QUERIES[name](spark, SMALL)
    assert sorted(found.columns) == names and spark_rows(found) == expected


def test_stages_do_what_their_operators_decide(spark, small):
    from test_near_duplicates import fingerprint, near_pairs, roots
    from test_search import search
    from test_tokens import encoded

    docs, texts = small
    before = rows(docs)

    clean = stages.toxicity(spark, docs, SMALL)
    verdicts = toxicity.toxicity(spark, docs, spark.read.parquet(f"{SMALL}/labels.parquet")).collect()
    bad = {r["doc_id"] for r in verdicts if r["predicted"]}
    assert rows(clean) == Counter({row: n for row, n in before.items() if row[0] not in bad})

    lines = stages.line_dedup(spark, docs, SMALL)
    found = line_templates.drop_recurring_lines(spark, docs).collect()
    kept = {r["doc_id"]: r["dedup"]["text"] for r in found if r["dedup"]["kept"]}
    assert lines.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in lines.collect()} == kept
    assert all(r["n_chars"] == len(r["text"]) for r in lines.collect() if r["text"] != dict(texts)[r["doc_id"]])

    single = stages.simhash_near_dedup(spark, docs, SMALL)
    linked = roots(len(texts), near_pairs([fingerprint(t) for _, t in texts], 4))
    first = {texts[i][0] for i in range(len(texts)) if linked[i] == i}
    assert rows(single) == Counter({row: n for row, n in before.items() if row[0] in first})

    items = spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()
    hits = search([t for _, t in texts], [tuple(i) for i in items])
    leaked = {texts[i][0] for i, (_, hit, _) in enumerate(hits) if hit}
    assert leaked
    rest = stages.benchmark_decontamination(spark, docs, SMALL)
    assert rows(rest) == Counter({row: n for row, n in before.items() if row[0] not in leaked})

    packed = stages.best_fit_packing(spark, docs, SMALL).collect()
    tokens = Counter()
    for r in packed:
        tokens[r["doc_id"]] += r["length"]
    assert tokens == Counter({i: len(encoded(t, 0)) for i, t in texts})


def test_run_applies_all_stages_in_order(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(
        corpus_pipeline,
        "STAGES",
        [(n, lambda s, d, f, n=n, g=g: seen.append((n, d.count())) or g(s, d, f)) for n, g in corpus_pipeline.STAGES],
    )
    out = corpus_pipeline.run(spark, SMALL)
    assert [n for n, _ in seen] == [
        "toxicity", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "best_fit_packing",
    ]
    counts = [n for _, n in seen]
    assert counts == sorted(counts, reverse=True) and counts[0] == 200
    assert out.select("doc_id").distinct().count() <= counts[-1]


def test_a_run_leaves_its_result_only(spark, monkeypatch):
    made: list[str] = []
    monkeypatch.setattr(session, "_watched", [made])
    there = lambda: {Path(p).name.split("-")[1] for p in made if Path(p).exists()}
    out = corpus_pipeline.run(spark, SMALL)
    assert there() == {"best_fit_packing"} and len(made) > 20 and out.count() > 0
    made.clear()
    broken = lambda *_: out.selectExpr("raise_error('no')")
    monkeypatch.setattr(corpus_pipeline, "STAGES", [*corpus_pipeline.STAGES[:2], ("broken", broken)])
    with pytest.raises(PySparkException):
        corpus_pipeline.run(spark, SMALL)
    assert "line_dedup" in there() and "toxicity" not in there()


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES[:-1]], ids=lambda f: f.__name__)
def test_stages_keep_odd_rows_whole(spark, odd_docs, empty_docs, stage):
    out = stage(spark, odd_docs, SMALL)
    assert out.dtypes == odd_docs.dtypes
    texts = {r["doc_id"]: r["text"] for r in out.collect()}
    assert texts[6] == "x" * 200_000 and texts[9].startswith("Ünïcödé")
    assert stage(spark, empty_docs, SMALL).collect() == []


def test_one_row_of_each_component_stays(spark, docs):
    a, b = "some text that has copies in here", "a wholly different text without any copies at all"
    out = stages.simhash_near_dedup(spark, docs((5, a), (3, a), (3, a), (None, a), (None, b), (None, b)), SMALL)
    assert sorted((r["doc_id"] or 0, r["text"]) for r in out.collect()) == [(0, b), (3, a)]


@pytest.mark.parametrize("broadcast_bytes", [ordering.BROADCAST_BYTES, 0])
def test_near_duplicates_go_with_and_without_a_broadcast(spark, docs, monkeypatch, broadcast_bytes):
    """A text that two thirds of all rows hold, under one id and under many; texts of their own stay."""
    monkeypatch.setattr(ordering, "BROADCAST_BYTES", broadcast_bytes)
    hot = "one text that very many documents of this table have in common with each other"
    own = [f"text number {i} is about {'abcdefghij'[i % 10] * 9} and {i * i} and {i * 7919}" for i in range(60)]
    out = stages.simhash_near_dedup(spark, docs(*[hot] * 60, *own, *[(7, hot)] * 60), SMALL)
    left = Counter(r["text"] for r in out.collect())
    assert left[hot] == 1 and all(n == 1 for n in left.values())
    keys = Counter((r["doc_id"], r["text"]) for r in out.collect())
    assert keys[0, hot] == 1


def test_the_rest_works_without_the_subpackage(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = (
        "import __spark_entry__ as e; q = e.queries(); "
        "assert 'pipeline' not in q and not any(k.startswith('op1') for k in q) and len(q) > 30; e.oracle_sql()"
    )
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, timeout=120)
