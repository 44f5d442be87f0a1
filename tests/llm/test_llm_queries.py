"""The registered queries and the pipeline on the smallest tables."""

import os
import re
import zlib

import pandas as pd
import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(frame):
    text = lambda x: "-" if pd.isna(x) else f"{x:.9g}" if isinstance(x, float) else re.sub(r"\.0$", "", str(x))
    return sorted(tuple(map(text, r)) for r in frame[sorted(frame.columns)].astype(object).values.tolist())


def test_sql_agrees(spark, duck):
    from marlstone.llm import queries

    for name, sql in queries.oracle_sql().items():
        got, want = queries.queries()[name](spark, SF).toPandas(), duck.execute(sql).df()
        assert plain(got) == plain(want), name


def test_contracts(spark, duck):
    from marlstone.llm import queries

    q = queries.queries()
    assert sorted(int(m[1]) for n in q if (m := re.match(r"op(\d+)_", n))) == list(range(1, 14))
    ids = {i for (i,) in duck.execute("SELECT doc_id FROM documents").fetchall()}
    tox = q["op4_toxicity"](spark, SF).collect()
    assert {r["doc_id"] for r in tox} == ids
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in tox)
    for name in ("op2_pii_surrogates", "op3_ngram_jaccard_join", "op5_secret_scan", "op6_source_mix", "op7_table_sharding", "op10_quality_rules"):
        assert {r["doc_id"] for r in q[name](spark, SF).select("doc_id").collect()} == ids, name


def test_pipeline(spark):
    """Each stage against the operator that it stands for, on its predecessor's rows."""
    import corpus_pipeline

    from marlstone.llm import common, decontaminate, jaccard, mixing, toxicity

    docs = common.table(spark, SF, "documents")
    want = docs.columns
    inputs = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out = common.written(stage(spark, inputs[-1], SF), f"test-{name}")
        assert out.columns[: len(want)] == want and (out.columns == want or name == "table_sharding")
        inputs.append(out)
    ids = [sorted(r["doc_id"] for r in d.select("doc_id").collect()) for d in inputs]
    toxic = {r["doc_id"] for r in toxicity.score(docs, common.table(spark, SF, "labels"), lambda c: ~toxicity.held_out(c)).where("score >= 0.3").collect()}
    assert ids[1] == sorted(set(ids[0]) - toxic)
    assert ids[2] == sorted(r["doc_id"] for r in jaccard.jaccard_join(inputs[1]).where("doc_id = class_id").collect())
    leaked = {r["doc_id"] for r in decontaminate.leaks(inputs[2], common.table(spark, SF, "benchmark")).collect()}
    assert ids[3] == sorted(set(ids[2]) - leaked)
    assert ids[4] == sorted(r["doc_id"] for r in mixing.mix(inputs[3]).collect() for _ in range(r["times"]))
    assert ids[5] == ids[4] == sorted(r["doc_id"] for r in corpus_pipeline.run(spark, SF).collect())


def test_pipeline_edges(spark):
    """Null and repeated ids, null, empty and long texts, clashing columns and empty tables pass every stage."""
    import corpus_pipeline
    from test_text_operators import COLUMNS, EDGE, docs, sentences

    rows = [*EDGE, *((None, sentences(1, 30), "s") for _ in range(3)), (4, sentences(2, 30), "s"), (6, sentences(2, 30) + " ", "s"), (7, sentences(3, 30), None), (7, sentences(4, 30), "t")]
    texts = {" ".join((t or "").split()) for _, t, _ in rows}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs(spark, rows), SF)
        assert out.columns[: len(COLUMNS)] == COLUMNS or name == "table_sharding", name
        left = [" ".join((r["text"] or "").split()) for r in out.collect()]
        if name == "ngram_jaccard_join":  # one of each, and every text without words
            assert sorted(x for x in left if x) == sorted(texts - {""}) and left.count("") == 3
        elif name != "source_mix":
            assert len(left) == len(rows) and {*left} == texts, name
        assert stage(spark, docs(spark, []).limit(0), SF).count() == 0
