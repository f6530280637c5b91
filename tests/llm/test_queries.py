"""The registered queries and the pipeline on the driver's smallest tables."""

import os
import re
import sys
from collections import Counter, defaultdict

import pytest

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SMALL), reason="driver tables missing")


def test_names_and_sql():
    import __spark_entry__ as E
    q, sql = E.queries(), E.oracle_sql()
    for n in range(1, 14):
        assert sum(k.startswith(f"op{n}_") for k in q) == 1
    assert "pipeline" in q and set(sql) <= set(q)


def test_sql_twins(spark):
    sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))
    from check_oracles import compare
    from leadflow.llm.oracles import ORACLES
    assert {v[0] for v in compare(spark, SMALL, list(ORACLES), verbose=False).values()} == {"OK"}


def test_pipeline_stages(spark):
    """Each stage against its rule, on what the stage before it kept."""
    import corpus_pipeline as P
    from leadflow.llm.mixing import mix
    assert [n for n, _ in P.STAGES] == ["quality_rules", "exact_dedup", "ngram_join", "mixing", "packing"]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = [docs]
    for _, stage in P.STAGES[:4]:
        out = stage(spark, kept[-1], SMALL)
        assert out.columns == docs.columns
        kept.append(spark.createDataFrame(out.collect(), docs.schema))
    texts = [{r.doc_id: r.text or "" for r in d.collect()} for d in kept]
    from tests_llm_helpers import brute_quality_kept, near_duplicate_classes
    assert set(texts[1]) == {i for i, t in texts[0].items() if brute_quality_kept(t)}
    same = defaultdict(list)
    for i, t in texts[1].items():
        same[re.sub(r"[\x20\x09-\x0D]", "", t)].append((-len(t), i))
    assert set(texts[2]) == {min(g)[1] for g in same.values()}
    assert set(texts[3]) == {min(c) for c in near_duplicate_classes(texts[2], 5, 80)}
    want = {r.doc_id: r.copies for r in mix(kept[3]).collect()}
    assert Counter(r.doc_id for r in kept[4].collect()) == +Counter(want)
    pieces = P.STAGES[4][1](spark, kept[4], SMALL).collect()
    total = Counter()
    for r in pieces:
        total[r.doc_id] += r.length
    tokens = {r.doc_id: r.doc_tokens for r in pieces}
    assert total == Counter({i: tokens[i] * n for i, n in want.items() if n})
