"""The pipeline's stages against brute force, and its guard in the entry file."""

import hashlib
import os
import subprocess
import sys
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from holdcast.llm import mixing, quality, simhash
from holdcast.llm.common import stash, table

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "mixing", "tokens"]
    stages = dict(corpus_pipeline.STAGES)
    good = stash(stages["quality"](spark, docs, SF), "test-good")
    scored = quality.op4_quality(docs, table(spark, SF, "labels")).filter("predicted = 1")
    assert {r["doc_id"] for r in good.collect()} == {r["doc_id"] for r in scored.collect()}
    once = stash(stages["exact_dedup"](spark, good, SF), "test-once")
    top = {}
    for r in good.collect():
        top[r["text"]] = max(top.get(r["text"], -1), r["doc_id"])
    assert {r["doc_id"] for r in once.collect()} == set(top.values())
    apart = stash(stages["near_dedup"](spark, once, SF), "test-apart")
    want = {r["component_id"] for r in simhash.op1_simhash(once).collect()}
    assert {r["doc_id"] for r in apart.collect()} == want
    mixed = stash(stages["mixing"](spark, apart, SF), "test-mixed")
    assert good.columns == once.columns == apart.columns == mixed.columns == columns
    words = sum(r["taken"] for r in mixing.op10_mixing(apart).collect())
    assert sum(len(r["text"].split()) for r in mixed.collect()) == words
    last = stages["tokens"](spark, mixed, SF).collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert Counter((r["doc_id"], r["decoded_sha256"]) for r in last) == Counter(
        (r["doc_id"], sha(r["text"])) for r in mixed.collect())
    assert Counter(corpus_pipeline.run(spark, SF).collect()) == Counter(last)


def test_entry_works_without_these_operators():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = ("import sys; sys.modules['holdcast.llm'] = None; sys.modules['corpus_pipeline'] = None; "
            "import __spark_entry__ as e; assert 'holding_report' in e.queries() and 'op1_simhash' not in e.queries(); "
            "assert set(e.queries()) == set(e.oracle_sql())")
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)


def test_stages_take_columns_of_any_name(spark):
    docs = table(spark, SF, "documents")
    names = ["__file", "__position", "_metadata", "__kept_file", "__at_file", "__size", "file", "position", "row", "size",
             "words", "pieces", "partly", "taken", "id", "digest", "a.b"]
    odd = docs
    for i, name in enumerate(names):
        odd = odd.withColumn(name, F.concat(F.lit(f"{i}:"), F.col("doc_id").cast("string")))
    odd = stash(odd.withColumn("n_chars", F.lit("many")), "test-odd")
    stages = dict(corpus_pipeline.STAGES)
    plain = docs
    for stage in ("quality", "exact_dedup", "near_dedup", "mixing"):
        odd, plain = stash(stages[stage](spark, odd, SF), "test-odd"), stash(stages[stage](spark, plain, SF), "test-plain")
        assert odd.columns == [*docs.columns, *names]
        got = odd.collect()
        assert Counter((r["doc_id"], r["text"]) for r in got) == Counter((r["doc_id"], r["text"]) for r in plain.collect())
        assert all(r[name] == f"{i}:{r['doc_id']}" for r in got for i, name in enumerate(names))
    assert stages["tokens"](spark, odd, SF).count() == odd.count()
