import os
import subprocess
import sys

import pytest

import corpus_pipeline
from shelfscan.llm import registry
from shelfscan.llm.decontamination import contamination
from shelfscan.llm.quality import quality_measures
from shelfscan.llm.simhash import near_duplicates

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    after = []
    for name, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, SF)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        after.append(docs)
        assert name == corpus_pipeline.STAGES[-1][0] or docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    good, cut, single, clean, coded = after
    assert quality_measures(good).where("not kept").count() == 0
    assert cut.count() == good.count() and cut.where("n_chars != length(text)").count() == 0
    assert near_duplicates(single).where("id != component").count() == 0
    assert contamination(clean, bench).where("n_hit > 0").count() == 0
    assert coded.count() == clean.count() and coded.where("n_tokens != size(ids)").count() == 0
    run = corpus_pipeline.run(spark, SF)
    assert run.count() > 100 and sorted(map(str, run.collect())) == sorted(map(str, coded.select(*run.columns).collect()))


def test_awkward_and_empty_tables(spark, awkward, nothing):
    for docs in (awkward, nothing):
        start = docs
        for name, function in corpus_pipeline.STAGES:
            out = function(spark, docs, SF)
            # each stage on the whole table, then on what is left of it
            rows = function(spark, start, SF).collect() if docs is not start else out.collect()
            assert len(rows) <= start.count() and (start is awkward or rows == [])
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == start.columns
                docs = spark.createDataFrame(out.collect(), out.schema)
        # rejected by the quality rules: null, empty and short texts
        assert not {3, 4, 5, 11, 12} & {r["doc_id"] for r in docs.collect()}


@pytest.mark.parametrize("n", range(1, 11))
def test_one_query_per_operator(n):
    assert len([q for q in registry.queries() if q.startswith(f"op{n}_")]) == 1


def test_workers_find_the_package_from_another_folder(tmp_path):
    script = (
        f"import sys; sys.path.insert(0, {str(os.getcwd())!r})\n"
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "from shelfscan.llm.simhash import fingerprints\n"
        "print(fingerprints(spark.createDataFrame([(1, 'a b c d')], 'doc_id long, text string')).count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=200)
    assert done.stdout.strip() == "1", done.stderr[-2000:]
