import glob
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as contract
from vidguard.catalog import tables as T
from vidguard.catalog.queries import REGISTRY
from vidguard.operators import gold, infer
from vidguard.operators import match as M

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not here")
QUICK = ("silver_ocr", "stratified_split", "snapshot_medians", "grid_match", "top_k_search",
         "metadata_similarity", "reviewed_predictions", "drift_alerts", "roc_auc", "leetspeak",
         "homophones", "candidate_rows")


def test_names_agree():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(REGISTRY) <= set(contract.queries())
    # without SQL: fitted weights, and texts that hashes respell; tested against plain references
    assert set(REGISTRY) - set(contract.oracle_sql()) == {
        "train_layer1", "medium_variants", "model_attributions", "repost_texts"}


@needs_data
@pytest.mark.parametrize("name", QUICK)
def test_query_equals_duckdb(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    df = contract.queries()[name](spark, SF)
    result = con.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    want = sorted(repr([r[columns.index(c)] for c in df.columns]) for r in result.fetchall())
    assert sorted(repr(list(r)) for r in df.collect()) == want


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@needs_data
def test_plans_prune_and_never_pair_everything(spark):
    features = plan_of(T.features(spark, SF))
    assert "CartesianProduct" not in features and "BroadcastNestedLoopJoin" not in features
    labels = plan_of(T.labels(spark, SF))
    assert "ReadSchema: struct<doc_id:bigint>" in labels and "text:string" not in labels
    queue = plan_of(contract.queries()["review_queue_size"](spark, SF))
    assert "ReadSchema: struct<event_type:string>" in queue
    hits = M.match_hits(T.query_vectors(spark, SF), T.seed_vectors(spark, SF),
                        broadcast_bytes=20_000)
    assert "CartesianProduct" not in plan_of(hits)
    assert "BroadcastNestedLoopJoin" not in plan_of(hits)


@needs_data
def test_joins_reuse_the_partitioning_of_the_dedupe(spark):
    """One exchange per feed for de-duplication and none added by the three joins."""
    tables = {n: T.silver_feed(spark, SF, n) for n in T.RAW}
    plan = plan_of(gold.feature_store(**tables))
    assert plan.count("hashpartitioning(video_id") == 4


@needs_data
def test_seed_corpus_is_training_only(spark):
    _, seeds = T.inference_inputs(spark, SF)
    assert seeds.where("split <> 'train' or label <> 1").count() == 0
    assert infer.TEXT_KEY in seeds.columns


@needs_data
def test_workers_get_the_package_wherever_the_driver_runs(tmp_path):
    root = os.path.dirname(os.path.abspath(contract.__file__))
    code = (
        "import importlib.util as u\n"
        f"s = u.spec_from_file_location('__spark_entry__', {root + '/__spark_entry__.py'!r})\n"
        "m = u.module_from_spec(s); s.loader.exec_module(m)\n"
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false')"
        ".config('spark.sql.shuffle.partitions', '2').getOrCreate()\n"
        f"print('rows', m.queries()['grid_match'](spark, {SF!r}).count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, timeout=180,
                         capture_output=True, text=True)
    assert "rows 167" in out.stdout, out.stderr[-2000:]
