"""What scratch writes and text work take in memory and on disk."""

import os
import time

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from demandlake.llm import ngram_join, packing, quality_rules, tables


def test_scratch_writes_send_small_batches_and_restore_settings(spark):
    names = ("spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    first = [spark.conf.get(c) for c in names]

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "b"])

    texts = spark.range(0, 5000, 1, 1).select(F.repeat(F.lit("x"), 4000).alias("text"))  # 20 MB in a task
    got = tables.keep(texts.mapInArrow(sizes, "n long, b long"), "test-batches").agg(F.sum("n"), F.max("b")).first()
    assert got[0] == 5000 and got[1] < 1.5 * tables.BATCH_BYTES
    assert [spark.conf.get(c) for c in names] == first


def test_smaller_batches_that_the_session_asks_for_stay(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    first = spark.conf.get(name)
    spark.conf.set(name, "64k")
    try:
        with tables.frugal(spark):
            assert int(spark.conf.get(name)) == 64 << 10
        assert spark.conf.get(name) == "64k"
    finally:
        spark.conf.set(name, first)


def test_shuffle_files_go_with_a_scratch_write(spark):
    dirs = [d.toString() for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    files = lambda: {f for d in dirs for _, _, names in os.walk(d) for f in names if f.startswith("shuffle_")}
    before = files()
    kept = tables.keep(spark.range(10_000).groupBy((F.col("id") % 7).alias("k")).count(), "test-shuffle")
    until = time.time() + 5
    while files() - before and time.time() < until:
        time.sleep(0.1)
    assert files() <= before
    assert kept.agg(F.sum("count")).first()[0] == 10_000


def test_op1_whole_sets_are_shuffled_once(spark, monkeypatch):
    text = lambda i: " ".join(f"w{i}x{j}" for j in range(12))
    docs = spark.createDataFrame([(i, text(i // 2)) for i in range(40)], "doc_id long, text string")  # each text twice
    plans = []

    def kept(df, name):
        if name == "sets":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return tables.keep(df, name)

    monkeypatch.setattr(ngram_join, "keep", kept)
    most = "spark.sql.autoBroadcastJoinThreshold"
    first = spark.conf.get(most)
    spark.conf.set(most, "-1")  # as with tables too large to send
    try:
        join = ngram_join._Join(docs)
        got = join.sets_of(join.classes).orderBy("cid").collect()
    finally:
        spark.conf.set(most, first)
    assert plans[0].count("Exchange hashpartitioning") == 2  # the sets once, the wanted classes once
    assert [r["cid"] for r in got] == sorted(r["cid"] for r in join.classes.collect()) and len(got) == 20
    assert all(r["n"] == 8 == len(set(r["tokens"])) for r in got)


def _texts(n=400, words=1000):
    rng = np.random.default_rng(3)
    texts = [" ".join(map(str, rng.integers(0, 10**6, words))) + " the same five words end all" for _ in range(n)]
    ids = pa.array(range(n), pa.int64())
    return pa.RecordBatch.from_arrays([ids, pa.array(texts), ids], ["doc_id", "text", "th"])


def test_text_work_is_done_in_small_pieces(monkeypatch):
    batch, seen = _texts(), []
    assert batch.column("text").nbytes > 2 << 20
    for module, name in ((ngram_join, "shingles"), (quality_rules, "count_rules"), (packing.T, "words")):
        f = getattr(module, name)
        monkeypatch.setattr(module, name, lambda data, *a, f=f: (seen.append(len(data)), f(data, *a))[1])
    renamed = batch.rename_columns(["key", "text", "th"])
    for made in (ngram_join._survey([batch]), quality_rules._count_batches([renamed]), packing._measure([batch.rename_columns(["row", "text", "th"])])):
        seen.clear()
        list(made)
        assert seen and max(seen) <= 512 << 10


def test_op1_survey_counts_tokens_over_pieces(monkeypatch):
    batch = _texts()

    def shared():
        got = pa.Table.from_batches(list(ngram_join._survey([batch]))).to_pandas()
        often = got[got["token"].notna()].groupby("token")["n"].sum()
        return got["token"].isna().sum(), sorted(zip(often.index, often, strict=True))

    monkeypatch.setattr(ngram_join, "SURVEY", 64 << 20)
    want = shared()
    assert want[0] == 400 and 400 in [n for _, n in want[1]]
    monkeypatch.setattr(ngram_join, "CHUNK", 20_000)
    assert shared() == want
