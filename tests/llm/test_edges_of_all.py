"""Edges that several operators share: rows repeated under one doc_id, null
ids, clashing extra columns, very long texts and urls, labels given twice, and
rows that are located without a copy."""

import collections
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_operators import SCHEMA, by_id, components_of, corpus, licenses_by_hand, removed_by_hand, shingle_set, spans_by_hand, words

import corpus_pipeline
from demandlake.llm import exact_dedup, license_scan, lm_scoring, mixing, ngram_join, packing, pii, quality_rules, suffix_dedup, tables, url_filter
from demandlake.llm.tables import ship

LONG = 1_000_000


@pytest.fixture(scope="module")
def odd_rows():
    """Rows repeated under their doc_id, and rows without one."""
    rows = corpus(seed=9, n=34)
    nameless = [(None, rows[20][1], "s1", "x", 1, "clash"), (None, None, None, "x", 1, "clash"), (None, "of no one " * 30, "s1", "x", 1, "clash")]
    return rows + rows[3:12] + nameless


@pytest.fixture(scope="module")
def odd(spark, odd_rows):
    ship(spark)
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3).cache()


def counted(df, *columns):
    return collections.Counter(tuple(r[c] for c in ("doc_id", *columns)) for r in df.collect())


# ------------------------------------------- repeated rows and null ids

def test_op1_repeated_rows_and_null_ids(odd, odd_rows):
    sets = [shingle_set(r[1]) for r in odd_rows]
    comp = components_of(dict(enumerate(sets)))
    members = collections.defaultdict(list)
    for i, c in comp.items():
        members[c].append(odd_rows[i][0])
    least = {c: min((m for m in v if m is not None), default=None) for c, v in members.items()}
    # an empty set is linked with nothing: its row is its own component
    want = collections.Counter((r[0], len(sets[i]), least[comp[i]] if sets[i] else r[0]) for i, r in enumerate(odd_rows))
    assert counted(ngram_join.join(odd), "n_shingles", "component_id") == want


def test_op3_and_op5_repeated_rows_and_clashing_columns(odd, odd_rows):
    got = counted(license_scan.scan(odd), "labels", "score")
    assert got == collections.Counter((r[0], *licenses_by_hand(r[1])) for r in odd_rows)
    clash = odd.withColumnsRenamed({"row": "tokens", "n": "base", "digest": "seed", "source": "email"})
    base = [hashlib.sha256(",".join(spans_by_hand(r[1])).encode()).hexdigest() for r in odd_rows]
    assert counted(pii.find(clash), "base_sha256") == collections.Counter((r[0], b) for r, b in zip(odd_rows, base, strict=True))


def test_op4_repeated_rows_and_null_ids(odd, odd_rows):
    named = [r for r in odd_rows if r[0] is not None]
    want = removed_by_hand(list(dict.fromkeys((r[0], r[1] or "") for r in named)))
    rows = collections.Counter((r[0], *want[r[0]]) for r in named)
    for r in odd_rows:  # a row without id loses nothing
        if r[0] is None:
            b = (r[1] or "").encode()
            rows[(None, len(b), 0, 0, hashlib.sha256(b).hexdigest())] += 1
    assert counted(suffix_dedup.dedup(odd), "n_bytes", "n_removed", "n_spans", "kept_sha256") == rows


def test_op6_repeated_rows_and_null_ids(odd, odd_rows):
    got = lm_scoring.score(odd).collect()
    assert collections.Counter(r["doc_id"] for r in got) == collections.Counter(r[0] for r in odd_rows)
    held = {i: __import__("zlib").crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, *_ in odd_rows}
    n = sum(len(words(r[1])) + 1 for r in odd_rows if not held[r[0]])
    assert {r["train_tokens"] for r in got} == {n} and all(r["held_out"] == held[r["doc_id"]] for r in got)


def test_op7_repeated_rows_do_not_change_the_verdict(spark, odd, odd_rows):
    labels = spark.createDataFrame([(r[0], int(len(words(r[1])) > 60), 0, "clash", 1) for r in odd_rows if r[0] is not None], "doc_id long, quality int, toxic int, kept string, n_words long")
    got = quality_rules.quality(odd, labels).collect()
    once = quality_rules.quality(odd.dropDuplicates(["doc_id", "text"]), labels).collect()
    verdict = {(r["doc_id"], r["n_words"]): (r["kept"], round(r["anomaly"], 12)) for r in got}
    assert verdict == {(r["doc_id"], r["n_words"]): (r["kept"], round(r["anomaly"], 12)) for r in once} and len(got) == len(odd_rows)


def test_op8_and_op9_repeated_rows_and_null_ids(odd, odd_rows):
    cover = collections.Counter()
    for r in packing.pack(odd).collect():
        cover.update((r["doc_id"], k) for k in range(r["start_word"], r["start_word"] + r["n_words"]))
    want = collections.Counter()
    for i, t, *_ in odd_rows:
        want.update((i, k) for k in range(len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))))
    assert cover == want
    got = mixing.mix(odd).collect()
    assert collections.Counter((r["doc_id"], r["size"]) for r in got) == collections.Counter((i, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, t, *_ in odd_rows)
    assert all(r["taken"] <= 3 * r["size"] for r in got)


def test_op10_null_ids(odd, odd_rows):
    groups = collections.defaultdict(list)
    for r in odd_rows:
        groups[r[1] or ""].append(r[0])
    want = collections.Counter()
    for i, t, *_ in odd_rows:
        g = groups[t or ""]
        want[(i, max((x for x in g if x is not None), default=None), len(g))] += 1
    assert counted(exact_dedup.exact_dedup(odd), "keep_id", "group_size") == want


def test_stages_after_exact_dedup_take_repeated_rows(spark, odd, odd_rows, tmp_path):
    stages = dict(corpus_pipeline.STAGES)
    heads = stages["near_dedup"](spark, odd, str(tmp_path))
    comp = components_of({i: shingle_set(r[1]) for i, r in enumerate(odd_rows)})
    alone = sum(1 for r in odd_rows if not shingle_set(r[1]))  # rows without a set all stay
    assert heads.columns == odd.columns
    assert heads.count() == alone + len({c for i, c in comp.items() if shingle_set(odd_rows[i][1])})
    mixed = stages["mix"](spark, odd, str(tmp_path)).collect()
    assert {(r["doc_id"], r["text"]) for r in mixed} <= {(r[0], r[1]) for r in odd_rows}
    packed = stages["pack"](spark, odd, str(tmp_path)).collect()
    assert sum(r["n_words"] for r in packed) == sum(len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in odd_rows)


# ------------------------------------------------------ very long inputs

@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 4096, 4097, 70000])
def test_running_sums(spark, n):
    rng = random.Random(n)
    x = [rng.randint(0, 9) for _ in range(n)]
    got = spark.createDataFrame([(x,)], "x array<int>").select(tables.running(F.col("x")).alias("r")).first()["r"]
    assert got == np.r_[0, np.cumsum(x)][:n].astype(int).tolist()


def test_op5_one_megabyte_of_numbers(spark):
    rng = random.Random(3)
    t = " ".join(str(rng.randint(256, 10**9)) for _ in range(LONG // 9))[:LONG]
    dotted = t.replace(" ", ".")
    texts = [t, "mail a@b.cd now\n" * (LONG // 16), "\U0001f600 a@b.cd " * 20000, dotted, "x" * LONG]
    got = by_id(pii.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))
    for i, t in enumerate(texts[:3]):
        want = spans_by_hand(t)
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
    assert got[1]["n_email"] == LONG // 16 and got[2]["n_email"] == 20000
    none = hashlib.sha256(b"").hexdigest()  # no part of the dotted numbers is a byte, no run of x a mail
    assert got[4]["base_sha256"] == none and (got[3]["n_email"], got[3]["n_ip"], got[3]["n_card"]) == (0, 0, 0)


def test_op3_a_hundred_thousand_phrases(spark):
    texts = ["cc by " * 100_000, "all rights reserved\n" * 30_000, "license " * 120_000]
    got = by_id(license_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))
    assert (got[0]["n_base"], got[0]["first_word"], got[0]["last_word"], got[0]["n_words"]) == (100_000, 0, 199_998, 200_000)
    assert (got[1]["n_base"], got[1]["last_word"], got[1]["labels"]) == (30_000, 89_997, "reserved")
    assert (got[2]["n_base"], got[2]["labels"], got[2]["score"]) == (0, "", 0.0)


def test_op2_very_long_urls(spark):
    long = "https://www.example.com/en/" + "a" * LONG
    rows = [(1, long), (2, "http://" + "h" * LONG + ".net/es/x"), (3, "no scheme " * 1000), (4, None)]
    got = {r["page_id"]: r for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert (got[1]["host"], got[1]["rule"], got[1]["verdict"]) == ("www.example.com", "www.example.com/en/", "allow")
    assert (len(got[2]["host"]), got[2]["rule"], got[2]["verdict"]) == (LONG + 4, "net/es/", "block")
    assert got[1]["path"] == "/en/" + "a" * LONG and got[3]["host"] == got[4]["host"] == ""


# ---------------------------------------------------------------- methods

def test_op3_templates_are_an_argument(spark):
    mine = (("house", "only for use inside the house of the makers", "inside the house"), ("other", "anything goes here", "anything goes"))
    texts = ["it is only for use inside the house of the makers ok", "only for use outside the house of the makers", "anything goes here", "released under the mit license"]
    got = by_id(license_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), mine))
    assert [got[i]["labels"] for i in range(4)] == ["house", "", "other", ""] and got[0]["score"] == 1.0


def test_op7_labels_given_twice_or_both_ways(spark, odd):
    count = quality_rules.counts(odd, "doc_id").withColumnRenamed("key", "doc_id").cache()
    good = [(r["doc_id"], 1, 0) for r in count.where("n_words >= 50 AND doc_id IS NOT NULL").select("doc_id").distinct().collect()]
    schema = "doc_id long, quality int, toxic int"
    fit = lambda rows: quality_rules.fit(count, spark.createDataFrame(rows, schema))
    assert fit(good + good)[1] == fit(good)[1]
    torn = good[:3]
    assert fit(good + [(i, 0, 0) for i, *_ in torn])[1] == fit(good[3:])[1]  # labelled both ways: no part in the fit


def test_op7_isolates_rows_beyond_the_fitted_ones():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 5))
    forest = quality_rules.fit_forest(x)
    inside = quality_rules.score_forest(forest, x)
    far = quality_rules.score_forest(forest, np.array([[9.0, 0, 0, 0, 0], [0, 0, -30, 0, 0], [7, 7, 7, 7, 7]]))
    assert far.min() > np.quantile(inside, 0.995) and inside.max() <= 1 and inside.min() > 0


def test_op9_fit_beyond_the_dynamic_programme():
    """Budgets whose rest is far over DP_WORDS come as near as small ones."""
    lengths = np.array([1, 7, 90, 40_000, 70_001, 300_000])
    for counts, budget in (([5, 5, 5, 3, 2, 4], 900_123), ([0, 0, 0, 9, 9, 9], 1_234_567), ([9, 9, 9, 1, 1, 1], 333_333)):
        some = np.array(counts) > 0
        n, c = lengths[some], np.array(counts)[some]
        take = mixing.fit_budget(n, c, budget)
        got = int((n * take).sum())
        assert (take >= 0).all() and (take <= c).all() and got <= budget
        left = n[take < c]
        assert not len(left) or budget - got < max(left.min(), mixing.DP_WORDS)


# ------------------------------------------------------------- located rows

def test_rows_from_files_are_located_without_a_copy(spark, odd, tmp_path):
    path = str(tmp_path / "docs.parquet")
    odd.repartition(4).write.parquet(path)
    docs = spark.read.parquet(path)
    at = tables.located(docs, "copy")
    assert not any("llm-copy" in f for f in at.inputFiles())
    one, two = ({r["row"]: (r["c0"], r["c1"]) for r in at.repartition(k).collect()} for k in (1, 5))
    assert one == two and len(one) == docs.count()
    copied = tables.located(docs.groupBy("doc_id").agg(F.first("text").alias("text")), "copy")
    assert any("llm-copy" in f for f in copied.inputFiles())
    own = docs.withColumn("_metadata", F.lit(1)).withColumn("row", F.lit("clash"))
    assert tables.located(own, "copy").count() == docs.count()
    lost = at.where("c0 IS NULL").select("row")
    assert tables.without(docs, at, lost, "lost").count() == docs.where("doc_id IS NOT NULL").count()
    assert isinstance(pa.array([1]), pa.Array)
