"""Quality rules: an isolation forest on rule statistics.

Every document gets counts (words, symbols, repeated lines and 3-word
windows, case, punctuation, ...).  Trees split random features at random
values over labelled good rows; a short mean path marks an anomaly.  A split's
value is drawn from the node's range and MARGIN ranges (of LEAST_RANGE at
least) beyond each end, so rows that lie outside of all good ones are isolated
too, and early; a node's depth is bounded by DEPTH times a logarithm.
The threshold comes from labelled rows of both classes: the best balanced
accuracy among the scores that lose MAX_GOOD_LOST of the good ones at most.

Every labelled row that passes the base rules has its part in the fit.  A
seeded hash halves the good ones.  Those of one half are dealt to the trees,
each row to one tree at least and to as many as give a tree TREE_ROWS rows; a
tree is grown in a task, counts all of its rows, and splits until a node holds
a TREE_ROWS-th of them, so its size is bounded however many they are.  The
other half and all bad ones are scored, and their counts by cell of the score
(2^-SCORE_BITS wide) set the threshold.  ``measure`` says what that is worth
on rows kept apart.

Defined results: null or empty text has no words and fails the base rules;
without labelled good rows the forest keeps what the base rules keep, without
bad ones the threshold is the lowest within the bound; a
document counts once in the fit, however often it is labelled or repeated, and
not at all if it is labelled both ways; an empty table gives an empty result.  A text is read
whole, whatever its length.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlake.llm import textops as T
from demandlake.llm.tables import keep

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
TREES = 200
TREE_ROWS = 512
MARGIN = 1.0
LEAST_RANGE = 0.01
DEPTH = 2
MAX_GOOD_LOST = 0.002
#: Labelled rows are counted by cells of the score; 2^SCORE_BITS a class come to the driver at most.
SCORE_BITS = 16
SEED = 7
#: Bytes of text handled at once.
CHUNK = 512 << 10

SYMBOL = np.zeros(256, bool)
SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True
DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True
PUNCT = np.zeros(256, bool)
PUNCT[33:48] = PUNCT[58:65] = PUNCT[91:97] = PUNCT[123:127] = True

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_letters", "n_upper", "n_digits", "n_punct", "n_distinct", "n_lines"]
FEATURES = ["symbols", "dup_lines", "repeats", "word_len", "letters", "upper", "digits", "punct", "distinct"]


def count_rules(data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of each text, as int64 arrays."""
    start, end, woff = T.words(data, off)
    doc = np.repeat(np.arange(len(off) - 1), np.diff(woff))
    pre = T.prefix_hash(data)
    wh = T.span_hash(pre, start, end)
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    per_byte = lambda table: T.totals(table[data].astype(np.int64), off)
    h, at, wdoc = T.windows(wh, woff, 3)
    cover = np.zeros(len(wh) + 3, np.int64)
    again = at[T.repeated(T.per_text(h, wdoc))]
    for j in range(3):
        cover[again + j] = 1
    # lines: each text's pieces between newlines
    cut = np.flatnonzero(data == 10)
    ls = np.sort(np.concatenate([off[:-1], cut + 1]))
    le = np.sort(np.concatenate([cut, off[1:]]))
    ldoc = np.searchsorted(cut, off[:-1])  # newlines before a text
    lines_off = np.concatenate([ldoc + np.arange(len(off) - 1), [len(ls)]])
    line_doc = np.repeat(np.arange(len(off) - 1), np.diff(lines_off))
    with_word = np.searchsorted(start, le) > np.searchsorted(start, ls)
    solid = np.flatnonzero(with_word)
    dup = np.zeros(len(ls), np.int64)
    dup[solid] = T.later(T.per_text(T.span_hash(pre, ls[solid], le[solid]), line_doc[solid]))
    return {
        "n_words": np.diff(woff).astype(np.int64),
        "word_chars": T.totals(chars[end] - chars[start], woff),
        "n_symbols": per_byte(SYMBOL),
        "n_dup_lines": T.totals(dup, lines_off),
        "n_repeat_words": T.totals(cover[: len(wh)], woff),
        "n_letters": per_byte(LETTER), "n_upper": per_byte(UPPER), "n_digits": per_byte(DIGIT), "n_punct": per_byte(PUNCT),
        "n_distinct": T.totals((~T.later(T.per_text(wh, doc))).astype(np.int64), woff),
        "n_lines": T.totals(with_word.astype(np.int64), lines_off),
    }


def _count_batches(batches):
    for rows, data, off in T.chunks(batches, limit=CHUNK):
        got = count_rules(data, off)
        yield pa.RecordBatch.from_arrays([rows.column("key"), *[pa.array(got[c], pa.int64()) for c in COUNTS + MORE]], ["key", *COUNTS, *MORE])


def counts(docs: DataFrame, key: str) -> DataFrame:
    """(key, counts...) of every row; ``key`` is a long column."""
    schema = "key long, " + ", ".join(f"{c} long" for c in COUNTS + MORE)
    return docs.select(F.col(key).cast("long").alias("key"), F.col("text").cast("string").alias("text")).mapInArrow(_count_batches, schema)


def features(pdf: pd.DataFrame) -> np.ndarray:
    """Scale-free statistics, so that a text's length alone is no anomaly."""
    n = np.maximum(pdf["n_words"].to_numpy(float), 1)
    c = np.maximum(pdf["word_chars"].to_numpy(float), 1)
    per_word = lambda x: pdf[x].to_numpy(float) / n
    per_char = lambda x: pdf[x].to_numpy(float) / c
    return np.column_stack([
        per_word("n_symbols"), pdf["n_dup_lines"].to_numpy(float) / np.maximum(pdf["n_lines"].to_numpy(float), 1), per_word("n_repeat_words"),
        pdf["word_chars"].to_numpy(float) / n, per_char("n_letters"), per_char("n_upper"), per_char("n_digits"), per_char("n_punct"),
        per_word("n_distinct") * np.log(n + 1) / np.log(60.0),
    ])


def _path_norm(n: float) -> float:
    return 2.0 * (np.log(n - 1) + 0.5772156649) - 2.0 * (n - 1) / n if n > 2 else max(n - 1.0, 0.0)


def grow_tree(x: np.ndarray, rng: np.random.Generator, rows: int = TREE_ROWS) -> tuple[np.ndarray, ...]:
    """One tree over all rows of ``x`` as flat arrays: feature (-1: leaf), cut,
    right child, path length at a leaf.  More than ``rows`` rows weigh as much
    as ``rows`` together; the order of the rows has no part."""
    share = min(1.0, rows / len(x))
    depth = DEPTH * int(np.ceil(np.log2(max(min(rows, len(x)), 2))))
    least = np.maximum(LEAST_RANGE, LEAST_RANGE * (x.max(0) - x.min(0)))  # also where all rows agree
    feat, cut, right, path = [], [], [], []

    def grow(idx, level):
        me = len(feat)
        for a, v in ((feat, -1), (cut, 0.0), (right, 0), (path, 0.0)):
            a.append(v)
        sub = x[idx]
        lo, hi = (sub.min(0), sub.max(0)) if len(idx) * share > 1 else (np.zeros(1), np.zeros(1))
        if level >= depth or not (hi > lo).any():
            path[me] = level + _path_norm(len(idx) * share)
            return me
        f = int(rng.integers(x.shape[1]))
        beyond = MARGIN * max(hi[f] - lo[f], least[f])
        c = float(rng.uniform(lo[f] - beyond, hi[f] + beyond))
        feat[me], cut[me] = f, c
        grow(idx[sub[:, f] < c], level + 1)  # at me + 1
        right[me] = grow(idx[sub[:, f] >= c], level + 1)
        return me

    grow(np.arange(len(x)), 0)
    return np.array(feat), np.array(cut), np.array(right), np.array(path)


def copies_of(n: int, trees: int = TREES, rows: int = TREE_ROWS) -> int:
    """The trees that each of ``n`` rows goes to: one at least."""
    return min(trees, max(1, -(-trees * rows // n)))


def fit_forest(x: np.ndarray, trees: int = TREES, rows: int = TREE_ROWS, seed: int = SEED) -> dict:
    """The forest of rows that are at hand."""
    copies = copies_of(len(x), trees, rows)
    start = np.random.default_rng(seed).permutation(len(x)) % trees
    own = [x[(t - start) % trees < copies] for t in range(trees)]
    forest = [grow_tree(part, np.random.default_rng([seed, t]), rows) for t, part in enumerate(own) if len(part)]
    return {"trees": forest, "norm": _norm(len(x), trees, rows)}


def _norm(n: int, trees: int = TREES, rows: int = TREE_ROWS) -> float:
    return max(_path_norm(min(rows, n * copies_of(n, trees, rows) / trees)), 1e-9)


def grow_forest(good: DataFrame, n: int) -> dict:
    """The forest of all ``n`` rows of ``good(h, counts...)``, grown in tasks."""
    first = F.pmod(F.col("h"), F.lit(TREES)).alias("first")
    dealt = good.select(*COUNTS, *MORE, first, F.explode(F.sequence(F.lit(0), F.lit(copies_of(n) - 1))).alias("next"))
    dealt = dealt.select(*COUNTS, *MORE, F.pmod(F.col("first") + F.col("next"), F.lit(TREES)).cast("int").alias("tree"))

    def grown(pdf: pd.DataFrame) -> pd.DataFrame:
        t = int(pdf["tree"].iloc[0])
        return pd.DataFrame([[t, *grow_tree(features(pdf), np.random.default_rng([SEED, t]))]], columns=["tree", "feature", "cut", "right", "path"])

    out = dealt.groupBy("tree").applyInPandas(grown, "tree int, feature array<int>, cut array<double>, right array<int>, path array<double>")
    rows = sorted(out.collect(), key=lambda r: r["tree"])  # TREES rows, each of a bounded number of nodes
    arrays = [tuple(np.array(r[c]) for c in ("feature", "cut", "right", "path")) for r in rows]
    return {"trees": arrays, "norm": _norm(n)}


def score_forest(forest: dict, x: np.ndarray) -> np.ndarray:
    """Anomaly score in (0, 1]: the shorter the mean path, the larger."""
    total = np.zeros(len(x))
    for feat, cut, right, path in forest["trees"]:
        at = np.zeros(len(x), np.int64)
        while True:
            f = feat[at]
            go = np.flatnonzero(f >= 0)
            if not len(go):
                break
            node = at[go]
            at[go] = np.where(x[go, f[go]] < cut[node], node + 1, right[node])
        total += path[at]
    return 2.0 ** (-(total / len(forest["trees"])) / forest["norm"])


def base_failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def calibrate(good: np.ndarray, bad: np.ndarray) -> float:
    """The threshold (kept: not above it) of best balanced accuracy among
    those that lose MAX_GOOD_LOST of the good rows at most; the lowest of equals."""
    at, place = np.unique(np.r_[good, bad], return_inverse=True)
    return calibrate_counts(at, np.bincount(place[: len(good)], minlength=len(at)), np.bincount(place[len(good) :], minlength=len(at)))


def calibrate_counts(at: np.ndarray, good: np.ndarray, bad: np.ndarray) -> float:
    """``calibrate`` from the numbers of good and bad rows by ascending score."""
    kept_good, kept_bad = np.cumsum(good), np.cumsum(bad)
    least = int(np.searchsorted(kept_good, np.ceil((kept_good[-1] - 1) * (1 - MAX_GOOD_LOST)), "right"))
    if not kept_bad[-1]:
        return float(at[least])
    gain = (kept_good / kept_good[-1] - kept_bad / kept_bad[-1])[least:]
    return float(at[least + np.flatnonzero(gain >= gain.max() - 1e-12)[0]])


def fit(counted: DataFrame, labels: DataFrame) -> tuple[dict, float] | None:
    """(forest, threshold) from all labelled rows that pass the base rules:
    half of the good ones grow the trees, the other half and the bad ones set
    the threshold.  None without labelled good rows."""
    return _fit(labelled(counted, labels))


def _fit(rows: DataFrame) -> tuple[dict, float] | None:
    half = F.pmod(F.shiftright("h", 32), F.lit(2)).alias("half")
    good = rows.where("quality = 1")
    held = {r["half"]: r["count"] for r in good.groupBy(half).count().collect()}
    n = sum(held.values())
    if n < 4:
        return None
    grows, sets = good.where(half == 0), rows.where((F.col("quality") == 0) | (half == 1))
    if 4 * min(held.get(0, 0), held.get(1, 0)) < n:  # a few rows that the hash did not halve have both parts
        grows, sets, held = good, rows, {0: n}
    forest = grow_forest(grows, held[0])
    cell = F.ceil(anomaly_of(rows, forest) * (1 << SCORE_BITS)).cast("int")
    counted = sets.select("quality", cell.alias("cell")).groupBy("cell").agg(F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("quality") == 0).alias("bad"))
    cells = sorted(counted.collect())
    at, is_good, is_bad = (np.array(c) for c in zip(*cells, strict=True))
    return forest, calibrate_counts(at / (1 << SCORE_BITS), is_good, is_bad)


def measure(counted: DataFrame, labels: DataFrame) -> tuple[float, float]:
    """(share of good rows lost, share of bad rows caught) among labelled rows
    kept apart: a third of both has no part in forest or threshold."""
    rows = labelled(counted, labels)
    apart = F.pmod(F.shiftright("h", 40), F.lit(3)) == 0
    forest, threshold = _fit(rows.where(~apart))
    out = rows.where(apart).select("quality", (anomaly_of(rows, forest) > threshold).alias("lost"))
    share = {r["quality"]: r["lost"] for r in out.groupBy("quality").agg(F.avg(F.col("lost").cast("int")).alias("lost")).collect()}
    return share[1], share[0]


def labelled(counted: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, h, quality, counts...) of every labelled good or bad document
    that passes the base rules, once; written."""
    once = labels.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("most")).where("quality = most AND quality IN (0, 1)")
    own = counted.where(~base_failed()).select("doc_id", F.struct(*COUNTS, *MORE).alias("r"))
    # rows repeated under one doc_id are one
    seen = own.join(once.select("doc_id", "quality"), "doc_id").groupBy("doc_id", "quality").agg(F.min("r").alias("r"))
    return keep(seen.select("doc_id", F.xxhash64(F.lit(SEED), "doc_id").alias("h"), "quality", "r.*"), "rule-labels")


def anomaly_of(counted: DataFrame, forest: dict):
    """The anomaly score of a row of counts, as a column."""
    shared = counted.sparkSession.sparkContext.broadcast(forest)  # TREES trees of bounded size

    @F.pandas_udf("double")
    def anomaly(pdf: pd.DataFrame) -> pd.Series:
        return pd.Series(score_forest(shared.value, features(pdf)))

    return anomaly(F.struct(*COUNTS, *MORE))


def _verdict(model: tuple[dict, float] | None):
    """Counts with base_failed, anomaly and kept, in a task."""

    def judged(pdf: pd.DataFrame) -> pd.DataFrame:
        failed = (pdf["n_words"] < MIN_WORDS) | (100 * pdf["n_repeat_words"] > MAX_REPEAT_PERCENT * pdf["n_words"])
        score = score_forest(model[0], features(pdf)) if model and len(pdf) else np.zeros(len(pdf))
        return pdf.assign(base_failed=failed, anomaly=score, kept=~failed & (score <= model[1] if model else True))

    return judged


def judge(counted: DataFrame, labels: DataFrame) -> DataFrame:
    """``counted`` (written) with base_failed, anomaly and kept."""
    model = fit(counted, labels)
    base = counted.withColumn("base_failed", base_failed())
    if model is None:
        return base.withColumn("anomaly", F.lit(0.0)).withColumn("kept", ~F.col("base_failed"))
    scored = base.withColumn("anomaly", anomaly_of(counted, model[0]))
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") <= F.lit(model[1])))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, n_words, the base counts, base_failed, kept, anomaly."""
    counted = keep(counts(docs, "doc_id").withColumnRenamed("key", "doc_id"), "rule-counts")
    return judge(counted, labels).select("doc_id", *COUNTS, "base_failed", "kept", "anomaly")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the rules and the forest keep, with their own
    columns.  The verdict is a map over the rows: texts are read once to fit
    and once to judge, and never move."""
    counted = keep(counts(docs, "doc_id").withColumnRenamed("key", "doc_id"), "rule-counts")
    shared = docs.sparkSession.sparkContext.broadcast(fit(counted, labels))
    names = docs.columns
    text = names.index("text")

    def run(batches):
        judged = _verdict(shared.value)
        for b in batches:
            parts = [(rows, count_rules(data, off)) for rows, data, off in T.chunks([b.rename_columns([f"c{i}" for i in range(len(names))])], f"c{text}", CHUNK)]
            if not parts:
                continue
            kept = judged(pd.DataFrame({c: np.concatenate([got[c] for _, got in parts]) for c in COUNTS + MORE}))["kept"].to_numpy()
            at = 0
            for rows, _ in parts:
                yield rows.filter(pa.array(kept[at : at + rows.num_rows])).rename_columns(names)
                at += rows.num_rows

    return docs.mapInArrow(run, docs.schema)
