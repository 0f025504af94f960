"""URL filter: a character language-model ratio behind host/path rules.

Rules judge what they fit; those URLs also teach two variable-order Markov
models over bytes, one of accepted and one of rejected URLs.  A byte's
probability starts uniform and is refined order by order: the counts of a
longer context are mixed with the shorter context's probability, by as much
as the longer context has been seen.  The score is the log-likelihood
difference per byte; its threshold is calibrated on held-out ruled URLs.

Counts are exact, by (order, context, byte), and the model grows with the
ruled URLs.  A byte's log ratio depends on its last five bytes and itself
only (its gram), so Spark computes it once for each gram of any URL.  The
most frequent grams, ``COMMON_GRAMS`` at most, are looked up in a broadcast table;
all other (URL, gram) are joined to the same numbers.  Log ratios are whole
numbers of 1 / ``UNIT``, so sums do not depend on their order.

Defined results: a null url or one without ``://`` has an empty host and
path and no rule; it is judged by the model over its bytes (null: none,
score 0).  Score ties with the threshold are allowed.  Without ruled URLs of
both classes all unruled URLs are allowed.  An empty table gives an empty
result; repeated rows are judged alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandlake.llm import textops as T
from demandlake.llm.tables import keep, lower_ascii, most_frequent

#: (verdict, rule): the rule's host fits itself and its subdomains, its path
#: is a prefix; the longest rule that fits wins.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
ORDERS = 6  # contexts of 0 to 5 bytes
SLOTS = 1 << 16  # of the one-process form, ``ratio``
COMMON_GRAMS = 1 << 20
UNIT = 1 << 32
STRENGTH = 4.0
HELD_OUT = 5  # one fold in five calibrates
BINS = 100  # score bins per unit, for the threshold
EDGE = 500  # bins reach from -EDGE to EDGE


def split_url(url):
    """(host, path) columns."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    u = F.coalesce(url.cast("string"), F.lit(""))
    return lower_ascii(F.regexp_extract(u, pattern, 1)), F.regexp_extract(u, pattern, 2)


def rule_of(host, path):
    """The longest fitting rule, else null."""
    out = F.lit(None).cast("string")
    for _, rule in sorted(RULES, key=lambda r: len(r[1])):
        h, slash, p = rule.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(slash + p)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def _grams(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Each byte with its five last ones (nine bits each, 0 before the start,
    the nearest lowest) as one exact number; its order-k form is the low
    9k + 8 bits."""
    place = np.arange(len(data)) - np.repeat(off[:-1], np.diff(off))
    out = data.astype(np.int64)
    for k in range(1, ORDERS):
        back = np.zeros(len(data), np.int64)
        back[k:] = data[:-k].astype(np.int64) + 1
        back[place < k] = 0
        out |= back << (9 * (k - 1) + 8)
    return out


def _count_batches(batches):
    """(kind, key, n): grams of a batch; 0 and 1 of accepted and rejected URLs that teach, 2 of others."""
    for rows, data, off in T.chunks(batches, "url"):
        kind = np.repeat(rows.column("kind").to_numpy(zero_copy_only=False).astype(np.int64), np.diff(off))
        key, n = np.unique(_grams(data, off) | kind << 60, return_counts=True)
        cols = [pa.array((key >> 60).astype(np.int32)), pa.array(key & ((1 << 60) - 1)), pa.array(n.astype(np.int64))]
        yield pa.RecordBatch.from_arrays(cols, ["kind", "key", "n"])


def count(urls: DataFrame) -> DataFrame:
    """(key, n0, n1, n) of every gram of ``urls(url, kind)``: in accepted and rejected teaching URLs, and in all."""
    cells = urls.select("url", "kind").mapInArrow(_count_batches, "kind int, key long, n long")
    of = lambda k: F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0))
    return cells.groupBy("key").agg(of(0).alias("n0"), of(1).alias("n1"), F.sum("n").alias("n"))


def log_ratios(grams: DataFrame) -> DataFrame:
    """(key, n, value) of every gram: its log-likelihood (block minus allow) in
    units.  A context has 256 bytes and a gram 257 longer ones at most, so
    no key of the windows and joins is hot."""
    level = [grams]
    for k in range(ORDERS - 2, -1, -1):
        short = F.col("key").bitwiseAND((1 << 9 * k + 8) - 1)
        level.insert(0, level[0].groupBy(short.alias("key")).agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")))
    out = None
    for k, cells in enumerate(level):
        context = Window.partitionBy(F.shiftright("key", 8))
        cells = cells.withColumns({f"c{c}": F.sum(f"n{c}").over(context) for c in (0, 1)})
        if out is None:
            cells = cells.withColumns({"q0": F.lit(1 / 256), "q1": F.lit(1 / 256)})
        else:
            cells = cells.withColumn("short", F.col("key").bitwiseAND((1 << 9 * (k - 1) + 8) - 1)).join(out, "short")
        p = {f"p{c}": (F.col(f"n{c}") + F.lit(STRENGTH) * F.col(f"q{c}")) / (F.col(f"c{c}") + F.lit(STRENGTH)) for c in (0, 1)}
        cells = cells.withColumns(p)
        out = cells.select(F.col("key").alias("short"), F.col("p0").alias("q0"), F.col("p1").alias("q1"))
    return cells.select("key", "n", F.round((F.log("p1") - F.log("p0")) * F.lit(float(UNIT))).cast("long").alias("value"))


def score(urls: DataFrame, values: DataFrame) -> DataFrame:
    """``urls`` (string ``url``, ...) without ``url``, with ``score``: the log
    likelihood (block minus allow) per byte."""
    common = most_frequent(values, COMMON_GRAMS).select("key", "value").toArrow().sort_by("key")
    shared = urls.sparkSession.sparkContext.broadcast((common.column("key").to_numpy(), common.column("value").to_numpy()))
    names = [c for c in urls.columns if c != "url"]

    def run(batches):
        keys, value = shared.value
        for rows, data, off in T.chunks(batches, "url"):
            gram = _grams(data, off)
            at = np.minimum(np.searchsorted(keys, gram), max(len(keys) - 1, 0))
            hit = keys[at] == gram if len(keys) else np.zeros(len(gram), bool)
            found = np.zeros(len(gram), np.int64)
            found[hit] = value[at[hit]]
            rare = np.flatnonzero(~hit)
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(rare, off).astype(np.int32)), pa.array(gram[rare]))
            got = [pa.array(T.totals(found, off)), pa.array(np.diff(off).astype(np.int64)), lists]
            yield pa.RecordBatch.from_arrays([*[rows.column(c) for c in names], *got], [*names, "common_value", "n_bytes", "rare"])

    schema = ", ".join(f"`{n}` {t}" for n, t in urls.dtypes if n != "url") + ", common_value long, n_bytes long, rare array<long>"
    pieces = keep(urls.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()), "url-pieces")
    pairs = pieces.select("row", F.explode("rare").alias("key")).join(values.select("key", "value"), "key")
    part = keep(pairs.groupBy("row").agg(F.sum("value").alias("rare_value")), "url-rare")
    total = F.col("common_value") + F.coalesce("rare_value", F.lit(0))
    return pieces.join(part, "row", "left").select(*names, (total / F.lit(float(UNIT)) / F.greatest("n_bytes", F.lit(1))).alias("score"))


def calibrate(held: DataFrame) -> float:
    """The threshold of best balanced accuracy on ``held(block, score)``; block
    above it.  Scores are counted in bins, so what is collected is bounded."""
    b = F.greatest(F.lit(-EDGE), F.least(F.lit(EDGE), F.floor(F.col("score") * BINS))).cast("int").alias("bin")
    hist = np.zeros((2, 2 * EDGE + 1))
    for r in held.groupBy(F.col("block").cast("int").alias("block"), b).count().collect():
        hist[r["block"], r["bin"] + EDGE] = r["count"]
    if not hist.sum(1).all():
        return 0.0
    share = hist / hist.sum(1, keepdims=True)
    allowed_below = np.cumsum(share[0])
    blocked_above = 1 - np.cumsum(share[1])
    good = allowed_below + blocked_above
    best = np.flatnonzero(good >= good.max() - 1e-12)
    return float((best[len(best) // 2] + 1 - EDGE) / BINS)  # the middle of a plateau


def judge(pages: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict, score."""
    host, path = split_url(F.col("url"))
    rows = pages.select("page_id", F.col("url").cast("string").alias("url")).withColumns({"host": host, "path": path})
    rows = rows.withColumn("rule", rule_of(F.col("host"), F.col("path")))
    blocked = F.lit(False)
    for verdict, rule in RULES:
        blocked = F.when(F.col("rule") == rule, F.lit(verdict == "block")).otherwise(blocked)
    rows = keep(rows.withColumn("block", F.when(F.col("rule").isNotNull(), blocked)), "urls")
    fold = F.pmod(F.crc32(F.coalesce("url", F.lit("")).cast("binary")), F.lit(HELD_OUT))
    rows = rows.withColumn("held", fold == 0)
    teaches = F.col("rule").isNotNull() & ~F.col("held")
    grams = keep(count(rows.select("url", F.when(teaches, F.col("block").cast("int")).otherwise(2).alias("kind"))), "url-grams")
    taught = grams.agg(F.coalesce(F.sum("n0"), F.lit(0)).alias("n0"), F.coalesce(F.sum("n1"), F.lit(0)).alias("n1")).first()
    both = taught["n0"] > 0 and taught["n1"] > 0
    scored = score(rows, keep(log_ratios(grams), "url-values"))
    threshold = calibrate(scored.where("rule IS NOT NULL AND held")) if both else 0.0
    by_model = (F.col("score") > F.lit(threshold)) if both else F.lit(False)
    bad = F.coalesce(F.col("block"), by_model)
    return scored.select("page_id", "host", "path", "rule", F.when(bad, "block").otherwise("allow").alias("verdict"), "score")


#: The same mixture in one process, over hashed cells instead of exact keys; no query uses it.
def _contexts(data: np.ndarray, off: np.ndarray):
    """(context key, context+byte key) per order, for all bytes of all texts;
    a context never reaches over the start of its text."""
    place = np.arange(len(data)) - np.repeat(off[:-1], np.diff(off))
    acc = np.zeros(len(data), np.uint64)
    for k in range(ORDERS):
        if k:
            back = np.zeros(len(data), np.uint64)
            back[k:] = data[:-k].astype(np.uint64) + T.U(1) if k else 0
            back[place < k] = T.U(0)  # before the start
            acc = acc * T.U(0x100000001B3) + back + T.U(k)
        ctx = T.mix(acc + T.U(k * 7919))
        sym = T.mix(ctx + (data.astype(np.uint64) + T.U(1)) * T.U(0x9E3779B97F4A7C15))
        yield k, (ctx % T.U(SLOTS)).astype(np.int64), (sym % T.U(SLOTS)).astype(np.int64)


def ratio(table: np.ndarray, data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Log-likelihood (block minus allow) per byte of each text."""
    p = [np.full(len(data), 1 / 256), np.full(len(data), 1 / 256)]
    for k, ctx, sym in _contexts(data, off):
        for c in (0, 1):
            p[c] = (np.minimum(table[c, k, 1][sym], table[c, k, 0][ctx]) + STRENGTH * p[c]) / (table[c, k, 0][ctx] + STRENGTH)
    return T.totals(np.log(p[1]) - np.log(p[0]), off) / np.maximum(np.diff(off), 1)
