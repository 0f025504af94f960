"""LM scoring by context-tree weighting over bytes.

A byte is eight binary decisions, most significant bit first; each decision
node has its own context tree whose contexts are the preceding bytes, up to
``DEPTH``.  A node's counts give a Krichevsky-Trofimov block probability;
weighting halves it with the product of its children, from the deepest
contexts up.  The ratio of the two is the node's weight, so the trained tree
predicts a bit by mixing the KT estimates of all depths along its context
path, and the code length of a text is the sum over its bits.

All counts cover every training text and the tree holds every context.  Its
predictions are computed in Spark tasks, one two-byte context (at most 65,536
counts) at a time, for each (context, byte) that any text holds.  The rows of
the most frequent contexts, ``DEEP_CONTEXTS`` at most, are broadcast; all other
(text, context, byte) are joined to the written predictions, which are the
same numbers, so the bound decides only how a prediction is looked up.

The base score is an add-one word unigram.  The most frequent
words, ``COMMON_WORDS`` at most, are looked up in a broadcast table of that fixed
size; all other (text, word) pairs are joined to the full counts.

Defined results: null text counts as empty (one end token, code length 0);
texts whose CRC-32 of the id modulo FOLDS equals HELD are held out (null id:
CRC of the empty string); repeated rows count as often as they occur; an
empty table gives an empty result; without training texts N and V are 0.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlake.llm import textops as T
from demandlake.llm.tables import keep, most_frequent

DEPTH = 3
DEEP_CONTEXTS = 1 << 15
COMMON_WORDS = 1 << 17
FOLDS, HELD = 7, 2
#: Hash of the end token; no word hashes to it but by chance of 2^-64.
END = -1


def _history(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The last three bytes before each byte as one number, zeros before a start."""
    place = np.arange(len(data)) - np.repeat(off[:-1], np.diff(off))
    out = np.zeros(len(data), np.uint32)
    for k in (1, 2, 3):
        back = np.zeros(len(data), np.uint32)
        back[k:] = data[:-k]
        back[place < k] = 0
        out |= back << np.uint32(8 * (k - 1))
    return out


def _word_hashes(data, off):
    start, end, woff = T.words(data, off)
    return T.span_hash(T.prefix_hash(data), start, end).view(np.int64), woff


class _Sums:
    """Counts by 64-bit key, merged whenever the pending part outgrows the kept one."""

    def __init__(self):
        self.keys, self.n, self.pending, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

    def add(self, keys, n):
        self.pending.append((keys, n))
        self.size += len(keys)
        if self.size > max(len(self.keys), 1 << 19):
            self.merge()

    def merge(self):
        k = np.concatenate([self.keys, *[p[0] for p in self.pending]])
        n = np.concatenate([self.n, *[p[1] for p in self.pending]])
        o = np.argsort(k)
        k, n = k[o], n[o]
        first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]][: len(k)])
        self.keys, self.n = k[first], np.add.reduceat(n, first) if len(first) else n
        self.pending, self.size = [], 0

    def rows(self, kind):
        """Emit and forget everything."""
        self.merge()
        for at in range(0, len(self.keys), 200_000):
            k, n = self.keys[at : at + 200_000], self.n[at : at + 200_000]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), kind, np.int32)), pa.array(k), pa.array(n)], ["kind", "key", "n"])
        self.__init__()


def _count(batches):
    """(kind, key, n): 0 words of training texts, 1 bytes of training texts
    with their three-byte history, 2 those of held-out texts."""
    words, grams, held = _Sums(), _Sums(), _Sums()
    for rows, data, off in T.chunks(batches):
        data = T.LOWER[data]
        out = rows.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
        wh, woff = _word_hashes(data, off)
        words.add(*np.unique(np.r_[wh[np.repeat(~out, np.diff(woff))], np.full((~out).sum(), END)], return_counts=True))
        all_grams = (_history(data, off).astype(np.int64) << 8 | data).astype(np.uint32)
        away = np.repeat(out, np.diff(off))
        for sums, g in ((grams, all_grams[~away]), (held, all_grams[away])):
            g.sort()
            first = np.flatnonzero(np.r_[True, g[1:] != g[:-1]][: len(g)])
            sums.add(g[first].astype(np.int64), np.diff(np.r_[first, len(g)]))
        for kind, sums in enumerate((words, grams, held)):  # a task's memory stays bounded
            if len(sums.keys) > 2_000_000:
                yield from sums.rows(kind)
    for kind, sums in enumerate((words, grams, held)):
        yield from sums.rows(kind)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    shift = np.maximum(0, np.ceil(8 - x)).astype(int)
    small = np.zeros_like(x)
    y = x.copy()
    for _ in range(int(shift.max(initial=0))):
        low = y < 8
        small[low] -= np.log(y[low])
        y[low] += 1
    return small + (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)


def _nodes(counts: np.ndarray) -> np.ndarray:
    """[rows, 512] visits of each node of the byte's bit tree (1 root, 256+b leaves)."""
    t = np.zeros((len(counts), 512))
    t[:, 256:] = counts
    for level in range(7, -1, -1):
        j = 1 << level
        t[:, j : 2 * j] = t[:, 2 * j : 4 * j : 2] + t[:, 2 * j + 1 : 4 * j : 2]
    return t


def _kt(t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log block probability, next-bit-one probability) of nodes 1..255."""
    a, b = t[:, 2:512:2], t[:, 3:512:2]
    block = np.zeros_like(a)  # of nothing: probability 1
    seen = a + b > 0
    x, y = a[seen], b[seen]
    block[seen] = _log_gamma(x + 0.5) + _log_gamma(y + 0.5) - _log_gamma(x + y + 1) - math.log(math.pi)
    return block, (b + 0.5) / (a + b + 1)


def _leaves(ctx: np.ndarray, sym: np.ndarray, n: np.ndarray):
    """Of one two-byte context's cells: its three-byte contexts, their bit
    estimates (the last row: a context never seen), its own bit estimates,
    their weights, and its log weighted probability per node."""
    uniq, inv = np.unique(ctx, return_inverse=True)
    local = np.zeros((len(uniq) + 1, 256))
    np.add.at(local, (inv, sym), n)
    pe, p = _kt(_nodes(local))
    own_pe, own_p = _kt(_nodes(local.sum(0, keepdims=True)))
    half = math.log(0.5)
    pw = np.logaddexp(half + own_pe[0], half + pe.sum(0))
    return uniq, p, own_p[0], np.exp(half + own_pe[0] - pw), pw


def _upper(c1: np.ndarray, w2sum: np.ndarray):
    """(weights, bit estimates) of the one-byte contexts and of the empty one."""
    half = math.log(0.5)
    pe1, p1 = _kt(_nodes(c1))
    pw1 = np.logaddexp(half + pe1, half + w2sum)
    pe0, p0 = _kt(_nodes(c1.sum(0, keepdims=True)))
    return np.exp(half + pe1 - pw1), p1, np.exp(half + pe0[0] - np.logaddexp(half + pe0[0], half + pw1.sum(0))), p0[0]


def _bytes_of(p: np.ndarray) -> np.ndarray:
    """log10 of each byte's probability from the bit estimates [rows, 255]."""
    bits = np.arange(256)
    log1, log0 = np.log10(p), np.log10(1 - p)
    out = np.zeros((len(p), 256))
    for b in range(8):
        node = (1 << b) | (bits >> (8 - b))
        out += np.where((bits >> (7 - b)) & 1, log1[:, node - 1], log0[:, node - 1])
    return out.astype(np.float32)


def _predictions(leaves, one, upper) -> np.ndarray:
    """log10 probabilities [contexts + 1, 256]: all depths mixed along each path."""
    _, p, p2, beta2, _ = leaves
    beta1, p1, beta0, p0 = upper
    p = beta2 * p2 + (1 - beta2) * p
    p = beta1[one] * p1[one] + (1 - beta1[one]) * p
    return _bytes_of(beta0 * p0 + (1 - beta0) * p)


def build_tree(ctx: np.ndarray, sym: np.ndarray, n: np.ndarray):
    """Prediction rows from (three-byte context, byte, count) cells, in one
    process: (two-byte contexts, three-byte contexts, log10 probabilities
    [two-byte, then three-byte, then one-byte contexts, 256]).  ``predictions``
    does the same in Spark tasks."""
    two, three = np.unique(ctx & 0xFFFF), np.unique(ctx)
    c1, w2sum = np.zeros((256, 256)), np.zeros((256, 255))
    np.add.at(c1, (ctx & 0xFF, sym), n)
    groups = [_leaves(*(x[(ctx & 0xFFFF) == t] for x in (ctx, sym, n))) for t in two]
    for t, leaves in zip(two, groups, strict=True):
        w2sum[t & 0xFF] += leaves[-1]
    upper = _upper(c1, w2sum)
    table = np.zeros((len(two) + len(three), 256), np.float32)
    for i, leaves in enumerate(groups):
        rows = _predictions(leaves, two[i] & 0xFF, upper)
        table[i], table[len(two) + np.searchsorted(three, leaves[0])] = rows[-1], rows[:-1]
    beta1, p1, beta0, p0 = upper  # a two-byte context never seen: the one-byte and zero-byte estimates
    one = _bytes_of(beta0 * p0 + (1 - beta0) * (beta1 * p1 + (1 - beta1) * 0.5))
    return two.astype(np.int64), three.astype(np.int64), np.vstack([table, one])


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def _weigh(table: pa.Table) -> pa.Table:
    """(one-byte context, two-byte context, log weighted probabilities) of one two-byte context."""
    two = int(table.column("two")[0].as_py())
    pw = _leaves(_column(table, "ctx"), _column(table, "sym"), _column(table, "n").astype(float))[-1]
    return pa.table({"one": pa.array([two & 0xFF], pa.int64()), "two": pa.array([two], pa.int64()), "pw": pa.array([pw], pa.list_(pa.float64()))})


def _add_up(table: pa.Table) -> pa.Table:
    """The sum over a one-byte context's children, 256 at most, in their order."""
    order = np.argsort(_column(table, "two"))
    pw = np.stack(table.column("pw").to_pylist())[order].sum(0)
    return pa.table({"one": table.column("one")[:1], "pw": pa.array([pw], pa.list_(pa.float64()))})


def predictions(grams: DataFrame) -> DataFrame:
    """``grams(ctx, sym, n, common)``, a row for each (three-byte context, byte)
    of any text with its count in the training texts -> (ctx, row) of each
    common context and (key, value) of each other cell; key = ctx * 256 + sym."""
    grams = grams.withColumn("two", F.col("ctx").bitwiseAND(0xFFFF))
    c1, w2sum = np.zeros((256, 256)), np.zeros((256, 255))
    for r in grams.groupBy(F.col("ctx").bitwiseAND(0xFF).alias("one"), "sym").agg(F.sum("n").alias("n")).collect():  # 65,536 at most
        c1[r["one"], r["sym"]] = r["n"]
    weights = grams.select("two", "ctx", "sym", "n").groupBy("two").applyInArrow(_weigh, "one long, two long, pw array<double>")
    for r in weights.groupBy("one").applyInArrow(_add_up, "one long, pw array<double>").collect():  # 256 at most
        w2sum[r["one"]] = r["pw"]
    shared = grams.sparkSession.sparkContext.broadcast(_upper(c1, w2sum))

    def predict(table: pa.Table) -> pa.Table:
        ctx, sym, common = _column(table, "ctx"), _column(table, "sym"), _column(table, "common").astype(bool)
        leaves = _leaves(ctx, sym, _column(table, "n").astype(float))
        rows = _predictions(leaves, int(ctx[0]) & 0xFF, shared.value)
        at, rare = np.searchsorted(leaves[0], ctx), np.flatnonzero(~common)
        whole = np.unique(at[common])
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(whole) + 1) * 256, pa.int32()), pa.array(rows[whole].ravel(), pa.float32()))
        names = ["ctx", "row", "key", "value"]
        wide = [pa.array(leaves[0][whole], pa.int64()), lists, pa.nulls(len(whole), pa.int64()), pa.nulls(len(whole), pa.float32())]
        cells = [pa.nulls(len(rare), pa.int64()), pa.nulls(len(rare), lists.type), pa.array(ctx[rare] << 8 | sym[rare], pa.int64()), pa.array(rows[at[rare], sym[rare]], pa.float32())]
        return pa.concat_tables([pa.table(wide, names), pa.table(cells, names)])

    return grams.groupBy("two").applyInArrow(predict, "ctx long, row array<float>, key long, value float")


class Scorer:
    """Lookups of the common contexts' predictions (made once a worker)."""

    def __init__(self, three, table):
        self.table = np.vstack([np.zeros((1, 256), np.float32), table])
        self.row3 = np.zeros(1 << 24, np.uint16)  # 0: not common
        self.row3[three] = np.arange(1, len(three) + 1, dtype=np.uint16)

    def log10(self, data, off):
        """(sum over each text's bytes of common contexts, keys of the other bytes, their offsets)."""
        h = _history(data, off)
        row = self.row3[h]
        rare = np.flatnonzero(row == 0)
        return T.totals(self.table[row, data].astype(np.float64), off), h[rare].astype(np.int64) << 8 | data[rare], np.searchsorted(rare, off)


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte."""
    spark = docs.sparkSession
    fold = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), (fold == HELD).alias("held_out"))
    counted = rows.select("text", "held_out").mapInArrow(_count, "kind int, key long, n long")
    trained = F.sum(F.when(F.col("kind") < 2, F.col("n")).otherwise(0))
    counts = keep(counted.groupBy(F.least("kind", F.lit(1)).alias("kind"), "key").agg(trained.alias("n"), F.sum("n").alias("seen")), "lm-counts")
    words = counts.where("kind = 0").select("key", "n")
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    n_train, denominator = int(total["n"]), int(total["n"]) + int(total["v"]) + 1
    common = most_frequent(words, COMMON_WORDS).toPandas().sort_values("key")
    grams = counts.where("kind = 1").select(F.shiftright("key", 8).alias("ctx"), F.col("key").bitwiseAND(0xFF).alias("sym"), "n", "seen")
    often = most_frequent(grams.groupBy("ctx").agg(F.sum("seen").alias("n")), DEEP_CONTEXTS).select("ctx", F.lit(True).alias("common"))
    grams = grams.drop("seen").join(F.broadcast(often), "ctx", "left").withColumn("common", F.coalesce("common", F.lit(False)))
    values = keep(predictions(grams), "lm-predictions")
    wide = values.where("row IS NOT NULL").select("ctx", "row").toArrow().sort_by("ctx")  # DEEP_CONTEXTS rows at most
    table = wide.column("row").combine_chunks().flatten().to_numpy().reshape(-1, 256)
    shared = spark.sparkContext.broadcast((wide.column("ctx").to_numpy(), table, common["key"].to_numpy(np.int64), common["n"].to_numpy(np.int64)))
    holder: dict[str, Scorer] = {}

    def run(batches):
        three, table, keys, n = shared.value
        if "s" not in holder:
            holder["s"] = Scorer(three, table)
        logs = np.log10((n + 1) / denominator)
        for rows, data, off in T.chunks(batches):
            data = T.LOWER[data]
            wh, woff = _word_hashes(data, off)
            uniq, inv, cnt = np.unique(wh, return_inverse=True, return_counts=True)
            at = np.minimum(np.searchsorted(keys, uniq), max(len(keys) - 1, 0))
            hit = keys[at] == uniq if len(keys) else np.zeros(len(uniq), bool)
            value = np.where(hit, logs[at] if len(keys) else 0.0, 0.0)
            known = hit[inv]
            rare = np.flatnonzero(~known)
            roff = np.searchsorted(rare, woff)
            byte_score, byte_keys, boff = holder["s"].log10(data, off)
            yield pa.RecordBatch.from_arrays([
                rows.column("doc_id"), rows.column("held_out"), pa.array(np.diff(woff) + 1, pa.int64()), pa.array(np.diff(off), pa.int64()),
                pa.array(T.totals(known.astype(np.int64), woff)), pa.array(T.totals(value[inv], woff)), pa.array(byte_score),
                pa.ListArray.from_arrays(pa.array(roff.astype(np.int32)), pa.array(wh[rare])),
                pa.ListArray.from_arrays(pa.array(boff.astype(np.int32)), pa.array(byte_keys)),
            ], ["doc_id", "held_out", "n_tokens", "n_bytes", "common_known", "common_score", "common_bytes", "rare", "rare_bytes"])

    kind = dict(rows.dtypes)["doc_id"]
    scored = rows.mapInArrow(
        run,
        f"doc_id {kind}, held_out boolean, n_tokens long, n_bytes long, common_known long, common_score double, common_bytes double, rare array<long>, rare_bytes array<long>",
    ).withColumn("row", F.monotonically_increasing_id())
    scored = keep(scored, "lm-scores")
    word_values = words.select(F.lit(0).alias("kind"), "key", F.log10((F.col("n") + 1) / F.lit(float(denominator))).alias("value"))
    byte_values = values.where("row IS NULL").select(F.lit(1).alias("kind"), "key", F.col("value").cast("double").alias("value"))
    pairs = [scored.select("row", F.lit(k).alias("kind"), F.explode(c).alias("key")) for k, c in enumerate(("rare", "rare_bytes"))]
    pairs = pairs[0].union(pairs[1]).join(word_values.union(byte_values), ["kind", "key"])
    of = lambda k, x: F.when(F.col("kind") == k, x)
    part = pairs.groupBy("row").agg(F.sum(of(0, F.col("value"))).alias("s"), F.count(of(0, F.lit(1))).alias("k"), F.sum(of(1, F.col("value"))).alias("b"))
    out = scored.drop("rare", "rare_bytes").join(part, "row", "left").withColumn("score", F.col("common_bytes") + F.coalesce("b", F.lit(0.0)))
    end_n = words.where(F.col("key") == END).agg(F.max("n")).first()[0] or 0
    unseen = -math.log10(denominator)
    known = F.col("common_known") + F.coalesce("k", F.lit(0))
    base = F.col("common_score") + F.coalesce("s", F.lit(0.0)) + (F.col("n_tokens") - 1 - known) * F.lit(unseen) + F.lit(math.log10((end_n + 1) / denominator))
    return out.select(
        "doc_id", "held_out", "n_tokens", (known + int(end_n > 0)).cast("long").alias("n_known"), F.lit(n_train).cast("long").alias("train_tokens"),
        base.alias("base_score"), "score", (-F.col("score") / math.log10(2) / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"),
    )
