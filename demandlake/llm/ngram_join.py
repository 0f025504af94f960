"""N-gram Jaccard self-join with adaptive multi-match prefixes.

Texts become sets of word 5-grams (64-bit hashes).  Under one global token
order, two sets of Jaccard similarity t or more share at least l tokens
within their l-prefixes, the first ``n - ceil(t n) + l`` tokens, for every l.
Each set picks its own l: a longer prefix costs more index entries, but asks
for l matches before a pair is verified; both costs are estimated from the
lengths of the set's own index lists.  A pair is a candidate if it shares
``min(l_x, l_y)`` tokens that belong to both prefixes of that level.

The order puts common tokens last: tokens that texts read together share are
counted over the whole corpus, and a table of ``CELLS`` cells holds the
largest count class of the tokens that fall into each; equal classes go by
hash.  Any order gives the same result; this one keeps a passage that many
documents share out of the prefixes.

Sets that are equal form one class, indexed once.  A token's members are not
paired with each other: in each round a member is compared with the token's
hash-chosen centres, verified links are contracted to components, and only
lists that still hold several components go on.  What remains is compared
exactly, in blocks: the sets outside a list's largest component against every
set of another component that shares enough tokens with their block.
No partner or candidate is dropped, so the components are those of all links.

Defined results: null or empty text has no set and is linked with nothing;
with fewer than five words the whole sequence is the one shingle; a
component's id is its smallest doc_id (null only if all are null); repeated
rows fall into one class; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandlake.llm import textops as T
from demandlake.llm.tables import forget, keep, located, without

SHINGLE = 5
SIM = (75, 100)  # 100 * intersection >= 75 * union
MAX_LEVEL = 16
#: Cells of the table of count classes, a byte each.
CELLS = 1 << 21
CENTRES = 2
ROUNDS = 2
#: Bytes of text handled at once, and over which the survey counts shared tokens.
CHUNK = 512 << 10
SURVEY = 2 << 20
#: Tokens of the queries of one block, and of the sets of one shard that it meets.
BLOCK_TOKENS = 1 << 17
SHARD_TOKENS = 1 << 18
#: Shared tokens, and pairs, that a block counts in one step.
STEP = 4 << 20
#: Bits of the filter that spares the texts of unneeded sets a shuffle.
FILTER_BITS = 1 << 23


def shingles(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first shingle of each text) of the distinct shingles of each
    text, texts in order; a text of one to four words has one shingle."""
    data = T.LOWER[data]
    start, end, woff = T.words(data, off)
    wh = T.span_hash(T.prefix_hash(data), start, end)
    h, _, doc = T.windows(wh, woff, SHINGLE)
    size = np.diff(woff)
    short = np.flatnonzero((size > 0) & (size < SHINGLE))
    if len(short):
        extra = np.zeros(len(short), np.uint64)
        for j in range(SHINGLE - 1):
            has = size[short] > j
            extra[has] = extra[has] * T.U(0xD1342543DE82EF95) + wh[woff[short[has]] + j]
        extra = T.mix(extra + size[short].astype(np.uint64))
        h, doc = np.r_[h, extra], np.r_[doc, short]
        o = np.argsort(doc, kind="stable")
        h, doc = h[o], doc[o]
    first = ~T.later(T.per_text(h, doc))
    h, doc = h[first], doc[first]
    return h, np.searchsorted(doc, np.arange(len(off)))


def _survey(batches):
    """Two kinds of rows: a text's set size and digest (token null), and the
    tokens that several texts of SURVEY bytes share, with their number of texts."""
    held, size = [], 0
    for rows, data, off in T.chunks(batches, limit=CHUNK):
        h, soff = shingles(data, off)
        d1, d2 = _digests(h, soff)
        ids = rows.column("doc_id")
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(np.diff(soff).astype(np.int64)), pa.array(d1), pa.array(d2), rows.column("th"), pa.nulls(len(ids), pa.int64())], _SURVEY
        )
        held.append(h)
        size += len(data)
        if size >= SURVEY:
            yield _often(held, ids.type)
            held, size = [], 0
    if held:
        yield _often(held, ids.type)


def _often(held: list[np.ndarray], kind: pa.DataType) -> pa.RecordBatch:
    h = np.sort(np.concatenate(held))
    first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]][: len(h)])
    n = np.diff(np.r_[first, len(h)])
    many = n > 1
    zero = pa.array(np.zeros(int(many.sum()), np.int64))
    return pa.RecordBatch.from_arrays([pa.nulls(len(zero), kind), pa.array(n[many].astype(np.int64)), zero, zero, zero, pa.array(h[first][many].view(np.int64))], _SURVEY)


_SURVEY = ["doc_id", "n", "d1", "d2", "th", "token"]


def needed(n):
    """Tokens that a set of n must share at least with any partner."""
    return -(-SIM[0] * n // SIM[1])


def _digests(h: np.ndarray, soff: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each set, whatever the order of its tokens."""
    return T.totals(T.mix(h), soff).view(np.int64), T.totals(T.mix(h ^ T.U(0xA5A5A5A5A5A5A5A5)), soff).view(np.int64)


def _count_classes(counted: DataFrame) -> np.ndarray:
    """The largest class of ``n`` (quarters of powers of two) among the tokens
    of each cell; CELLS / 8 rows come to the driver at most."""
    cls = F.least(F.lit(127), F.floor(F.log2(F.col("n").cast("double")) * 4)).cast("long")
    cell = counted.groupBy(F.col("token").bitwiseAND(CELLS - 1).alias("cell")).agg(F.max(cls).alias("c"))
    eight = F.bit_or(F.expr("shiftleft(c, CAST((cell & 7) * 8 AS INT))"))
    got = cell.groupBy(F.shiftright("cell", 3).alias("at")).agg(eight.alias("w")).toPandas()
    words = np.zeros(CELLS // 8, np.int64)
    words[got["at"].to_numpy(np.int64)] = got["w"].to_numpy(np.int64)
    return words.view(np.uint8)


def _prefixes(classes: np.ndarray):
    """Texts -> size, digest and the longest prefix that any level may need."""

    def run(batches):
        for _, data, off in T.chunks(batches, limit=CHUNK):
            h, soff = shingles(data, off)
            order = classes[h & T.U(CELLS - 1)].astype(np.uint64) << T.U(56) | h >> T.U(8)
            d1, d2 = _digests(h, soff)
            size, signed = np.diff(soff), h.view(np.int64)
            lens = np.where(size > 0, size - needed(size) + np.minimum(MAX_LEVEL, needed(size)), 0)
            parts = [signed[a:z][np.argsort(order[a:z])[:k]] for a, z, k in zip(soff[:-1], soff[1:], lens, strict=True) if k]
            tokens = np.concatenate(parts) if parts else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(lens)].astype(np.int32)), pa.array(tokens))
            yield pa.RecordBatch.from_arrays([pa.array(size.astype(np.int64)), pa.array(d1), pa.array(d2), lists], ["n", "d1", "d2", "prefix"])

    return run


def _sets(wanted: np.ndarray):
    """Texts whose hash may be wanted (a bit array; false hits only cost
    work) -> their whole sets.  Other texts are left out unread."""
    bits = np.unpackbits(wanted.view(np.uint8), bitorder="little").astype(bool)

    def picked(batches):
        for b in batches:
            th = b.column("th").to_numpy(zero_copy_only=False)
            yield b.filter(pa.array(bits[th & (FILTER_BITS - 1)] & bits[(th >> 32) & (FILTER_BITS - 1)]))

    def run(batches):
        for _, data, off in T.chunks(picked(batches), limit=CHUNK):
            h, soff = shingles(data, off)
            d1, d2 = _digests(h, soff)
            lists = pa.ListArray.from_arrays(pa.array(soff.astype(np.int32)), pa.array(h.view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(np.diff(soff).astype(np.int64)), pa.array(d1), pa.array(d2), lists], ["n", "d1", "d2", "tokens"])

    return run


def _shared(ask: np.ndarray, asker: np.ndarray, askers: int, met: np.ndarray, row: np.ndarray, rows: int, valid=None):
    """(query, met set, shared tokens) of the pairs that share some, in steps
    of bounded size.  ``row`` ascends; ``valid`` tells of (index in ``ask``,
    index in ``met``) whether a shared token counts."""
    if not len(ask):
        return
    o = np.argsort(ask, kind="stable")
    token = ask[o]
    first = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
    held, vocab = np.diff(np.r_[first, len(token)]), token[first]
    at = np.searchsorted(vocab, met)
    at[at == len(vocab)] = 0
    hit = np.flatnonzero(vocab[at] == met)
    at, row = at[hit], row[hit]
    start = np.searchsorted(row, np.arange(rows + 1))
    cost = np.r_[0, np.cumsum(held[at])][start]
    a, most = 0, max(1, STEP // askers)
    while a < rows:
        z = int(np.searchsorted(cost, cost[a] + STEP, "right")) - 1
        z = min(max(z, a + 1), a + most, rows)
        part = slice(start[a], start[z])
        k = held[at[part]]
        entry = o[np.repeat(first[at[part]], k) + np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)]
        pair = np.repeat(row[part] - a, k) * askers + asker[entry]
        if valid is not None:
            pair = pair[valid(entry, np.repeat(hit[part], k))]
        count = np.bincount(pair, minlength=1)
        pair = np.flatnonzero(count)
        yield pair % askers, a + pair // askers, count[pair]
        a = z


def _candidates(table: pa.Table) -> pa.Table:
    """The listed tokens of a block's queries and of one shard -> the queries
    and sets that share enough with one another, by ``_Join.enough``."""
    block = table.column("block")[0].as_py()
    col = {c: table.column(c).to_numpy() for c in ("query", "cid", "comp", "n", "level", "token", "at")}
    side = []
    for mine in (col["query"], ~col["query"]):
        at = np.flatnonzero(mine)
        at = at[np.argsort(col["cid"][at], kind="stable")]
        cid, first, row = np.unique(col["cid"][at], return_index=True, return_inverse=True)
        side.append((at, cid, row, *[col[c][at][first].astype(np.int64) for c in ("comp", "n", "level")]))
    (qa, qid, qrow, qcomp, qn, qlevel), (ma, mid, mrow, mcomp, mn, mlevel) = side
    place = col["at"].astype(np.int64)

    def valid(i, j):
        return np.maximum(place[qa[i]], place[ma[j]]) <= np.minimum(qlevel[qrow[i]], mlevel[mrow[j]])

    some_q, some_m = np.zeros(len(qid), bool), np.zeros(len(mid), bool)
    for x, y, shared in _shared(col["token"][qa], qrow, len(qid), col["token"][ma], mrow, len(mid), valid):
        small, large, level = np.minimum(qn[x], mn[y]), np.maximum(qn[x], mn[y]), np.minimum(qlevel[x], mlevel[y])
        overlap = -(-(small + large) * SIM[0] // (SIM[0] + SIM[1]))
        behind = needed(large) - level
        ok = (qcomp[x] != mcomp[y]) & (small * SIM[1] >= large * SIM[0]) & (shared >= np.maximum(level, overlap - behind))
        some_q[x[ok]] = True
        some_m[y[ok]] = True
    cid, comp = np.r_[qid[some_q], mid[some_m]], np.r_[qcomp[some_q], mcomp[some_m]]
    n = np.r_[qn[some_q], mn[some_m]]
    query = np.arange(len(cid)) < some_q.sum()
    return pa.table({"block": pa.array(np.full(len(cid), block, np.int64)), "cid": cid, "comp": comp, "n": n, "query": query})


def _compare(table: pa.Table) -> pa.Table:
    """A block's queries against one shard: (x, y) of components that links
    join, in stars: fewer rows than components, whatever the number of links."""
    query, cid, comp = (table.column(c).to_numpy() for c in ("query", "cid", "comp"))
    lists = table.column("tokens").combine_chunks()
    size, flat = lists.value_lengths().to_numpy().astype(np.int64), lists.flatten().to_numpy()
    owner = np.repeat(np.arange(len(size)), size)
    asks = query[owner]
    xs, ys = np.flatnonzero(query), np.flatnonzero(~query)
    joined = [np.zeros((0, 2), np.int64)]
    for x, y, i in _shared(flat[asks], (np.cumsum(query) - 1)[owner[asks]], len(xs), flat[~asks], (np.cumsum(~query) - 1)[owner[~asks]], len(ys)):
        x, y = xs[x], ys[y]
        similar = (SIM[1] * i >= SIM[0] * (size[x] + size[y] - i)) & (comp[x] != comp[y])
        joined.append(np.unique(np.column_stack([comp[x[similar]], comp[y[similar]]]), axis=0))
    node, at = np.unique(np.concatenate(joined), return_inverse=True)
    x, y = at.reshape(-1, 2).T
    root = np.arange(len(node))
    while (root[x] != root[y]).any():
        np.minimum.at(root, np.maximum(root[x], root[y]), np.minimum(root[x], root[y]))
        while (root[root] != root).any():
            root = root[root]
    far = np.flatnonzero(root != np.arange(len(node)))
    return pa.table({"x": pa.array(node[far]), "y": pa.array(node[root[far]])})


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) of all nodes of ``edges(x, y)``; comp is the smallest node.
    Roots hook to smaller roots, chains are halved, edges are contracted:
    the tables shrink in every turn, and nothing is collected."""
    label = keep(edges.select(F.explode(F.array("x", "y")).alias("node")).distinct().withColumn("comp", F.col("node")), "labels")
    e = edges
    while True:
        hook = keep(
            e.where("x != y").groupBy(F.greatest("x", "y").alias("from")).agg(F.min(F.least("x", "y")).alias("to")), "hooks"
        )
        if hook.isEmpty():
            return label
        while True:  # pointer jumping: every root learns its final root
            up = hook.select(F.col("from").alias("to"), F.col("to").alias("above"))
            moved = keep(hook.join(up, "to", "left").select("from", F.coalesce("above", "to").alias("to"), F.col("above").isNotNull().alias("moved")), "hooks")
            hook = moved.select("from", "to")
            if moved.where("moved").isEmpty():
                break
        new = hook.select(F.col("from").alias("comp"), "to")
        label = keep(label.join(new, "comp", "left").select("node", F.coalesce("to", "comp").alias("comp")), "labels")
        for end in ("x", "y"):
            e = e.join(hook.select(F.col("from").alias(end), "to"), end, "left").withColumn(end, F.coalesce("to", end)).drop("to")
        e = keep(e.where("x != y").distinct(), "edges")


class _Join:
    """The state of one join: classes, token lists, verified links."""

    def __init__(self, docs: DataFrame):
        text = F.col("text").cast("string")
        self.texts = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("th"))
        kind = dict(docs.dtypes)["doc_id"]
        seen = keep(self.texts.mapInArrow(_survey, f"doc_id {kind}, n long, d1 long, d2 long, th long, token long").withColumn("row", F.monotonically_increasing_id()), "survey")
        self.rows = seen.where("token IS NULL").drop("token")
        run = _prefixes(_count_classes(seen.where("token IS NOT NULL").groupBy("token").agg(F.sum("n").alias("n"))))
        key = ["n", "d1", "d2"]
        cls = self.rows.where("n > 0").groupBy(*key).agg(F.min("row").alias("cid"), F.min("th").alias("th"), F.count(F.lit(1)).alias("copies"))
        self.classes = keep(cls, "classes")
        prefix = self.texts.select("text").mapInArrow(run, "n long, d1 long, d2 long, prefix array<long>").where("n > 0")
        prefix = prefix.groupBy(*key).agg(F.first("prefix").alias("prefix")).join(self.classes, key).select("cid", "n", "prefix")
        first = F.col("n") - F.ceil(F.col("n") * SIM[0] / SIM[1])  # tokens of level 0
        entry = prefix.select("cid", "n", first.alias("first"), F.posexplode("prefix").alias("pos", "token"))
        entry = entry.select("token", "cid", (F.col("n") * 64 + F.greatest(F.lit(1), F.col("pos") + 1 - F.col("first"))).alias("pack"))
        entry = entry.withColumn("m", F.count(F.lit(1)).over(Window.partitionBy("token"))).where("m > 1")
        lists = keep(entry.select("token", "cid", F.floor(F.col("pack") / 64).cast("int").alias("n"), (F.col("pack") % 64).cast("int").alias("at"), "m"), "all-lists")
        self.lists, self.written = self.with_level(lists), lists
        self.links = None
        self.label = None

    @staticmethod
    def with_level(lists: DataFrame) -> DataFrame:
        """Each set's level of least estimated cost, and its entries up to that
        level.  The entries of level l name ``probes`` partners; a pair needs l
        of them, so about ``probes / l`` pairs are verified, each at n tokens."""
        probes = [F.sum(F.when(F.col("at") <= i, F.col("m") - 1).otherwise(0)) for i in range(1, MAX_LEVEL + 1)]
        level = range(1, MAX_LEVEL + 1)
        lists = lists.repartition("cid")  # one exchange for the sums and the join; a set's entries are bounded by its text
        own = lists.groupBy("cid").agg(F.first("n").alias("n"), F.array(*probes).alias("p"))
        least = F.ceil(F.col("n") * SIM[0] / SIM[1])
        cost = F.array(*[F.when(least >= i, F.col("p")[i - 1] * (1 + F.col("n") / i)).otherwise(F.lit(float("inf"))) for i in level])
        best = own.select("cid", cost.alias("cost")).select("cid", F.array_position("cost", F.array_min("cost")).cast("int").alias("level"))
        return lists.drop("m").join(best, "cid").where("at <= level")

    def open_lists(self) -> DataFrame:
        """The entries that can still matter, each with its set's component: in
        lists that hold several components, and of sets with as many such
        entries as a pair needs."""
        # what one call drops, merged components leave dropped: the next call goes on from here
        own = self.lists
        if self.label is None:
            own = own.withColumn("comp", F.col("cid"))
        else:
            own = own.join(self.label.withColumnRenamed("node", "cid"), "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
        by_token, by_set = Window.partitionBy("token"), Window.partitionBy("cid")
        held = own.select("*", F.min("comp").over(by_token).alias("a"), F.max("comp").over(by_token).alias("b"), F.min("level").over(by_token).alias("least"))
        have = held.where("a != b").drop("a", "b").withColumn("have", F.count(F.lit(1)).over(by_set))
        own = keep(have.where("have >= least(level, least)").drop("have", "least"), "open-lists")
        forget(self.written)
        self.lists, self.written = own.drop("comp"), own
        return own

    @staticmethod
    def enough(pairs: DataFrame) -> DataFrame:
        """(x, y, shared) of pairs that share enough prefix tokens, from a row
        per shared token (cid/n/level/at of both sides).  With l the smaller
        level, at least l tokens of level l; and as many as are missing if
        all tokens behind one of the prefixes were shared too."""
        fits = (F.least("n", "n2") * SIM[1] >= F.greatest("n", "n2") * SIM[0]) & (F.greatest("at", "at2") <= F.least("level", "level2"))
        sizes = [F.least("n", "n2").alias("small"), F.greatest("n", "n2").alias("large"), F.least("level", "level2").alias("l")]
        key = [F.least("cid", "cid2").alias("x"), F.greatest("cid", "cid2").alias("y"), *sizes]
        overlap = F.ceil((F.col("small") + F.col("large")) * SIM[0] / (SIM[0] + SIM[1]))
        behind = F.ceil(F.col("large") * SIM[0] / SIM[1]) - F.col("l")
        most = F.greatest(F.col("l"), overlap - behind)
        return pairs.where(fits).groupBy(*key).agg(F.count(F.lit(1)).alias("shared")).where(F.col("shared") >= most).select("x", "y", "shared")

    def star_pairs(self, lists: DataFrame, seed: int) -> DataFrame:
        """Each member against its best-sharing centre: linear in the lists."""
        names = ["cid", "n", "level", "at", "comp"]
        centres = [F.min(F.struct(F.xxhash64(F.lit(seed + i), "cid").alias("h"), *names)).alias(f"c{i}") for i in range(CENTRES)]
        picked = lists.groupBy("token").agg(*centres)
        both = lists.join(picked, "token").withColumn("c", F.explode(F.array_distinct(F.array(*[F.col(f"c{i}") for i in range(CENTRES)]))))
        both = both.where("comp != c.comp").select("cid", "n", "level", "at", *[F.col(f"c.{x}").alias(f"{x}2") for x in names[:-1]])
        member = self.enough(both)
        one = member.select("x", "y", "shared", F.explode(F.array("x", "y")).alias("m"))
        best = one.groupBy("m").agg(F.max(F.struct("shared", "x", "y")).alias("b"))
        return best.select("b.x", "b.y").distinct()

    def sets_of(self, wanted: DataFrame) -> DataFrame:
        """(cid, n, tokens) of the wanted classes, from one more pass over the texts."""
        cls = keep(self.classes.join(wanted.select("cid").distinct(), "cid").select("cid", "n", "d1", "d2", "th"), "wanted-sets")
        bit = cls.select(F.explode(F.array("th", F.shiftright("th", 32))).alias("d")).select(F.col("d").bitwiseAND(FILTER_BITS - 1).alias("bit"))
        one = F.expr("shiftleft(1L, CAST(bit & 63 AS INT))")
        got = bit.groupBy(F.shiftright("bit", 6).alias("at")).agg(F.bit_or(one).alias("w")).toPandas()  # FILTER_BITS / 64 rows at most
        words = np.zeros(FILTER_BITS // 64, np.int64)
        words[got["at"].to_numpy(np.int64)] = got["w"].to_numpy(np.int64)
        sets = self.texts.select("text", "th").mapInArrow(_sets(words), "n long, d1 long, d2 long, tokens array<long>")
        key = ["n", "d1", "d2"]  # of the join and of the copies, so that whole sets are shuffled once
        return keep(sets.join(cls.drop("th"), key).dropDuplicates(key).select("cid", "n", "tokens"), "sets")

    def verify(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose whole sets are similar enough."""
        pairs = keep(pairs, "pairs")
        sets = self.sets_of(pairs.select(F.explode(F.array("x", "y")).alias("cid")))
        left = pairs.join(sets.select(F.col("cid").alias("x"), F.col("n").alias("nx"), F.col("tokens").alias("sx")), "x")
        both = left.join(sets.select(F.col("cid").alias("y"), F.col("n").alias("ny"), F.col("tokens").alias("sy")), "y")
        inter = F.size(F.array_intersect("sx", "sy"))
        links = keep(both.select("x", "y", "nx", "ny", inter.alias("i")).where(f"{SIM[1]} * i >= {SIM[0]} * (nx + ny - i)").select("x", "y"), "links")
        forget(pairs, sets)
        return links

    @staticmethod
    def families(lists: DataFrame) -> DataFrame:
        """(cid, family, home): a family is all sets that lists connect; home
        is the least set of most of a set's lists."""
        least = lists.groupBy("token").agg(F.min("cid").alias("y"))
        near = keep(lists.join(least, "token").groupBy("cid", "y").agg(F.count(F.lit(1)).alias("k")), "near-sets")
        home = near.groupBy("cid").agg(F.max(F.struct("k", "y")).alias("h")).select("cid", F.col("h.y").alias("home"))
        family = components(near.select(F.col("cid").alias("x"), "y"))
        return home.join(family.select(F.col("node").alias("cid"), F.col("comp").alias("family")), "cid")

    def block_links(self, lists: DataFrame) -> DataFrame:
        """(x, y) of components that links left open join, as nodes of
        ``components``: enough of them to join all that are linked.

        The queries are the sets outside the largest component of one of their
        lists: every open pair has one.  Queries of one family are dealt to
        blocks of bounded size, so a token's list is met by its family's
        blocks and no others; the sets that a block meets are dealt to shards
        of bounded size.  First the listed tokens meet, then the whole sets of
        those that share enough of them with one of the other side."""
        size = lists.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("k"))
        main = size.groupBy("token").agg(F.max(F.struct("k", "comp")).alias("m"), F.sum("k").alias("held")).select("token", F.col("m.comp").alias("main"), "held")
        out = lists.join(main, "token").where("comp != main")
        query = out.groupBy("cid").agg(F.first("n").alias("n")).join(self.families(lists), "cid")
        query = keep(query, "queries")
        total = query.agg(F.sum("n")).first()[0] or 0
        size = query.groupBy("family", "home").agg(F.sum("n").alias("at_home")).withColumn("tokens", F.sum("at_home").over(Window.partitionBy("family")))
        # a family within a block's size goes to one; a larger one is dealt by home, a larger home by set
        by_home = F.xxhash64("family", F.pmod(F.xxhash64("home"), F.ceil(F.col("tokens") / BLOCK_TOKENS)))
        by_set = F.xxhash64("family", "home", F.pmod(F.xxhash64("cid"), F.ceil(F.col("at_home") / BLOCK_TOKENS)))
        small = F.pmod(F.xxhash64("family"), F.lit(1 + total // BLOCK_TOKENS))
        block = F.when(F.col("tokens") <= BLOCK_TOKENS, small).when(F.col("at_home") <= BLOCK_TOKENS, by_home).otherwise(by_set)
        query = keep(query.join(size, ["family", "home"]).select("cid", "n", block.alias("block")), "blocks")

        entry = ["cid", "comp", "n", "level", "token", "at"]
        own = lists.join(query.select("cid", "block"), "cid")
        met = lists.join(own.select("token", "block").distinct(), "token").select("block", *entry)
        dealt = met.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / SHARD_TOKENS).cast("int").alias("shards"))
        found = keep(self.in_shards(own.select("block", *entry), met, keep(dealt, "shards")).groupBy("block", "shard").applyInArrow(_candidates, "block long, cid long, comp long, n long, query boolean"), "met")
        found = found.distinct()

        asks, met = found.where("query"), found.where("NOT query")
        dealt = met.groupBy("block").agg(F.ceil(F.sum("n") / SHARD_TOKENS).cast("int").alias("shards"))
        sets = self.sets_of(found)
        both = self.in_shards(asks.drop("query", "n"), met.drop("query", "n"), keep(dealt, "shards")).join(sets.select("cid", "tokens"), "cid")
        links = keep(both.groupBy("block", "shard").applyInArrow(_compare, "x long, y long"), "links")
        forget(found, sets)
        return links

    @staticmethod
    def in_shards(queries: DataFrame, met: DataFrame, shards: DataFrame) -> DataFrame:
        """The queries of a block in all its shards, each met set in one."""
        left = queries.join(shards, "block").withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
        right = met.join(shards, "block").withColumn("shard", F.pmod(F.xxhash64("cid"), F.col("shards")).cast("int"))
        return left.withColumn("query", F.lit(True)).unionByName(right.withColumn("query", F.lit(False))).drop("shards")

    def add(self, links: DataFrame) -> bool:
        """Contract new links; false if there are none."""
        if links.isEmpty():
            return False
        self.links = links if self.links is None else self.links.unionByName(links)
        self.label = components(self.links)
        return True

    def run(self) -> DataFrame:
        """(row, doc_id, n, comp): comp names the component by a row of it."""
        for r in range(ROUNDS):
            if not self.add(self.verify(self.star_pairs(self.open_lists(), 1 + r * CENTRES))):
                break
        self.add(self.block_links(self.open_lists()))
        cls = self.classes.select("cid", "n", "d1", "d2", "copies")
        if self.label is None:
            cls = cls.withColumn("comp", F.col("cid"))
        else:
            cls = cls.join(self.label.withColumnRenamed("node", "cid"), "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
        joint = cls.where("copies > 1 OR comp != cid").select("n", "d1", "d2", "comp")
        own = self.rows.select("row", "doc_id", "n", "d1", "d2").join(joint, ["n", "d1", "d2"], "left")
        return own.select("row", "doc_id", "n", F.coalesce("comp", "row").alias("comp"))


def join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id."""
    found = keep(_Join(docs).run(), "components")
    least = found.groupBy("comp").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("k")).where("k > 1").drop("k")
    out = found.join(least, "comp", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component (the smallest doc_id; of rows repeated
    under it, one), with its own columns."""
    held = located(docs, "join-input")
    own, text = (F.col(f"c{docs.columns.index(c)}") for c in ("doc_id", "text"))
    # the join names documents by the row's locator, which is unique and never null
    found = keep(_Join(held.select(F.col("row").alias("doc_id"), text.alias("text"))).run(), "components")
    ids = held.select(F.col("row").alias("doc_id"), own.alias("id"))
    first = found.join(ids, "doc_id").groupBy("comp").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "doc_id")).alias("m"), F.count(F.lit(1)).alias("k"))
    first = first.where("k > 1").select("comp", F.col("m.doc_id").alias("stays"))
    lost = found.join(first, "comp").where("doc_id != stays").select(F.col("doc_id").alias("row"))
    return without(docs, held, lost, "join-lost")
