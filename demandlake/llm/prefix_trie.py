"""Prefix trie of conversations: ternary search trees per range shard.

A conversation is the sequence of its turns (role, text), given by 16-byte
digests; each distinct prefix is a node.  Spark sorts the sequences by ranges,
so a shard (at most ``SHARD_TURNS`` turns of neighbouring sequences) shares
nodes with other shards only on the paths of its first and its last sequence.

In a shard, turns are dictionary-encoded to small ids in digest order, and its
distinct sequences go into a ternary search tree, the median first, then the
medians of both halves, and so on, which keeps the tree balanced.  One
iterative traversal, children before parents, accumulates members, children,
leaves and saved tokens.  Nodes off the two border paths are final.  The
border paths, with what their nodes have gathered, are the sequences of the
next level, which is sorted and cut into shards again, until one shard holds
all.  A border node's members that end there are written as chunks of ids,
in order, and hashed in a stream.

Defined results: rows without a conv_id belong to no conversation and are left
out; a null role or text is empty; turns go by turn (null first), then role,
then digest; repeated rows are turns of their own; other columns are not read;
an empty table gives an empty result.  Texts of any length are read whole, and
only their digests move.  One conversation's digests (24 bytes a turn) must
fit a task; its texts need not.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlake.llm.tables import keep, n_words, ship, text_or_empty

#: Turns of one ternary search tree (and one task's memory).
SHARD_TURNS = 1 << 16
#: A shard holds this many sequences at least (8 or more), so every level shrinks.
SHARD_PATHS = 8
#: Copies of a border node's row, to which its children are dealt.
SALTS = 16
NONE = hashlib.sha256(b"").hexdigest()

OUT = """
    node struct<conv_id:long,depth:long,parent_conv_id:long,n_convs:long,n_children:long,n_leaves:long,saved_tokens:long,ends_sha256:string,
                key:binary,parent_key:binary>,
    path struct<seq:array<binary>,words:array<long>,convs:array<long>,least:array<long>,children:array<long>,leaves:array<long>,saved:array<long>>,
    ends struct<key:binary,first:long,ids:string>
"""


# ------------------------------------------------------------ sequences

def sequences(conversations: DataFrame, block: int = 20) -> DataFrame:
    """conv_id, base (conv_id - conv_id % block) and ``turns`` (digest,
    words) in order; all of a block's conversations in one partition."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    # the role's length keeps (role, text) apart from other splits of the same letters
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text_or_empty())))
    conv = F.col("conv_id").cast("long")
    turns = conversations.where("conv_id IS NOT NULL").select(
        conv.alias("conv_id"), (conv - conv % block).alias("base"),
        F.struct(F.col("turn"), role.alias("role"), digest.alias("digest"), n_words(text_or_empty()).alias("words")).alias("t"),
    )
    one = turns.repartition("base").groupBy("base", "conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return one.select("conv_id", "base", F.transform("t", lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words"))).alias("turns"))


def borrowed_heads(seqs: DataFrame, most: int = 3) -> DataFrame:
    """Each conversation with its first h turns replaced by those of its
    base, h = crc32(decimal conv_id) % (most + 1)."""
    heads = seqs.where("conv_id = base").select("base", F.slice("turns", 1, most).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).cast("int")
    own = F.slice("turns", h + 1, F.size("turns") + 1)
    head = F.coalesce(F.slice("head", F.lit(1), h), F.slice("turns", 1, 0))
    return seqs.join(heads, "base", "left").select("conv_id", F.concat(head, own).alias("turns"))


# ------------------------------------------------------------ one shard

class TernaryTree:
    """Ternary search tree over sequences of small integers.

    ``lo``/``hi`` lead to other turns at the same depth, ``eq`` one turn
    deeper.  Node 0 is the textless root, above the tree's first turn; every
    other node stands for one prefix.  ``parent`` is the prefix without its
    last turn, which always has a smaller number."""

    def __init__(self):
        self.turn, self.lo, self.eq, self.hi, self.parent, self.depth = [-1], [0], [0], [0], [0], [0]

    def _new(self, turn: int, parent: int) -> int:
        for column, value in ((self.turn, turn), (self.lo, 0), (self.eq, 0), (self.hi, 0), (self.parent, parent), (self.depth, self.depth[parent] + 1)):
            column.append(value)
        return len(self.turn) - 1

    def insert(self, sequence) -> list[int]:
        """The nodes of all prefixes, root first."""
        path, at = [0], 0
        for turn in sequence:
            here = self.eq[at]
            if not here:
                here = self.eq[at] = self._new(turn, at)
            while turn != self.turn[here]:
                side = self.lo if turn < self.turn[here] else self.hi
                if not side[here]:
                    side[here] = self._new(turn, at)
                here = side[here]
            path.append(here)
            at = here
        return path


def median_order(n: int) -> list[int]:
    """0..n-1, the median first, then the medians of both halves, ..."""
    out, spans = [], [(0, n)]
    for lo, hi in spans:
        if lo < hi:
            mid = (lo + hi) // 2
            out.append(mid)
            spans += [(lo, mid), (mid + 1, hi)]
    return out


class Shard:
    """Rows of neighbouring sequences, sorted, to final nodes, two border
    paths and the border's ends.  ``level`` 0 takes (conv_id, seq, words),
    later ones the paths of the level before; ``top`` has no border."""

    def __init__(self, level: int, top: bool):
        self.level, self.top = level, top

    def run(self, rows: list[dict]):
        ids = {d: i for i, d in enumerate(sorted({d for r in rows for d in r["seq"]}))}
        runs: list[tuple[tuple[int, ...], list[dict]]] = []
        for r in rows:
            seq = tuple(ids[d] for d in r["seq"])
            if runs and runs[-1][0] == seq:
                runs[-1][1].append(r)
            else:
                runs.append((seq, [r]))
        tree, paths = TernaryTree(), [[] for _ in runs]
        for i in median_order(len(runs)):
            paths[i] = tree.insert(runs[i][0])
        size = len(tree.turn)
        convs, least, children, leaves, saved, words = ([0] * size for _ in range(6))
        least = [None] * size
        ends: dict[int, list[int]] = {}
        for (_, copies), path in zip(runs, paths, strict=True):
            for node, w in zip(path[1:], copies[0]["words"], strict=True):
                words[node] = w
            if self.level == 0:
                own = [r["conv_id"] for r in copies]
                ends[path[-1]] = own
                low = min(own)
                for node in path:
                    convs[node] += len(own)
                    least[node] = low if least[node] is None else min(least[node], low)
                continue
            for r in copies:
                for d, node in enumerate(path):
                    convs[node] += r["convs"][d]
                    children[node] += r["children"][d]
                    leaves[node] += r["leaves"][d]
                    saved[node] += r["saved"][d]
                    low = r["least"][d]
                    if low is not None:
                        least[node] = low if least[node] is None else min(least[node], low)
        border = {} if self.top else dict.fromkeys([*paths[0], *paths[-1]])
        # children have larger numbers than their parent: backwards, no recursion
        for node in range(size - 1, -1, -1):
            if node in border:
                continue
            leaves[node] += not children[node]
            saved[node] += (convs[node] - 1) * words[node]
            if node:
                up = tree.parent[node]
                children[up] += 1
                leaves[up] += leaves[node]
                saved[up] += saved[node]
        keys: dict[int, bytes] = {}
        if self.level or border:
            keep_keys = range(size) if self.level else border
            digest = sorted(ids)
            keys[0] = hashlib.md5(b"").digest()
            for node in sorted(keep_keys):
                if node:
                    keys[node] = hashlib.md5(keys[tree.parent[node]] + digest[tree.turn[node]]).digest()
        for node in range(size):
            if node in border:
                if ends.get(node):
                    yield {"ends": {"key": keys[node], "first": min(ends[node]), "ids": ",".join(map(str, sorted(ends[node])))}}
                continue
            up = tree.parent[node]
            far = node > 0 and up in border
            hashed = hashlib.sha256(",".join(map(str, sorted(ends.get(node, ())))).encode()).hexdigest() if self.level == 0 else None
            yield {"node": {
                "conv_id": least[node], "depth": tree.depth[node], "parent_conv_id": None if far or not node else least[up],
                "n_convs": convs[node], "n_children": children[node], "n_leaves": leaves[node], "saved_tokens": saved[node],
                "ends_sha256": hashed, "key": keys.get(node) if self.level else None, "parent_key": keys[up] if far else None,
            }}
        if border:
            seen: set[int] = set()
            for which in dict.fromkeys((0, len(runs) - 1)):
                path, sample = paths[which], runs[which][1][0]
                new = [node not in seen for node in path]
                seen.update(path)
                yield {"path": {
                    "seq": sample["seq"], "words": sample["words"],
                    "least": [least[v] if fresh else None for v, fresh in zip(path, new, strict=True)],
                    **{name: [column[v] if fresh else 0 for v, fresh in zip(path, new, strict=True)]
                       for name, column in (("convs", convs), ("children", children), ("leaves", leaves), ("saved", saved))},
                }}


def _shards(level: int, top: bool, turns: int, paths: int):
    schema = pa.schema([
        ("node", pa.struct([(n, t) for n, t in (
            ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
            ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()), ("key", pa.binary()), ("parent_key", pa.binary()))])),
        ("path", pa.struct([("seq", pa.list_(pa.binary())), *((n, pa.list_(pa.int64())) for n in ("words", "convs", "least", "children", "leaves", "saved"))])),
        ("ends", pa.struct([("key", pa.binary()), ("first", pa.int64()), ("ids", pa.string())])),
    ])

    def out(rows):
        part = []
        for r in Shard(level, top).run(rows):
            part.append(r)
            if len(part) == 4096:
                yield pa.RecordBatch.from_pylist(part, schema)
                part = []
        if part:
            yield pa.RecordBatch.from_pylist(part, schema)

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for r in batch.to_pylist():
                # the top is one shard, whatever it holds
                if not top and len(held) >= paths and size + len(r["seq"]) + 1 > turns:
                    yield from out(held)
                    held, size = [], 0
                held.append(r)
                size += len(r["seq"]) + 1
        if held:
            yield from out(held)

    return run


# ------------------------------------------------------------ all shards

def _hash_ends(batches):
    """Chunks of ids, sorted by (key, first), to one digest a key."""
    key, h = None, None
    for batch in batches:
        done = []
        for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if k == key:
                h.update(b"," + ids.encode())
                continue
            if h is not None:
                done.append((key, h.hexdigest()))
            key, h = k, hashlib.sha256(ids.encode())
        yield pa.RecordBatch.from_pylist([{"key": k, "sha": s} for k, s in done], pa.schema([("key", pa.binary()), ("sha", pa.string())]))
    if h is not None:
        yield pa.RecordBatch.from_pylist([{"key": key, "sha": h.hexdigest()}], pa.schema([("key", pa.binary()), ("sha", pa.string())]))


def trie(rebuilt: DataFrame, shard_turns: int = SHARD_TURNS, shard_paths: int = SHARD_PATHS) -> DataFrame:
    """The nodes of the trie of (conv_id, turns), ``turns`` as in
    ``sequences``: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256."""
    ship(rebuilt.sparkSession)
    rows = keep(rebuilt.select("conv_id", F.col("turns.digest").alias("seq"), F.col("turns.words").alias("words")), "trie-sequences")
    level, found = 0, []
    while True:
        paths, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("seq") + 1), F.lit(0))).first()
        top = level > 0 and (size <= shard_turns or paths <= shard_paths)
        if top:
            order, dealt = ["seq"], rows.coalesce(1)
        elif level:  # each level has half as many paths at most
            order = ["seq"]
            dealt = rows.repartitionByRange(max(1, min(size // shard_turns, paths // shard_paths)), *order)
        else:
            order = ["seq", "conv_id"]
            dealt = rows.repartitionByRange(*order)
        out = keep(dealt.sortWithinPartitions(*order).mapInArrow(_shards(level, top, shard_turns, shard_paths), OUT), f"trie-level-{level}")
        found.append(out)
        if top or not paths:
            break
        rows, level = out.where("path IS NOT NULL").select("path.*"), level + 1
    nodes = found[0].where("node IS NOT NULL").select("node.*")
    for out in found[1:]:
        nodes = nodes.unionByName(out.where("node IS NOT NULL").select("node.*"))
    ends = found[0].where("ends IS NOT NULL").select("ends.*")
    ends = ends.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_hash_ends, "key binary, sha string")
    # border nodes carry a key: their ends, and their number for the children
    keyed = nodes.where("key IS NOT NULL").join(ends, "key", "left").withColumn("ends_sha256", F.coalesce("sha", F.lit(NONE))).drop("sha")
    names = keyed.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("found"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    every = nodes.where("key IS NULL").unionByName(keyed)
    done = every.where("parent_key IS NULL").drop("key", "parent_key")
    far = every.where("parent_key IS NOT NULL").withColumn("salt", F.pmod(F.xxhash64("conv_id", "depth"), F.lit(SALTS)).cast("int"))
    far = far.join(names, ["parent_key", "salt"]).withColumn("parent_conv_id", F.col("found"))
    return done.unionByName(far.select(done.columns))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of all conversations, their heads borrowed (see
    ``borrowed_heads``)."""
    return trie(borrowed_heads(sequences(conversations)))
