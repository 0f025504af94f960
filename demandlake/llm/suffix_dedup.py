"""Suffix-array dedup: remove every byte covered by a LENGTH-byte string that
also starts in a document with a smaller doc_id.

1. Anchors.  Every LENGTH-byte string selects the smallest GRAM-byte gram in
   it, so equal strings select equal grams at equal places.  All strings that
   may select an anchor lie in its context of ``GRAM + 2 * REACH`` bytes.
   Spark deals (gram, context hash, document, place) to parts by gram.  A
   context that a smaller document has too repeats as a whole; a gram whose
   contexts all first occur in one document is done.
2. Contexts.  What is left, grams with different contexts in different
   documents, is compared byte by byte: each such context is sent once, by the
   smallest document that has it.
3. Shards.  A part's contexts form texts, all contexts of a gram in one; a
   text's suffix array is built by
   Larsson-Sadakane refinement (groups sorted by their first 8 bytes, then
   doubled within unsorted groups), common prefixes by Kasai's walk, all
   contexts in step.  Runs of common prefix LENGTH are equal strings; the
   smallest doc_id of a run decides.
4. A part that is too large for a task is split into several shards; each
   sends its sorted distinct strings, and a merge looks up every shard's
   strings in the union by binary search.  What a shard finds leaves it array
   by array and is shuffled, not written, so no task holds a part's strings.

Contexts count as equal when a 64-bit hash of them and 32 or more bits of
their gram's are.  A gram with many contexts in one batch of documents is not
collected: its contexts go to step 2 at once, and only the fact is dealt.
Exact copies of a smaller document are settled by digest.

Defined results: null text counts as empty; a row without doc_id removes
nothing and loses nothing; texts under LENGTH bytes lose nothing; rows
repeated under one doc_id get equal results, and of different texts under
one doc_id the one of smallest digest is compared, others stay whole; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlake.llm import textops as T
from demandlake.llm.tables import forget, keep, text_or_empty

LENGTH = 50
GRAM = 24
REACH = LENGTH - GRAM  # bytes that a string may reach before its anchor
WIDTH = LENGTH + REACH
CHUNK = 1 << 18
#: Text bytes whose anchors one part takes, and contexts that one shard takes.
PART_BYTES = 6 << 20
SHARD_CONTEXTS = 30_000
#: Anchors that a task gathers before it deals them, and contexts of one gram
#: among them beyond which they are compared without asking its part.
HOLD = 1 << 18
GRAM_CONTEXTS = 8
#: Contexts that a task cuts out at once, and that it gathers before it deals them.
CONTEXT_BATCH = 10_000
CONTEXT_HOLD = 30_000
#: Contexts of one suffix array, but for one gram's.
ARRAY_CONTEXTS = 4_000
#: Buckets of a split part's strings: so many at least, and so many a shard.
MERGE_BUCKETS = 64
SHARD_BUCKETS = 8


def _row_hash(rows: np.ndarray) -> np.ndarray:
    """64-bit hash of each row of a byte matrix."""
    wide = np.zeros((len(rows), -(-rows.shape[1] // 8) * 8), np.uint8)
    wide[:, : rows.shape[1]] = rows
    out = np.zeros(len(rows), np.uint64)
    for w in wide.view(np.uint64).T:
        out = T.mix(out * T.U(0x9E3779B97F4A7C15) + w + T.U(1))
    return out


def _slide(x: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` over each run of ``width`` entries (shorter result)."""
    out, have = x, 1
    while have * 2 <= width:
        out = best(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return best(out[: len(out) - rest], out[rest:]) if rest else out


def anchors(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place, hash, context hash, text) of the grams that some string of
    LENGTH bytes selects."""
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none, none.astype(np.uint64), none.astype(np.uint64), none
    pre = T.prefix_hash(data)
    place = np.arange(len(data) - GRAM + 1)
    gram = T.span_hash(pre, place, place + GRAM)
    least = _slide(gram, REACH + 1, np.minimum)  # per string start
    end = np.repeat(off[1:], np.diff(off))[: len(least)]
    least[np.arange(len(least)) + LENGTH > end] = 0  # a string never crosses texts
    pad = np.zeros(REACH, np.uint64)
    most = _slide(np.r_[pad, least, pad], REACH + 1, np.maximum)  # over the strings that hold a gram
    at = np.flatnonzero(most == gram)
    doc = np.searchsorted(off, at, "right") - 1
    lo, hi = _reach(at, off[doc], off[doc + 1])
    return at, gram[at], T.mix(T.span_hash(pre, lo, hi) + (at - lo).astype(np.uint64)), doc


def _reach(at: np.ndarray, first, end) -> tuple[np.ndarray, np.ndarray]:
    """The contexts [lo, hi) of anchors in a text [first, end)."""
    return np.maximum(first, at - REACH), np.minimum(end, at + LENGTH)


def _heads(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    new = np.zeros(max(len(keys[0]) - 1, 0), bool)
    for k in keys:
        new |= k[1:] != k[:-1]
    return np.flatnonzero(np.r_[True, new]) if len(keys[0]) else np.zeros(0, np.int64)


def _spread(values: np.ndarray, heads: np.ndarray, n: int) -> np.ndarray:
    return np.repeat(values, np.diff(np.r_[heads, n]))


def _by_key(key: np.ndarray, *arrays: np.ndarray):
    """(key, slices) of arrays grouped by key."""
    o = np.argsort(key, kind="stable")
    key = key[o]
    cut = _heads(key)
    for a, b in zip(cut, np.r_[cut[1:], len(key)][: len(cut)], strict=True):
        yield int(key[a]), *[x[o[a:b]] for x in arrays]


def _pack(x: np.ndarray) -> bytes:
    """All first bytes, then all second ones, ...: sorted numbers compress."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes()


def _unpack(blobs, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    rows = [np.frombuffer(x, np.uint8).reshape(width, -1).T for x in blobs]
    return np.ascontiguousarray(np.concatenate(rows)).view(kind).ravel() if rows else np.zeros(0, kind)


_BLOBS = "part int, a binary, b binary, c binary, d binary"


def _rows(out: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*out, strict=True)) if out else [()] * 5
    kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["part", "a", "b", "c", "d"])


def _told(doc: np.ndarray, pos: np.ndarray, compare: np.ndarray, parts: int):
    """What is known of anchors, by bucket of documents: the context repeats
    as a whole, or (``compare``) is to be compared."""
    for k, d, p, c in _by_key((T.mix(doc.astype(np.uint64)) % T.U(parts)).astype(np.int32), doc, pos, compare):
        o = np.lexsort((p, d))
        yield k, _pack(d[o]), _pack(p[o]), np.packbits(c[o]).tobytes()


def _owners(gram: np.ndarray, ctx: np.ndarray, doc: np.ndarray):
    """Order by (gram, context, document); there: the smallest document of a
    context, where grams begin, and per gram whether two documents own some."""
    o = np.lexsort((doc, ctx, gram))
    g, c, d = gram[o], ctx[o], doc[o]
    same = _heads(g, c)
    owner = _spread(d[same], same, len(o))
    grams = _heads(g)
    several = np.zeros(0, bool)
    if len(o):
        several = np.minimum.reduceat(owner, grams) != np.maximum.reduceat(owner, grams)
    return o, owner, same, grams, several


def _gather(parts: int, hold: int, gram_contexts: int):
    """Texts -> anchors by part of their gram, one row a part and batch of
    texts; of equal contexts in the batch only those of the smallest document."""

    def deal(held):
        h, ctx, own, pos = [np.concatenate(x) for x in zip(*held, strict=True)]
        o, owner, same, grams, several = _owners(h, ctx, own)
        h, ctx, own, pos = h[o], ctx[o], own[o], pos[o]
        head = np.zeros(len(h), np.int64)
        head[same] = 1
        n = np.add.reduceat(head, grams)
        hot = _spread(several & (n > gram_contexts), grams, len(h))
        first = own == owner
        known = ~first | hot
        out = [(k, None, d, p, c) for k, d, p, c in _told(own[known], pos[known], first[known], parts)]
        fact = np.zeros(len(h), bool)
        fact[grams] = hot[grams]
        send = np.flatnonzero(~known | fact)
        send = send[np.lexsort((pos[send], own[send]))]
        place = np.where(hot, -1, pos).astype(np.int32)
        low = (h >> T.U(32)).astype(np.uint32)
        for k, g, c, d, p in _by_key((h[send] % T.U(parts)).astype(np.int32), low[send], ctx[send], own[send], place[send]):
            out.append((k, _pack(g), _pack(d), _pack(p), _pack(c)))
        return _rows(out)

    def run(batches):
        held, n = [], 0
        for rows, data, off in T.chunks(batches, limit=CHUNK):
            at, h, ctx, doc = anchors(data, off)
            if not len(at):
                continue
            ids = rows.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            held.append((h, ctx, ids[doc], (at - off[doc]).astype(np.int32)))
            n += len(at)
            if n >= hold:
                yield deal(held)
                held, n = [], 0
        if held:
            yield deal(held)

    return run


_TOLD = "part int, a binary, b binary, c binary"


def _judge(parts: int):
    """One part: the contexts that a smaller document has too, and those of
    grams that several documents own."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        told = pdf["a"].isna()
        out = list(zip(pdf["part"][told], pdf["b"][told], pdf["c"][told], pdf["d"][told], strict=True))
        pdf = pdf[~told]
        if len(pdf):
            low, doc, pos, ctx = [_unpack(pdf[c], k) for c, k in zip("abcd", (np.uint32, np.int64, np.int32, np.uint64), strict=True)]
            marked = np.unique(low[pos < 0])  # known to a batch to be compared
            real = pos >= 0
            low, doc, pos, ctx = low[real], doc[real], pos[real], ctx[real]
            o, owner, _, grams, several = _owners(low, ctx, doc)
            low, doc, pos = low[o], doc[o], pos[o]
            again = doc > owner
            compare = ~again & (_spread(several, grams, len(low)) | np.isin(low, marked))
            take = again | compare
            out += _told(doc[take], pos[take], compare[take], parts)
        return pd.DataFrame(out, columns=["part", "a", "b", "c"]).astype({"part": "int32"})

    return run


_FOUND = "doc_id long, again binary, compare binary"


def _by_document(pdf: pd.DataFrame) -> pd.DataFrame:
    """One bucket of documents: places of both kinds, a row per document."""
    doc, pos = _unpack(pdf["a"], np.int64), _unpack(pdf["b"], np.int32)
    compare = np.concatenate([np.unpackbits(np.frombuffer(c, np.uint8))[: len(a) // 8] for a, c in zip(pdf["a"], pdf["c"], strict=True)]).astype(bool)
    out = [(d, p[~c].tobytes(), p[c].tobytes()) for d, p, c in _by_key(doc, pos, compare)]
    return pd.DataFrame(out, columns=["doc_id", "again", "compare"])


def _contexts(parts: int):
    """Texts and their anchors to compare -> contexts by part of their gram."""

    def deal(held):
        whole, own, pos = [np.concatenate(x) for x in zip(*held, strict=True)]
        part = (_row_hash(whole[:, REACH : REACH + GRAM]) >> T.U(32)) % T.U(parts)
        out = []
        for q, w, d, x in _by_key(part.astype(np.int32), whole, own, pos):
            for k in range(0, len(w), ARRAY_CONTEXTS):  # rows are what shards are dealt by
                few = slice(k, k + ARRAY_CONTEXTS)
                out.append((q, w[few].tobytes(), d[few].tobytes(), x[few].tobytes(), None))
        return _rows(out)

    def run(batches):
        held, n = [], 0
        column = np.arange(WIDTH, dtype=np.uint8)
        for rows, data, off in T.chunks(batches, limit=CHUNK):
            ids = rows.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            blobs = rows.column("compare").to_pylist()
            pos = np.frombuffer(b"".join(blobs), np.int32).astype(np.int64)
            doc = np.repeat(np.arange(len(blobs)), [len(x) // 4 for x in blobs])
            padded = np.r_[np.zeros(REACH, np.uint8), data, np.zeros(LENGTH, np.uint8)]
            for k in range(0, len(pos), CONTEXT_BATCH):
                own, p = doc[k : k + CONTEXT_BATCH], pos[k : k + CONTEXT_BATCH]
                at = off[own] + p
                lo, hi = _reach(at, off[own], off[own + 1])
                left, right = (at - lo).astype(np.uint8), (hi - at).astype(np.uint8)
                ctx = np.lib.stride_tricks.sliding_window_view(padded, WIDTH)[at]
                ctx[(column < (REACH - left)[:, None]) | (column >= (REACH + right)[:, None])] = 0  # other texts
                held.append((np.ascontiguousarray(np.column_stack([ctx, left, right])), ids[own], p.astype(np.int32)))
                n += len(p)
                if n >= CONTEXT_HOLD:
                    yield deal(held)
                    held, n = [], 0
        if held:
            yield deal(held)

    return run


def _valid(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Bit c: the string that starts at column c lies inside the text."""
    c = np.arange(REACH + 1)
    back = REACH - c
    ok = (back[None, :] <= left[:, None].astype(int)) & (LENGTH - back[None, :] <= right[:, None].astype(int))
    return (ok.astype(np.uint32) << c.astype(np.uint32)).sum(1).astype(np.uint32)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """All places sorted by their suffixes (Larsson-Sadakane: a place's rank
    is its group's last index; only unsorted groups go on, by doubled steps)."""
    n = len(text)
    padded = np.r_[text, np.zeros(8, np.uint8)]
    key = np.zeros(n, np.uint64)
    for j in range(8):
        key |= padded[j : j + n].astype(np.uint64) << T.U(56 - 8 * j)
    sa = np.argsort(key).astype(np.int32)
    s = key[sa]
    rank = np.zeros(n, np.int32)

    def groups(edge, order, base):
        start = np.flatnonzero(edge)
        size = np.diff(np.r_[start, len(order)])
        rank[order] = np.repeat(base[start] + size, size)
        return np.repeat(size > 1, size)

    edge = np.r_[True, s[1:] != s[:-1]] if n else np.zeros(0, bool)
    del key, s
    open_ = np.flatnonzero(groups(edge, sa, np.arange(n, dtype=np.int32))).astype(np.int32)
    h = 8
    while len(open_):
        order = sa[open_]
        b = np.where(order + h < n, rank[np.minimum(order + h, n - 1)], n - h - order)  # past the end: the shorter first
        pair = (rank[order].astype(np.int64) << 32) + (b.astype(np.int64) + h)
        o = np.argsort(pair)
        order, pair = order[o], pair[o]
        sa[open_] = order
        edge = np.r_[True, pair[1:] != pair[:-1]]
        open_ = open_[groups(edge, order, open_)]
        h *= 2
    return sa


def common_prefixes(text: np.ndarray, sa: np.ndarray, width: int, cap: int = LENGTH) -> np.ndarray:
    """For each entry of ``sa`` the prefix (``cap`` at most) common with the
    entry before.  Kasai's walk: one place further to the right at most one
    byte is lost.  ``text`` is rows of ``width``; all rows walk in step."""
    n = len(text)
    before = np.full(n, -1, np.int32)
    before[sa[1:]] = sa[:-1]
    padded = np.r_[text, np.zeros(cap + 1, np.uint8)]
    lcp = np.zeros(n, np.uint8)
    base = np.arange(0, n, width)
    h = np.zeros(len(base), np.int64)
    for c in range(width):
        i = base + c
        j = before[i]
        h = np.where(j < 0, 0, np.maximum(h - 1, 0))
        go = np.flatnonzero((j >= 0) & (h < cap))
        while len(go):
            go = go[padded[i[go] + h[go]] == padded[j[go] + h[go]]]
            h[go] += 1
            go = go[h[go] < cap]
        lcp[i] = h
    return lcp[sa]


_MASKS = "doc_id long, a binary, b binary"
_SHARD = "bucket long, doc_id long, a binary, b binary, c binary, d binary"


def _shard(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One task: (bucket below 0) the repeated strings per document; (others,
    if its part is split) its distinct strings with smallest document.
    Contexts of one gram meet in one array; the arrays are kept small, and
    each one's rows are sent before the next is built, for memory."""
    rows = pd.concat(list(batches))
    whole = np.concatenate([np.frombuffer(x, np.uint8) for x in rows["a"]]).reshape(-1, WIDTH + 2)
    own = np.concatenate([np.frombuffer(x, np.int64) for x in rows["b"]])
    pos = np.concatenate([np.frombuffer(x, np.int32) for x in rows["c"]]).astype(np.int64)
    part, shard, shards = [int(rows[c].iloc[0]) for c in ("part", "shard", "shards")]
    del rows
    buckets = max(MERGE_BUCKETS, SHARD_BUCKETS * shards) if shards > 1 else 0
    h = _row_hash(whole[:, REACH : REACH + GRAM])
    for _, idx in _by_key((h % T.U(max(1, len(whole) // ARRAY_CONTEXTS))).astype(np.int64), np.arange(len(whole))):
        out = [(-1 - (part << 32 | shard) if k < 0 else part << 32 | k, *x) for k, *x in _array(whole[idx], own[idx], pos[idx], buckets)]
        yield pd.DataFrame(out, columns=["bucket", "doc_id", "a", "b", "c", "d"])


def _array(whole: np.ndarray, own: np.ndarray, pos: np.ndarray, buckets: int) -> list[tuple]:
    """Of one suffix array: (-1, the repeated strings of a document) and, by
    bucket if there are ``buckets``, (bucket, the distinct strings)."""
    mask = _valid(whole[:, WIDTH], whole[:, WIDTH + 1])
    text = np.ascontiguousarray(whole[:, :WIDTH]).ravel()
    sa = suffix_array(text)
    lcp = common_prefixes(text, sa, WIDTH)
    row, col = sa // WIDTH, sa % WIDTH
    ok = (col <= REACH) & ((mask[row] >> np.minimum(col, 31).astype(np.uint32)) & 1).astype(bool)
    run = np.cumsum(lcp < LENGTH)[ok]
    row, col, place = row[ok], col[ok], sa[ok]
    cut = _heads(run)
    if not len(cut):
        return []
    least = np.repeat(np.minimum.reduceat(own[row], cut), np.diff(np.r_[cut, len(run)]))
    bits = np.zeros(len(whole), np.uint32)
    dup = own[row] > least
    np.bitwise_or.at(bits, row[dup], np.uint32(1) << col[dup].astype(np.uint32))
    some = np.flatnonzero(bits)
    out = [(-1, d, p.tobytes(), m.tobytes(), None, None) for d, p, m in _by_key(own[some], pos[some], bits[some])]
    if buckets:  # in suffix order, so every bucket's strings are sorted
        mine = np.flatnonzero(~dup)
        flat = np.lib.stride_tricks.sliding_window_view(text, LENGTH)[place[mine]]
        h = _row_hash(flat)
        for k, s, d, p, c in _by_key((h % T.U(buckets)).astype(np.int64), flat, own[row[mine]], pos[row[mine]], col[mine]):
            out.append((k, 0, s.tobytes(), d.tobytes(), p.tobytes(), c.astype(np.int64).tobytes()))
    return out


def _merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted strings of several shards: each is looked up in the union by
    binary search; a smaller document in another shard marks it repeated.
    What a shard found by itself goes on as it is."""
    held = []
    for pdf in batches:
        if pdf["bucket"].iloc[0] < 0:  # as all of its group
            yield pdf[["doc_id", "a", "b"]]
        else:
            held.append(pdf)
    if held:
        yield _looked_up(pd.concat(held))


def _looked_up(pdf: pd.DataFrame) -> pd.DataFrame:
    runs = [(np.frombuffer(r.a, f"S{LENGTH}"), np.frombuffer(r.b, np.int64), np.frombuffer(r.c, np.int64), np.frombuffer(r.d, np.int64)) for r in pdf.itertuples()]
    # one document may hold a string several times
    distinct = [s[np.r_[True, s[1:] != s[:-1]]] for s, *_ in runs]
    union = distinct[0]
    for s in distinct[1:]:
        at = np.searchsorted(union, s)
        new = (at == len(union)) | (union[np.minimum(at, len(union) - 1)] != s)
        union = np.insert(union, at[new], s[new])
    least = np.full(len(union), np.iinfo(np.int64).max)
    for s, d, _, _ in runs:
        np.minimum.at(least, np.searchsorted(union, s), d)
    out = []
    for s, d, p, c in runs:
        hit = np.flatnonzero(least[np.searchsorted(union, s)] < d)
        out += [(doc, q.tobytes(), m.tobytes()) for doc, q, m in _by_key(d[hit], p[hit], (np.uint32(1) << c[hit].astype(np.uint32)).astype(np.uint32))]
    return pd.DataFrame(out, columns=["doc_id", "a", "b"])


def _cut(batches):
    """Text, contexts that repeat and repeated strings -> removed bytes, spans,
    digest of the rest."""
    column = np.arange(REACH + 1)
    for rows, data, off in T.chunks(batches, limit=CHUNK):
        removed, spans, digests = [], [], []
        for i, (again, blobs) in enumerate(zip(rows.column("again").to_pylist(), rows.column("strings").to_pylist(), strict=True)):
            text = data[off[i] : off[i + 1]]
            lo, hi = _reach(np.frombuffer(again or b"", np.int32).astype(np.int64), 0, len(text))
            if blobs:
                pos = np.frombuffer(b"".join(x["a"] for x in blobs), np.int64)
                mask = np.frombuffer(b"".join(x["b"] for x in blobs), np.uint32)
                which, c = np.nonzero((mask[:, None] >> column.astype(np.uint32)) & 1)
                start = pos[which] - REACH + c
                lo, hi = np.r_[lo, start], np.r_[hi, start + LENGTH]
            step = np.bincount(lo, minlength=len(text) + 1) - np.bincount(hi, minlength=len(text) + 1)
            gone = np.cumsum(step[:-1]) > 0
            removed.append(int(gone.sum()))
            spans.append(int((gone & ~np.r_[False, gone[:-1]]).sum()))
            digests.append(hashlib.sha256(text[~gone].tobytes()).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), rows.column("digest"), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests, pa.string())],
            ["doc_id", "digest", "gone", "spans", "rest"],
        )


def _only(texts: DataFrame, found: DataFrame, name: str) -> DataFrame:
    """The texts of the documents in ``found``.  The ids are written alone, so
    Spark knows their size before it chooses between sending them to the texts
    and moving the texts (then once: the join that follows has the same key)."""
    return texts.join(keep(found.select("doc_id"), name), "doc_id", "left_semi")


def dedup(docs: DataFrame, part_bytes: int = PART_BYTES, shard_contexts: int = SHARD_CONTEXTS, hold: int = HOLD, gram_contexts: int = GRAM_CONTEXTS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256: one row per document."""
    text = text_or_empty()
    digest = F.sha2(F.col("text").cast("binary"), 256).alias("digest")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    base = keep(texts.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), digest), "sa-base")
    size = base.agg(F.sum("n_bytes")).first()[0] or 0
    parts = max(1, math.ceil(size / part_bytes))
    named = base.where("doc_id IS NOT NULL AND n_bytes >= " + str(LENGTH))
    judged = named.groupBy("doc_id").agg(F.min("digest").alias("digest"))  # one text per id
    others = keep(named.join(judged, ["doc_id", "digest"], "left_anti").select("doc_id", "digest").distinct(), "sa-others")
    first = judged.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("k")).where("k > 1").drop("k")
    copies = keep(judged.join(first, "digest").where("doc_id > least").select("doc_id", "digest"), "sa-copies")

    texts = texts.where("doc_id IS NOT NULL AND octet_length(text) >= " + str(LENGTH)).withColumn("digest", digest)
    texts = texts.join(others, ["doc_id", "digest"], "left_anti")
    told = texts.select("doc_id", "text").mapInArrow(_gather(parts, hold, gram_contexts), _BLOBS).groupBy("part").applyInPandas(_judge(parts), _TOLD)
    found = told.groupBy("part").applyInPandas(_by_document, _FOUND)
    found = keep(found.join(copies.select("doc_id"), "doc_id", "left_anti"), "sa-found")
    open_ = keep(found.where("length(compare) > 0").select("doc_id", "compare"), "sa-open")
    n_open = open_.agg(F.sum(F.length("compare"))).first()[0] or 0
    shards = max(1, math.ceil(n_open / 2 / shard_contexts))  # half a shard each: few are split, but those of frequent grams
    ctx = keep(_only(texts, open_, "sa-open-ids").select("doc_id", "text").join(open_, "doc_id").mapInArrow(_contexts(shards), _BLOBS), "sa-contexts")
    weight = ctx.groupBy("part").agg(F.ceil(F.sum(F.length("b")) / (8 * shard_contexts)).alias("shards"))
    dealt = ctx.join(weight, "part").withColumn("shard", F.pmod(F.xxhash64("b"), F.col("shards")))
    masks = dealt.groupBy("part", "shard").applyInPandas(_shard, _SHARD).groupBy("bucket").applyInPandas(_merge, _MASKS)
    masks = masks.groupBy("doc_id").agg(F.collect_list(F.struct("a", "b")).alias("strings"))
    gone = found.select("doc_id", "again").join(masks, "doc_id", "full").where("length(again) > 0 OR strings IS NOT NULL")
    gone = keep(gone, "sa-gone")
    forget(found, ctx, open_)
    cut = _only(texts, gone, "sa-gone-ids").join(gone, "doc_id").mapInArrow(_cut, "doc_id long, digest string, gone long, spans long, rest string")
    cut = cut.dropDuplicates(["doc_id", "digest"])
    whole = copies.join(named.select("doc_id", "digest", "n_bytes").distinct(), ["doc_id", "digest"])
    whole = whole.select("doc_id", "digest", F.col("n_bytes").alias("gone"), F.lit(1).cast("long").alias("spans"), F.lit(hashlib.sha256().hexdigest()).alias("rest"))
    out = base.join(cut.unionByName(whole), ["doc_id", "digest"], "left")
    return out.select(
        "doc_id", "n_bytes", F.coalesce("gone", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("spans", F.lit(0)).cast("long").alias("n_spans"), F.coalesce("rest", "digest").alias("kept_sha256"),
    )
