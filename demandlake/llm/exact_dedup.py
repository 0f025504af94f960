"""Exact dedup by a minimal perfect hash over historical digests.

The rows of the history are reduced to distinct SHA-256 digests, dealt to
shards by digest (uniform, so no hot shard), and each shard builds a
minimal perfect hash: levels of bit arrays, a key taking the first level
where no other key hits its bit, its slot being the rank of that bit.  A
slot holds the full digest and the winner's locator.  Digests of the new
load, grouped first, are looked up; the slot's 32 bytes decide membership.
Members join the historical group, nonmembers form groups of their own.

Defined results: null text counts as empty; the largest doc_id of equal
texts stays (null is smaller than any); of rows repeated with that same
doc_id exactly one stays; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlake.llm.tables import keep, located, text_or_empty, without
from demandlake.llm.textops import U, mix

GAMMA = 2.0
MAX_LEVELS = 40
SHARD_KEYS = 50_000


def _lanes(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), "<u8").reshape(-1, 4).astype(np.uint64)


def _bit(lanes: np.ndarray, level: int, size: int) -> np.ndarray:
    h = mix(lanes[:, level % 4] + U(((level + 1) * 0x9E3779B97F4A7C15) % (1 << 64)))
    return (h % U(size)).astype(np.int64)


def build_mph(digests: list[bytes]) -> tuple[list[int], list[bytes], np.ndarray]:
    """(level sizes, packed bits per level, slot of each digest).  Keys that
    outlive all levels (never seen in practice) take the last slots in digest order."""
    lanes = _lanes(digests)
    left = np.arange(len(lanes))
    slot = np.full(len(lanes), -1, np.int64)
    sizes, levels, placed = [], [], 0
    for level in range(MAX_LEVELS):
        if not len(left):
            break
        size = max(8, int(math.ceil(GAMMA * len(left) / 8)) * 8)
        at = _bit(lanes[left], level, size)
        hit = np.bincount(at, minlength=size)
        alone = hit[at] == 1
        bits = hit == 1
        rank = np.cumsum(bits) - 1
        slot[left[alone]] = placed + rank[at[alone]]
        placed += int(bits.sum())
        sizes.append(size)
        levels.append(np.packbits(bits).tobytes())
        left = left[~alone]
    for k in sorted(left, key=lambda i: digests[i]):
        slot[k] = placed
        placed += 1
    return sizes, levels, slot


def find_slots(digests: list[bytes], sizes: list[int], levels: list[bytes]) -> np.ndarray:
    """Slot that each digest would have if it is a key; -1 if no level has its bit."""
    lanes = _lanes(digests)
    out = np.full(len(lanes), -1, np.int64)
    left, base = np.arange(len(lanes)), 0
    for level, (size, packed) in enumerate(zip(sizes, levels, strict=True)):
        bits = np.unpackbits(np.frombuffer(packed, np.uint8))[:size].astype(bool)
        at = _bit(lanes[left], level, size)
        hit = bits[at]
        out[left[hit]] = base + (np.cumsum(bits) - 1)[at[hit]]
        base += int(bits.sum())
        left = left[~hit]
    return out


_GROUP = "digest binary, win_id long, win_row long, n long"
_INDEX = "shard long, sizes array<long>, levels array<binary>, slots array<binary>, win_id array<long>, win_row array<long>, n array<long>"
_FOUND = f"{_GROUP}, member boolean"


def _opt(x):
    return None if x is None or pd.isna(x) else int(x)


def _index_shard(pdf: pd.DataFrame) -> pd.DataFrame:
    digests = [bytes(x) for x in pdf["digest"]]
    sizes, levels, slot = build_mph(digests)
    order = np.argsort(slot)
    row = {
        "shard": int(pdf["shard"].iloc[0]), "sizes": sizes, "levels": levels,
        "slots": [digests[i] for i in order],
        "win_id": [_opt(pdf["win_id"].iloc[i]) for i in order],
        "win_row": [int(pdf["win_row"].iloc[i]) for i in order],
        "n": [int(pdf["n"].iloc[i]) for i in order],
    }
    return pd.DataFrame([row])


def _better(a_id, a_row, b_id, b_row):
    """The larger of two (doc_id, row) locators, a null id being smallest."""
    a, b = ((x is not None, x if x is not None else 0, r) for x, r in ((a_id, a_row), (b_id, b_row)))
    return (a_id, a_row) if a >= b else (b_id, b_row)


def _look_up(new: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    out = []
    slots, taken = [], {}
    if len(index):
        ix = index.iloc[0]
        slots = [bytes(x) for x in ix["slots"]]
        taken = {i: [_opt(ix["win_id"][i]), int(ix["win_row"][i]), int(ix["n"][i])] for i in range(len(slots))}
    if len(new):
        digests = [bytes(x) for x in new["digest"]]
        at = find_slots(digests, [int(x) for x in ix["sizes"]], [bytes(x) for x in ix["levels"]]) if slots else np.full(len(digests), -1)
        if slots and any(at < 0):  # keys beyond all levels sit in the last slots
            tail = {d: i for i, d in enumerate(slots)} if sum(len(x) for x in ix["levels"]) and len(ix["sizes"]) == MAX_LEVELS else {}
            at = np.array([tail.get(d, -1) if a < 0 else a for d, a in zip(digests, at, strict=True)])
        for d, a, wid, wrow, n in zip(digests, at, new["win_id"], new["win_row"], new["n"], strict=True):
            if a >= 0 and slots[a] == d:  # all 32 bytes
                h = taken[int(a)]
                h[:2] = _better(h[0], h[1], _opt(wid), int(wrow))
                h[2] += int(n)
            else:
                out.append((d, _opt(wid), int(wrow), int(n), False))
    out += [(slots[i], *taken[i], True) for i in taken]
    df = pd.DataFrame(out, columns=["digest", "win_id", "win_row", "n", "member"])
    return df.astype({"win_id": "Int64", "win_row": "int64", "n": "int64", "member": "bool"})


def _groups(df: DataFrame) -> DataFrame:
    """One row per digest; partial aggregation before the shuffle, so a text
    that a third of all rows repeat ships one row per map task."""
    win = F.max(F.struct(F.coalesce(F.col("doc_id").isNotNull(), F.lit(False)).alias("has"), "doc_id", "row"))
    return df.groupBy("digest").agg(win.alias("w"), F.count(F.lit(1)).alias("n")).select(
        "digest", F.col("w.doc_id").alias("win_id"), F.col("w.row").alias("win_row"), "n"
    )


def dedup(digested: DataFrame, is_history) -> DataFrame:
    """``digested(doc_id, row, digest, ...)`` -> the same rows with keep_id,
    keep_row, group_size.  ``is_history`` is a boolean column expression."""
    shards = max(1, math.ceil(digested.count() / SHARD_KEYS))
    shard = F.pmod(F.xxhash64("digest"), F.lit(shards)).alias("shard")
    old = _groups(digested.where(is_history)).select("*", shard)
    new = _groups(digested.where(~is_history)).select("*", shard)
    index = old.groupBy("shard").applyInPandas(_index_shard, _INDEX)
    found = new.groupBy("shard").cogroup(index.groupBy("shard")).applyInPandas(_look_up, _FOUND)
    copies = found.where("n > 1").select("digest", "win_id", "win_row", F.col("n").alias("group_n"))
    joined = digested.join(copies, "digest", "left")  # AQE splits a hot digest's rows
    several = F.col("group_n").isNotNull()
    return joined.select(
        *[c for c in digested.columns],
        F.when(several, F.col("win_id")).otherwise(F.col("doc_id")).alias("keep_id"),
        F.when(several, F.col("win_row")).otherwise(F.col("row")).alias("keep_row"),
        F.coalesce("group_n", F.lit(1)).cast("long").alias("group_size"),
    )


def digest_rows(docs: DataFrame, *extra: str) -> DataFrame:
    """(doc_id, row, digest): ``row`` is the locator of a written row."""
    return docs.select(
        "doc_id", F.monotonically_increasing_id().alias("row"),
        F.unhex(F.sha2(text_or_empty().cast("binary"), 256)).alias("digest"), *extra,
    )


def history_half():
    """The rows that count as loaded before: even CRC of the id (null: 0)."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(2)) == 0


def exact_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per document."""
    digested = keep(digest_rows(docs), "digests")
    return dedup(digested, history_half()).select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_winners(docs: DataFrame) -> DataFrame:
    """The documents that stay, with their own columns."""
    held = located(docs, "dedup-input")
    own, text = (F.col(f"c{docs.columns.index(c)}") for c in ("doc_id", "text"))
    digested = held.select(own.alias("doc_id"), "row", F.unhex(F.sha2(F.coalesce(text.cast("string"), F.lit("")).cast("binary"), 256)).alias("digest"))
    lost = dedup(keep(digested, "digests"), history_half()).where("row != keep_row")
    return without(docs, held, lost, "dedup-lost")
