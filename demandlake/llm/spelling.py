"""Spelling variants by a bit-sliced position index.

Words are counted over all texts, then dealt to shards so that any two words
one edit apart meet: of the pieces into which the shorter word of a pair is
cut (``PIECE`` letters each), the edit touches one, so both words agree on all
the others.  A word's keys are (length of the shorter word, piece left out,
the rest); equal keys go to one shard, and a shard holds about ``SHARD_WORDS``
words.  A key's words differ within ``PIECE`` + 1 letters, which bounds them
whatever the corpus.

Inside a shard the index holds, for each (position, letter), the bitset of the
words with that letter there.  A block of query words of one length runs over
it letter by letter; word-parallel recurrences keep four bitsets a query: no
error yet, one letter replaced (same positions), one of the query's letters
left out (positions shifted down), one letter more (positions shifted up).
The index is built for ``INDEX_WORDS`` words at a time, so memory does not
follow the shard.

Forms are followed to their root by pointer doubling in Spark.

Defined results: a null or empty text has no words; a null doc_id counts as
an empty id in the damage rule; repeated rows count again; texts of any length
are read whole; other columns are not read; an empty table gives an empty
result; of near words with equal counts the smallest in code-point order wins.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlake.llm.tables import keep, lower_ascii, ship, text_or_empty

#: After lower-casing A-Z.
RUN = "[a-z\\u00C0-\\u00FF]+"
DAMAGE = 97
MIN_LENGTH = 5
MIN_COUNT = 3
#: A form is at least so many times as frequent as the word.
RATIO = 2
PIECE = 3
SHARD_WORDS = 8192
INDEX_WORDS = 8192
QUERIES = 256


def vocabulary(docs: DataFrame, damage: int = DAMAGE, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """word, n: the runs of all texts, every ``damage``-th by crc32 of
    ``doc_id:run`` with one letter deleted."""
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(lower_ascii(text_or_empty()), F.lit(RUN), F.lit(0))).alias("run"),
    )
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    word = F.when(F.col("h") % damage == 0, cut).otherwise(F.col("run"))
    words = runs.withColumn("h", h).select(word.alias("word")).where(F.length("word") >= min_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def _keys(piece: int, min_length: int) -> Column:
    """All keys of a word, as the shorter and as the longer one of a pair."""
    size = F.length("word")

    def of(longer: int) -> Column:
        m = size - longer
        pieces = F.sequence(F.lit(0), F.floor((m - 1) / piece).cast("int"))

        def key(j: Column) -> Column:
            end = F.least((j + 1) * piece, m) + longer
            rest = F.concat(F.substring(F.col("word"), F.lit(1), j * piece), F.lit(" "), F.substring(F.col("word"), end + 1, size))
            return F.concat_ws(" ", m.cast("string"), j.cast("string"), rest)

        return F.transform(pieces, key)

    return F.concat(of(0), F.when(size > min_length, of(1)).otherwise(F.array().cast("array<string>")))


class PositionIndex:
    """Bitsets over words by (position, letter), and by length."""

    def __init__(self, letters: np.ndarray, length: np.ndarray):
        """``letters`` is (word, position), 0 behind a word's end, letters
        numbered from 1; the last number is a letter that no word holds."""
        n, width = letters.shape
        self.n, self.width = n, width
        self.bits = {}  # (position) -> (letter, block of 64 words)
        blocks = -(-n // 64)
        self.size = int(letters.max(initial=0)) + 2
        place = np.arange(n)
        for p in range(width):
            flat = np.zeros((self.size, blocks * 64), bool)
            flat[letters[:, p], place] = True
            flat[0] = False
            self.bits[p] = self._packed(flat)
        self.by_length = {int(k): self._packed((length == k)[None, :], blocks)[0] for k in np.unique(length)}
        self.none = np.zeros(blocks, np.uint64)

    @staticmethod
    def _packed(flat: np.ndarray, blocks: int | None = None) -> np.ndarray:
        if blocks is not None:
            flat = np.pad(flat, ((0, 0), (0, blocks * 64 - flat.shape[1])))
        return np.packbits(flat, axis=1, bitorder="little").view(np.uint64)

    def at(self, position: int, letter: np.ndarray):
        """Bitsets of the words with each query's letter at the position."""
        if position >= self.width:
            return self.none
        return self.bits[position][np.where(letter < self.size, letter, 0)]

    def near(self, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) of all words exactly one edit away from the queries,
        which are (query, position) letters of one length."""
        n, size = query.shape
        same = np.full((n, len(self.none)), np.uint64(0xFFFFFFFFFFFFFFFF))
        replaced, fewer, more = (np.zeros_like(same) for _ in range(3))
        for i in range(size):
            here = self.at(i, query[:, i])
            replaced = (replaced & here) | (same & ~here)
            fewer = (fewer & self.at(i - 1, query[:, i])) | same if i else same.copy()
            more = (more | same) & self.at(i + 1, query[:, i])
            same = same & here
        more |= same
        found = (replaced & self.by_length.get(size, self.none)) | (fewer & self.by_length.get(size - 1, self.none)) | (more & self.by_length.get(size + 1, self.none))
        # where the error can stand at several places the sets overlap, never with the word itself
        q, block = np.nonzero(found)
        bits = np.unpackbits(found[q, block].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        which, bit = np.nonzero(bits)
        return q[which], block[which] * 64 + bit


def letters_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word, position) letters numbered from 1, and the lengths."""
    length = np.array([len(w) for w in words], np.int64)
    width = int(length.max(initial=0))
    points = np.frombuffer("".join(w.ljust(width, "\0") for w in words).encode("utf-32-le"), np.uint32).reshape(len(words), width)
    alphabet = np.unique(points[points > 0])
    return np.where(points > 0, np.searchsorted(alphabet, points) + 1, 0), length


def _near_in_shard(pdf: pd.DataFrame) -> pd.DataFrame:
    """(word, near, near_n) of the words of one shard."""
    pdf = pdf.drop_duplicates("word").sort_values("word").reset_index(drop=True)
    words, n = pdf["word"].to_numpy(), pdf["n"].to_numpy()
    letters, length = letters_of(list(words))
    got_q, got_w = [], []
    for lo in range(0, len(words), INDEX_WORDS):
        index = PositionIndex(letters[lo : lo + INDEX_WORDS], length[lo : lo + INDEX_WORDS])
        for size in np.unique(length):
            which = np.flatnonzero(length == size)
            for a in range(0, len(which), QUERIES):
                block = which[a : a + QUERIES]
                q, w = index.near(letters[block, :size])
                got_q.append(block[q])
                got_w.append(w + lo)
    q, w = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (got_q, got_w))
    return pd.DataFrame({"word": words[q], "near": words[w], "near_n": n[w]})


def near_words(words: DataFrame, piece: int = PIECE, shard_words: int = SHARD_WORDS, min_length: int = MIN_LENGTH) -> DataFrame:
    """word, near, near_n for all pairs one edit apart, both ways round; a
    pair that meets in several shards comes several times."""
    keyed = words.select("word", "n", F.explode(_keys(piece, min_length)).alias("key"))
    shards = max(1, -(-keyed.count() // shard_words))
    dealt = keyed.select("word", "n", F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard"))
    return dealt.groupBy("shard").applyInPandas(_near_in_shard, "word string, near string, near_n long")


def _rooted(words: DataFrame) -> DataFrame:
    """(word, root) of the words with a form.  Counts at least double along
    forms, so there is no circle and few rounds of doubling suffice."""
    at = keep(words.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "spelling-forms")
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = at.join(ahead, "root", "left")
        at = keep(step.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        if not at.where("moved").limit(1).count():
            return at.select("word", "root")
        at = at.drop("moved")


def variants(docs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n: a row per word of the vocabulary."""
    ship(docs.sparkSession)
    words = keep(vocabulary(docs), "spelling-words")
    pairs = near_words(words).unionByName(words.select("word", F.lit(None).cast("string").alias("near"), F.lit(None).cast("long").alias("near_n")))
    # min and distinct count do not mind a pair that comes several times
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("near"))))
    found = pairs.groupBy("word").agg(F.count_distinct("near").alias("n_near"), best.alias("best"))
    wins = -F.col("best.m") >= ratio * F.col("n")
    judged = words.join(found, "word").select(
        "word", "n", "n_near", F.when(wins, F.col("best.near")).alias("form"), F.when(wins, -F.col("best.m")).alias("form_n")
    )
    judged = keep(judged, "spelling-judged")
    return judged.join(_rooted(judged), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
