"""Spelling variants, the prefix trie and chat formatting against brute-force
versions: nulls, empty and long texts, ties, repeated rows, clashing columns,
empty tables, shards and pieces far smaller than the input."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandlake.llm import chat_format, prefix_trie, spelling, textops
from demandlake.llm.tables import ship

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, word string, n long, near string, key string"
TURNS = "conv_id long, turn long, role string, text string, base long, seq string, piece long, whole string"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


# ------------------------------------------------------------- spelling

def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants_by_hand(rows):
    n = collections.Counter()
    for d, t, *_ in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = w.translate(LOWER)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            n[w if h % 97 else w[: h % len(w)] + w[h % len(w) + 1 :]] += 1
    n = {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        if best is not None and n[best] >= 2 * n[w]:
            form[w] = best
    out = {}
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None)
    return out


def texts(seed=5):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abé", k=rng.randint(4, 9))) for _ in range(60)]
    for w in list(words):  # variants, some of them chains
        for _ in range(3):
            i = rng.randrange(len(w))
            w = rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("abÿ") + w[i:], w[:i] + rng.choice("abé") + w[i + 1 :]])
            words.append(w)
    weight = [2 ** rng.randint(0, 7) for _ in words]
    rows = [(None, None), (1, ""), (2, "12 -- ×÷×÷×"), (None, "nullid " * 5), (3, "Straße STRASSE straßen " * 4)]
    rows += [(i, " ".join(w.upper() if rng.random() < 0.2 else w for w in rng.choices(words, weight, k=40))) for i in range(10, 150)]
    rows += [(7, ",".join(rng.choices(words, weight, k=20000)))] + rows[-3:]
    return [(d, t, "clash", 1, "clash", "clash") for d, t in rows]


def found(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_variants_equal_brute_force(spark):
    rows = texts()
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    want = variants_by_hand(rows)
    got = spelling.variants(docs).cache()
    assert got.count() == len(want) > 100
    assert found(got) == want
    assert any(f and r != f for f, r, *_ in want.values()), "no chain of forms in the fixture"


@pytest.mark.parametrize(("piece", "shard_words"), [(1, 40), (2, 7), (3, 100000)])
def test_near_words_at_any_shard_size(spark, piece, shard_words):
    ship(spark)
    words = sorted({w for w in variants_by_hand(texts())})
    df = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    got = {(r.word, r.near) for r in spelling.near_words(df, piece=piece, shard_words=shard_words).collect()}
    assert got == {(a, b) for a in words for b in words if one_edit(a, b)}


def test_index_blocks_and_unknown_letters(monkeypatch):
    rng = random.Random(2)
    words = sorted({"".join(rng.choices("abc", k=rng.randint(1, 6))) for _ in range(300)})
    monkeypatch.setattr(spelling, "INDEX_WORDS", 70)
    monkeypatch.setattr(spelling, "QUERIES", 9)
    import pandas as pd

    got = spelling._near_in_shard(pd.DataFrame({"word": words, "n": 1}))
    assert set(zip(got["word"], got["near"], strict=True)) == {(a, b) for a in words for b in words if one_edit(a, b)}
    assert len(got) == len(set(zip(got["word"], got["near"], strict=True)))


def test_variants_of_nothing(spark):
    got = spelling.variants(spark.createDataFrame([], DOCS))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"] and not got.collect()


# ----------------------------------------------------------------- trie

def conversations(seed=1, n=90):
    rng = random.Random(seed)
    say = lambda: " ".join(rng.choices(["a", "b\tc", "d\n", "é"], k=rng.randint(0, 3)))
    rows = [(None, 0, "user", "lost"), (-40, 1, "user", "x"), (-21, None, None, None)]
    for c in range(n):
        if c % 11 == 0:
            continue
        long = 60 if c in (5, 25) else rng.randint(1, 5)
        rows += [(c, t, rng.choice(["user", "assistant", "system", None]) if t else "user", say() if t else "hello") for t in range(long)]
    common = [(t, "user", f"turn {t}") for t in range(4)]
    rows += [(c, *t) for c in range(200, 400, 3) for t in common]  # many copies of one conversation
    rows += [(500, 3, "user", "late"), (500, None, "user", "first"), (500, None, "assistant", "second"), (500, 3, "user", "late")]
    return [(*r, 1, "clash", 2, "clash") for r in rows]


def trie_by_hand(rows):
    own = collections.defaultdict(list)
    for c, t, r, x, *_ in rows:
        if c is not None:
            own[c].append(((t is not None, t or 0), r or "", x or ""))
    # ties by a digest of (role, text)
    digest = lambda r, x: hashlib.md5(f"{len(r)}:{r}{x}".encode()).digest()
    own = {c: [(r, x) for _, r, x in sorted(v, key=lambda t: (t[0], t[1], digest(t[1], t[2])))] for c, v in own.items()}
    seqs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        seqs[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members, kids = collections.defaultdict(list), collections.defaultdict(set)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
            if d:
                kids[s[: d - 1]].add(s[:d])
    leaves, saved = {}, {}
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in kids[k]) or 1
        saved[k] = sum(saved[x] for x in kids[k]) + ((len(members[k]) - 1) * len(WORD.findall(k[-1][1])) if k else 0)
    rows = [
        (min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(kids[k]), leaves[k], saved[k], sha(",".join(str(c) for c in sorted(m) if seqs[c] == k)))
        for k, m in members.items()
    ]
    return sorted(rows, key=str)


def test_trie_equals_brute_force(spark):
    rows = conversations()
    got = prefix_trie.conversation_trie(spark.createDataFrame(rows, TURNS).repartition(4))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == trie_by_hand(rows)


@pytest.mark.parametrize("shard_turns", [1, 40, 300])
def test_trie_over_many_shards_and_levels(spark, shard_turns):
    rows = conversations(seed=4, n=160)
    seqs = prefix_trie.borrowed_heads(prefix_trie.sequences(spark.createDataFrame(rows, TURNS).repartition(4)))
    got = prefix_trie.trie(seqs, shard_turns=shard_turns)
    assert sorted((tuple(r) for r in got.collect()), key=str) == trie_by_hand(rows)


def test_ternary_tree_is_balanced_and_whole():
    rng = random.Random(3)
    seqs = sorted({tuple(rng.choices(range(200), k=rng.randint(0, 3))) for _ in range(3000)})
    tree = prefix_trie.TernaryTree()
    paths = {}
    order = prefix_trie.median_order(len(seqs))
    assert sorted(order) == list(range(len(seqs)))
    for i in order:
        paths[seqs[i]] = tree.insert(seqs[i])
    prefixes = {s[:d]: p[d] for s, p in paths.items() for d in range(len(s) + 1)}
    assert len(prefixes) == len(tree.turn) == len(set(prefixes.values()))
    assert all(tree.parent[v] == prefixes[k[:-1]] and tree.depth[v] == len(k) for k, v in prefixes.items() if k)

    def height(v):
        return 0 if not v else 1 + max(height(tree.lo[v]), height(tree.hi[v]))

    assert height(tree.eq[0]) <= 12  # 200 siblings


def test_trie_of_nothing(spark):
    assert not prefix_trie.conversation_trie(spark.createDataFrame([], TURNS)).collect()


# ----------------------------------------------------------------- chat

CONTROL = [*chat_format.TEMPLATE.marks, "\\", "\\\\", "[", "<", "[\\INST]", "[INST", "]", "é", "\n", "x y", ""]


def chats(seed=2):
    rng = random.Random(seed)
    text = lambda: "".join(rng.choices(CONTROL, k=rng.randint(0, 9)))
    rows = [(None, 0, "assistant", "of no one"), (1, None, None, None), (1, 0, "", ""), (2, 0, "odd\nrole[/ROLE]", "[/TURN]"), (2, 1, "assistant", None)]
    rows += [(3, t, "assistant", text() + "é" * 3000) for t in range(400)]  # one long conversation
    rows += [(4, 0, "user", "[INST]" * 30000), (4, 1, "assistant", "\\" * 50001 + "</s>")]
    rows += [(5, 0, "assistant", "same")] * 3
    rows += [(c, t, rng.choice(["user", "assistant", "system", "tool", None]), rng.choice([text(), None])) for c in range(10, 120) for t in range(rng.randint(1, 6))]
    return [(*r, 1, "clash", 2, "clash") for r in rows]


def chats_by_hand(rows):
    conv = collections.defaultdict(list)
    for c, t, r, x, *_ in rows:
        conv[c].append(((t is not None, t or 0), r or "", x or ""))
    out = {}
    for c, turns in conv.items():
        turns = sorted(turns, key=lambda t: t[:2])
        loss = "".join(x for _, r, x in turns if r == "assistant")
        out[c] = (len(turns), sha("".join(f"{r}\n{x}\n" for _, r, x in turns)), len(loss), sha(loss))
    return out


def written(turns):
    """The template's string, written out plainly."""
    t = chat_format.TEMPLATE
    of = {r: (a, b) for r, a, b in t.roles}
    mark = re.compile("|".join(map(re.escape, t.marks)))
    put = lambda s: mark.sub(lambda m: m[0][0] + "\\" + m[0][1:], s.replace("\\", "\\\\"))
    o, m, e = t.other
    return "".join(of[r][0] + put(x) + of[r][1] if r in of else o + put(r) + m + put(x) + e for r, x in turns)


def test_chat_round_trip_and_contract_columns(spark):
    rows = chats()
    df = spark.createDataFrame(rows, TURNS).repartition(3)
    pieces = chat_format.format_conversations(df)
    got = {r.conv_id: r for r in chat_format.digests(pieces).collect()}
    want = chats_by_hand(rows)
    assert {c: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for c, r in got.items()} == want
    whole = collections.defaultdict(list)
    for p in pieces.collect():
        assert p.n_chars == len(p.formatted)
        whole[p.conv_id].append((p.piece, p.formatted, p.loss))
    assert len(whole[3]) > 1, "the long conversation is one piece"
    strings = {c: "".join(f for _, f, _ in sorted(v, key=lambda x: x[0])) for c, v in whole.items()}
    assert {c: len(s) for c, s in strings.items()} == {c: r.formatted_chars for c, r in got.items()}
    conv = collections.defaultdict(list)
    for c, t, r, x, *_ in rows:
        conv[c].append(((t is not None, t or 0), r or "", x or ""))
    assert {c: s for c, s in strings.items()} == {c: written([t[1:] for t in sorted(v, key=lambda t: t[:2])]) for c, v in conv.items()}
    # the mask covers the escaped assistant text and no mark
    marks = re.compile("|".join(map(re.escape, chat_format.TEMPLATE.marks)))
    assert not any(marks.search(f[a:b]) for v in whole.values() for _, f, loss in v for a, b in loss)


@pytest.mark.parametrize("seed", range(20))
def test_escape_is_reversible_and_hides_marks(seed):
    rng = random.Random(seed)
    rows = ["".join(rng.choices(CONTROL, k=rng.randint(0, 12))) for _ in range(50)]
    data = [r.encode() for r in rows]
    off = np.r_[0, np.cumsum([len(b) for b in data])]
    marks = chat_format.TEMPLATE.marks
    out, to = chat_format.escape(np.frombuffer(b"".join(data), np.uint8), off, marks)
    assert len(chat_format.find_marks(out, to, marks)[0]) == 0
    drop = chat_format.escapes(out)
    assert [out[a:b][~drop[a:b]].tobytes() for a, b in zip(to[:-1], to[1:], strict=True)] == data


def test_template_refuses_ambiguous_marks():
    for marks in (("[A]", "[A]B", "[C]"), ("x", "[B]", "[C]"), ("[[A]", "[B]", "[C]"), ("[\\A]", "[B]", "[C]")):
        with pytest.raises(ValueError):
            chat_format.Template(other=marks)


def test_another_template_and_key_type(spark):
    t = chat_format.Template(roles=(("user", "<u>", "</u>"), ("bot", "<b>", "</b>")), other=("<r>", "</r>", "<end>"), trained=("user", "bot"))
    df = spark.createDataFrame([("c1", 0, "user", "<b>a</b>"), ("c1", 1, "bot", "<x>"), (None, 0, "sys", "[INST]")], "conv_id string, turn int, role string, text string")
    pieces = {p.conv_id: p.formatted for p in chat_format.format_conversations(df, t).collect()}
    assert pieces == {"c1": "<u><\\b>a<\\/b></u><b><x></b>", None: "<r>sys</r>[INST]<end>"}
    got = {r.conv_id: (r.n_turns, r.loss_chars, r.loss_sha256) for r in chat_format.digests(chat_format.format_conversations(df, t), t).collect()}
    assert got == {"c1": (2, 11, sha("<b>a</b><x>")), None: (1, 0, sha(""))}


def test_chat_of_nothing(spark):
    pieces = chat_format.format_conversations(spark.createDataFrame([], TURNS))
    assert not chat_format.digests(pieces).collect()


def test_assemble_copies_long_segments_too():
    rng = np.random.default_rng(0)
    src = rng.integers(0, 256, 3 * chat_format.SLICE_BYTES, dtype=np.uint8)
    start = np.array([[0, 5], [7, 100], [3, 3]])
    size = np.array([[4, chat_format.SLICE_BYTES + 9], [0, 2 * chat_format.SLICE_BYTES], [1, 0]])
    buffer, to, off = chat_format.assemble(src, start, size)
    want = [b"".join(src[a : a + k].tobytes() for a, k in zip(s, z, strict=True)) for s, z in zip(start, size, strict=True)]
    assert bytes(buffer) == b"".join(want) and [len(w) for w in want] == np.diff(off).tolist()
    assert to[1, 1] == len(want[0])
    assert textops.CHUNK_BYTES > chat_format.SLICE_BYTES


def test_null_ids_in_the_damage_rule(spark):
    rows = [(None, "abcdef " * 4, "", 0, "", "")]
    got = found(spelling.variants(spark.createDataFrame(rows, DOCS).withColumn("extra", F.lit(1))))
    assert got == variants_by_hand(rows)
