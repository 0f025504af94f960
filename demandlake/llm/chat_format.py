"""Chat formatting by columnar byte assembly.

A conversation becomes one string: every turn stands between the marks of its
role, and the spans under the loss mask are the texts of the trained roles.
Control strings (the template's marks) inside texts and roles are escaped,
reversibly: a backslash is put before each backslash and behind the first
character of each control string, so no mark is ever found in a text.

Turns are dealt by ranges of (conv_id, turn), so a conversation of any length
is spread over tasks; inside a task the turns of one chunk (``CHUNK_BYTES`` of
text) are laid out at once: lengths of all segments, their cumulative offsets,
and the source index of every byte are arrays, and all bytes are copied into
one preallocated Arrow buffer.  A conversation that is cut by a chunk or task
border gives several pieces; concatenated in the order of ``piece`` they are
its string.

Defined results: a null text or role is empty; a null conv_id is a
conversation of its own; turns of one conversation go by turn, nulls first,
then by role, then by a hash of the text; repeated rows are turns of their
own; an empty table gives an empty result; other columns are not read.  A turn
is formatted whole, whatever its length.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlake.llm import textops as T
from demandlake.llm.tables import keep, ship, text_or_empty

ESCAPE = ord("\\")
STARTS = b"<["
#: Segments from this length on are copied as slices, not by index.
SLICE_BYTES = 1 << 16
PIECES = "piece long, n_turns long, formatted string, loss array<struct<start:long,end:long>>, n_chars long, whole boolean"
DIGESTS = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


@dataclass(frozen=True)
class Template:
    """Marks of the turns: ``roles`` are (role, open, close); any other role
    is written out between ``other``'s first two marks, its text before the
    third.  ``trained`` are the roles under the loss mask.  A mark starts with
    one of ``<[``, holds neither of them again, and no mark begins another."""

    roles: tuple[tuple[str, str, str], ...] = (("user", "[INST]", "[/INST]"), ("assistant", "[ANS]", "</s>"), ("system", "[SYS]", "[/SYS]"))
    other: tuple[str, str, str] = ("[ROLE]", "[/ROLE]", "[/TURN]")
    trained: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        for m in self.marks:
            b = m.encode("ascii")
            if len(b) < 2 or b[0] not in STARTS or any(c in STARTS or c == ESCAPE for c in b[1:]):
                raise ValueError(f"not a mark: {m!r}")
            if any(o != m and o.startswith(m) for o in self.marks):
                raise ValueError(f"{m!r} begins another mark")

    @property
    def marks(self) -> list[str]:
        return sorted({m for _, a, b in self.roles for m in (a, b)} | set(self.other))


TEMPLATE = Template()


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The indices of all spans [start, start + length), one after another."""
    before = np.cumsum(length) - length
    return np.repeat(start - before, length) + np.arange(int(length.sum()))


def assemble(src: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[pa.Buffer, np.ndarray, np.ndarray]:
    """Rows of segments, given as (row, segment) matrices of spans of ``src``,
    laid out in one Arrow buffer: (buffer, start of each segment, total)."""
    flat, size = start.ravel(), length.ravel()
    to = np.cumsum(size) - size
    total = int(size.sum())
    buffer = pa.allocate_buffer(total)
    out = np.frombuffer(buffer, np.uint8)
    small = size < SLICE_BYTES
    for i in np.flatnonzero(~small):
        out[to[i] : to[i] + size[i]] = src[flat[i] : flat[i] + size[i]]
    out[ranges(to[small], size[small])] = src[ranges(flat[small], size[small])]
    return buffer, to.reshape(start.shape), np.append(to.reshape(start.shape)[:, 0], total)


def find_marks(data: np.ndarray, off: np.ndarray, marks: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(position, index of the mark) of all marks in the texts, by position."""
    at = np.flatnonzero(np.isin(data, np.frombuffer(STARTS, np.uint8)))
    end = off[np.searchsorted(off, at, "right")] if len(at) else at
    pos, kind = [], []
    for k, m in enumerate(marks):
        b = m.encode("ascii")
        here = at[at + len(b) <= end]
        for j, c in enumerate(b):
            here = here[data[here + j] == c]
        pos.append(here)
        kind.append(np.full(len(here), k))
    pos, kind = np.concatenate(pos), np.concatenate(kind)
    order = np.argsort(pos, kind="stable")
    return pos[order], kind[order]


def escape(data: np.ndarray, off: np.ndarray, marks: list[str]) -> tuple[np.ndarray, np.ndarray]:
    at = np.sort(np.concatenate([np.flatnonzero(data == ESCAPE), find_marks(data, off, marks)[0] + 1]))
    return np.insert(data, at, ESCAPE), off + np.searchsorted(at, off, "left")


def escapes(data: np.ndarray) -> np.ndarray:
    """Mask of the bytes that ``escape`` put in: of a run of backslashes the
    first, third, and so on."""
    out = data == ESCAPE
    at = np.flatnonzero(out)
    if len(at):
        first = np.r_[True, at[1:] != at[:-1] + 1]
        start = at[first][np.cumsum(first) - 1]
        out[at[(at - start) % 2 == 1]] = False
    return out


def _lead(data: np.ndarray) -> np.ndarray:
    return (data & 0xC0) != 0x80


def _strings(values: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, lengths) of a few strings."""
    b = [v.encode() for v in values]
    size = np.array([len(x) for x in b], np.int64)
    return np.frombuffer(b"".join(b), np.uint8), np.cumsum(size) - size, size


def _format(template: Template):
    """Arrow batches of (conv_id, role, text), in order, to pieces."""
    marks = template.marks
    table, mark_at, mark_len = _strings(["", *marks])
    of = {m: i + 1 for i, m in enumerate(marks)}
    names = [r for r, _, _ in template.roles]
    opens = np.array([*(of[a] for _, a, _ in template.roles), of[template.other[0]]])
    mids = np.array([*(0 for _ in template.roles), of[template.other[1]]])
    closes = np.array([*(of[b] for _, _, b in template.roles), of[template.other[2]]])
    trained = np.array([*(r in template.trained for r in names), False])

    def run(batches):
        chunk = TaskContext.get().partitionId() << 32
        for rows, data, off in T.chunks(batches):
            role = rows.column("role")
            code = pc.fill_null(pc.index_in(role, pa.array(names, pa.string())), len(names)).to_numpy(zero_copy_only=False)
            written = pc.if_else(pa.array(code == len(names)), role, "")
            text, text_off = escape(data, off, marks)
            named, named_off = escape(*T.utf8(written), marks)
            n = rows.num_rows
            src = np.concatenate([text, named, table])
            at, size = np.zeros((n, 5), np.int64), np.zeros((n, 5), np.int64)
            at[:, 1], size[:, 1] = len(text) + named_off[:-1], np.diff(named_off)
            at[:, 3], size[:, 3] = text_off[:-1], np.diff(text_off)
            for j, which in ((0, opens[code]), (2, mids[code]), (4, closes[code])):
                at[:, j], size[:, j] = len(text) + len(named) + mark_at[which], mark_len[which]
            buffer, to, row_off = assemble(src, at, size)
            points = np.r_[0, np.cumsum(_lead(np.frombuffer(buffer, np.uint8)))]
            ends = pc.run_end_encode(rows.column("conv_id")).run_ends.to_numpy().astype(np.int64)
            first = np.r_[0, ends[:-1]]
            piece_off = row_off[np.r_[0, ends]]
            formatted = pa.LargeStringArray.from_buffers(len(ends), pa.py_buffer(piece_off), buffer)
            learn = np.flatnonzero(trained[code])
            base = points[piece_off[:-1]][np.searchsorted(ends, learn, "right")]
            spans = pa.StructArray.from_arrays(
                [pa.array(points[to[learn, 3]] - base), pa.array(points[to[learn, 3] + size[learn, 3]] - base)], ["start", "end"]
            )
            inner = np.ones(len(ends), bool)
            inner[[0, -1]] = False
            yield pa.RecordBatch.from_arrays([
                rows.column("conv_id").take(pa.array(first)), pa.array(np.full(len(ends), chunk)), pa.array(ends - first), formatted.cast(pa.string()),
                pa.ListArray.from_arrays(pa.array(np.searchsorted(learn, np.r_[0, ends]).astype(np.int32)), spans),
                pa.array(np.diff(points[piece_off])), pa.array(inner),
            ], ["conv_id", "piece", "n_turns", "formatted", "loss", "n_chars", "whole"])
            chunk += 1

    return run


def format_conversations(conversations: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """conv_id, piece, n_turns, formatted, loss (code-point spans of the piece
    under the loss mask), n_chars, whole (no other piece of its conversation)."""
    ship(conversations.sparkSession)
    turns = conversations.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), text_or_empty().alias("text"))
    order = ["conv_id", "turn", "role", F.xxhash64("text")]
    turns = turns.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "role", "text")
    return turns.mapInArrow(_format(template), f"conv_id {_type(conversations)}, {PIECES}")


def _type(df: DataFrame) -> str:
    return df.schema["conv_id"].dataType.simpleString()


def parse(data: np.ndarray, off: np.ndarray, template: Template):
    """Reads formatted pieces back: (bytes without escapes plus the roles'
    names and a line feed, spans of (role, line feed, text, line feed) by
    turn, piece of each turn, where a byte of ``data`` has gone)."""
    marks = template.marks
    of = {m: i for i, m in enumerate(marks)}
    pos, kind = find_marks(data, off, marks)
    put = escapes(data)
    gone = np.r_[0, np.cumsum(~put)]  # place of each byte when the escapes are out
    names, name_at, name_len = _strings([*(r for r, _, _ in template.roles), "\n"])
    plain = data[~put]
    src = np.concatenate([plain, names])
    opens = np.full(len(marks), -1)
    opens[[of[a] for _, a, _ in template.roles]] = np.arange(len(template.roles))
    opens[of[template.other[0]]] = len(template.roles)
    turn = np.flatnonzero(opens[kind] >= 0)
    role = opens[kind[turn]]
    stated = role == len(template.roles)  # the role stands in the text
    head = turn + stated  # the mark before the text
    length = np.array([len(m) for m in marks])
    text, end = pos[head] + length[kind[head]], pos[head + 1]
    at, size = np.zeros((len(turn), 4), np.int64), np.zeros((len(turn), 4), np.int64)
    which = np.minimum(role, len(template.roles) - 1)
    at[:, 0], size[:, 0] = len(plain) + name_at[which], name_len[which]
    role_at = pos[turn[stated]] + length[kind[turn[stated]]]
    at[stated, 0], size[stated, 0] = gone[role_at], gone[pos[head[stated]]] - gone[role_at]
    at[:, 2], size[:, 2] = gone[text], gone[end] - gone[text]
    at[:, 1] = at[:, 3] = len(plain) + name_at[-1]
    size[:, 1] = size[:, 3] = 1
    return src, at, size, np.searchsorted(off, pos[turn], "right") - 1, gone


class _Digest:
    def __init__(self, key):
        self.key, self.turns, self.loss = key, hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0


def _read_back(template: Template, cut: bool):
    """Pieces, in order, to digests by conversation.  ``cut=False`` digests
    whole conversations only and hands the pieces of the others on."""
    names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def row(d: _Digest):
        return [d.n_turns, d.turns.hexdigest(), d.loss_chars, d.loss.hexdigest(), d.chars]

    def run(batches):
        open_ = None
        for rows, data, off in T.chunks(batches, "formatted"):
            n = rows.num_rows
            src, at, size, piece, gone = parse(data, off, template)
            said, _, said_off = assemble(src, at, size)
            turn_off = np.searchsorted(piece, np.arange(n + 1))
            lead = np.append(np.flatnonzero(_lead(data)), len(data))
            base = np.searchsorted(lead, off[:-1])
            loss = rows.column("loss")
            loss_off = loss.offsets.to_numpy().astype(np.int64)
            spans = loss.values
            owner = np.repeat(np.arange(n), np.diff(loss_off))
            ls, le = (spans.field(f).to_numpy(zero_copy_only=False)[loss_off[0] : loss_off[-1]] for f in ("start", "end"))
            ls, le = gone[lead[base[owner] + ls]], gone[lead[base[owner] + le]]
            learnt, _, learnt_off = assemble(src, ls[:, None], (le - ls)[:, None])
            loss_off -= loss_off[0]
            points = np.r_[0, np.cumsum(_lead(np.frombuffer(learnt, np.uint8)))]
            whole = rows.column("whole").to_pylist()
            done = []
            for i, key in enumerate(rows.column("conv_id").to_pylist()):
                if not cut and not whole[i]:
                    continue
                if open_ is None or open_[1].key != key or not cut:
                    if cut and open_ is not None:
                        done.append(open_)
                    open_ = (key, _Digest(key))
                d = open_[1]
                d.n_turns += int(turn_off[i + 1] - turn_off[i])
                d.turns.update(memoryview(said)[said_off[turn_off[i]] : said_off[turn_off[i + 1]]])
                a, b = learnt_off[loss_off[i]], learnt_off[loss_off[i + 1]]
                d.loss.update(memoryview(learnt)[a:b])
                d.loss_chars += int(points[b] - points[a])
                d.chars += int(base[i + 1] - base[i]) if i + 1 < n else int(len(lead) - 1 - base[i])
                if not cut:
                    done.append(open_)
            yield from _rows(done, rows, whole, row, names, cut)
        if cut and open_ is not None:
            yield _batch([open_], rows.schema.field("conv_id").type, row, names)

    return run


def _batch(done, kind, row, names):
    cols = list(zip(*[row(d) for _, d in done], strict=True)) or [[]] * len(names)
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], kind), *(pa.array(list(c), t) for c, t in zip(cols, types, strict=True))], ["conv_id", *names])


def _rows(done, rows, whole, row, names, cut):
    """Digest rows; with ``cut=False`` the pieces left go along in a column."""
    kind = rows.schema.field("conv_id").type
    got = _batch(done, kind, row, names)
    if cut:
        yield got
        return
    left = rows.filter(pa.array([not w for w in whole]))
    held = pa.StructArray.from_arrays([left.column(c) for c in ("piece", "formatted", "loss")], ["piece", "formatted", "loss"])
    yield pa.RecordBatch.from_arrays([*got.columns, pa.nulls(got.num_rows, held.type)], [*got.schema.names, "held"])
    blank = [pa.nulls(left.num_rows, got.schema.field(c).type) for c in names]
    yield pa.RecordBatch.from_arrays([left.column("conv_id"), *blank, held], [*got.schema.names, "held"])


def digests(pieces: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """What the formatted conversations say, read back from them: conv_id,
    n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    A conversation that lies in one piece is read where it is; only pieces of
    cut ones move.  The digest of a conversation is a chain over all of its
    bytes, so its pieces pass through one task, one at a time."""
    kind = _type(pieces)
    held = "held struct<piece:long,formatted:string,loss:array<struct<start:long,end:long>>>"
    first = keep(pieces.mapInArrow(_read_back(template, False), f"conv_id {kind}, {DIGESTS}, {held}"), "chat-digests")
    cut = first.where("held IS NOT NULL").select("conv_id", "held.*", F.lit(False).alias("whole"))
    cut = cut.repartition("conv_id").sortWithinPartitions("conv_id", "piece").drop("piece")
    rest = cut.mapInArrow(_read_back(template, True), f"conv_id {kind}, {DIGESTS}")
    return first.where("held IS NULL").drop("held").unionByName(rest)
