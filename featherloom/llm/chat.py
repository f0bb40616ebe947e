"""Chat formatting by columnar byte assembly, with reversible escaping and loss spans."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# fixed values: the template and the control strings that no text may contain unescaped
OPEN, BREAK, CLOSE = b"<|im_start|>", b"\n", b"<|im_end|>\n"
CONTROLS = (b"<|im_start|>", b"<|im_end|>", b"<s>", b"</s>", b"[INST]", b"[/INST]")
BACKSLASH = 0x5C


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the n+1 offsets of its rows; nulls are empty."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None and offsets[-1] > offsets[0] else np.empty(0, np.uint8)
    return flat, offsets - offsets[0]


def _escapes(flat: np.ndarray, offsets: np.ndarray, line: bool) -> np.ndarray:
    """Per byte whether a backslash goes before it: backslashes, the second byte of every control string, and newlines if ``line``."""
    mark = flat == BACKSLASH
    if line:
        mark |= flat == 10
    ends = np.repeat(offsets[1:], np.diff(offsets))
    for c in CONTROLS:
        n = len(c)
        if len(flat) < n:
            continue
        at = np.flatnonzero(flat[:len(flat) - n + 1] == c[0])
        for k in range(1, n):
            at = at[flat[at + k] == c[k]]
        mark[at[at + n <= ends[at]] + 1] = True
    return mark


class _Piece:
    """A column of escaped texts: lengths, and how to copy them to given places."""

    def __init__(self, column: pa.Array, line: bool = False):
        self.flat, self.offsets = _bytes_of(column)
        self.mark = _escapes(self.flat, self.offsets, line)
        self.sums = np.concatenate([[0], np.cumsum(self.mark)])
        self.lengths = np.diff(self.offsets) + np.diff(self.sums[self.offsets])

    def put(self, out: np.ndarray, starts: np.ndarray) -> None:
        move = np.repeat(starts - self.offsets[:-1] - self.sums[self.offsets[:-1]], np.diff(self.offsets))
        to = np.arange(len(self.flat)) + self.sums[1:] + move
        out[to] = self.flat
        out[to[self.mark] - 1] = BACKSLASH


def assemble(turns: pa.Table) -> pa.RecordBatch:
    """Formats whole conversations, given in order: one row each with its text, turn count and loss spans (code points, end exclusive)."""
    n = turns.num_rows
    role, text = (_Piece(turns.column(c).combine_chunks(), line) for c, line in (("role", True), ("text", False)))
    sizes = np.stack([np.full(n, len(OPEN)), role.lengths, np.full(n, len(BREAK)), text.lengths, np.full(n, len(CLOSE))], axis=1)
    places = np.concatenate([[0], np.cumsum(sizes.ravel())])
    starts, total = places[:-1].reshape(n, 5), int(places[-1])
    buffer = pa.allocate_buffer(total)
    out = np.frombuffer(buffer, np.uint8)
    for k, fixed in ((0, OPEN), (2, BREAK), (4, CLOSE)):
        out[(starts[:, k][:, None] + np.arange(len(fixed))).ravel()] = np.tile(np.frombuffer(fixed, np.uint8), n)
    role.put(out, starts[:, 1])
    text.put(out, starts[:, 3])
    keys = turns.column("conv_id").to_pylist()
    first = np.array([i for i in range(n) if i == 0 or keys[i] != keys[i - 1]], np.int64)
    bounds = np.append(first, n)
    at = np.append(starts[first, 0], total).astype(np.int64)
    points = np.concatenate([[0], np.cumsum((out & 0xC0) != 0x80)])  # code points before each byte
    learned = np.array([r == "assistant" for r in turns.column("role").to_pylist()], bool)
    base = np.repeat(points[at[:-1]], np.diff(bounds))
    lo, hi = points[starts[:, 3]] - base, points[starts[:, 4]] - base
    count = np.concatenate([[0], np.cumsum(learned)])[bounds].astype(np.int32)
    return pa.record_batch({
        "conv_id": turns.column("conv_id").combine_chunks().take(pa.array(first)),
        "n_turns": pa.array(np.diff(bounds), pa.int64()),
        "formatted": pa.Array.from_buffers(pa.large_string(), len(first), [None, pa.py_buffer(at), buffer]).cast(pa.string()),
        "loss_start": pa.ListArray.from_arrays(pa.array(count), pa.array(lo[learned], pa.int64())),
        "loss_end": pa.ListArray.from_arrays(pa.array(count), pa.array(hi[learned], pa.int64())),
    })


def format_chats(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, n_turns, formatted, loss_start, loss_end (places of the assistant texts in ``formatted``).

    ``turns``: conv_id, turn, role, text. Rows are taken by turn, ties by role and text; null roles and texts are empty, rows with null
    conv_id are one conversation, other columns are ignored, an empty table gives none. Conversations are dealt by id and streamed in
    order, so a task holds one batch of rows and the rows of one unfinished conversation; a conversation is one value of the result and
    therefore must fit a task.
    """
    kind = dict(turns.dtypes)["conv_id"]
    placed = turns.select("conv_id", "turn", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            if not b.num_rows:
                continue
            keys = b.column("conv_id").to_pylist()
            cut = len(keys) - 1
            while cut and keys[cut - 1] == keys[-1]:
                cut -= 1
            if cut == 0 and (not held or held[-1].column("conv_id")[-1].as_py() == keys[0]):
                held.append(b)  # still the same conversation
                continue
            done = pa.Table.from_batches([*held, b.slice(0, cut)])
            if done.num_rows:
                yield assemble(done)
            held = [b.slice(cut)]
        if held:
            yield assemble(pa.Table.from_batches(held))

    return placed.mapInArrow(run, f"conv_id {kind}, n_turns long, formatted string, loss_start array<long>, loss_end array<long>")


_TURN = re.compile(r"<\|im_start\|>((?:[^\\\n]|\\.)*)\n(.*?)<\|im_end\|>\n", re.S)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns (role, text) of a formatted conversation; raises if anything else stands in it."""
    turns, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return turns


def digests(formatted: DataFrame) -> DataFrame:
    """What stands in the formatted conversations, read back from them: turn count, digests of all turns and of the text under the mask."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for cid, text, lo, hi in zip(*(b.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_start", "loss_end"))):
                turns = parse(text)
                loss = "".join(unescape(text[i:j]) for i, j in zip(lo, hi))
                rows.append((cid, len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
                             len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            kinds = [b.schema.field("conv_id").type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    return formatted.mapInArrow(run, T.StructType([
        *[f for f in formatted.select("conv_id").schema.fields], T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()),
        T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType())]))
