"""Chat formatting by columnar byte assembly.

A turn becomes ``<s>[INST] role [/INST] text</s>``; a conversation is its turns one after the other. Control strings inside
roles and texts get a backslash after their first character and backslashes are doubled, so no control string of a
role or text is left, and taking the backslashes away gives back what was there.

A batch of turns is formatted column by column: the lengths of all segments (fixed strings, roles, texts), running
offsets, and for every output byte the place it comes from, all in numpy; the bytes are then copied at once into one
preallocated Arrow buffer, which is the column of formatted conversations. Formatting needs no shuffle but the one that
brings a conversation's turns together in order. A conversation is one value of the result; turns of any number of
conversations pass through a task batch by batch, and only an unfinished conversation is carried on.

Null roles and texts are empty; a null turn comes first; turns alike in number follow by role and text; rows with a null
conversation id are one conversation. Repeated rows are turns of their own. An empty table gives an empty result. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.llm.common import text_of

#: Strings that mark turns; they never stand in an escaped role or text.
CONTROL = ("</s>", "<s>", "[/INST]", "[INST]")
OPEN, MIDDLE, CLOSE = "<s>[INST] ", " [/INST] ", "</s>"
LEARNED_ROLES = ("assistant",)
#: Output bytes assembled at a time.
AT_ONCE = 1 << 21

_CONTROL_PATTERN = "(" + "|".join(re.escape(c[0]) for c in dict.fromkeys(x[0] for x in CONTROL)) + ")(" + "|".join(re.escape(c[1:]) for c in CONTROL) + ")"
_TURN = re.compile(re.escape(OPEN) + r"(.*?)" + re.escape(MIDDLE) + r"(.*?)" + re.escape(CLOSE), re.DOTALL)


def escape(column: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(pc.replace_substring(column, "\\", "\\\\"), _CONTROL_PATTERN, r"\1\\\2")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The data buffer of a string column, and where each value starts and how long it is."""
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw, ends[:-1], np.diff(ends)


def assemble(columns: Sequence[pa.Array | str], rows: int) -> tuple[pa.Buffer, np.ndarray]:
    """The values of ``columns`` (a string stands for itself in each row) row after row in one buffer; each segment's offsets."""
    sources, starts, lengths, base = [], [], [], 0
    for column in columns:
        if isinstance(column, str):
            raw = np.frombuffer(column.encode(), np.uint8)
            start, length = np.zeros(rows, np.int64), np.full(rows, len(raw), np.int64)
        else:
            raw, start, length = _bytes_of(column)
        sources.append(raw)
        starts.append(start + base)
        lengths.append(length)
        base += len(raw)
    pool = np.concatenate(sources)
    start, length = np.stack(starts, 1).ravel(), np.stack(lengths, 1).ravel()
    offsets = np.concatenate([[0], np.cumsum(length)])
    buffer = pa.allocate_buffer(int(offsets[-1]))
    out = np.frombuffer(buffer, np.uint8)
    a = 0
    while a < len(length):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + AT_ONCE, side="right")) - 1)
        first, last = offsets[a], offsets[b]
        if b == a + 1:
            out[first:last] = pool[start[a] : start[a] + length[a]]
        else:
            #: the place in the pool that each output byte is copied from
            out[first:last] = pool[np.repeat(start[a:b] - offsets[a:b], length[a:b]) + np.arange(first, last)]
        a = b
    return buffer, offsets


def _formatted(turns: pa.Table, learned: Sequence[str]) -> pa.RecordBatch:
    """One row per conversation of whole conversations' turns, in order: id, number of turns, text, learned spans."""
    turns = turns.combine_chunks()
    rows = turns.num_rows
    role, text = (turns.column(c).combine_chunks() for c in ("role", "text"))
    role, text = (c if isinstance(c, pa.Array) else pa.concat_arrays(c.chunks) for c in (role, text))
    buffer, offsets = assemble([OPEN, escape(role), MIDDLE, escape(text), CLOSE], rows)
    group = turns.column("group").to_numpy()
    firsts = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [rows]])
    byte_at = offsets.reshape(-1)[::5]
    ends = np.append(byte_at[firsts[:-1]], offsets[-1]).astype(np.int64)
    made = pa.LargeStringArray.from_buffers(len(firsts) - 1, pa.py_buffer(ends.tobytes()), buffer)
    #: spans count characters; a character begins at each byte that doesn't continue one
    begins = np.concatenate([[0], np.cumsum((np.frombuffer(buffer, np.uint8) & 0xC0) != 0x80)])
    bounds = begins[offsets]
    is_learned = pc.is_in(role, pa.array(list(learned), pa.string())).to_numpy(zero_copy_only=False)
    which = np.flatnonzero(is_learned)
    owner = np.searchsorted(firsts, which, side="right") - 1
    from_start = bounds[5 * firsts[owner]]
    spans = pa.StructArray.from_arrays(
        [pa.array(bounds[5 * which + 3] - from_start), pa.array(bounds[5 * which + 4] - from_start)], ["start", "end"]
    )
    counts = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(firsts) - 1))]).astype(np.int32)
    ids = turns.column("conv").combine_chunks().take(pa.array(firsts[:-1]))
    return pa.RecordBatch.from_arrays(
        [ids if isinstance(ids, pa.Array) else pa.concat_arrays(ids.chunks), pa.array(np.diff(firsts)), made.cast(pa.string()), pa.ListArray.from_arrays(pa.array(counts), spans)],
        ["conv", "n_turns", "formatted", "learned"],
    )


def format_conversations(
    turns: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", learned: Sequence[str] = LEARNED_ROLES
) -> DataFrame:
    """conv, n_turns, formatted and learned (spans of characters of ``formatted`` that a model learns from) per conversation."""
    narrow = turns.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), text_of(role).alias("role"), text_of(text).alias("text"))
    kind = narrow.schema["conv"].dataType
    schema = T.StructType([
        T.StructField(conv, kind), T.StructField("n_turns", T.LongType()), T.StructField("formatted", T.StringType()),
        T.StructField("learned", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
    ])
    learned = tuple(learned)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last, number = None, 0

        def out(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            made = _formatted(pa.Table.from_batches(parts), learned)
            return made.rename_columns(schema.fieldNames())

        for batch in batches:
            for begin in range(0, batch.num_rows, 1024):
                part = batch.slice(begin, 1024)
                keys, groups = part.column(0).to_pylist(), []
                for key in keys:
                    if (held or groups) and key != last:
                        number += 1
                    last = key
                    groups.append(number)
                part = part.append_column("group", pa.array(groups, pa.int64()))
                start = next((i for i in range(len(groups) - 1, -1, -1) if groups[i] != groups[-1]), -1) + 1
                if start == 0 and (not held or held[-1].column("group")[-1].as_py() == groups[-1]):
                    held.append(part)
                    continue
                yield out([*held, part.slice(0, start)] if start else held)
                held = [part.slice(start)]
        if held:
            yield out(held)

    ordered = narrow.repartition("conv").sortWithinPartitions("conv", F.asc_nulls_first("turn"), "role", "text")
    return ordered.select("conv", "role", "text").mapInArrow(run, schema)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def digest(formatted: DataFrame, *, conv: str = "conv_id") -> DataFrame:
    """What the output itself says, per conversation: numbers and digests of its turns and of the text under the loss mask."""
    schema = T.StructType([
        T.StructField(conv, formatted.schema[conv].dataType), T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()),
        T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, whole, spans in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                turns = read_back(whole)
                said = hashlib.sha256()
                for role, text in turns:
                    said.update(f"{role}\n{text}\n".encode())
                loss = "".join(unescape(whole[s["start"] : s["end"]]) for s in spans)
                rows.append((key, len(turns), said.hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(whole)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([r[i] for r in rows], t) for i, t in ((1, pa.int64()), (2, pa.string()), (3, pa.int64()), (4, pa.string()), (5, pa.int64())))],
                schema.fieldNames(),
            )

    return formatted.select(conv, "formatted", "learned").mapInArrow(run, schema)
