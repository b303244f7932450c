"""Chat formatting by columnar byte assembly.

A turn becomes ``### Role: text </turn>`` and a line feed.  In texts a
backslash is doubled and ``###`` and ``</turn>`` get a backslash in front, so
that a control string without one is always the template's.  Each Arrow batch
is put together in one buffer: lengths of all segments, their running sums as
places, and one scatter for headers, contents and ends each.

A conversation is streamed in the order of (turn, role, text) and leaves in
chunks, so none has to fit in memory.  Null texts and roles count as empty,
null turns come first, equal rows are all kept, and rows whose conv_id is null
form one conversation.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import clean_columns, slices, text_buffer

NAMES = {"system": "System", "user": "User", "assistant": "Assistant"}
ROLES = {v: k for k, v in NAMES.items()}
OPEN, MIDDLE, CLOSE = "### ", ": ", " </turn>\n"

CHUNKS = "conv_id long, chunk long, formatted string, loss_start array<long>, loss_end array<long>"
DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

_TURN = re.compile(r"### ((?:[^\\:]|\\.)*+): ((?:[^\\ ]|\\.| (?!</turn>\n))*+) </turn>\n", re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(texts: pa.Array) -> pa.Array:
    for old, new in (("\\", "\\\\"), ("###", "\\###"), ("</turn>", "\\</turn>")):
        texts = pc.replace_substring(texts, old, new)
    return texts


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text) if "\\" in text else text


def header(role: str) -> str:
    """Roles without a name of their own are written behind an @."""
    name = NAMES.get(role) or "@" + role.replace("\\", "\\\\").replace(":", "\\:").replace("###", "\\###")
    return f"{OPEN}{name}{MIDDLE}"


def role_of(name: str) -> str:
    return unescape(name[1:]) if name.startswith("@") else ROLES[name]


def scatter(out: np.ndarray, places: np.ndarray, source: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> None:
    """Copy segment i of ``source`` to ``places[i]`` of ``out``, all at once."""
    before = np.cumsum(lengths) - lengths
    within = np.arange(int(lengths.sum())) - np.repeat(before, lengths)
    out[np.repeat(places, lengths) + within] = source[np.repeat(starts, lengths) + within]


def assemble(rows: pa.RecordBatch, chunk: int) -> pa.RecordBatch:
    """One output row for each run of equal conv_id."""
    conv = rows.column("conv_id")
    roles = pc.fill_null(rows.column("role"), "").dictionary_encode()
    names = [header(r).encode() for r in roles.dictionary.to_pylist()]
    role = roles.indices.to_numpy()
    content, offsets = text_buffer(escape(pc.fill_null(rows.column("text"), "")))
    head_len = np.array([len(x) for x in names], np.int64)
    text_len, end = np.diff(offsets), np.frombuffer(CLOSE.encode(), np.uint8)

    lengths = np.stack([head_len[role], text_len, np.full(len(role), len(end))], axis=1)
    ends = np.cumsum(lengths.ravel()).reshape(lengths.shape)
    places = ends - lengths
    out = np.empty(int(ends[-1, -1]), np.uint8)
    scatter(out, places[:, 0], np.frombuffer(b"".join(names), np.uint8), (np.cumsum(head_len) - head_len)[role], lengths[:, 0])
    scatter(out, places[:, 1], content, offsets[:-1], text_len)
    out[(places[:, 2][:, None] + np.arange(len(end))).ravel()] = np.tile(end, len(role))

    ids = pc.fill_null(conv, 0).to_numpy()
    null = conv.is_null().to_numpy(zero_copy_only=False)
    first = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]) | (null[1:] != null[:-1])])
    row_at = places[first, 0]
    bounds = np.r_[row_at, len(out)].astype(np.int32)
    formatted = pa.StringArray.from_buffers(len(first), pa.py_buffer(bounds), pa.py_buffer(out))
    # The loss mask: in bytes from the start of the row's text.
    learnt = role == next((i for i, r in enumerate(roles.dictionary.to_pylist()) if r == "assistant"), -1)
    run = np.cumsum(np.bincount(first, minlength=len(role))) - 1
    per_row = np.r_[0, np.cumsum(np.bincount(run[learnt], minlength=len(first)))].astype(np.int32)
    start = places[:, 1][learnt] - row_at[run[learnt]]
    masks = [pa.ListArray.from_arrays(pa.array(per_row), pa.array(x)) for x in (start, start + text_len[learnt])]
    return pa.record_batch([conv.take(pa.array(first)), pa.array(chunk + np.arange(len(first))), formatted, *masks], names=["conv_id", "chunk", "formatted", "loss_start", "loss_end"])


def format_chat(turns: DataFrame, partitions: int | None = None) -> DataFrame:
    """Formatted chunks (``CHUNKS``), in order within their partition.

    All turns of a conversation meet in one partition, sorted on disk if need
    be, and pass through in batches.
    """
    rows = clean_columns(turns, "conv_id", "turn", "role", "text").withColumn("conv_id", F.col("conv_id").cast("long"))
    rows = rows.repartition(partitions, "conv_id") if partitions else rows.repartition("conv_id")
    rows = rows.sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = 0
        for batch in batches:
            for part in slices(batch, "text", 8 << 20):
                out = assemble(part, chunk)
                chunk += out.num_rows
                yield out

    return rows.mapInArrow(run, CHUNKS)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted text."""
    out, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at character {at}")
        out.append((role_of(m[1]), unescape(m[2])))
        at = m.end()
    return out


def read_back(chunks: DataFrame) -> DataFrame:
    """Digests of each conversation (``DIGESTS``), read from its chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, done = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if state is None or state["conv_id"] != row["conv_id"]:
                    if state:
                        done.append(state)
                    state = {"conv_id": row["conv_id"], "n": 0, "turns": hashlib.sha256(), "loss_chars": 0, "loss": hashlib.sha256(), "chars": 0}
                state["chars"] += len(row["formatted"])
                for role, text in parse(row["formatted"]):
                    state["n"] += 1
                    state["turns"].update(f"{role}\n{text}\n".encode())
                data = row["formatted"].encode() if row["loss_start"] else b""
                for a, b in zip(row["loss_start"], row["loss_end"], strict=True):
                    text = unescape(data[a:b].decode())
                    state["loss_chars"] += len(text)
                    state["loss"].update(text.encode())
            if done:
                yield digests(done)
                done = []
        if state:
            yield digests([state])

    def digests(states: list[dict]) -> pa.RecordBatch:
        rows = [{"conv_id": s["conv_id"], "n_turns": s["n"], "turns_sha256": s["turns"].hexdigest(), "loss_chars": s["loss_chars"], "loss_sha256": s["loss"].hexdigest(), "formatted_chars": s["chars"]} for s in states]
        return pa.RecordBatch.from_pylist(rows, pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]))

    return chunks.mapInArrow(run, DIGESTS)
