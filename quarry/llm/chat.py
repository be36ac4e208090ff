"""Chat formatting by columnar byte assembly.

A turn is ``<|im_start|>role\\n`` + text + ``<|im_end|>\\n``.  Inside roles and
texts a backslash is put after the first character of every control string (and
one more where backslashes already follow it), so no control string is left and
taking one away again gives the text back.  Conversations are formatted a block
of rows at a time: segment lengths, offsets and scatter indices are arrays, and
headers and contents are copied into one buffer that becomes an Arrow column.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import common

START, END, NEWLINE = "<|im_start|>", "<|im_end|>\n", "\n"
LOSS_ROLE = "assistant"
#: Control strings of common templates, as first character and rest (fixed list).
CONTROL = ("<|im_start|>", "<|im_end|>", "<|im_sep|>", "<|endoftext|>", "<|startoftext|>", "<|begin_of_text|>",
           "<|end_of_text|>", "<|start_header_id|>", "<|end_header_id|>", "<|eot_id|>", "<|system|>", "<|user|>",
           "<|assistant|>", "<|end|>", "<|pad|>", "<s>", "</s>", "<unk>", "<pad>", "[INST]", "[/INST]", "<<SYS>>",
           "<</SYS>>", "<bos>", "<eos>", "<start_of_turn>", "<end_of_turn>")
PART_BYTES = 4 << 20
PARTS = ("conv_id long, part long, n_turns long, text string, loss array<struct<start:long,end:long>>, "
         "bounds array<struct<role_start:long,role_end:long,start:long,end:long>>")


def _quoted(s: str) -> str:
    return "".join("\\" + c if c in "|[]()<>/.*+?^$\\{}" and c not in "<>/" else c for c in s)


def _split_patterns() -> list[tuple[str, str]]:
    """(pattern, first character) by first character of control strings."""
    found = []
    for first in sorted({c[0] for c in CONTROL}):
        rest = "|".join(_quoted(c[1:]) for c in sorted(CONTROL, key=len, reverse=True) if c[0] == first)
        found.append((f"({_quoted(first)}\\\\*)({rest})", first))
    return found


_SPLIT = _split_patterns()


def escape(texts: pa.Array) -> pa.Array:
    """Puts one backslash into every control string, escaped ones included."""
    for pattern, _ in _SPLIT:
        texts = pc.replace_substring_regex(texts, pattern, "\\1\\\\\\2")
    return texts


def unescape(texts: pa.Array) -> pa.Array:
    """Takes one backslash out of every escaped control string."""
    for pattern, first in _SPLIT:
        taken = pattern.replace(f"({_quoted(first)}\\\\*)", f"({_quoted(first)}\\\\*)\\\\")
        texts = pc.replace_substring_regex(texts, taken, "\\1\\2")
    return texts


def escape_role(roles: pa.Array) -> pa.Array:
    """Roles stand on one line: % and the line end are percent-coded."""
    return escape(pc.replace_substring(pc.replace_substring(roles, "%", "%25"), "\n", "%0A"))


def unescape_role(roles: pa.Array) -> pa.Array:
    return pc.replace_substring(pc.replace_substring(unescape(roles), "%0A", "\n"), "%25", "%")


def _characters(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Code points before each byte place."""
    lead = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=lead[1:])
    return lead[at]


def assemble(columns: list[pa.Array]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of row 0 of each column, then of row 1, and so on, in one buffer;
    and the offsets of its segments (rows x columns)."""
    parts = [common.buffers_of(c) for c in columns]
    n, k = len(columns[0]), len(columns)
    lengths = np.empty((n, k), np.int64)
    for j, (_, at) in enumerate(parts):
        lengths[:, j] = np.diff(at)
    offsets = np.zeros(n * k + 1, np.int64)
    np.cumsum(lengths.ravel(), out=offsets[1:])
    out = np.empty(offsets[-1], np.uint8)
    for j, (data, at) in enumerate(parts):
        # where byte i of this column goes: its own place, moved with its segment
        move = offsets[j:-1:k] - at[:-1]
        out[np.repeat(move, lengths[:, j]) + np.arange(len(data))] = data
    return out, offsets


def format_chat(turns: DataFrame) -> DataFrame:
    """Formatted conversations of ``turns`` (conv_id, turn, role, text).

    One row per conversation and part: conv_id, part, n_turns, text, loss (spans
    of assistant texts) and bounds (role and text of each turn), in code points
    of the part.  Parts are whole turns of about ``PART_BYTES``; only a longer
    conversation has more than one, so no conversation is gathered whole.

    Rows are dealt out by conversation and sorted by turn, then role and text; a
    null turn sorts first, null role and text are empty, rows that repeat stay.
    Rows with a null conv_id form one conversation.
    """
    spark = turns.sparkSession
    common.ship(spark)
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def parts(batches):
        last, part = object(), 0  # conversation and part of the rows before
        for rows in common.slices(batches, "text", PART_BYTES):
            conv = rows.column(0).to_pylist()
            change = [i for i in range(1, len(conv)) if conv[i] != conv[i - 1]]
            number = []
            for first in [0, *change]:
                part = part + 1 if conv[first] == last else 0
                last = conv[first]
                number.append(part)
            yield format_rows(rows, np.array([0, *change, len(conv)]), number)

    return rows.mapInArrow(parts, PARTS)


def format_rows(rows: pa.RecordBatch, firsts: np.ndarray, parts: list[int]) -> pa.RecordBatch:
    """One output row for the rows between each two places of ``firsts``."""
    n = rows.num_rows
    role, text = rows.column(2), rows.column(3)
    fixed = lambda s: pa.array([s] * n, pa.string())
    data, offsets = assemble([fixed(START), escape_role(role), fixed(NEWLINE), escape(text), fixed(END)])
    starts = offsets[np.concatenate([firsts[:-1] * 5, [n * 5]])]
    chars = _characters(data, offsets)
    base = np.repeat(chars[firsts[:-1] * 5], np.diff(firsts))
    span = {name: chars[k:-1 if k < 5 else None:5][:n] - base for name, k in
            (("role_start", 1), ("role_end", 2), ("start", 3), ("end", 4))}
    texts = pa.Array.from_buffers(pa.large_string(), len(firsts) - 1,
                                  [None, pa.py_buffer(starts.astype(np.int64)), pa.py_buffer(data)])
    bounds = pa.StructArray.from_arrays([pa.array(v) for v in span.values()], names=list(span))
    at = pa.array(firsts.astype(np.int32))
    under = np.asarray(pc.equal(role, LOSS_ROLE).to_numpy(zero_copy_only=False), bool)
    kept = np.concatenate([[0], np.cumsum(under)])[firsts].astype(np.int32)
    loss = pa.StructArray.from_arrays([pa.array(span["start"][under]), pa.array(span["end"][under])], names=["start", "end"])
    return pa.RecordBatch.from_arrays(
        [rows.column(0).take(pa.array(firsts[:-1])), pa.array(np.array(parts, np.int64)), pa.array(np.diff(firsts).astype(np.int64)),
         texts.cast(pa.string()), pa.ListArray.from_arrays(pa.array(kept), loss), pa.ListArray.from_arrays(at, bounds)],
        names=["conv_id", "part", "n_turns", "text", "loss", "bounds"])


def turns_of(text: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of formatted text; fails if it isn't that."""
    pieces = text.split(START)
    if pieces[0]:
        raise ValueError("formatted text does not begin with a turn")
    roles, texts = [], []
    for piece in pieces[1:]:
        role, line, rest = piece.partition(NEWLINE)
        if not line or not rest.endswith(END) or END in rest[: -len(END)]:
            raise ValueError("a turn has no end")
        roles.append(role)
        texts.append(rest[: -len(END)])
    return list(zip(unescape_role(pa.array(roles, pa.string())).to_pylist(),
                    unescape(pa.array(texts, pa.string())).to_pylist()))


DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def chat_digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, read back from its formatted text and loss spans.

    Parts are sorted by conversation and hashed one after another, a part at a
    time.
    """
    common.ship(formatted.sparkSession)
    rows = formatted.select("conv_id", "part", "text", "loss").repartition("conv_id").sortWithinPartitions("conv_id", "part")

    def digests(batches):
        open_, done = None, []

        def result(s):
            return (s["conv"], s["turns"], s["all"].hexdigest(), s["chars"], s["loss"].hexdigest(), s["formatted"])

        def batch():
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)],
                                             names=[c.split()[0] for c in DIGESTS.split(", ")])
            done.clear()
            return out

        for part in common.slices(batches, "text", PART_BYTES):
            for conv, text, loss in zip(*(part.column(i).to_pylist() for i in (0, 2, 3))):
                if open_ is None or open_["conv"] != conv:
                    if open_ is not None:
                        done.append(result(open_))
                    open_ = {"conv": conv, "turns": 0, "all": hashlib.sha256(), "chars": 0, "loss": hashlib.sha256(),
                             "formatted": 0}
                found = turns_of(text)
                open_["turns"] += len(found)
                open_["formatted"] += len(text)
                for role, said in found:
                    open_["all"].update(f"{role}\n{said}\n".encode())
                for said in unescape(pa.array([text[s["start"]:s["end"]] for s in loss], pa.string())).to_pylist():
                    open_["chars"] += len(said)
                    open_["loss"].update(said.encode())
            if done:
                yield batch()
        if open_ is not None:
            done.append(result(open_))
            yield batch()

    return rows.mapInArrow(digests, DIGESTS)
