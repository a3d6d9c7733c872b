"""Chat formatting on tokens: the parts of a turn are encoded one by one, reserved ids are put between them, and the
loss mask is the running sum of +1 and -1 at the ends of the parts that are to be learnt.

Content can't make a reserved id, as these lie outside the vocabulary. So that the rendered text can be read back as
well, control strings inside texts are broken up: `\\.` goes behind their first character, and a backslash is doubled.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import bounded

TOKENIZER_PATH = "/opt/tokenizers/byte_bpe_50k.json"
LEARNT = ("assistant",)
#: Control strings, in the order of their reserved ids behind the vocabulary.
OPEN = {"system": "### System: ", "user": "### User: ", "assistant": "### Assistant: "}
OTHER, ROLE_END, TURN_END = "### Role: ", "</role>", "</turn>"
CONTROLS = [*OPEN.values(), OTHER, ROLE_END, TURN_END]
SPECIAL = re.compile("|".join(re.escape(c) for c in ["\\", *CONTROLS]))
ESCAPED = re.compile(r"\\(\\|\.)")


def escape(text: str) -> str:
    return SPECIAL.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\.{m[0][1:]}", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(lambda m: "\\" if m[1] == "\\" else "", text)


class Template:
    """Encoding and reading of turns with one tokenizer."""

    def __init__(self, tokenizer_json: str, learnt: tuple[str, ...] = LEARNT) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.first = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.reserved = {c: self.first + i for i, c in enumerate(CONTROLS)}
        self.learnt = learnt

    def encode(self, turns: list[tuple[str, str]]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(ids, mask) of each (role, text)."""
        parts = [escape(x) for role, text in turns for x in (("" if role in OPEN else role), text)]
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]
        out, end, role_end, other = [], self.reserved[TURN_END], self.reserved[ROLE_END], self.reserved[OTHER]
        for k, (role, _) in enumerate(turns):
            head = [self.reserved[OPEN[role]]] if role in OPEN else [other, *ids[2 * k], role_end]
            body = ids[2 * k + 1]
            whole = np.array([*head, *body, end], np.int32)
            steps = np.zeros(len(whole), np.int8)
            if role in self.learnt:
                steps[len(head)] += 1
                steps[len(head) + len(body)] -= 1  # the same place for an empty text
            out.append((whole, np.cumsum(steps, dtype=np.int8)))
        return out

    def text(self, ids: np.ndarray) -> str:
        return self.tokenizer.decode(ids.tolist(), skip_special_tokens=False) if len(ids) else ""

    def read(self, ids: np.ndarray, mask: np.ndarray) -> tuple[str, str, str, int]:
        """(role, text, text under the mask, length of the rendered turn) from a turn's ids."""
        at = np.flatnonzero(ids >= self.first)
        controls = [CONTROLS[i - self.first] for i in ids[at]]
        if controls[0] == OTHER:
            role_part = self.text(ids[1 : at[1]])
            role, start = unescape(role_part), at[1] + 1
        else:
            role_part, role, start = "", next(r for r, c in OPEN.items() if c == controls[0]), 1
        body = self.text(ids[start : at[-1]])
        under = mask.astype(bool)
        text = unescape(body)
        learnt = text if np.array_equal(under, (np.arange(len(ids)) >= start) & (np.arange(len(ids)) < at[-1])) else unescape(self.text(ids[under]))
        return role, text, learnt, sum(map(len, controls)) + len(role_part) + len(body)


def format_turns(turns: DataFrame, tokenizer_json: str, *, learnt: tuple[str, ...] = LEARNT, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turn, ids, mask) per row of turns. Each row is encoded by itself, so a conversation of any length is
    spread over all tasks. Null text and null role count as empty; an unknown role is spelt out between two reserved
    ids; rows with a null conversation form one of their own, and a null turn comes first. mask is 1 on the tokens of
    the learnt roles' texts. Other columns, whatever their names, are left out; very long texts are encoded whole."""
    spark = turns.sparkSession
    shared = spark.sparkContext.broadcast(tokenizer_json)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template = Template(shared.value, learnt)
        for batch in bounded(batches):
            conv, turn, role, text = (batch.column(i) for i in range(4))
            found = template.encode(list(zip([r or "" for r in role.to_pylist()], [t or "" for t in text.to_pylist()], strict=True)))
            ids = pa.array([i for i, _ in found], pa.list_(pa.int32()))
            mask = pa.array([m for _, m in found], pa.list_(pa.int8()))
            yield pa.RecordBatch.from_arrays([conv, turn, ids, mask], names=["conv_id", "turn", "ids", "mask"])

    rows = turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), role_col, text_col)
    return rows.mapInArrow(run, "conv_id long, turn long, ids array<int>, mask array<tinyint>")


def digests(formatted: DataFrame, tokenizer_json: str) -> DataFrame:
    """One row per conversation, read back from its formatted turns in order: number of turns, SHA-256 of all turns and
    of the text under the mask, and lengths. Rows of a conversation pass by one at a time in sorted order and only the
    running digests are held; turns of the same number are ordered by role and text."""
    spark = formatted.sparkSession
    shared = spark.sparkContext.broadcast(tokenizer_json)
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template = Template(shared.value)
        for batch in bounded(batches):
            ids, masks = batch.column(2), batch.column(3)
            rows = [template.read(i.values.to_numpy(), m.values.to_numpy()) for i, m in zip(ids, masks, strict=True)]
            cols = [pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), [pa.string()] * 3 + [pa.int64()], strict=True)] if rows else [pa.array([], k) for k in [pa.string()] * 3 + [pa.int64()]]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *cols], names=["conv_id", "turn", "role", "text", "learnt", "chars"])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []

        def close() -> None:
            conv, n, turns, chars, loss, length = now
            done.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), length))

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)], names=names)
            done.clear()
            return out

        for batch in bounded(batches):
            for conv, role, text, learnt, chars in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4, 5)), strict=True):
                if now is None or now[0] != conv:
                    if now is not None:
                        close()
                    now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                now[1] += 1
                now[2].update(f"{role}\n{text}\n".encode())
                now[3] += len(learnt)
                now[4].update(learnt.encode())
                now[5] += chars
            if done:
                yield flush()
        if now is not None:
            close()
            yield flush()

    rows = formatted.mapInArrow(read, "conv_id long, turn long, role string, text string, learnt string, chars long")
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return rows.mapInArrow(fold, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def tokenizer_json(path: str = TOKENIZER_PATH) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()
