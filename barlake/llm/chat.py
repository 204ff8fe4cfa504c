"""Chat formatting at the level of tokens.

A turn is ``<|im_start|>role<|im_sep|>text<|im_end|>``. Role and text are encoded by themselves, the
reserved ids are spliced in between, so no text can ever yield one, and the loss mask follows
from prefix sums over segment lengths. Control strings inside a text are escaped reversibly:
``<|im_end|>`` becomes ``<\\|im_end|>``, ``<\\|im_end|>`` becomes ``<\\\\|im_end|>``, and so on.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how the byte-level vocabulary cuts text into pieces.
PIECES = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CONTROLS = ("<|im_start|>", "<|im_sep|>", "<|im_end|>")
_ESCAPE = re.compile(r"<(\\*\|(?:im_start|im_sep|im_end|endoftext)\|>)")
_UNESCAPE = re.compile(r"<\\(\\*\|(?:im_start|im_sep|im_end|endoftext)\|>)")
#: Longer runs without white space are encoded in parts, as merging takes quadratic time.
_LONG_RUN = re.compile(r"\S{4096}")


def escape(text: str) -> str:
    return _ESCAPE.sub(r"<\\\1", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1", text)


@lru_cache(maxsize=2)
def encoding(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("chat", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})


def reserved(path: str) -> list[int]:
    """The ids after the vocabulary (and its own free one), for the control strings."""
    first = encoding(path).n_vocab + 1
    return [first + i for i in range(len(CONTROLS))]


def encode(text: str, path: str) -> list[int]:
    tokens: list[int] = []
    start = 0
    for run in _LONG_RUN.finditer(text) if len(text) > 4096 else ():
        tokens += encoding(path).encode_ordinary(text[start : run.end()])
        start = run.end()
    return tokens + encoding(path).encode_ordinary(text[start:])


def decode(tokens, path: str) -> str:
    return encoding(path).decode_bytes([int(t) for t in tokens]).decode()


_ENCODED = "conv_id bigint, turn bigint, role string, role_ids array<int>, text_ids array<int>"


def encode_turns(conversations: DataFrame, path: str) -> DataFrame:
    """Role and text of each turn as tokens, wherever the row lies: no shuffle."""

    def over_all(batches):
        for batch in batches:
            texts = [encode(escape(t or ""), path) for t in batch.column("text").to_pylist()]
            known: dict[str, list[int]] = {}
            roles = batch.column("role").to_pylist()
            for role in set(roles):
                known[role] = encode(escape(role), path)
            lists = pa.list_(pa.int32())
            yield pa.record_batch(
                [*(batch.column(c) for c in ("conv_id", "turn", "role")), pa.array([known[r] for r in roles], lists), pa.array(texts, lists)],
                ["conv_id", "turn", "role", "role_ids", "text_ids"],
            )

    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return rows.mapInArrow(over_all, _ENCODED)


def _lists(column) -> list[np.ndarray]:
    """The values of each list of a list column, as views."""
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy()
    return [values[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def _assemble(roles, texts, losses, controls):
    """Tokens, mask and start of each turn of a batch, laid end to end."""
    start, sep, end = (np.array([c], np.int32) for c in controls)
    segments = [s for role, text in zip(roles, texts, strict=True) for s in (start, role, sep, text, end)]
    lengths = np.fromiter(map(len, segments), np.int64, len(segments))
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    tokens = np.concatenate(segments) if segments else np.empty(0, np.int32)
    # +1 where a learned text begins, -1 behind it: their prefix sum is the mask.
    steps = np.zeros(len(tokens) + 1, np.int8)
    np.add.at(steps, bounds[3::5][: len(losses)][losses], 1)
    np.add.at(steps, bounds[4::5][: len(losses)][losses], -1)
    return tokens, np.cumsum(steps[:-1], dtype=np.int8), bounds[::5]


_TURNS = "conv_id bigint, turn bigint, offset bigint, ids array<int>, loss array<tinyint>"


def format_conversations(conversations: DataFrame, *, path: str = VOCABULARY, learn: str = "assistant") -> DataFrame:
    """One row per turn, conversations together and in order: ``conv_id, turn, offset, ids, loss``.

    ``offset`` is the place of the turn's first token in its conversation, ``loss`` is 1 for the
    tokens of ``learn`` texts. Turns are ordered by turn (null first), then role, then tokens; null
    roles and texts count as empty; rows without a conv_id form one conversation; repeated rows
    are repeated turns. A conversation of any length passes through its task row by row; an
    empty table gives no rows.
    """

    def over_all(batches):
        controls = reserved(path)
        current, offset = object(), 0
        for batch in batches:
            losses = np.array([r == learn for r in batch.column("role").to_pylist()], bool)
            tokens, mask, starts = _assemble(_lists(batch.column("role_ids")), _lists(batch.column("text_ids")), losses, controls)
            offsets = []
            sizes = np.diff(starts)
            for conv, size in zip(batch.column("conv_id").to_pylist(), sizes.tolist(), strict=True):
                if conv != current:
                    current, offset = conv, 0
                offsets.append(offset)
                offset += size
            cuts = pa.array(starts.astype(np.int32))
            yield pa.record_batch(
                [
                    batch.column("conv_id"), batch.column("turn"), pa.array(offsets, pa.int64()),
                    pa.ListArray.from_arrays(cuts, pa.array(tokens)), pa.ListArray.from_arrays(cuts, pa.array(mask)),
                ],
                ["conv_id", "turn", "offset", "ids", "loss"],
            )

    ordered = encode_turns(conversations, path).repartition("conv_id")
    return ordered.sortWithinPartitions("conv_id", "turn", "role", "text_ids").mapInArrow(over_all, _TURNS)


class _Reader:
    """What one conversation says, read turn by turn from its tokens."""

    def __init__(self, conv):
        self.conv, self.turns, self.loss_chars, self.chars = conv, 0, 0, 0
        self.said, self.learned = hashlib.sha256(), hashlib.sha256()

    def read(self, ids: np.ndarray, loss: np.ndarray, controls, path: str) -> None:
        marks = np.flatnonzero(ids >= controls[0])
        if ids[marks].tolist() != list(controls) or marks[0] != 0 or marks[2] != len(ids) - 1:
            raise ValueError(f"conversation {self.conv}: turn {self.turns} is not well formed")
        role, text = (decode(ids[a + 1 : b], path) for a, b in ((marks[0], marks[1]), (marks[1], marks[2])))
        self.turns += 1
        self.chars += len(role) + len(text) + sum(map(len, CONTROLS))
        self.said.update(f"{unescape(role)}\n{unescape(text)}\n".encode())
        edges = np.flatnonzero(np.diff(np.concatenate([[0], loss, [0]])))
        for a, b in edges.reshape(-1, 2):
            learned = unescape(decode(ids[a:b], path))
            self.loss_chars += len(learned)
            self.learned.update(learned.encode())

    def row(self):
        return (self.conv, self.turns, self.said.hexdigest(), self.loss_chars, self.learned.hexdigest(), self.chars)


_READ = [
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
    ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
]


def read_back(formatted: DataFrame, *, path: str = VOCABULARY) -> DataFrame:
    """One row per conversation with what its tokens and mask decode to.

    Takes the rows as ``format_conversations`` leaves them: each conversation in one partition,
    in order. Only running digests are held.
    """

    def over_all(batches):
        controls = reserved(path)
        reader = None
        for batch in batches:
            rows = []
            for conv, ids, loss in zip(batch.column("conv_id").to_pylist(), _lists(batch.column("ids")), _lists(batch.column("loss")), strict=True):
                if reader is None or conv != reader.conv:
                    if reader:
                        rows.append(reader.row())
                    reader = _Reader(conv)
                reader.read(ids, loss, controls, path)
            yield _batch(rows)
        if reader:
            yield _batch([reader.row()])

    def _batch(rows):
        columns = zip(*rows, strict=True) if rows else [[]] * len(_READ)
        return pa.record_batch([pa.array(list(c), kind) for c, (_, kind) in zip(columns, _READ, strict=True)], [n for n, _ in _READ])

    schema = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    return formatted.mapInArrow(over_all, schema)
