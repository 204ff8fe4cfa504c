"""Ids and bytes of texts by public tokenizers whose files every executor can read."""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

from barlake.llm.chat import PIECES

BYTE_BPE, PIECE_BPE = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
#: Runs without blanks that are too long for an encoder of quadratic time.
_LONG_RUN = re.compile(r"\S{4096}")


@lru_cache(maxsize=4)
def byte_bpe(path: str, plain: bool) -> Tokenizer:
    # Tasks share the cores already.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = plain
    return tokenizer


@lru_cache(maxsize=4)
def piece_bpe(path: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=path)


def byte_encoder(path: str = BYTE_BPE, *, plain: bool = True):
    """Encodes by a byte-level vocabulary; with ``plain`` the strings of special tokens are ordinary text.

    Ids are those of the ``tokenizers`` library, found by a faster one with the same merges and pieces;
    texts with a very long run without blanks, on which that takes quadratic time, go to the library itself.
    """
    slow, fast = byte_bpe(path, plain), _ranked(path)
    special = set() if plain else set(fast.special_tokens_set)

    def encode(text: str) -> np.ndarray:
        if _LONG_RUN.search(text):
            return np.array(slow.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(fast.encode(text, allowed_special=special, disallowed_special=()), np.uint32)

    return encode


@lru_cache(maxsize=2)
def _ranked(path: str) -> tiktoken.Encoding:
    """The vocabulary as ranks; its merges must make its ids in order."""
    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    entries, merges = told["model"]["vocab"], told["model"]["merges"]
    made = [entries["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in merges]
    if made != list(range(256, 256 + len(merges))):
        raise ValueError(f"{path}: merges are not in the order of their ids")
    special = {t["content"]: t["id"] for t in told["added_tokens"]}
    table = byte_table(path)[0]
    ranks = {table[i]: i for entry, i in entries.items() if entry not in special}
    return tiktoken.Encoding("ranks", pat_str=PIECES, mergeable_ranks=ranks, special_tokens=special)


def piece_encoder(path: str = PIECE_BPE):
    """Encodes by a vocabulary of pieces, which itself puts a blank before the text."""
    model = piece_bpe(path)
    return lambda text: np.array(model.encode(text, num_threads=1), np.uint32)


def _byte_letters() -> dict[str, int]:
    """The character that stands for each byte: itself where it prints, else one from 256 on."""
    printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printed]
    return {chr(b): b for b in printed} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=4)
def byte_table(path: str = BYTE_BPE) -> tuple[list[bytes], np.ndarray]:
    """The bytes of each id of a byte-level vocabulary, and their number."""
    letters = _byte_letters()
    entries = byte_bpe(path, True).get_vocab(with_added_tokens=True)
    table = [b""] * (max(entries.values()) + 1)
    for entry, number in entries.items():
        known = all(c in letters for c in entry)
        table[number] = bytes(letters[c] for c in entry) if known else entry.encode()
    return table, np.fromiter(map(len, table), np.int64, len(table))


@lru_cache(maxsize=4)
def piece_table(path: str = PIECE_BPE) -> tuple[list[bytes], np.ndarray]:
    """The bytes of each id of a vocabulary of pieces, and their number."""
    model = piece_bpe(path)
    table = []
    for piece in map(model.id_to_piece, range(model.get_piece_size())):
        raw = re.fullmatch("<0x([0-9A-F]{2})>", piece)
        table.append(bytes.fromhex(raw[1]) if raw else piece.replace("▁", " ").encode())
    return table, np.fromiter(map(len, table), np.int64, len(table))
