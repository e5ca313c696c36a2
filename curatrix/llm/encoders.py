"""Encoders of public vocabularies, one of each in a Python worker."""

from __future__ import annotations

import base64
import json
from functools import lru_cache

import public_tokenizers
import tiktoken
from tokenizers import Tokenizer


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable ones for themselves, others from code point 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


@lru_cache(maxsize=4)
def rank_file(path: str) -> tiktoken.Encoding:
    """The encoder of a file of ranks, without special tokens."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


class Vocabulary:
    """Ids of a tokenizers file, as encode(text, add_special_tokens=False) gives them.

    The merges of a plain byte-level file are those of its ids as ranks, which tiktoken applies several times faster.
    Texts that hold the text of an added token, and all texts of other kinds of files, go through tokenizers itself.
    """

    def __init__(self, path: str):
        self.slow = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        self.added = [t["content"] for t in told.get("added_tokens", [])]
        split = told.get("pre_tokenizer") or {}
        self.fast = None
        if told["model"]["type"] == "BPE" and split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True) and not told.get("normalizer"):
            letters = byte_letters()
            ranks = {bytes(letters[c] for c in token): i for token, i in told["model"]["vocab"].items() if token not in self.added}
            self.fast = tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        if self.fast is None or any(t in text for t in self.added):
            return self.slow.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)
