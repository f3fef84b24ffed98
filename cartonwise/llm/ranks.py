"""Byte-level BPE of a vocabulary file, through tiktoken, for texts of any shape."""

from __future__ import annotations

import json
import re
from functools import cached_property

import public_tokenizers
import tiktoken

# The characters that the split pattern takes as white space.
_SPACES = "".join(map(chr, [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
# Runs beyond this many white-space characters exhaust the stack of the pattern's engine.
_LONG_RUN = 1000
_RUNS = re.compile(f"[{_SPACES}]{{{_LONG_RUN},}}")


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in vocabulary files: printable bytes stand for themselves, the others are
    numbered from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Ranks:
    """A vocabulary file's merges. `special`: its added tokens; `encode` takes their strings as ordinary text."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        alphabet = byte_alphabet()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {bytes(alphabet[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in self.special}
        self.bpe = tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=self.tokens, special_tokens=self.special)

    @cached_property
    def piece(self) -> tiktoken.Encoding:
        """The same merges on a whole text; few workers ever need it."""
        return tiktoken.Encoding(f"{self.bpe.name} whole", pat_str=r"[\s\S]+", mergeable_ranks=self.tokens, special_tokens={})

    def encode(self, text: str) -> list[int]:
        """The pattern gives a run of white space to one piece, but for the last character if the text goes on: long runs are
        cut out and encoded as that piece."""
        if len(text) <= _LONG_RUN:
            return self.bpe.encode_ordinary(text)
        ids, at = [], 0
        for run in _RUNS.finditer(text):
            end = run.end() if run.end() == len(text) else run.end() - 1
            ids += self.bpe.encode_ordinary(text[at:run.start()])
            ids += self.piece.encode_ordinary(text[run.start():end])
            at = end
        return ids + self.bpe.encode_ordinary(text[at:])
