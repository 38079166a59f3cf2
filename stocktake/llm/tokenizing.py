"""Public tokenizers at corpus speed: what a chunk of text becomes is remembered, new chunks are merged natively.

word_bpe_49k lower-cases, drops white space and never joins characters across it, so a text's ids are those of its
blank-separated chunks in turn. Plain chunks (printable characters below U+0250) are split into pieces by the
tokenizer's own pattern and merged by tiktoken's core over the same vocabulary; the end-of-word mark is a byte that
UTF-8 never has. Both ways of merging agree if every token's own characters merge back into that token, which
tests/llm checks for the whole vocabulary. All other chunks go through the tokenizer itself.
"""

from __future__ import annotations

import base64
import json
import os
import struct
from functools import cache

import numpy as np
import regex

from .common import Remembered

PLAIN = regex.compile("[\\x21-\\x7e\\xa1-\\u024f]*")
#: The pattern in word_bpe_49k.json.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
END_OF_WORD = b"\xff"
SUFFIX = "</w>"


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_characters() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for each byte."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(other)}


def suffixed_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary of a byte-level BPE with word ends as byte strings; a word end is the byte 0xFF."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    byte = byte_characters()
    ranks = {}
    for token, i in model["vocab"].items():
        end = token.endswith(SUFFIX)
        letters = token[: -len(SUFFIX)] if end else token
        if letters and all(c in byte for c in letters) and not token.startswith("<|"):
            ranks[bytes(byte[c] for c in letters) + END_OF_WORD * end] = i
    return ranks


class ChunkIds(Remembered):
    """chunk -> its ids as little-endian unsigned 32-bit bytes."""

    LIMIT = 1 << 19  # merging a chunk anew takes long

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.whole = Tokenizer.from_file(path)
        ranks = suffixed_ranks(path)
        self.merge = tiktoken.Encoding("word-ends", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece

    def make(self, chunk: str) -> bytes:
        if not PLAIN.fullmatch(chunk) or "<|" in chunk:
            return self.little(self.whole.encode(chunk, add_special_tokens=False).ids)
        if (low := chunk.lower()) != chunk:
            return self[low]
        if chunk[-1:] in (".", ",") and chunk[:-1].isalpha():
            return self[chunk[:-1]] + self.little(self.merge(chunk[-1:].encode() + END_OF_WORD))
        if chunk.isalpha():
            return self.little(self.merge(chunk.encode() + END_OF_WORD))
        return b"".join(self.little(self.merge(x.encode() + END_OF_WORD)) for x in PIECES.findall(chunk))

    @staticmethod
    def little(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def of(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


@cache
def chunk_ids(path: str) -> ChunkIds:
    return ChunkIds(path)


class TokenLengths(Remembered):
    """chunk -> the byte lengths of its tokens (16-bit), for a byte-level vocabulary given as a rank file.

    Token boundaries of these vocabularies always fall before a blank that stands between two other characters, and
    around a single line break between two other characters, so such chunks are encoded by themselves.
    """

    LIMIT = 1 << 19
    CHUNKS = regex.compile(r"\n| ?[^ \n]+")
    RUNS = regex.compile(r"\s\s|^\s|\s$|[^\S \n]")

    def __init__(self, path: str):
        import public_tokenizers as P
        import tiktoken

        super().__init__()
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encode = tiktoken.Encoding("ranks", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.sizes = np.zeros(max(ranks.values()) + 1, np.uint16)
        for token, i in ranks.items():
            self.sizes[i] = len(token)

    def slow(self, text: str) -> bytes:
        return self.sizes[np.array(self.encode(text), np.int64)].tobytes() if text else b""

    make = slow

    def of(self, text: str) -> np.ndarray:
        joined = self.slow(text) if self.RUNS.search(text) else b"".join(map(self.__getitem__, self.CHUNKS.findall(text)))
        return np.frombuffer(joined, np.uint16)


@cache
def token_lengths(path: str) -> TokenLengths:
    return TokenLengths(path)
