"""Byte-level BPE vocabularies and the pieces in which text is encoded."""

from __future__ import annotations

import base64
import importlib.util
import os
import re

import numpy as np
import regex

#: Where the public vocabularies lie unless a path is given.
VOCAB_DIR = "/opt/tokenizers"
DEFAULT_VOCAB = f"{VOCAB_DIR}/byte_bpe_multi_50k.tiktoken"
#: The split that goes with these rank files, as their README gives it.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Entries after which a worker's memo of pieces starts anew; results don't depend on it.
MEMO = 1_000_000

_INNER = re.compile(r"\s ")
_CUT = re.compile(r"(?<=\S)(?= )")


def read_vocab(path: str = DEFAULT_VOCAB) -> bytes:
    if not os.path.exists(path):
        spec = importlib.util.find_spec("public_tokenizers")
        if spec is None:
            raise FileNotFoundError(path)
        path = os.path.join(os.path.dirname(spec.origin), os.path.basename(path))
    with open(path, "rb") as file:
        return file.read()


def parse_ranks(raw: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in raw.splitlines() if line)}


def pretokens(text: str, _pattern=regex.compile(PATTERN.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))) -> list[str]:
    return _pattern.findall(text)


def pieces(text: str) -> tuple[str | None, list[str]]:
    """Parts of a text that are encoded independently of each other.

    A space after a character that isn't white space always starts a pre-token,
    so text may be parted there. ``(first, rest)``: of ``rest`` the leading space
    is left out if ``first`` isn't None; else the parts are given in full.
    """
    if _INNER.search(text):
        return None, _CUT.split(text)
    first, *rest = text.split(" ")
    return first, rest


class Encoder:
    """A vocabulary with its merges, and token numbers as arrays."""

    def __init__(self, raw: bytes):
        import tiktoken

        ranks = parse_ranks(raw)
        self.core = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        size = max(ranks.values()) + 1
        self.kind = np.dtype(np.uint16 if size <= 65536 else np.uint32)
        self.words = [b""] * size
        for word, rank in ranks.items():
            self.words[rank] = word
        self.lengths = np.array([len(x) for x in self.words], np.int64)

    def __call__(self, data: bytes) -> np.ndarray:
        return np.array(self.core.encode_ordinary(data.decode()), self.kind)

    def tokens(self, raw: bytes) -> np.ndarray:
        return np.frombuffer(raw, self.kind)

    def decode(self, tokens: np.ndarray) -> bytes:
        return b"".join(map(self.words.__getitem__, tokens.tolist()))
