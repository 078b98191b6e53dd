"""Byte-level BPE of whole texts, exactly as the ``tokenizers`` library encodes them."""

from __future__ import annotations

import base64
import json
import re
from array import array
from functools import lru_cache

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

VOCABULARY = "byte_bpe_50k"
_BEYOND_LATIN = re.compile("[^\x00-ɏ]")


@lru_cache(maxsize=1)
def special_tokens(vocabulary: str = VOCABULARY) -> dict[str, int]:
    """Strings and ids of the vocabulary's special tokens."""
    with open(public_tokenizers.path(f"{vocabulary}.json"), encoding="utf-8") as file:
        return {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}


class Encoder:
    """Texts beyond Latin letters, or with a special token's string, go to the library itself.

    All others take the same vocabulary's ranks in ``tiktoken``, which is faster and gives the
    same ids there: up to U+024F both agree on what is a letter, a digit or a space.
    """

    def __init__(self, vocabulary: str = VOCABULARY) -> None:
        path = public_tokenizers.path(f"{vocabulary}.json")
        self.special = special_tokens(vocabulary)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        token = {v: k for k, v in ranks.items()} | {v: k.encode() for k, v in self.special.items()}
        self.token_bytes = [token.get(i, b"") for i in range(max(token) + 1)]
        # One row per id: its digits and a comma, filled up with zero bytes.
        digits = np.array([b"%d," % i for i in range(len(self.token_bytes))])
        self.digits = digits.view(np.uint8).reshape(len(digits), -1)
        self.token_lengths = np.array([len(t) for t in self.token_bytes], dtype=np.int64)

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text, 32 bits each."""
        if (not text.isascii() and _BEYOND_LATIN.search(text)) or any(s in text for s in self.special):
            ids = self.library.encode(text, add_special_tokens=False).ids
        else:
            ids = self.fast.encode_ordinary(text)
        return np.frombuffer(array("I", ids), dtype=np.uint32) if ids else np.empty(0, np.uint32)

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 bytes of the decoded text; broken sequences become replacement characters."""
        raw = b"".join(map(self.token_bytes.__getitem__, ids.tolist()))
        return raw.decode("utf-8", errors="replace").encode("utf-8")

    def decimal_list(self, ids: np.ndarray) -> bytes:
        """The ids in decimal digits, joined by commas."""
        digits = self.digits[ids].ravel()
        return digits[digits != 0].tobytes()[:-1]


@lru_cache(maxsize=1)
def shared_encoder(vocabulary: str = VOCABULARY) -> Encoder:
    """The encoder of a Python worker, loaded once for all of its tasks."""
    return Encoder(vocabulary)
