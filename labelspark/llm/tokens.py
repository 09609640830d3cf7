"""Byte-level encoding with a public vocabulary, and where in a text its tokens lie."""

from __future__ import annotations

import json
import re

import numpy as np

from labelspark.llm.bpe import byte_letters

# Fixed value of the vocabulary's file: how a text is cut into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The word pattern looks ahead behind white space; runs from here on are left to the library that needs no stack for it.
LONG_BLANK = re.compile(r"\s{20000}")


class ByteLevel:
    """The byte-level vocabulary of the JSON file at ``path``: the bytes of each id, and the encoder of ordinary text.

    The text is read on the driver and goes along with the tasks; a task makes its encoder when it first needs it. Merges of
    such a file are in the order of their ids, so that the bytes with their ids are all that an encoder has to know.
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            self.file = file.read()
        given = json.loads(self.file)
        added = {t["id"] for t in given["added_tokens"]}
        byte_of = {letter: byte for byte, letter in enumerate(byte_letters())}
        vocab = given["model"]["vocab"]
        self.bytes: list[bytes] = [b""] * (1 + max(vocab.values()))
        for letters, i in vocab.items():
            if i not in added:
                self.bytes[i] = bytes(byte_of[c] for c in letters)
        self._fast = self._slow = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_fast": None, "_slow": None}

    def lengths(self) -> np.ndarray:
        return np.array([len(b) for b in self.bytes], "int64")

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text; strings of special tokens are ordinary text."""
        if len(text) >= 20_000 and LONG_BLANK.search(text):
            return self._encode_slow(text)
        if self._fast is None:
            import tiktoken

            ranks = {b: i for i, b in enumerate(self.bytes) if b}
            self._fast = tiktoken.Encoding("byte level", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
        return np.array(self._fast.encode_ordinary(text), "int64")

    def _encode_slow(self, text: str) -> np.ndarray:
        if self._slow is None:
            from tokenizers import Tokenizer

            self._slow = Tokenizer.from_str(self.file)
            self._slow.no_truncation()
            self._slow.no_padding()
            self._slow.encode_special_tokens = True
        return np.array(self._slow.encode(text, add_special_tokens=False).ids, "int64")


def code_points(data: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte spans as spans of the code points that they touch; a code point cut by tokens belongs to each of them."""
    so_far = np.cumsum((np.frombuffer(data, "uint8") & 0xC0) != 0x80)
    return so_far[starts] - 1, so_far[ends - 1]
