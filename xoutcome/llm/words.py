"""Encoding of single words with a file of the tokenizers library."""

from __future__ import annotations

import os
import re
import struct
from functools import lru_cache

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

VOCABULARY = "word_bpe_49k.json"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _byte_letters() -> list[str]:
    """The printable letter that byte-level BPE writes for each byte: itself if printable, else one from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class _Known(dict):
    """The ids of words; the first ``limit`` different ones are remembered, which the frequent ones are among."""

    def __init__(self, encoder: "WordEncoder"):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, word: bytes) -> bytes:
        found = self.encoder.word(word)
        if len(self) < self.encoder.limit and len(word) < 100:
            self[word] = found
        return found


class WordEncoder:
    """Ids of words, a word being a run without ASCII white space.

    The vocabulary's rules drop white space, so the ids of a text are those of its words in order. Most words are
    Latin-1 letters with ASCII marks behind them: those two parts go straight to the BPE model, once each; every
    other word takes the library's whole way. The first ``limit`` parts and words stay in memory, but no very long ones.
    """

    PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\\[-`{-~]*)")

    def __init__(self, path: str, limit: int = 250_000):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.parts: dict[str, bytes] = {}
        self.limit = limit
        self.known = _Known(self)

    def part(self, text: str) -> bytes:
        found = self.parts.get(text)
        if found is None:
            # Printable ASCII stands for itself.
            tokens = self.model.tokenize(text if text.isascii() else "".join([self.letters[b] for b in text.encode()]))
            found = struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens])
            if len(self.parts) < self.limit and len(text) < 100:
                self.parts[text] = found
        return found

    def word(self, word: bytes) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        text = word.decode("utf-8", "replace")
        plain = self.PLAIN.fullmatch(text)
        if plain is None:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        marks = plain[2]
        return self.part(plain[1].lower()) + (self.part(marks) if marks else b"")

    def text(self, text: bytes) -> bytes:
        """The ids of a whole text."""
        known = self.known
        return b"".join([known[w] for w in text.split()])

    def pieces(self) -> np.ndarray:
        """The piece of every id."""
        return np.array([(self.tokenizer.id_to_token(i) or "").encode() for i in range(self.tokenizer.get_vocab_size())], object)


@lru_cache(maxsize=2)
def encoder(path: str, limit: int = 250_000) -> WordEncoder:
    """One encoder for a worker process, which keeps it until it ends."""
    return WordEncoder(path, limit)
