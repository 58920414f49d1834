"""Token ids and spans of whole texts by given public tokenizer files; every text is encoded once, whole."""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import numpy as np
import public_tokenizers
import tiktoken
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

# Vocabularies that are there as ranks too: the same ids, in less time.
RANKS = {"byte_bpe_50k.json": "byte_bpe_50k.tiktoken"}
# White space in a row that the ranks' expressions bear; they fail at twice as much.
WHITE = 500_000
_WHITE = re.compile(rf"\s{{{WHITE}}}")


def vocabulary(name: str) -> str:
    """Where a public vocabulary file is on this machine."""
    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def load(name: str, plain: bool = False) -> Tokenizer:
    """A tokenizer; ``plain`` takes the strings of special tokens in a text as ordinary text."""
    own = Tokenizer.from_file(vocabulary(name))
    own.encode_special_tokens = plain
    return own


@lru_cache(maxsize=2)
def _ranked(name: str) -> tiktoken.Encoding | None:
    if name not in RANKS:
        return None
    with open(vocabulary(RANKS[name]), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


class Encoder:
    """Ids of texts by a byte-level vocabulary. ``plain`` as in `load`."""

    def __init__(self, name: str, plain: bool = False) -> None:
        self.name, self.plain = name, plain
        own = load(name, plain)
        self.special = [] if plain else [t.content for t in own.get_added_tokens_decoder().values()]
        # a token of a byte-level vocabulary is written with one character for each byte
        self.bytes_of = np.zeros(own.get_vocab_size(), np.int64)
        for token, i in own.get_vocab().items():
            self.bytes_of[i] = len(token)

    def ids_of(self, text: str) -> list[int]:
        ranked = _ranked(self.name)
        long = len(text) > WHITE and _WHITE.search(text)
        if ranked is not None and not long and not any(t in text for t in self.special):
            return ranked.encode_ordinary(text)
        return load(self.name, self.plain).encode(text, add_special_tokens=False).ids

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, 32 bits each."""
        return [np.array(self.ids_of(t), np.uint32) for t in texts]

    def spans(self, texts: list[str]) -> list[np.ndarray]:
        """(first, past the last) code point of every token of each text, in order. A token that holds
        some of a code point's bytes spans that code point."""
        out = []
        for text in texts:
            stops = np.cumsum(self.bytes_of[np.array(self.ids_of(text), np.int64)])
            starts = np.concatenate([[0], stops[:-1]])[: len(stops)].astype(np.int64)
            if not text.isascii():
                data = np.frombuffer(text.encode(), np.uint8)
                point = np.cumsum((data & 0xC0) != 0x80) - 1  # the code point that a byte belongs to
                starts, stops = point[starts], point[stops - 1] + 1
            out.append(np.stack([starts, stops], axis=1))
        return out


@lru_cache(maxsize=4)
def encoder(name: str, plain: bool = False) -> Encoder:
    """The encoder of this worker."""
    return Encoder(name, plain)


@lru_cache(maxsize=4)
def token_bytes(name: str) -> list[bytes]:
    """The bytes of every token of a byte-level vocabulary."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
    own = load(name)
    out = [b""] * own.get_vocab_size()
    for token, i in own.get_vocab().items():
        out[i] = bytes(of[c] for c in token) if all(c in of for c in token) else token.encode()
    return out


@lru_cache(maxsize=2)
def pieces(name: str) -> tuple[SentencePieceProcessor, list[bytes]]:
    """A sentence-piece model and the bytes of its pieces: U+2581 is a space, byte pieces are one byte."""
    own = SentencePieceProcessor(model_file=vocabulary(name))
    out = []
    for i in range(own.get_piece_size()):
        piece = own.id_to_piece(i)
        out.append(bytes([int(piece[3:5], 16)]) if own.is_byte(i) else piece.replace("▁", " ").encode())
    return own, out
