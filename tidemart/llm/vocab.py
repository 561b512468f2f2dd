"""Public vocabularies inside tasks: exact encoding of whole texts."""

from __future__ import annotations

import base64
import os
import re
from functools import lru_cache

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

BYTE_BPE = "byte_bpe_50k.json"
BYTE_BPE_RANKS = "byte_bpe_50k.tiktoken"
PIECE_BPE = "piece_bpe_32k.model"

#: The added token of the byte vocabulary; its id follows those of the ranks.
END_OF_TEXT = "<|endoftext|>"
#: White space that is neither a blank nor a line feed.
OTHER_BLANK = re.compile(r"[\t\r\v\f\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]").search
#: Texts with so much white space in a row go through the slower library, whose pattern does not backtrack.
LONG_BLANKS = re.compile(r"\s{1000}").search
#: A generation of a cache holds this many words, so a worker's memory does not grow with the input.
CACHE_WORDS = 100_000
#: Longer words are encoded each time they are met.
CACHED_CHARS = 64


def vocabulary_path(name: str, folder: str | None = None) -> str:
    """Place of a vocabulary file: in `folder`, or where the public package has it on this machine."""
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


class WordCache(dict):
    """`encode(word)` of recent words: two generations, the older one dropped when the newer is full."""

    def __init__(self, encode, words: int = CACHE_WORDS):
        super().__init__()
        self.encode, self.words, self.old = encode, words, {}

    def __missing__(self, word):
        value = self.old.get(word)
        if value is None:
            value = self.encode(word)
        if len(word) <= CACHED_CHARS:
            if len(self) >= self.words:
                self.old = dict(self)
                self.clear()
            self[word] = value
        return value


def byte_characters() -> dict[int, str]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the others from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {byte: chr(byte if byte in printable else next(others)) for byte in range(256)}


class ByteEncoder:
    """Ids of whole texts, equal to the tokenizer file's own `encode(text, add_special_tokens=False)`.

    Texts go through the rank file beside the tokenizer file, which has the same vocabulary and pattern and a faster library. The two libraries could
    class a character differently, so each one beyond ASCII is probed once in a task; a text with a character that differs, with very
    long white space, or that spells an added token (unless `plain`, when these are ordinary text) goes through the tokenizer file, as do all
    where there is no rank file. No words are remembered, so memory does not grow with the input.
    """

    def __init__(self, path: str, plain: bool = False):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = plain
        ranks = os.path.splitext(path)[0] + ".tiktoken"
        self.ranked = rank_encoder(ranks) if os.path.exists(ranks) else None
        self.added = [] if plain else [token.content for token in self.library.get_added_tokens_decoder().values()]
        self.agreed: set[str] = set(map(chr, range(128)))
        self.differing: set[str] = set()

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _agrees(self, text: str) -> bool:
        """Whether both libraries class all characters alike."""
        if text.isascii():
            return True
        seen = set(text)
        for character in seen - self.agreed - self.differing:
            probe = f"a{character}1{character}{character}, {character} a"
            same = self.ranked.encode_ordinary(probe) == self.library.encode(probe, add_special_tokens=False).ids
            (self.agreed if same else self.differing).add(character)
        return self.differing.isdisjoint(seen)

    def ids(self, text: str) -> np.ndarray:
        """Ids of one text as unsigned integers of 32 bits."""
        if self.ranked is None or any(some in text for some in self.added) or LONG_BLANKS(text) or not self._agrees(text):
            return np.frombuffer(self.whole(text), "<u4")
        return self.ranked.encode_to_numpy(text, disallowed_special=())


@lru_cache(maxsize=4)
def byte_encoder(path: str, plain: bool = False) -> ByteEncoder:
    return ByteEncoder(path, plain)


@lru_cache(maxsize=4)
def rank_encoder(path: str):
    """Encoder of a rank file, for counts."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(os.path.basename(path), pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={END_OF_TEXT: len(ranks)})


@lru_cache(maxsize=4)
def piece_encoder(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@lru_cache(maxsize=4)
def spelt_characters(path: str) -> frozenset[str]:
    """Characters that a piece vocabulary has a piece for, and blanks; any other character becomes bytes."""
    pieces = piece_encoder(path)
    named = (pieces.id_to_piece(piece) for piece in range(pieces.get_piece_size()) if not pieces.is_byte(piece))
    return frozenset({piece for piece in named if len(piece) == 1} | set(" \t\n\v\f\r"))
