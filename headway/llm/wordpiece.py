"""Worker side of the ``tokenizers`` files: ids of white-space separated pre-tokens, cached.

A tokenizer that drops white space never merges across it, so the ids of a text
are the ids of its pre-tokens in a row.  Special strings hold no ASCII white
space and are found within their pre-token as the library finds them.
"""

from __future__ import annotations

import json
import os

CACHE_ROWS = 500_000     # entries of one worker's cache before it starts anew


def load_tokenizer(file: bytes):
    """The library's tokenizer, without truncation and padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(file.decode())
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def drops_case(file: bytes) -> bool:
    """Whether the file lower-cases, splits off letter runs and maps bytes to characters one by one.

    Then a pre-token of small letters alone is one word of the model, and an
    ASCII full stop or comma after a letter is a word of its own.
    """
    own = json.loads(file)
    normal = [x["type"] for x in (own.get("normalizer") or {}).get("normalizers", [])]
    split = (own.get("pre_tokenizer") or {}).get("pretokenizers", [])
    return (normal == ["NFC", "Replace", "Lowercase"] and [x["type"] for x in split] == ["Split", "ByteLevel"]
            and r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+" in split[0]["pattern"].get("Regex", "")
            and not split[1]["add_prefix_space"])


def byte_letters() -> dict[int, str]:
    """Byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for the letters from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = (b for b in range(256) if b not in plain)
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(other)}


class TokenCache(dict):
    """pre-token (UTF-8 bytes) -> ``of(ids)``; a miss is encoded by the library.

    ``first`` holds entries that stay when the cache is full and starts anew.
    The values of the parts of a pre-token add up to its value.
    """

    def __init__(self, file: bytes, of, first: dict | None = None):
        super().__init__(first or {})
        self.tokenizer, self.of, self.first = load_tokenizer(file), of, first or {}
        self.small = drops_case(file)
        self.letters = byte_letters()
        self.model = self.tokenizer.model

    def split(self, text: str) -> list[bytes]:
        """Pre-tokens of a text; small letters where case is dropped and no special string can be meant."""
        data = text.encode()
        if self.small and b"<|" not in data:
            data = data.lower()     # of bytes: A-Z alone
        return data.split()

    def __missing__(self, piece: bytes):
        if len(self) >= CACHE_ROWS + len(self.first):
            self.clear()
            self.update(self.first)
        if self.small and len(piece) > 1 and piece[-1] in b".," and piece[-2:-1].isalpha():
            value = self[piece[:-1]] + self[piece[-1:]]
        else:
            word = piece.decode()
            # below U+0180, letters are composed already and lower-case one by one
            if self.small and word.isalpha() and word < "ƀ" and max(word) < "ƀ" and word == word.lower():
                if len(piece) > len(word):
                    word = piece.decode("latin-1").translate(self.letters)
                value = self.of([t.id for t in self.model.tokenize(word)])
            else:
                value = self.of(self.tokenizer.encode(word, add_special_tokens=False).ids)
        self[piece] = value
        return value
