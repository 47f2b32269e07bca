"""Byte-level BPE of texts through a cache of their space-separated pieces.

A space between two characters that are not white space always starts a token of its own pattern match, so the pieces
around it are encoded independently of each other. Frequent pieces are then encoded once for each worker.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Callable
from functools import lru_cache
from struct import pack

# White space of any of the libraries; a space next to one is not a safe place to cut.
_BLANK = r"[\s\x1c-\x1f\x85]"
# White space other than space and line feed; texts without it need no slow search.
_RARE = re.compile("[\t\x0b-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_UNSAFE = re.compile(rf"{_BLANK} | {_BLANK}")


def _plain(text: str) -> bool:
    """No space of the text is next to white space."""
    if not text.replace("\n", "").isprintable() and _RARE.search(text):
        return not _UNSAFE.search(text)
    return "  " not in text and " \n" not in text and "\n " not in text


# Marks that the patterns take together with nothing but other marks; an apostrophe may begin a short form.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

_CUT = re.compile(r"(?<=[^\s\x1c-\x1f\x85]) (?=[^\s\x1c-\x1f\x85])")


class PieceCache(dict):
    """Piece without its leading space -> its ids as little-endian 32-bit integers; a key that starts with a line feed
    has no space before it. Holds ``most`` pieces and the ``most`` before them, so that frequent ones stay."""

    def __init__(self, encode: Callable[[str], list[int]], most: int = 500_000):
        super().__init__()
        self.encode, self.most = encode, most
        self.old: dict[str, bytes] = {}
        self.runs: dict[str, bytes] = {"\n": self.packed("\n")}

    def packed(self, text: str) -> bytes:
        ids = self.encode(text)
        return pack(f"<{len(ids)}I", *ids)

    def _run(self, text: str) -> bytes:
        """A line feed before a letter, or marks behind one: always a pattern match of its own."""
        ids = self.runs.get(text)
        if ids is None:
            ids = self.packed(text)
            if len(text) < 16 and len(self.runs) < 10_000:
                self.runs[text] = ids
        return ids

    def word(self, letters: str) -> bytes:
        """Ids of letters behind a space."""
        return self.packed(" " + letters)

    def _made(self, piece: str) -> bytes:
        """Lines of a piece, and marks behind a letter at its end, are pattern matches of their own."""
        lines = piece.split("\n")
        if lines[0] and len(lines) > 1 and all(x and not x[0].isspace() and not x[-1].isspace() for x in lines):
            return self[lines[0]] + b"".join(self["\n" + x] for x in lines[1:])
        word = piece.rstrip(MARKS)
        if len(word) < len(piece) and word[-1:].isalpha():
            return self[word] + self._run(piece[len(word):])
        if piece[:1] == "\n" and piece[1:].isalpha():
            return self._run("\n") + self.packed(piece[1:])
        return self.packed(piece if piece[:1] == "\n" else " " + piece)

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = self.word(piece) if piece.isalpha() else self._made(piece)
        if len(piece) < 64:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids

    def ids(self, text: str) -> bytes:
        first, *rest = text.split(" ") if _plain(text) else _CUT.split(text)
        word = first.rstrip(MARKS)
        if word.isalpha():
            head = self.packed(word) + (self._run(first[len(word):]) if word is not first else b"")
        else:
            head = self.packed(first)
        return head + b"".join(map(self.__getitem__, rest))


class WholeTexts(PieceCache):
    """Texts that hold the content of an added token are encoded whole, as the library looks for these tokens first."""

    def __init__(self, encode: Callable[[str], list[int]], whole: Callable[[str], list[int]], added: list[str],
                 word: Callable[[str], bytes]):
        super().__init__(encode)
        self.whole, self.added, self.word = whole, added, word

    def ids(self, text: str) -> bytes:
        if any(a in text for a in self.added):
            ids = self.whole(text)
            return pack(f"<{len(ids)}I", *ids)
        return super().ids(text)


@lru_cache(1)
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(1)
def rank_file_cache(path: str, pattern: str) -> PieceCache:
    import tiktoken

    encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks(path), special_tokens={})
    return PieceCache(encoding.encode_ordinary)


def _visible_bytes() -> dict[int, int]:
    """Byte-level vocabularies write a byte as a visible character: itself if it is one, else the next from code 256."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in visible]
    return {b: b for b in visible} | {b: 256 + k for k, b in enumerate(others)}


@lru_cache(1)
def json_file_cache(path: str) -> PieceCache:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    tokenizer = Tokenizer(whole.model)  # the pieces hold no added token
    tokenizer.pre_tokenizer = whole.pre_tokenizer
    merge, visible = whole.model.tokenize, {b: chr(c) for b, c in _visible_bytes().items()}

    # Letters are one match of the pattern: only the merges are left to do.
    def merged(letters: str, space: str) -> list[int]:
        return [t.id for t in merge(space + (letters if letters.isascii() else letters.encode().decode("latin-1").translate(visible)))]

    def encode(text: str) -> list[int]:
        letters = text[1:] if text[:1] == " " else text
        return merged(letters, visible[32] * (text is not letters)) if letters.isalpha() else tokenizer.encode(text, add_special_tokens=False).ids

    def word(letters: str) -> bytes:
        return array("I", merged(letters, visible[32])).tobytes()

    added = [t.content for t in whole.get_added_tokens_decoder().values()]
    return WholeTexts(encode, lambda text: whole.encode(text, add_special_tokens=False).ids, added, word)
