"""Token ids of whole texts as little-endian unsigned 32-bit integers.

Both tokenizers cut a text into words before they merge pieces, so the ids of
a text are the ids of its chunks, one after the other, wherever a chunk border
is certain to be a border of words too.  Texts are cut at blanks; the
tokenizers library encodes each distinct chunk once and its ids are kept as
bytes, as long as the Python worker lives.  Chunks of plain letters and common marks skip the library's
normalising and pre-tokenising steps and go to its model word by word; all
others go through the whole tokenizer.
"""

from __future__ import annotations

import re
import struct
import sys
import types
from collections.abc import Callable
from itertools import islice

from tokenizers import Tokenizer

KEPT = 1 << 20              # chunks whose ids are kept in a worker (about 150 MB when full), and words of other chunks, a quarter as many
FIRST = 1 << 17             # of these, the first ones stay when there is no room: most frequent words come early
LONGEST = 48                # characters of a chunk that is worth keeping

_BLANK = re.compile(r"(?<=\S)(?= \S)")     # a single blank between two characters that are no white space
_LETTERS = "[^\\W\\d_]++"                  # with str.isalpha() checked on top: exactly the Unicode letters
_MARKS = "[.,;:!?()|]++"
_LINE_WORDS = re.compile(f" ?{_LETTERS}| ?{_MARKS}|\n")
_PLAIN_LINE = re.compile(f" ?(?:{_LETTERS}|{_MARKS}|(?<=\\S)\n(?=\\S))++")
_WORDS = re.compile(f"{_LETTERS}|{_MARKS}")
_PLAIN = re.compile(f"(?:{_LETTERS}|{_MARKS})++")
#: Letters up to here keep their composition, and their lower case is one rule for all libraries.
_LATIN_END = "\u0100"


def _byte_letters() -> dict[int, int]:
    """Byte-level BPE writes a byte as a letter: printable ones stand for themselves, the others follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: b for b in own} | {b: 256 + i for i, b in enumerate(rest)}


def _ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _make_room(cache: dict, first: int) -> None:
    kept = list(islice(cache.items(), first))
    cache.clear()
    cache.update(kept)


class _Words(dict):
    """Word of the tokenizer's own cutting -> its ids as bytes, by the tokenizer's model."""

    def __init__(self, tokenizer: Tokenizer):
        super().__init__()
        self.model, self.letters = tokenizer.model, _byte_letters()
        self.blank = chr(self.letters[32])

    def __missing__(self, word: str) -> bytes:
        found = self.ids(word)
        if len(self) >= KEPT // 4:
            _make_room(self, FIRST // 4)
        self[word] = found
        return found

    def ids(self, word: str) -> bytes:
        """The ids of a word, which is not kept here."""
        body = word[1:] if word[0] == " " else word
        if body.isascii() and body.isalpha():           # letters stand for themselves
            written = word if body is word else self.blank + body
        else:
            written = word.encode().decode("latin-1").translate(self.letters)
        return _ids([t.id for t in self.model.tokenize(written)])


class _Odd(Exception):
    """A piece whose blanks are no certain word borders."""


class _Pieces(dict):
    """Piece of a text between blanks -> ids as bytes; ``lead`` is put before the piece."""

    def __init__(self, tokenizer: Tokenizer, words: _Words, lead: str, drops_space: bool):
        super().__init__()
        self.tokenizer, self.words, self.lead, self.drops_space = tokenizer, words, lead, drops_space

    def whole(self, chunk: str) -> bytes:
        return _ids(self.tokenizer.encode(chunk, add_special_tokens=False).ids)

    def cut(self, chunk: str) -> list[str] | None:
        """The words of a plain chunk; None if the whole tokenizer has to see it."""
        if self.drops_space:
            if not _PLAIN.fullmatch(chunk) or max(chunk) >= _LATIN_END:
                return None
            parts = _WORDS.findall(chunk.lower())
        else:
            if not _PLAIN_LINE.fullmatch(chunk):
                return None
            parts = _LINE_WORDS.findall(chunk)
        for part in parts:
            body = part.lstrip(" ")
            if body[0] not in ".,;:!?()|\n" and not body.isalpha():
                return None
        return parts

    def simple(self, piece: str) -> bytes | None:
        """The ids of a piece of letters, or of letters and one mark; None if it is anything else."""
        body = piece if piece.isalpha() else piece[:-1]
        if not body.isalpha() or (body is not piece and piece[-1] not in ".,;:!?()|"):
            return None
        if self.drops_space:
            if not body.isascii() and max(body) >= _LATIN_END:
                return None
            if body is not piece or body != body.lower():
                ids = self[body.lower()]
            else:
                return self.words.ids(body)
        elif body is piece:
            return self.words.ids(self.lead + body)
        else:
            ids = self[body]
        return ids if body is piece else ids + self.words[piece[-1]]

    def __missing__(self, piece: str) -> bytes:
        found = None
        if len(piece) < LONGEST:
            found = self.simple(piece)
        if found is None:
            if not self.drops_space and (not piece or piece[0].isspace() or piece[-1].isspace()):
                raise _Odd
            chunk = self.lead + piece
            if len(chunk) > LONGEST:
                return self.whole(chunk)
            parts = self.cut(chunk)
            found = self.whole(chunk) if parts is None else b"".join(map(self.words.__getitem__, parts))
        if len(self) >= KEPT:
            _make_room(self, FIRST)
        self[piece] = found
        return found


def of_worker(key: tuple, make: Callable[[], Callable[[str | None], bytes]]) -> Callable[[str | None], bytes]:
    """The worker's encoder of this key, made by its first task.

    Code of this package reaches a task by value, with module variables of its
    own; what is to outlive the task has to hang on a module of the process.
    """
    name = "tessera_worker_encoders"
    kept = sys.modules.setdefault(name, types.ModuleType(name)).__dict__.setdefault("kept", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]


def _tokenizer(path: str, special_tokens: bool) -> Tokenizer:
    """``special_tokens``: strings of special tokens in a text become their ids, as by the library's own call; else ordinary text."""
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = not special_tokens
    return tokenizer


def _special(tokenizer: Tokenizer) -> Callable[[str], bool]:
    """Whether a text holds an added token, which the library cuts out before all else: such a text is not cut here."""
    added = [re.escape(t.content) for t in tokenizer.get_added_tokens_decoder().values() if t.content]
    found = re.compile("|".join(added)).search if added else None
    return lambda text: found is not None and found(text) is not None


def byte_level_encoder(path: str, special_tokens: bool = False) -> Callable[[str | None], bytes]:
    """Text (null: empty) -> bytes of its ids, for a byte-level vocabulary whose words begin with their blank."""
    tokenizer = _tokenizer(path, special_tokens)
    words, special = _Words(tokenizer), _special(tokenizer)
    first, later = _Pieces(tokenizer, words, "", False), _Pieces(tokenizer, words, " ", False)

    def encode(text: str | None) -> bytes:
        if not text:
            return b""
        if special(text):
            return first.whole(text)
        try:
            head, *rest = text.split(" ")
            return b"".join([first[head], *map(later.__getitem__, rest)])
        except _Odd:
            return b"".join(map(first.whole, _BLANK.split(text)))
    return encode


def lower_word_encoder(path: str, special_tokens: bool = False) -> Callable[[str | None], bytes]:
    """Text (null: empty) -> bytes of its ids, for a lower-case vocabulary that drops white space."""
    tokenizer = _tokenizer(path, special_tokens)
    pieces, special = _Pieces(tokenizer, _Words(tokenizer), "", True), _special(tokenizer)

    def encode(text: str | None) -> bytes:
        if not text:
            return b""
        if special(text):
            return pieces.whole(text)
        return b"".join(map(pieces.__getitem__, text.replace("\n", " ").split(" ")))
    return encode
