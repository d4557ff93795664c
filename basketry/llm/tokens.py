"""Token ids of whole texts, by a public tokenizer, with a cache of words."""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Sequence

import numpy as np

#: Words kept in the cache of one Python worker, and the longest one kept.
CACHE_WORDS, CACHE_CHARS = 700_000, 40

_INNER_SPACE = re.compile(r"(?<=\S) (?=\S)")
_SPACES = re.compile(r"\s\s")
#: Marks that end a word; none opens a contraction.
_MARKS = ".,;:!?%&$#*|-"


def _byte_letters() -> list[str]:
    """The letter that stands for each byte value: its own if it is printed."""
    printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in printed else chr(next(others)) for b in range(256)]


class Words(dict):
    """Ids of " " + word, or of a word that begins with a line break, as it is.

    An unknown word gets room for its ids, which are filled in later.
    """

    def __init__(self):
        self.new: dict[str, bytearray] = {}

    def __missing__(self, word: str) -> bytearray:
        room = self.new.get(word)
        if room is None:
            room = self.new[word] = bytearray()
        return room

    def keep(self, new: dict[str, bytearray], most: int, chars: int) -> None:
        """Keeps the first of the words filled in, up to ``most`` in all and ``chars`` long."""
        room = most - len(self)
        for word, ids in new.items():
            if room <= 0:
                break
            if len(word) <= chars:
                self[word] = bytes(ids)
                room -= 1


class Encoder:
    """Ids of texts as unsigned 32-bit integers, in the machine's byte order (little-endian
    wherever Spark runs).

    A byte-level tokenizer never lets a piece cross a single space between two
    other characters: the space opens the piece that follows. A single line break
    is a piece of its own. So a text is cut there, each distinct word goes through
    the tokenizer once, and the ids are joined. New words of a batch go through it as one text, whose ids are cut
    where a token begins with a space. A word of letters, with or without marks
    behind it, is one or two pieces and goes straight to the tokenizer's model,
    which then cuts at plain spaces only. A tokenizer of another kind gets the
    whole texts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import CharDelimiterSplit

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        kind = json.loads(self.tokenizer.to_str())
        before = kind.get("pre_tokenizer") or {}
        self.by_word = (
            before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space")
            and not kind.get("normalizer")
            and kind["model"]["type"] == "BPE"
        )
        self.words = Words()
        self.tails: dict[str, bytes] = {}  # ids of marks
        letters = _byte_letters()
        self.letters = np.array([ord(x) for x in letters], "<u2")
        self.letters[0] = ord(" ")  # between pieces; no piece of letters or marks holds the byte 0
        self.pieces = Tokenizer(self.tokenizer.model)
        self.pieces.pre_tokenizer = CharDelimiterSplit(" ")
        size = max(kind["model"]["vocab"].values(), default=0) + 1 if self.by_word else 0
        self.opens = np.zeros(size, bool)  # whether a token begins with a space
        for token, number in kind["model"]["vocab"].items() if self.by_word else ():
            self.opens[number] = token.startswith(letters[32])

    def _ids(self, texts: Sequence[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(list(texts), add_special_tokens=False)
        return [array("I", x.ids).tobytes() for x in found]

    def _cut(self, ids: list[int]) -> list[bytes]:
        """Ids of several words, cut where one begins with a space."""
        whole = np.array(ids, np.uint32)
        ends = [*(np.flatnonzero(self.opens[whole]) * 4).tolist(), 4 * len(whole)]
        data = whole.tobytes()
        return [data[a:b] for a, b in zip(ends, ends[1:])]

    def _mapped(self, pieces: Sequence[str]) -> str:
        """Pieces of letters or marks as the model has them, with spaces between them."""
        data = np.frombuffer("\0".join(pieces).encode(), np.uint8)
        return self.letters[data].tobytes().decode("utf-16-le")

    def _pieces(self, pieces: Sequence[str]) -> list[bytes]:
        """Ids of each piece."""
        found = self.pieces.encode_batch_fast(
            self._mapped(pieces).split(" "), add_special_tokens=False
        )
        return [array("I", x.ids).tobytes() for x in found]

    def _tail(self, marks: str) -> bytes:
        tail = self.tails.get(marks)
        if tail is None:
            tail = self._pieces([marks])[0]
            if len(self.tails) < 1000:
                self.tails[marks] = tail
        return tail

    def _fill(self, words: dict[str, bytearray]) -> None:
        """Puts the ids of new words into their places."""
        known, stems, breaks, plain, odd = self.words, {}, {}, [], []
        waiting = [], [], []  # of stems: a word's place, the number of its stem, ids of marks
        waiting_breaks = [], [], []
        for word, room in words.items():
            stem = word.rstrip(_MARKS)
            lined = word.startswith("\n")
            if (stem[1:] if lined else stem).isalpha():
                tail = self._tail(word[len(stem) :]) if len(stem) < len(word) else b""
                ids = known.get(stem)
                if ids is not None:
                    room += ids
                    room += tail
                    continue
                those, (rooms, numbers, tails) = (
                    (breaks, waiting_breaks) if lined else (stems, waiting)
                )
                rooms.append(room)
                numbers.append(those.setdefault(stem, len(those)))
                tails.append(tail)
            elif word and " " not in word and not word[0].isspace() and not word[-1].isspace():
                plain.append(word)
            else:
                odd.append(word)
        coded = []
        if stems:
            one = self._mapped([f" {stem}" for stem in stems])
            ids = self.pieces.encode_batch_fast([one], add_special_tokens=False)[0].ids
            coded.append((waiting, self._cut(ids)))
        if breaks:
            first = self._pieces(["\n"])[0]
            found = [first + x for x in self._pieces([stem[1:] for stem in breaks])]
            coded.append((waiting_breaks, found))
        for those, found in coded:
            for room, number, tail in zip(*those):
                room += found[number]
                room += tail
        if plain:
            one = self.tokenizer.encode_batch_fast([" " + " ".join(plain)], add_special_tokens=False)
            for word, ids in zip(plain, self._cut(one[0].ids), strict=True):
                words[word] += ids
        whole = [w if w.startswith("\n") else f" {w}" for w in odd]
        for word, ids in zip(odd, self._ids(whole)):
            words[word] += ids

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        if not self.by_word:
            return self._ids(texts)
        cut = [
            _INNER_SPACE.split(t) if _SPACES.search(t) else t.replace("\n", " \n").split(" ")
            for t in texts
        ]
        heads = dict(zip(firsts := list({c[0] for c in cut}), self._ids(firsts)))
        known = self.words
        get = known.__getitem__
        found = [[heads[c[0]], *map(get, c[1:])] for c in cut]
        new, known.new = known.new, {}
        self._fill(new)
        out = [b"".join(ids) for ids in found]
        known.keep(new, CACHE_WORDS, CACHE_CHARS)
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This Python worker's encoder of a tokenizer file."""
    if path not in _ENCODERS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has the cores
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
