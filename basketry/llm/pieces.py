"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies."""

from __future__ import annotations

import codecs
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from basketry.llm.common import python_tasks
from basketry.llm.tokens import Words

#: Parts and words kept in the caches of one Python worker, and the longest one kept.
CACHE_PARTS, CACHE_WORDS, CACHE_CHARS = 500_000, 500_000, 40

#: Parts up to this length are merged side by side, so many at a time.
SIDE_BY_SIDE, ROWS = 32, 20_000

#: Stands for a space within pieces.
SPACE = "▁"
#: Characters below this one, and the space, are looked up in a table.
COMMON = 512

# A byte that is not part of a character becomes one replacement character.
codecs.register_error("byte_by_byte", lambda e: ("�", e.start + 1))


class PieceCodec:
    """Ids of texts and texts of ids, as the sentencepiece library makes them.

    The model file gives pieces, scores and the normaliser; the merging and the
    joining are done here. Merging keeps an agenda of adjacent symbol pairs
    whose joint text is a piece: the best score goes first, the leftmost of
    equals; a pair whose symbols have changed since is passed over.

    Every merge makes a piece, so none crosses two neighbouring characters that
    no piece has next to each other. A text is cut into words before spaces and
    line breaks, where the vocabulary allows it, and a new word between any such
    two characters; each distinct part goes through the agenda once. Words and
    parts are kept.

    Needs a model with byte pieces, which stand for characters that no piece
    has, and without symbols defined by its user.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids: dict[str, int] = {}
        self.order: dict[str, float] = {}  # the better the score, the smaller
        self.unused: set[str] = set()
        self.bytes: dict[int, int] = {}  # id of each byte's piece
        self.surface: list[bytes] = []
        self.silent: set[int] = set()
        self.opening: set[int] = set()
        neighbours: set[str] = set()
        for i in range(sp.vocab_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(piece[3:5], 16)
                self.bytes[value] = i
                self.surface.append(bytes([value]))
            elif sp.is_control(i):
                self.silent.add(i)
                self.surface.append(b"")
            elif sp.is_unknown(i):
                self.surface.append(" ⁇ ".encode())
            else:
                self.ids[piece] = i
                self.order[piece] = -sp.get_score(i)
                if sp.is_unused(i):
                    self.unused.add(piece)
                if piece.startswith(SPACE):
                    self.opening.add(i)
                neighbours.update(map(str.__add__, piece, piece[1:]))
                self.surface.append(piece.replace(SPACE, " ").encode())
        if len(self.bytes) < 256:
            raise ValueError("the model has no byte pieces")
        # two neighbouring characters of pieces as one number; common ones in a table too
        self.neighbours = np.array(sorted(ord(a) << 32 | ord(b) for a, b in neighbours), np.int64)
        self.common = np.zeros(0x110000, np.int16)
        self.common[1:COMMON] = np.arange(1, COMMON)
        self.common[ord(SPACE)] = COMMON
        self.common_pairs = np.zeros((COMMON + 1, COMMON + 1), bool)
        for pair in neighbours:
            a, b = self.common[[ord(pair[0]), ord(pair[1])]]
            if a and b:
                self.common_pairs[a, b] = True
        self.prefixed = sp.normalize("a").startswith(SPACE)
        # whether no piece goes on over a space behind another character, or over a line break
        self.by_word = not any(b == "\n" or (b == SPACE and a != SPACE) for a, b in neighbours)
        self.words = Words()  # a space in front is left out
        self.known: dict[str, bytes] = {}  # ids of parts
        # symbols of the side by side agendas: pieces, then other letters within them
        letters = {c for piece in self.ids for c in piece} - self.ids.keys()
        self.symbols = {**self.ids, **{c: len(self.surface) + i for i, c in enumerate(sorted(letters))}}
        self.symbol_of = np.full(0x110000, -1, np.int64)
        for text, i in self.symbols.items():
            if len(text) == 1:
                self.symbol_of[ord(text)] = i
        self.plain = np.arange(len(self.surface) + len(letters))
        self.plain[len(self.surface) :] = -1
        self.plain[[self.ids[p] for p in self.unused]] = -1
        self._table = None

    def merge(self, text: str) -> list[str]:
        """The pieces of a normalised text."""
        order = self.order
        symbols = list(text)
        after = list(range(1, len(symbols) + 1))
        before = list(range(-1, len(symbols) - 1))
        halves: dict[str, tuple[str, str]] = {}  # of unused pieces
        agenda = [
            (order[pair], i, i + 1, pair)
            for i, pair in enumerate(map(str.__add__, text, text[1:]))
            if pair in order
        ]
        heapify(agenda)
        while agenda:
            _, left, right, pair = heappop(agenda)
            if not symbols[left] or not symbols[right] or symbols[left] + symbols[right] != pair:
                continue
            if pair in self.unused:
                halves[pair] = symbols[left], symbols[right]
            symbols[left], symbols[right] = pair, ""
            following = after[left] = after[right]
            if following < len(symbols):
                before[following] = left
                joint = pair + symbols[following]
                if joint in order:
                    heappush(agenda, (order[joint], left, following, joint))
            ahead = before[left]
            if ahead >= 0:
                joint = symbols[ahead] + pair
                if joint in order:
                    heappush(agenda, (order[joint], ahead, left, joint))
        pieces = [s for s in symbols if s]
        if halves:
            return [p for piece in pieces for p in _apart(piece, halves)]
        return pieces

    def _part(self, text: str) -> bytes:
        found = array("I")
        for piece in self.merge(text):
            known = self.ids.get(piece)
            if known is None:
                found.extend(self.bytes[b] for b in piece.encode())
            else:
                found.append(known)
        return found.tobytes()

    def _parts(self, texts: list[str]) -> list[list[str]]:
        """Each text, cut where no piece can cross."""
        parts, upto = self._flat_parts(texts)
        return [parts[a:b] for a, b in zip(upto, upto[1:])]

    def _flat_parts(self, texts: list[str]) -> tuple[list[str], list[int]]:
        """The parts of all texts, and how many there are before each text and in all."""
        joined = "".join(texts)
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
        own = self.common[codes]
        cut = np.ones(len(codes), bool)
        cut[:-1] = ~self.common_pairs[own[:-1], own[1:]]
        rare = np.flatnonzero((own[:-1] == 0) | (own[1:] == 0))
        pairs = codes[rare].astype(np.int64) << 32 | codes[rare + 1]
        at = np.minimum(np.searchsorted(self.neighbours, pairs), len(self.neighbours) - 1)
        cut[rare] = self.neighbours[at] != pairs
        ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        cut[ends[ends > 0] - 1] = True
        last = np.flatnonzero(cut) + 1
        bounds = [0, *last.tolist()]
        parts = [joined[a:b] for a, b in zip(bounds, bounds[1:])]
        return parts, [0, *np.searchsorted(last, ends, "right").tolist()]

    def _pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each pair of symbols that makes a piece: key, rank of its score, the piece."""
        if self._table is None:
            found = []
            for piece, i in self.ids.items():
                for at in range(1, len(piece)):
                    left, right = (self.symbols.get(x) for x in (piece[:at], piece[at:]))
                    if left is not None and right is not None:
                        found.append((left << 32 | right, self.order[piece], i))
            found.sort()
            keys, order, made = (np.array(x) for x in zip(*found))
            ranks = np.unique(order, return_inverse=True)[1].astype(np.int32)
            self._table = keys, ranks, made.astype(np.int64)
        return self._table

    def _side_by_side(self, parts: list[str]) -> list[bytes | None]:
        """Ids of parts of about one length; none where a symbol is no piece."""
        keys, ranks, made = self._pairs()
        none, wide = np.iinfo(np.int32).max, max(map(len, parts))
        length = np.array([len(p) for p in parts])
        inside = np.arange(wide + 2) < length[:, None]  # two columns of nothing at the end
        symbols = np.full((len(parts), wide + 2), -1, np.int64)
        codes = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), "<u4")
        symbols[inside] = self.symbol_of[codes]

        def look(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            key = np.where((left < 0) | (right < 0), -1, left << 32 | right)
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            return np.where(keys[at] == key, ranks[at], none), made[at]

        agenda, joint = look(symbols[:, :-1], symbols[:, 1:])
        after = np.tile(np.minimum(np.arange(1, wide + 3), wide + 1), (len(parts), 1))
        before = np.tile(np.arange(-1, wide + 1), (len(parts), 1))
        rows = np.arange(len(parts))
        while True:
            left = agenda[rows].argmin(1)  # the leftmost of equals
            more = agenda[rows, left] < none
            rows, left = rows[more], left[more]
            if not len(rows):
                break
            right = after[rows, left]
            following = after[rows, left] = after[rows, right]
            before[rows, following] = left
            symbols[rows, left] = joint[rows, left]
            symbols[rows, right], agenda[rows, right], inside[rows, right] = -1, none, False
            agenda[rows, left], joint[rows, left] = look(symbols[rows, left], symbols[rows, following])
            ahead = before[rows, left]
            r, k, a = rows[ahead >= 0], left[ahead >= 0], ahead[ahead >= 0]
            agenda[r, a], joint[r, a] = look(symbols[r, a], symbols[r, k])
        found = np.where(inside, np.where(symbols >= 0, self.plain[symbols], -1), 0)
        whole = (found >= 0).all(1)
        ids = found[inside].astype("=u4").tobytes()
        ends = 4 * np.cumsum(inside.sum(1))
        starts = np.append(0, ends[:-1])
        return [ids[a:b] if w else None for a, b, w in zip(starts.tolist(), ends.tolist(), whole)]

    def _whole(self, texts: list[str]) -> list[bytes]:
        """Ids of normalised texts, by their parts."""
        parts, upto = self._flat_parts(texts)
        known = self.known
        new = {p for p in parts if p not in known}
        short = sorted((p for p in new if len(p) <= SIDE_BY_SIDE), key=len)
        for i in range(0, len(short), ROWS):
            some = short[i : i + ROWS]
            known.update((p, x) for p, x in zip(some, self._side_by_side(some)) if x is not None)
        for part in new:
            if part not in known:
                known[part] = self._part(part)
        found = list(map(known.__getitem__, parts))
        ends = np.append(0, np.cumsum(np.fromiter(map(len, found), np.int64, len(found))))[upto].tolist()
        ids = b"".join(found)
        out = [ids[a:b] for a, b in zip(ends, ends[1:])]
        room = CACHE_PARTS - len(known) + len(new)
        for part in new:
            if len(part) > CACHE_CHARS or room <= 0:
                del known[part]
            else:
                room -= 1
        return out

    def _words(self, text: str) -> list[str]:
        """What is in front of a normalised text's words, and these, without spaces.

        A text with a run of spaces, or one before a line break, is not cut.
        """
        if not self.by_word or SPACE + SPACE in text or SPACE + "\n" in text:
            return [text]
        return text.replace("\n", SPACE + "\n").split(SPACE)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The texts' ids as unsigned 32-bit integers, without an end id."""
        cut = [self._words(self.library.normalize(t)) for t in texts]
        known = self.words
        get = known.__getitem__
        found = [tuple(map(get, words[1:])) for words in cut]
        new, known.new = known.new, {}
        heads = list({words[0] for words in cut})
        whole = self._whole([*heads, *(w if w.startswith("\n") else SPACE + w for w in new)])
        for room, ids in zip(new.values(), whole[len(heads) :], strict=True):
            room += ids
        first = dict(zip(heads, whole))
        out = [b"".join((first[words[0]], *ids)) for words, ids in zip(cut, found)]
        known.keep(new, CACHE_WORDS, CACHE_CHARS)
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of some ids, with the bytes of neighbouring byte pieces joined."""
        joined = b"".join(map(self.surface.__getitem__, ids))
        if self.prefixed and joined[:1] == b" ":
            if next(i for i in ids if i not in self.silent) in self.opening:
                joined = joined[1:]
        return joined.decode("utf-8", "byte_by_byte")


def _apart(piece: str, halves: dict[str, tuple[str, str]]) -> list[str]:
    """An unused piece as the pieces it was merged from."""
    todo, out = [piece], []
    while todo:
        now = todo.pop()
        if now in halves:
            todo.extend(reversed(halves[now]))
        else:
            out.append(now)
    return out


_CODECS: dict[str, PieceCodec] = {}


def codec(path: str) -> PieceCodec:
    """This Python worker's codec of a model file."""
    if path not in _CODECS:
        _CODECS[path] = PieceCodec(path)
    return _CODECS[path]


def recode(
    docs: DataFrame,
    model: str,
    end: bool = True,
    check: bool = True,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Encode every whole text, decode its ids, and compare with the library.

    Returns a row per row of ``docs``: doc_id, ids (array of integers, the
    model's end id last if ``end``), decoded (the text that the ids give) and
    same_as_library: whether both equal what the sentencepiece library makes
    of the same Arrow batch; null if ``check`` is off.

    Nothing is shuffled. Other columns are left out; a null text is empty and
    has the end id alone; rows that repeat come each; a null key stays null; an
    empty table gives no rows. ``model`` is a file that every executor can read.
    """
    python_tasks(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        library = own.library
        tail = [library.eos_id()] if end else []
        last = array("I", tail).tobytes()
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found = [x + last for x in own.encode(texts)]
            lists = [array("I", x).tolist() for x in found]
            decoded = [own.decode(x) for x in lists]
            same = [None] * len(texts)
            if check:
                theirs = library.encode(texts, add_eos=end, num_threads=1)
                same = [
                    x == y and t == library.decode(x)
                    for x, y, t in zip(lists, theirs, decoded)
                ]
            joined = np.frombuffer(b"".join(found), "=u4").astype(np.int32)
            ends = np.cumsum([0, *(len(x) // 4 for x in found)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(joined)),
                    pa.array(decoded, pa.string()),
                    pa.array(same, pa.bool_()),
                ],
                ["doc_id", "ids", "decoded", "same_as_library"],
            )

    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    return rows.mapInArrow(
        run, "doc_id long, ids array<int>, decoded string, same_as_library boolean"
    )
