"""Encoding of whole texts with a word-level BPE file of the tokenizers library, word by word.

The file's normaliser and splitter work within the words between ASCII white space (composition, lower case and
classes of letters never reach over a space, and white space itself is dropped), so a text's identifiers are those of
its words in turn. Corpora repeat words, so each distinct word is encoded once a process, and a text is gathered from
one flat array of identifiers. Words are looked up together: those of fewer than 16 bytes by two integers that hold
all their bytes and their length, in a hash table of numpy arrays; longer ones in a dictionary.

Words of Latin letters are cut further, as the file's own splitter does, into pieces that the library's BPE model encodes,
many pieces in one call; all others go through the library whole. Words and pieces are forgotten when there are too
many, so memory is bounded.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache
from itertools import chain

import numpy as np

from .common import U64, mix, words

END_ID = 1
#: Distinct words, and pieces, that a process remembers.
WORDS, PIECES = 15 << 17, 1 << 19
#: Bytes of a text that are cut into words at a time.
SEGMENT = 1 << 20
#: Pieces that the library's model is handed as one text.
LINE = 64
_GAP = re.compile(rb"[\t-\r ]")
#: The lowest k bytes of an integer.
_LOW = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: Characters below this have one form, and so has their lower case; I with a dot above is the only exception.
_PLAIN = "ƀ"
_LETTER, _NUMBER = ("".join(re.escape(chr(c)) for c in range(0x180) if unicodedata.category(chr(c))[0] == kind) for kind in "LN")
_PIECE = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^\t-\r \x85\xa0{_LETTER}{_NUMBER}]+")  # fixed values of the file


def _byte_names() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(rest)}


class _Lists:
    """Lists of identifiers one after another, by their number."""

    def __init__(self):
        self.n, self.edge, self.flat = 0, np.zeros(1024, np.int64), np.zeros(4096, np.uint32)

    def add(self, length: np.ndarray, flat: np.ndarray) -> None:
        first, used = self.n, int(self.edge[self.n])
        self.n += len(length)
        for name, need in (("edge", self.n + 1), ("flat", used + len(flat))):
            old = getattr(self, name)
            if need > len(old):
                setattr(self, name, np.concatenate([old, np.zeros(max(need, 2 * len(old)) - len(old), old.dtype)]))
        self.edge[first + 1 : self.n + 1] = used + np.cumsum(length)
        self.flat[used : used + len(flat)] = flat

    def take(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(identifiers of the lists at ``place`` in turn, number of each)"""
        begin = self.edge[place]
        n = self.edge[place + 1] - begin
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.arange(total) + np.repeat(begin - ends + n, n)], n


class _Short:
    """Keys of two integers -> places, in a table with open addresses that is at most half full."""

    def __init__(self):
        self.slots, self.low, self.high, self.places = np.full(1 << 12, -1, np.int32), *(np.zeros(1 << 11, t) for t in (np.uint64, np.uint64, np.int32))
        self.n = 0

    def _at(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return (mix(low ^ mix(high)) & U64(len(self.slots) - 1)).astype(np.int64)

    def find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Places, -1 for keys that aren't there."""
        out, todo, at = np.full(len(low), -1, np.int64), np.arange(len(low)), self._at(low, high)
        while len(todo):
            row = self.slots[at]
            same = (row >= 0) & (self.low[row] == low[todo]) & (self.high[row] == high[todo])
            out[todo[same]] = self.places[row[same]]
            on = (row >= 0) & ~same
            todo, at = todo[on], at[on] + 1 & len(self.slots) - 1
        return out

    def add(self, low: np.ndarray, high: np.ndarray, places: np.ndarray) -> None:
        """Keys that differ and aren't there."""
        first, self.n = self.n, self.n + len(low)
        if 2 * self.n > len(self.slots):
            size = 1 << (2 * self.n).bit_length()
            for name in ("low", "high", "places"):
                old = getattr(self, name)
                setattr(self, name, np.concatenate([old[:first], np.zeros(size // 2 - first, old.dtype)]))
            self.slots, fresh = np.full(size, -1, np.int32), 0
        else:
            fresh = first
        self.low[first : self.n], self.high[first : self.n], self.places[first : self.n] = low, high, places
        row = np.arange(fresh, self.n, dtype=np.int32)
        at = self._at(self.low[row], self.high[row])
        while len(row):
            free = self.slots[at] < 0
            self.slots[at[free]] = row[free]  # of several rows for a slot one stays
            lost = self.slots[at] != row
            row, at = row[lost], at[lost] + 1 & len(self.slots) - 1


class WordEncoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.names = _byte_names()
        self.model = Tokenizer(self.tokenizer.model)  # cuts at white space, which no name of a byte is
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.last = np.zeros(self.tokenizer.get_vocab_size(), bool)  # identifiers that end a piece
        self.last[[k for name, k in self.tokenizer.get_vocab().items() if name.endswith("</w>")]] = True
        self._forget()

    @staticmethod
    @lru_cache(maxsize=2)
    def of(path: str) -> WordEncoder:
        """The process's encoder of a file: tasks of one worker share its dictionaries."""
        return WordEncoder(path)

    def _forget(self) -> None:
        self.ids, self.short, self.long = _Lists(), _Short(), {}
        self._forget_pieces()

    def _forget_pieces(self) -> None:
        self.pieces, self.piece_ids = {}, _Lists()

    def _model(self, pieces: list[str]) -> None:
        """Identifiers of new pieces, ``LINE`` of them in one text."""
        shown = [p if p.isascii() and p.isprintable() else p.encode().decode("latin-1").translate(self.names) for p in pieces]
        lines = self.model.encode_batch_fast([" ".join(shown[k : k + LINE]) for k in range(0, len(shown), LINE)], add_special_tokens=False)
        flat = np.fromiter(chain.from_iterable(x.ids for x in lines), np.uint32)
        ends = np.flatnonzero(self.last[flat]) + 1
        if len(ends) != len(pieces) or ends[-1] != len(flat):
            raise ValueError("the model doesn't mark the ends of words")
        self.piece_ids.add(np.diff(ends, prepend=0), flat)

    def _cut(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(identifiers, number of each) of words of Latin letters, piece by piece."""
        if len(self.pieces) >= PIECES:
            self._forget_pieces()
        cut, known = [_PIECE.findall(w.lower()) for w in words], self.pieces
        if fresh := [p for p in dict.fromkeys(chain.from_iterable(cut)) if p not in known]:
            self._model(fresh)
            known.update(zip(fresh, range(len(known), len(known) + len(fresh)), strict=True))
        ids, n = self.piece_ids.take(np.fromiter(map(known.__getitem__, chain.from_iterable(cut)), np.int64))
        edge = np.cumsum([0, *map(len, cut)])
        return ids, np.diff(np.r_[0, np.cumsum(n)][edge])

    def _learn(self, words: list[bytes]) -> None:
        """Identifiers of new words; they get the next places."""
        texts = [w.decode() for w in words]
        plain = np.array([(t.isascii() or (max(t) < _PLAIN and "İ" not in t)) and "<|" not in t for t in texts])
        ids, n = self._cut([t for t, p in zip(texts, plain.tolist(), strict=True) if p])
        whole = [x.ids for x in self.tokenizer.encode_batch_fast([t for t, p in zip(texts, plain.tolist(), strict=True) if not p], add_special_tokens=False)]
        length = np.zeros(len(texts), np.int64)
        length[plain], length[~plain] = n, [len(x) for x in whole]
        flat, of_plain = np.zeros(int(length.sum()), np.uint32), np.repeat(plain, length)
        flat[of_plain], flat[~of_plain] = ids, np.fromiter(chain.from_iterable(whole), np.uint32)
        self.ids.add(length, flat)

    def _places(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Of the words' identifiers; new words are learnt."""
        place, size, raw = np.full(len(start), -1, np.int64), end - start, data.tobytes() + bytes(16)
        short = np.flatnonzero(size < 16)
        eight = np.ndarray(len(raw) - 7, "<u8", raw, strides=(1,))
        a, k = start[short], size[short]
        low = eight[a] & _LOW[np.minimum(k, 8)]
        high = eight[a + 8] & _LOW[np.maximum(k - 8, 0)] | k.astype(np.uint64) << U64(56)
        found = self.short.find(low, high)
        fresh, new = np.flatnonzero(found < 0), []
        if len(fresh):
            order = fresh[np.lexsort((low[fresh], high[fresh]))]
            edge = np.r_[True, (np.diff(low[order]) != 0) | (np.diff(high[order]) != 0)]
            first = order[edge]
            found[order] = self.ids.n + np.cumsum(edge) - 1
            self.short.add(low[first], high[first], found[first])
            new = [raw[x : x + y] for x, y in zip(a[first].tolist(), k[first].tolist(), strict=True)]
        place[short] = found
        for i in np.flatnonzero(size >= 16).tolist():
            word = raw[start[i] : end[i]]
            if (known := self.long.get(word)) is None:
                known = self.long[word] = self.ids.n + len(new)
                new.append(word)
            place[i] = known
        if new:
            self._learn(new)
        return place

    def rows(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(identifiers of all rows in turn, number of each), without special ones; of rows as ``texts_of`` gives them.

        Rows of more than ``SEGMENT`` bytes together must be one row, which is cut at its spaces.
        """
        if len(data) > SEGMENT and len(offsets) == 2:
            raw, at, out = memoryview(data), 0, []
            while at < len(data):
                gap = _GAP.search(raw, min(at + SEGMENT, len(data)))
                stop = gap.start() if gap else len(data)
                out.append(self.rows_at_once(data[at:stop], np.array([0, stop - at]))[0])
                at = stop
            ids = np.concatenate(out)
            return ids, np.array([len(ids)])
        return self.rows_at_once(data, offsets)

    def rows_at_once(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.ids.n > WORDS:
            self._forget()
        start, end, of_row = words(data, offsets)
        ids, n = self.ids.take(self._places(data, start, end))
        return ids, np.diff(np.r_[0, np.cumsum(n)][of_row])

    def encode(self, text: str) -> np.ndarray:
        """The identifiers of a whole text, without special ones."""
        data = np.frombuffer(text.encode(), np.uint8)
        return self.rows(data, np.array([0, len(data)]))[0]
