"""Token ids of whole texts, each distinct piece of text encoded once.

A byte-level tokenizer never joins across a single blank that stands between two other characters, so a
text can be cut there and the pieces encoded on their own. Neither does it join letters and the marks after
them, nor what stands on either side of a single line break, which is a token of its own. A block of texts is
cut with numpy, and Arrow tells its distinct pieces apart, so that a word keeps its ids whatever mark or line
follows and is looked up once per block. Pieces are kept in a bounded table per worker;
pieces that are new in a block of texts are encoded in one call. Texts with other white space around a
blank (two blanks, a line break and a blank, a blank at an edge) are encoded whole. A word of letters alone
goes straight to the tokenizer's model, in the byte alphabet that the model is written in. A text with the
string of a special token is encoded whole, and the string becomes that token, as the library does it.
"""

from __future__ import annotations

from array import array
from codecs import charmap_decode
from collections.abc import Callable, Iterable, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from rollbook.llm.textblocks import raw

#: Entries in the younger of the two generations of a table, and characters in its entries: one block of texts may go beyond.
MOST_PIECES = 400_000
MOST_CHARS = 1 << 23
#: Texts encoded at a time.
TEXT_BYTES = 1 << 21
MARKS = "!\"#$%&()*+,-./:;<=>?@[]^_`{|}~"
TOKENIZER = "byte_bpe_50k.json"

_coders: dict[str, Coder] = {}


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def coder(path: str) -> Coder:
    """One per worker and file. `.json` is read by tokenizers, `.tiktoken` by tiktoken."""
    if path not in _coders:
        _coders[path] = Coder(path)
    return _coders[path]


class Table:
    """Ids of pieces seen lately, or their numbers; one whose ids depend on what stands around it has None.

    Two generations: when the younger is full it becomes the older one, from which pieces in use move back.
    """

    def __init__(self, blank: str, many: Callable[[list[str]], list]):
        self._blank, self._many = blank, many
        self.known: dict[str, Any] = {}
        self._chars = 0
        self._older: dict[str, Any] = {}
        self._tails: dict[str, Any] = {}

    def learn(self, pieces: Iterable[str]) -> None:
        self._turn()
        self._learn(pieces)

    def values(self, pieces: list[str]) -> list:
        """What is known of each piece, after those that are new were learnt."""
        self._turn()
        out = list(map(self.known.get, pieces))
        other = [k for k, value in enumerate(out) if value is None]
        self._learn([pieces[k] for k in other])
        for k in other:
            out[k] = self.known[pieces[k]]
        return out

    def _turn(self) -> None:
        if len(self.known) > MOST_PIECES or self._chars > MOST_CHARS:
            self._older, self.known, self._chars = self.known, {}, 0

    def _learn(self, pieces: Iterable[str]) -> None:
        known = self.known
        unknown = {p for p in pieces if p not in known}
        self._chars += sum(map(len, unknown))
        again = self._older.keys() & unknown
        known.update([(p, self._older.pop(p)) for p in again])
        cut, new = {}, []
        for p in unknown.difference(again) if again else unknown:
            bare = p[1:] if p[:1] == " " else p
            if bare.isalpha() or p == "\n":
                new.append(p)
            elif not bare or bare[0].isspace() or bare[-1].isspace():
                known[p] = None
            elif len(word := p.rstrip(MARKS)) < len(p) and word.removeprefix(" ").isalpha():
                cut[p] = word
            else:
                new.append(p)
        self._encode(new)
        if cut:
            self._learn(set(cut.values()))
            tails = {p: p[len(word) :] for p, word in cut.items()}
            for tail in set(tails.values()).difference(self._tails):
                self._tails[tail] = self._many([tail])[0]
            known.update((p, known[word] + self._tails[tails[p]]) for p, word in cut.items())
            if len(self._tails) > 15_000:
                self._tails = {}

    def _encode(self, new: list[str]) -> None:
        if new:
            self.known.update(zip(new, self._many([self._blank + p for p in new]), strict=True))


def _bytes(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for first, last in ranges:
        out[first : last + 1] = True
    return out


_MARK = np.isin(np.arange(256), list(MARKS.encode()))
_ASCII_LETTER, _SOLID = _bytes((0x41, 0x5A), (0x61, 0x7A)), _bytes((0x21, 0x7E))
#: First bytes of characters of two bytes: U+00C0 to U+027F are letters but for two, up to U+07FF none is white space.
_LETTER_LEAD, _SOLID_LEAD = _bytes((0xC3, 0xC9)), _bytes((0xC3, 0xDF))


def _starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pieces begin: texts, blanks, marks after letters, line breaks between other characters and what follows these."""
    start = data == 0x20
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True

    def ends(at: np.ndarray, one: np.ndarray, lead: np.ndarray) -> np.ndarray:
        """Of places, those before which a character of one byte in `one`, or of two with the first in `lead`, ends."""
        before, two = data[at - 1], data[at - 2]
        return one[before] | ((before >= 0x80) & lead[two] & ~((two == 0xC3) & ((before == 0x97) | (before == 0xB7))))

    mark = np.flatnonzero(_MARK[data])
    mark = mark[~edge[mark]]
    start[mark[ends(mark, _ASCII_LETTER, _LETTER_LEAD)]] = True
    line = np.flatnonzero(data == 0x0A)
    line = line[~edge[line] & ~edge[line + 1]]
    line = line[ends(line, _SOLID, _SOLID_LEAD) & (_SOLID | _SOLID_LEAD)[data[line + 1]]]
    start[line] = start[line + 1] = True
    return np.flatnonzero(start | edge[:-1])


class Cut:
    """A block of texts cut into pieces: the distinct ones, which stands where, and where each text begins. Null is empty."""

    def __init__(self, texts: pa.Array | Sequence[str]):
        self.texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        data, offsets = raw(self.texts)
        starts = _starts(data, offsets)
        ends = pa.py_buffer(np.append(starts, len(data)))
        coded = pa.LargeStringArray.from_buffers(len(starts), ends, pa.py_buffer(data)).dictionary_encode()
        self.pieces, self.at = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        self.first = np.searchsorted(starts, offsets)

    def text(self, k: int) -> str:
        return self.texts[k].as_py() or ""

    def whole(self, values: pa.Array) -> list[int]:
        """Texts with a piece that has no value."""
        if not values.null_count:
            return []
        return np.flatnonzero(self.sums(values.is_null().to_numpy(zero_copy_only=False))).tolist()

    def sums(self, values: np.ndarray) -> np.ndarray:
        """The sum over each text's pieces of a number per distinct piece."""
        return np.diff(np.append(0, np.cumsum(values[self.at], dtype=np.int64))[self.first])


class Coder:
    def __init__(self, path: str):
        if path.endswith(".tiktoken"):
            import base64

            import public_tokenizers
            import tiktoken

            with open(path, "rb") as file:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
            model = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.whole = lambda text: array("I", model.encode_ordinary(text)).tobytes()
            self._special: list[str] = []
            many = lambda pieces: [self.whole(p) for p in pieces]
        else:
            from tokenizers import Tokenizer

            model = Tokenizer.from_file(path)
            model.encode_special_tokens = True  # their strings in a piece are ordinary text
            self._special = [t.content for t in model.get_added_tokens_decoder().values()]
            inner, self.vocabulary = model.model, model.get_vocab
            self.whole = lambda text: array("I", model.encode(text, add_special_tokens=False).ids).tobytes()

            def marked(text: str) -> bytes:
                model.encode_special_tokens = False
                ids = self.whole(text)
                model.encode_special_tokens = True
                return ids

            self._marked = marked

            def many(pieces: list[str]) -> list[bytes]:
                other = [p for p in pieces if not p.lstrip(" ").isalpha()]
                ids = dict(zip(other, _split(model.encode(other, is_pretokenized=True, add_special_tokens=False), len(other)), strict=True)) if other else {}
                return [ids[p] if p in ids else array("I", [t.id for t in inner.tokenize(_in_bytes(p))]).tobytes() for p in pieces]

        self._ids = Table("", many)
        self._numbers = Table("", lambda pieces: [len(ids) // 4 for ids in many(pieces)])

    def encode_after_blank(self, texts: Sequence[str]) -> list[bytes]:
        """Ids of a blank and each text, in the same form; strings of special tokens are ordinary text."""
        return self._joined(Cut([" " + text for text in texts]))

    def encode(self, texts: pa.Array | Sequence[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; null is empty."""
        out = self._joined(cut := Cut(texts))
        for k in self._with_special(cut):
            out[k] = self._marked(cut.text(k))
        return out

    def count(self, cut: Cut) -> np.ndarray:
        """How many ids `encode` gives for each text."""
        values = pa.array(self._numbers.values(cut.pieces), pa.int64())
        out = cut.sums(values.fill_null(0).to_numpy())
        for k in cut.whole(values):
            out[k] = len(self.whole(cut.text(k))) // 4
        for k in self._with_special(cut):
            out[k] = len(self._marked(cut.text(k))) // 4
        return out

    def _joined(self, cut: Cut) -> list[bytes]:
        values = pa.array(self._ids.values(cut.pieces), pa.large_binary())
        _, ends, data = values.take(pa.array(cut.at)).buffers()
        at = np.frombuffer(ends, np.int64)[cut.first].tolist() if len(cut.at) else [0] * len(cut.first)
        ids = memoryview(data or b"")
        out = [bytes(ids[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
        for k in cut.whole(values):
            out[k] = self.whole(cut.text(k))
        return out

    def _with_special(self, cut: Cut) -> list[int]:
        found = [pc.match_substring(cut.texts, special).fill_null(False) for special in self._special]
        return sorted({k for flags in found for k in np.flatnonzero(flags.to_numpy(zero_copy_only=False)).tolist()})


#: The byte alphabet: printable bytes stand for themselves, the others follow from 256 on.
_PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_ALPHABET = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
_TABLE = "".join(chr(_ALPHABET.get(b, b)) for b in range(256))


def _in_bytes(piece: str) -> str:
    return charmap_decode(piece.encode(), "strict", _TABLE)[0]


def _split(encoding, n: int) -> list[bytes]:
    ids, of = np.array(encoding.ids, "<u4"), np.array(encoding.word_ids, np.int64)
    at = (4 * np.searchsorted(of, np.arange(n + 1))).tolist()
    data = ids.tobytes()
    return [data[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
