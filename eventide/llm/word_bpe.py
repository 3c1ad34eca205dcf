"""Whole texts to ids with the tokenizers library, a table of known pieces in each worker before it.

ASCII white space ends every token and is dropped by the vocabulary's rules,
so a text's ids are those of its pieces in order. Texts are cut into pieces by
the file's own rule, written out for characters up to U+00FF, many texts at
once; a piece that was seen before is looked up, once for each place it stands
in, and new ones go through the library's model, many together. A word with a
character above U+00FF or ``<|`` goes through the library whole.

Long texts are cut at white space, so memory is bounded by ``CHUNK``
characters and a table of ``TABLE_BYTES``, whatever the texts.
"""

from __future__ import annotations

import json
import os
import re
from itertools import chain

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from eventide.llm.common import Known

#: Bytes of the worker's table.
TABLE_BYTES = 64 << 20
#: Characters cut into pieces together.
CHUNK = 1 << 20

# Letters and numbers up to U+00FF, as classes L and N of the Unicode standard have them.
_L, _N, _S = "a-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\x09-\x0d \x85\xa0"
# Fixed value: the rule of the vocabulary, whose letters and numbers are written out above.
RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Letters first, as they are the most frequent; nothing else of the rule starts with one.
_LETTERS, _NUMBER, _REST = f"[{_L}]+", f"[{_N}]", f"[^{_S}{_L}{_N}]+"
_PIECE = re.compile(f"{_LETTERS}|{_NUMBER}|'(?:[stmd]|[rv]e|ll)|{_REST}")
_WORD = re.compile(r"[^\x09-\x0d ]+")
_BLANK = re.compile(r"[\x09-\x0d ]")
# Classes of characters up to U+00FF: none (white space), letters, numbers, others.
_CLASS = bytes(0 if re.match(f"[{_S}]", chr(i)) else 1 if re.match(_LETTERS, chr(i)) else 2 if re.match(_NUMBER, chr(i)) else 3 for i in range(256))
# White space to str.split, though not to the vocabulary's rules.
_SEPARATORS = "\x1c\x1d\x1e\x1f"
_ODD = re.compile(r"[^\x00-\xff]|<\|")
#: Marks a word that goes through the library whole; no piece holds it.
_WHOLE = "\n"
#: Pieces that go through the model together.
STEP = 4096
#: What the model puts behind a piece's last character, and so behind its last token.
END = "</w>"


def chunks(text: str, most: int = 0):
    """The text in parts of about so many characters that end at white space."""
    a, most = 0, most or CHUNK
    while len(text) - a > most:
        m = _BLANK.search(text, a + most)
        if not m:
            break
        yield text[a : m.start()]
        a = m.start()
    yield text[a:] if a else text


def _room(a: np.ndarray, n: int) -> np.ndarray:
    return a if n <= len(a) else np.concatenate([a, np.zeros(max(n, 2 * len(a)) - len(a), a.dtype)])


class Coded(Known):
    """Known pieces by code, and the ids of each. A piece that is new when looked up gets the next code."""

    def __init__(self, most: int):
        super().__init__(most)
        self._empty()

    def _empty(self):
        self.clear()
        self.held, self.codes, self.used, self.new = 0, 0, 0, []
        self.ids, self.starts, self.sizes = np.zeros(1 << 10, np.uint32), np.zeros(1 << 10, np.int64), np.zeros(1 << 10, np.int64)

    def __missing__(self, piece: str) -> int:
        self[piece] = code = self.codes + len(self.new)
        self.new.append(piece)
        return code

    def look_up(self, parts: list[list[str]]) -> np.ndarray:
        """Codes of all pieces of the parts."""
        return np.fromiter(map(self.__getitem__, chain.from_iterable(parts)), np.int64, sum(map(len, parts)))

    def put(self, codes: np.ndarray, ids: np.ndarray, sizes: np.ndarray, at: int) -> int:
        """Set the ids of codes, which lie one behind the other from ``at`` on; where they end."""
        if len(codes):
            self.ids = _room(self.ids, at + len(ids))
            self.starts, self.sizes = (_room(a, int(codes[-1]) + 1) for a in (self.starts, self.sizes))
            self.ids[at : at + len(ids)] = ids
            self.starts[codes], self.sizes[codes] = at + np.cumsum(sizes) - sizes, sizes
        return at + len(ids)

    def take(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of codes, and how many each has."""
        sizes = self.sizes[codes]
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts[codes] - ends + sizes, sizes)
        at += np.arange(len(at))
        return self.ids[at], sizes

    def begin(self) -> None:
        if self.held > self.most:
            self._empty()

    def end(self) -> None:
        """Drop new pieces that were met once; the others get codes without gaps."""
        self.leave(self.new)
        stay = [i for i, p in enumerate(self.new) if p in self]
        ids, sizes = self.take(self.codes + np.array(stay, np.int64))
        last = self.codes + len(stay)
        self.update(zip((self.new[i] for i in stay), range(self.codes, last), strict=True))
        self.used = self.put(np.arange(self.codes, last), ids, sizes, self.used)
        self.held += ids.nbytes
        self.codes, self.new = last, []


def _plain(text: str) -> bool:
    """Whether cut_plain may cut the text."""
    if not text.isascii():
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return False
    return "<|" not in text and not any(x in text for x in _SEPARATORS)


def cut_plain(texts: list[str]) -> tuple[list[str], np.ndarray]:
    """Pieces of all texts, and how many each has: what _PIECE finds, by blanks put between classes of characters."""
    lower = [t.lower() for t in texts]
    raw = "\n".join([*lower, "  "]).encode("latin-1")
    c, b = np.frombuffer(raw.translate(_CLASS), np.uint8), np.frombuffer(raw, np.uint8)
    solid = c != 0
    # Whether a blank goes before a character; a number is a piece by itself.
    edge = np.zeros(len(c), bool)
    edge[1:] = ((c[1:] != c[:-1]) | (c[1:] == 2)) & solid[1:] & solid[:-1]
    # Texts end with two blanks at least, so there are two characters behind each apostrophe.
    i = np.flatnonzero(b == ord("'"))
    if len(i):
        # One within a run of others belongs to the run.
        i = i[(i == 0) | (c[i - 1] != 3)]
        x, y = b[i + 1], b[i + 2]
        short = np.isin(x, np.frombuffer(b"stmd", np.uint8))
        long = ((x == ord("r")) | (x == ord("v"))) & (y == ord("e")) | (x == ord("l")) & (y == ord("l"))
        i, n = i[short | long], np.where(short, 2, 3)[short | long]
        edge[i + 1] = False
        edge[i + n] = solid[i + n]
    blanks = np.flatnonzero(edge)
    own = np.ones(len(b) + len(blanks), bool)
    own[blanks + np.arange(len(blanks))] = False
    out = np.full(len(own), ord(" "), np.uint8)
    out[own] = b
    solid[1:] &= edge[1:] | ~solid[:-1]
    at = np.append(0, np.cumsum([len(t) + 1 for t in lower], dtype=np.int64))
    return out.tobytes().decode("latin-1").split(), np.diff(np.searchsorted(np.flatnonzero(solid), at))


class WordBPE:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        # The piecewise way is taken only for the kind of file that it is exact for.
        rules = [x["type"] for x in (made.get("normalizer") or {}).get("normalizers", [])]
        split = [x for x in (made.get("pre_tokenizer") or {}).get("pretokenizers", []) if x["type"] == "Split"]
        fits = rules == ["NFC", "Replace", "Lowercase"] and len(split) == 1 and split[0]["behavior"] == "Removed" and split[0]["invert"]
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        # No symbol is unknown, so that each piece has one token with END, its last.
        known = made["model"].get("end_of_word_suffix") == END and all(c in vocab and c + END in vocab for c in pre_tokenizers.ByteLevel.alphabet())
        self.spaced = bool(fits and known and split[0]["pattern"]["Regex"] == RULE)
        # The library's rules without those that the cut has done.
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.CharDelimiterSplit("\n"), level])
        self.last = np.zeros(max(vocab.values(), default=0) + 1, bool)
        self.last[[i for t, i in vocab.items() if t.endswith(END)]] = True
        self.table = Coded(TABLE_BYTES)

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces, which are what the library's rules would cut, and how many each has: its model alone is left to do."""
        lines = ("\n".join(pieces[a : a + STEP]) for a in range(0, len(pieces), STEP))
        ids = np.concatenate([np.empty(0, np.uint32), *(np.array(self.model.encode_batch_fast([x], add_special_tokens=False)[0].ids, np.uint32) for x in lines)])
        return ids, np.diff(np.flatnonzero(self.last[ids]) + 1, prepend=0)

    def _cut(self, text: str) -> list[str]:
        words = _WORD.findall(text)
        return list(chain.from_iterable([_WHOLE + w] if _ODD.search(w) else _PIECE.findall(w.lower()) for w in words))

    def _learn(self) -> None:
        """Give the table the ids of its new pieces."""
        table = self.table
        whole = [i for i, p in enumerate(table.new) if p[0] == _WHOLE]
        plain = [i for i, p in enumerate(table.new) if p[0] != _WHOLE] if whole else range(len(table.new))
        at = table.put(table.codes + np.array(plain, np.int64), *self._pieces([table.new[i] for i in plain]), table.used)
        made = self._library([table.new[i][1:] for i in whole])
        table.put(table.codes + np.array(whole, np.int64), np.frombuffer(b"".join(made), "<u4"), np.array([len(m) // 4 for m in made], np.int64), at)

    def _encode(self, texts: list[str]) -> list[bytes]:
        plain = [_plain(t) for t in texts]
        pieces, counts = cut_plain([t for t, p in zip(texts, plain, strict=True) if p])
        parts = [self._cut(t) for t, p in zip(texts, plain, strict=True) if not p]
        self.table.begin()
        codes = self.table.look_up([pieces, *parts])
        self._learn()
        ids, sizes = self.table.take(codes)
        self.table.end()
        ends = np.append(0, np.cumsum(sizes))[np.cumsum([*counts, *map(len, parts)], dtype=np.int64)].tolist()
        ids = ids.astype("<u4", copy=False)
        made = [ids[a:z].tobytes() for a, z in zip([0, *ends], ends)]
        own, odd = iter(made[: len(counts)]), iter(made[len(counts) :])
        return [next(own if p else odd) for p in plain]

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of texts, as little-endian unsigned 32-bit integers, without special tokens added."""
        if not self.spaced:
            return self._library(texts)
        made: list[list[bytes]] = [[] for _ in texts]
        waiting: list[tuple[int, str]] = []

        def flush():
            for (i, _), ids in zip(waiting, self._encode([t for _, t in waiting]), strict=True):
                made[i].append(ids)
            waiting.clear()

        n = 0
        for i, text in enumerate(texts):
            for chunk in chunks(text.encode("utf-8", "replace").decode() if not text.isascii() else text):
                waiting.append((i, chunk))
                n += len(chunk)
                if n >= CHUNK:
                    flush()
                    n = 0
        flush()
        return [m[0] if len(m) == 1 else b"".join(m) for m in made]


_LOADED: dict[str, WordBPE] = {}


def loaded(path: str) -> WordBPE:
    """One for each worker."""
    if path not in _LOADED:
        _LOADED[path] = WordBPE(path)
    return _LOADED[path]


def ids_crc32(column: str = "ids") -> Column:
    """Unsigned CRC-32 of packed ids."""
    return F.crc32(column)
