"""Token ids by the public tokenizer libraries, inside tasks."""

from __future__ import annotations

import codecs
import hashlib
import re
from array import array
from collections.abc import Callable
from functools import lru_cache
from pathlib import Path
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

KNOWN = 100_000  # words of a generation; a worker remembers two, about 40 MB
LONGEST = 64  # longer words are not remembered
TAIL = b".,!?;:"
# printable ASCII without what could start a special token or a contraction
_PLAIN, _RUNS = re.compile(rb"[!-&(-;=-{}~]+"), re.compile(rb"[a-z]+|[0-9]|[^a-z0-9]+")
_SPACES = b" \t\n\r\x0b\x0c"
# bytes of the lower-case letters of ASCII and from U+00DF to U+00FF
_LETTERS = bytes([*range(97, 123), 0xC3, *sorted({*range(0x9F, 0xC0)} - {0xB7})])
# 1 for white space, 2 for marks of ASCII, 3 for the first byte of U+00C0 to U+00FF, 4 for that of U+0300 and up
_KINDS = bytes(
    1 if b in _SPACES else 2 if 33 <= b < 127 and not chr(b).isalnum() else 3 if b == 0xC3 else 4 * (b >= 0xCC)
    for b in range(256)
)


class _Words(dict):
    """Ids of words, found on first use, many at once by ``all``. At ``KNOWN`` words it begins a new
    generation and keeps the last one to look back at, so that frequent words are never lost."""

    def __init__(self, find) -> None:
        self.find, self.before = find, {}

    def __missing__(self, word: bytes) -> bytes:
        ids = self.before.get(word)
        return self._keep(word, self.find(word) if ids is None else ids)

    def all(self, words: list[bytes], find: Callable[[list[bytes]], list[bytes]]) -> list[bytes]:
        """Ids of each word; ``find`` gives those of the new ones."""
        ids = list(map(self.get, words))
        lost = [i for i, x in enumerate(ids) if x is None]
        for i in lost:
            ids[i] = self.before.get(words[i])
        new = [i for i in lost if ids[i] is None]
        for i, x in zip(new, find([words[i] for i in new])):
            ids[i] = x
        for i in lost:
            self._keep(words[i], ids[i])
        return ids

    def _keep(self, word: bytes, ids: bytes) -> bytes:
        if len(word) <= LONGEST:
            if len(self) >= KNOWN:
                self.before = dict(self)
                self.clear()
            self[word] = ids
        return ids


class Encoder:
    """Ids of texts, as bytes of little-endian unsigned 32-bit numbers.

    ``by_word`` cuts texts into runs without ASCII white space, looks up each different one, and in it letters and
    other characters apart, and encodes only what is new. That is right only for a tokenizer that drops
    white space, lower-cases, and parts letters from other characters, as word_bpe_49k does.
    Others get the whole text.
    """

    def __init__(self, name: str, model: bytes, by_word: bool = False) -> None:
        self.by_word = by_word
        if name.endswith(".model"):
            import sentencepiece

            pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
            self.library = lambda texts: pieces.encode(texts, num_threads=1)
        else:
            from tokenizers import Tokenizer
            from tokenizers.pre_tokenizers import ByteLevel, CharDelimiterSplit

            library = Tokenizer.from_str(model.decode())
            library.no_truncation()
            library.no_padding()
            self.merges = library.model
            level = ByteLevel(add_prefix_space=False, use_regex=False)
            # names of the bytes of the letters that _run takes
            self.names = {c: "".join(p for p, _ in level.pre_tokenize_str(chr(c))) for c in range(0x80, 0x250)}
            # names of the bytes of _LETTERS, and the model alone over words so written, between blanks
            self.bytes = [chr(b) for b in range(256)]
            for c in range(0xC0, 0x100):
                for b, name in zip(chr(c).encode(), "".join(p for p, _ in level.pre_tokenize_str(chr(c)))):
                    self.bytes[b] = name
            self.bytes = "".join(self.bytes)
            self.between = Tokenizer(self.merges)
            self.between.pre_tokenizer = CharDelimiterSplit(" ")
            # whether a token ends its word
            suffix, vocab = getattr(self.merges, "end_of_word_suffix", None), library.get_vocab(with_added_tokens=False)
            self.last = np.zeros(max(vocab.values(), default=0) + 1, bool)
            if suffix:
                self.last[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
            self.library = lambda texts: [
                e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)
            ]
        self.words = _Words(self._word)

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [array("I", ids).tobytes() for ids in self.library(texts)]

    def _word(self, word: bytes) -> bytes:
        """Ids of a new word, put together from parts that are words themselves."""
        known = self.words
        if word.isalpha():  # most words: letters, or letters and one mark
            low = word.lower()
            return self._merged(low.decode()) if low == word else known[low]
        core, mark = word[:-1], word[-1:]
        if core.isalpha() and mark in TAIL:
            return known[core.lower()] + known[mark]
        if _PLAIN.fullmatch(word):
            runs = _RUNS.findall(word.lower())
            return b"".join([known[r] for r in runs]) if len(runs) > 1 else self._run(word)
        core = word.rstrip(TAIL)
        if 0 < len(core) < len(word) and core.decode().lower().isalpha():
            return known[core] + known[word[len(core) :]]
        return self._run(word)

    def _run(self, run: bytes) -> bytes:
        text = run.decode()
        low = text.lower()
        # Latin letters in composed form: the same, and bytes beyond ASCII have names of their own
        if low.isalpha() and max(low) < "\u0250" and max(text) < "\u0250" and is_normalized("NFC", text):
            return self._merged(low.translate(self.names))
        return self._ids([text])[0]

    def _merged(self, text: str) -> bytes:
        return array("I", [t.id for t in self.merges.tokenize(text)]).tobytes()

    def _new(self, words: list[bytes]) -> list[bytes]:
        """Ids of new words; those of plain letters go to the model together."""
        plain = [not w.translate(None, _LETTERS) for w in words]
        letters = [w for w, p in zip(words, plain) if p]
        found = [x for at in range(0, len(letters), 4096) for x in self._letters(letters[at : at + 4096])]
        rest = iter(found)
        return [next(rest) if p else self._word(w) for w, p in zip(words, plain)]

    def _letters(self, words: list[bytes]) -> list[bytes]:
        names = codecs.charmap_decode(b" ".join(words), "strict", self.bytes)[0]
        ids = np.array(self.between.encode_batch_fast([names], add_special_tokens=False)[0].ids, "<u4")
        cuts = [0, *(4 * (np.flatnonzero(self.last[ids]) + 1)).tolist()]
        if len(cuts) != len(words) + 1:  # the model does not mark the ends of words
            return [self._merged(x) for x in names.split(" ")]
        data = ids.tobytes()
        return [data[a:b] for a, b in zip(cuts, cuts[1:])]

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        flat, ends = self.flat(pa.array(texts, pa.binary()))
        cuts = [0, *ends.tolist()]
        return [flat[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]

    def flat(self, texts: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and where those of each text end; a null is empty."""
        texts = texts.fill_null(b"")
        if not self.by_word:
            ids = self._ids([t.decode() for t in texts.to_pylist()])
            return np.frombuffer(b"".join(ids), "<u4"), np.cumsum([len(x) // 4 for x in ids], dtype=np.int64)
        words, ends = split_words(texts)
        found = words.dictionary_encode()
        ids = self.words.all(_strings(found.dictionary), self._new)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        table, starts = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(sizes) - sizes
        codes = found.indices.to_numpy()
        n = sizes[codes]
        till = np.concatenate(([0], np.cumsum(n)))
        at = np.repeat(starts[codes] - till[:-1], n)
        at += np.arange(len(at))
        return table[at], till[ends]


def _parts(strings: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets from 0 and bytes of an array without nulls."""
    _, offsets, data = strings.buffers()
    if not len(strings):
        return np.zeros(1, np.int32), np.zeros(0, np.uint8)
    offsets = np.frombuffer(offsets, np.int32)[strings.offset : strings.offset + len(strings) + 1]
    held = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return offsets - offsets[0], held[offsets[0] : offsets[-1]]


def _strings(strings: pa.BinaryArray) -> list[bytes]:
    offsets, data = _parts(strings)
    cuts, data = offsets.tolist(), data.tobytes()
    return [data[a:b] for a, b in zip(cuts, cuts[1:])]


def split_words(texts: pa.BinaryArray) -> tuple[pa.BinaryArray, np.ndarray]:
    """Runs without ASCII white space of all texts, and the number of those up to the end of each text.

    So that few are new, they are in lower case and the last marks after a letter (ASCII, or U+00C0 to U+00FF)
    that they are parted from are a word of their own. A letter before a character from U+0300 on keeps its
    case, as both may be composed before the tokenizer lower-cases. A text with ``<|``, which starts a special
    token, is told by its case and marks and keeps them.
    """
    offsets, data = _parts(texts)
    size = len(data)
    if not size:
        return pa.array([], pa.binary()), np.zeros(len(texts), np.int64)
    data = data.tobytes()
    raw = np.frombuffer(data + b"  ", np.uint8)
    kinds = np.frombuffer(data.translate(_KINDS), np.uint8)
    low = np.frombuffer(bytearray(data.lower()), np.uint8)
    latin = np.flatnonzero(kinds == 3)
    latin = latin[(raw[latin + 1] <= 0x9E) & (raw[latin + 1] != 0x97) & (raw[latin + 2] < 0xCC)]
    low[latin + 1] += 32
    after = np.flatnonzero(kinds[1:] == 4)
    low[after] = raw[after]
    space = kinds == 1
    gap = np.empty(size + 1, bool)  # whether a word can't go on here
    gap[1:] = space
    gap[offsets] = True
    marks = np.flatnonzero(kinds == 2)
    head = np.append(True, np.diff(marks) > 1)[: len(marks)] | gap[marks]
    till = marks[np.append(head[1:], True)[: len(marks)]] + 1
    marks = marks[head]
    marks = marks[(gap[till] | np.append(space, True)[till]) & ~gap[marks]]
    a, b = low[marks - 2], low[marks - 1]
    marks = marks[((b >= 97) & (b <= 122)) | ((a == 0xC3) & (b >= 0x80) & (b <= 0xBF) & (b != 0x97) & (b != 0xB7))]
    special = pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False)
    if special.any():
        inside = np.repeat(special, np.diff(offsets))
        low[inside] = raw[:size][inside]
        marks = marks[~inside[marks]]
    first = gap[:-1] & ~space
    first[marks] = True
    letters = low.tobytes().translate(None, _SPACES)
    starts = np.flatnonzero(first[~space])
    cuts = np.append(starts, len(letters)).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(cuts), pa.py_buffer(letters)])
    return words, np.searchsorted(np.flatnonzero(first), offsets[1:])


@lru_cache(maxsize=1)
def encoder(name: str, model: bytes, by_word: bool = False) -> Encoder:
    """The encoder of this process: a worker's next task goes on with the words it knows."""
    return Encoder(name, model, by_word)


def load(path: str) -> tuple[str, bytes]:
    """Name and content of a tokenizer file; read on the driver, sent to tasks by broadcast."""
    return Path(path).name, Path(path).read_bytes()


def version(name: str, model: bytes) -> str:
    return hashlib.sha256(name.encode() + b"\0" + model).hexdigest()


def pieces(texts: pa.BinaryArray, limit: int = 2 << 20):
    """Slices of an array of texts with at most about ``limit`` bytes each, one text at least."""
    start = size = 0
    for at, more in enumerate(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).tolist()):
        size += more
        if size >= limit:
            yield slice(start, at + 1)
            start, size = at + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))
