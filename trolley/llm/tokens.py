"""Whole-text encoding with the ``tokenizers`` library, with a memo over text chunks.

Byte-pair encoding never merges across a pre-token. A text is therefore cut at places where a pre-token is
sure to end, each distinct chunk is encoded once by the library and kept in a bounded memo, and the chunks'
ids are joined. The result is the library's result for the whole text:

* byte-level BPE: chunks are white space and then a run of plain letters, digits or signs, where the next character
  surely starts a pre-token; else "white space, then non-white space" (``\\s*\\S+``). The pre-tokenizer's own
  boundaries lie inside or at the ends of these. So a word is one chunk, whatever signs follow it;
* BPE with word ends: white space is dropped, so chunks are the runs between ASCII white space. NFC and the
  per-character lower-casing never look across white space. A-Z are lower-cased beforehand, so that a chunk is kept
  once; not in texts with combining marks, where composition may depend on the letter's case.

The chunks of a block of texts that the memo lacks are encoded together. Those of plain letters, digits and signs are cut
further, at the pre-tokenizer's own places, and all parts go to the library's BPE model in one call, in its alphabet of
bytes, with marks between them that no merge holds. A model with word ends adds them to a call's last character alone, so
its copy writes a last character as a character of its own. Any other chunk goes through the whole library.

Python's ``\\s`` also holds U+001C to U+001F, which the tokenizer takes for symbols: such a text is encoded
whole. Strings of special tokens inside a text are ordinary text.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import pairwise

import numpy as np

from trolley.llm.common import KEPT

BYTE_CHUNKS = re.compile(r"\s*\S+|\s+")
WORD_CHUNKS = re.compile(r"[^ \t-\r]+")
_MARKS = re.compile("[\u0300-\u036f]")
_ODD_SPACE = re.compile("[\x1c-\x1f]")
#: The pre-tokens of plain chunks: Latin letters, ASCII digits and ASCII signs but the apostrophe (contractions).
_SIGNS = r"!-&(-/:-@\[-`{-~"
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_PARTS = {
    False: re.compile(rf" ?[{_LETTERS}]+| ?[0-9]+| ?[{_SIGNS}]+"),
    True: re.compile(rf"[a-zß-öø-ÿ]+|[0-9]|[{_SIGNS}]+"),
}
#: A plain chunk that is one pre-token.
_ONE = {False: re.compile(rf" ?[{_LETTERS}]+| ?[{_SIGNS}]+"), True: re.compile("[a-zß-öø-ÿ]+")}
#: Byte-level chunks. An apostrophe after a sign belongs to the same pre-token, after a letter or digit it starts one.
FINE_CHUNKS = re.compile(
    rf"\s*+(?:[{_LETTERS}]++(?![^\s0-9'{_SIGNS}])|[{_SIGNS}]++(?![^\s0-9{_LETTERS}])|[0-9]++(?![^\s'{_SIGNS}{_LETTERS}]))|\s*\S+|\s+"
)
#: Byte-level models write a byte as a character: printable ones as themselves, the others from 256 on.
_PRINTED = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTES = {b: 256 + i for i, b in enumerate(x for x in range(256) if x not in _PRINTED)}
_WRITTEN = np.array([_BYTES.get(b, b) for b in range(256)], "<u2")
_MARK, _PART = 2, 1  # bytes after a chunk, and after a part of one; plain chunks hold neither
_LAST = 0xE000  # private characters: a byte at the end of a word
MEMO_ENTRIES = 150_000  # chunks per generation; two generations live at a time (about 65 MB a Python worker)
BLOCK_CHARS = 1 << 18  # of the texts whose chunks are looked up together
CALL_CHUNKS = 256  # that go to the model in one call
SPAN_ENTRIES = 250_000  # the same for the spans of chunks
LONGEST_KEPT = 64  # characters of a chunk that is worth keeping


class Memo(dict):
    """chunk → value, with two generations: when the young one is full it becomes the old one."""

    def __init__(self, make: Callable, limit: int = SPAN_ENTRIES):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
            if len(key) > LONGEST_KEPT:
                return value
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class PlainModel:
    """The library's BPE model, asked for the ids of many plain chunks at once."""

    def __init__(self, model, marks: str, ids: Sequence[int], word_ends: bool):
        self.model, self.word_ends = model, word_ends
        self.chunk_end, self.part_end = ids
        self.written = _WRITTEN.copy()  # byte → its character, as UTF-16
        self.written[[_MARK, _PART]] = [ord(m) for m in marks]

    @staticmethod
    def of(tok, suffix: str | None) -> PlainModel | None:
        """None if the vocabulary is not one of bytes, or merges a mark."""
        vocab = tok.get_vocab(with_added_tokens=False)
        alphabet = {chr(c): b for b, c in enumerate(_WRITTEN.tolist())}
        if not all(c in vocab and (not suffix or c + suffix in vocab) for c in alphabet):
            return None
        if not suffix:
            marks = "\xc0\xc1"
            if any(m in t for t in vocab if len(t) > 1 for m in marks):
                return None
            return PlainModel(tok.model, marks, [vocab[m] for m in marks], False)
        spec = json.loads(tok.to_str())["model"]
        if any(spec.get(k) for k in ("dropout", "continuing_subword_prefix", "ignore_merges")):
            return None

        def own(token: str) -> str:
            stem = token.removesuffix(suffix)
            return token if stem == token else stem[:-1] + chr(_LAST + alphabet[stem[-1]])

        from tokenizers.models import BPE

        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["merges"]]
        marks, top = "\x02\x01", max(vocab.values())
        own_vocab = {own(t): i for t, i in vocab.items() if t[:-1].isascii() or alphabet.keys() >= set(t)}
        model = BPE(own_vocab | {marks[0]: top + 1, marks[1]: top + 2}, [(own(a), own(b)) for a, b in pairs])
        return PlainModel(model, marks, (top + 1, top + 2), True)

    def ids(self, chunks: Sequence[str], dtype: str) -> list[bytes]:
        """The ids of each chunk, in which the pre-tokens are parted by marks."""
        out = []
        for i in range(0, len(chunks), CALL_CHUNKS):
            out += self._call(chunks[i : i + CALL_CHUNKS], dtype)
        return out

    def _call(self, chunks: Sequence[str], dtype: str) -> list[bytes]:
        read = np.frombuffer(chr(_MARK).join(chunks).encode("utf-8"), np.uint8)
        chars = self.written[read]
        if self.word_ends:
            last = np.append(np.flatnonzero(read <= _MARK), len(read)) - 1
            chars[last] = read[last].astype("<u2") + _LAST
        made = self.model.tokenize(chars.tobytes().decode("utf-16-le"))
        got = np.array([t.id for t in made])
        ends = got == self.chunk_end
        real = ~ends & (got != self.part_end)
        data = got[real].astype(dtype).tobytes()
        cuts = [0, *(np.cumsum(real)[ends] * np.dtype(dtype).itemsize).tolist(), len(data)]
        return [data[a:b] for a, b in pairwise(cuts)]


class Encoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        word_ends = getattr(self.tok.model, "end_of_word_suffix", None)
        self.chunks = WORD_CHUNKS if word_ends else BYTE_CHUNKS  # of ``spans``
        self.fine = WORD_CHUNKS if word_ends else FINE_CHUNKS
        self.lower = bool(word_ends)  # such a vocabulary's normaliser lower-cases
        #: The narrowest type that holds every id of the vocabulary.
        self.dtype = "<u2" if self.tok.get_vocab_size() <= 1 << 16 else "<u4"
        self.code = "H" if self.dtype == "<u2" else "I"
        self.one, self.parts = _ONE[self.lower], _PARTS[self.lower]
        self.plain = PlainModel.of(self.tok, word_ends)
        self.young: dict[str, bytes] = {}  # chunk → ids, in two generations as in ``Memo``
        self.old: dict[str, bytes] = {}
        self.span_memo = Memo(self._starts)

    def _ids(self, chunk: str) -> bytes:
        return self._all_ids([chunk])[0]

    def _all_ids(self, texts: list[str]) -> list[bytes]:
        made = self.tok.encode_batch_fast(texts, add_special_tokens=False)
        return [array(self.code, e.ids).tobytes() for e in made]

    def _learn(self, chunks: set[str]) -> list[str]:
        """Put the chunks' ids into the young generation; those too long to be kept are returned."""
        plain, parted, odd, long = [], [], [], []
        one, findall, old, young = self.one.fullmatch, self.parts.findall, self.old.get, self.young
        for c in chunks.difference(young):
            if ids := old(c):
                young[c] = ids
            elif len(c) > LONGEST_KEPT:
                long.append(c)
            elif self.plain is None:
                odd.append(c)
            elif one(c):
                plain.append(c)
                parted.append(c)
            else:
                parts = findall(c)
                if sum(map(len, parts)) == len(c):
                    plain.append(c)
                    parted.append(chr(_PART).join(parts))
                else:
                    odd.append(c)
        if plain:
            self.young.update(zip(plain, self.plain.ids(parted, self.dtype)))
        if odd := odd + long:
            self.young.update(zip(odd, self._all_ids(odd)))
        return long

    def _starts(self, chunk: str) -> bytes:
        spans = self.tok.encode(chunk, add_special_tokens=False).offsets
        return np.asarray(spans, dtype="<i4").reshape(-1, 2).tobytes()

    def encode(self, text: str) -> bytes:
        """The ids of a whole text, little-endian, in the vocabulary's narrowest type (``dtype``)."""
        return next(self.encode_all([text]))

    def encode_all(self, texts: Iterable[str]) -> Iterator[bytes]:
        """``encode`` of each text, in their order; unknown chunks of a block of texts are encoded together."""
        block, size = [], 0
        for text in texts:
            block.append(text)
            size += len(text)
            if size >= BLOCK_CHARS:
                yield from self._block(block)
                block, size = [], 0
        yield from self._block(block)

    def _block(self, texts: list[str]) -> list[bytes]:
        found = [None if _ODD_SPACE.search(t) else self.fine.findall(self._lowered(t)) for t in texts]
        chunks = set().union(*filter(None, found))
        long = self._learn(chunks)
        known = self.young
        out = [self._ids(t) if f is None else b"".join([known[c] for c in f]) for t, f in zip(texts, found)]
        for c in long:
            del self.young[c]
        if len(self.young) >= MEMO_ENTRIES:
            self.old, self.young = self.young, {}
        return out

    def _lowered(self, text: str) -> str:
        if self.lower and not _MARKS.search(text):
            return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # A-Z alone
        return text

    def pack(self, *ids: int) -> bytes:
        """Single ids in the same form."""
        return np.array(ids, self.dtype).tobytes()

    def spans(self, text: str) -> np.ndarray:
        """(n, 2) character spans [start, end) of a whole text's tokens, in order."""
        if _ODD_SPACE.search(text):
            return np.frombuffer(self._starts(text), dtype="<i4").reshape(-1, 2)
        found = list(self.chunks.finditer(text))
        if not found:
            return np.zeros((0, 2), dtype="<i4")
        parts = [self.span_memo[m.group()] for m in found]
        at = np.fromiter((m.start() for m in found), dtype="<i4", count=len(found))
        n = np.fromiter((len(p) >> 3 for p in parts), dtype=np.int64, count=len(parts))
        rel = np.frombuffer(b"".join(parts), dtype="<i4").reshape(-1, 2)
        return rel + np.repeat(at, n)[:, None]


def encoder(path: str) -> Encoder:
    """The process's encoder for a vocabulary file (Python workers are reused, so the memo lives on)."""
    if path not in KEPT:
        KEPT[path] = Encoder(path)
    return KEPT[path]


def widen(ids: bytes, dtype: str) -> bytes:
    """Ids in a narrow type as little-endian unsigned 32-bit integers."""
    return ids if dtype == "<u4" else np.frombuffer(ids, dtype).astype("<u4").tobytes()


def vocabulary(name: str) -> str:
    """Path of one of the installed public vocabulary files."""
    import public_tokenizers

    return public_tokenizers.path(name)
