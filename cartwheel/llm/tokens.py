"""Fast encoding with a byte-level BPE of the ``tokenizers`` library.

The pre-tokenizer never lets a unit run past certain borders: before a space or line break that stands alone,
after such a line break, and between an ASCII letter and ASCII punctuation. Texts are cut there and every
chunk is encoded alone. Chunks repeat, so a batch's bytes are cut and its equal chunks are found by array operations
(a hash of every chunk, each compared with the first of its hash byte by byte), and the ids of distinct ones are kept in bounded
per-process tables: the library sees each distinct chunk of a table's life once. Texts with other white space,
or white space side by side, take a plainer cut; texts with the string of an added token are not cut.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

import numpy as np
import pandas as pd
from tokenizers import Tokenizer

from cartwheel.llm import storage

#: White space that the array path does not take.
_ODD = re.compile(r"[^\S \n]|\s\s")
_CUT = re.compile(r"(?<=\S)(?= )")
_BYTES = 1 << 20  # of text in one array step
ENTRY = 160  # bytes of a remembered chunk besides its own: two objects and their place in the table
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SPACE, _BREAK, _LETTER, _MARK = 1, 2, 3, 4
_KIND = np.zeros(256, np.uint8)
_KIND[ord(" ")], _KIND[ord("\n")] = _SPACE, _BREAK
for _b in range(33, 127):  # an apostrophe may start a contraction, digits and letters have units of their own
    _KIND[_b] = _LETTER if chr(_b).isalpha() else 0 if chr(_b) in "'0123456789" else _MARK


def _powers(size: int) -> np.ndarray:
    return np.cumprod(np.full(size, _STEP, np.uint64))


_kept_powers = lru_cache(maxsize=1)(_powers)


def powers(size: int) -> np.ndarray:
    """Powers of the hash's base; one table is kept, longer ones are made for the text that needs them."""
    return _kept_powers(2 * _BYTES) if size <= 2 * _BYTES else _powers(size + 1)


def equal_chunks(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each chunk, the same for equal bytes, and the first chunk of each number."""
    sizes = ends - starts
    power = powers(len(data))
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(data * power[:len(data)])])
        codes = (sums[ends] - sums[starts]) * power[len(data) - starts] ^ sizes.astype(np.uint64) * _STEP
    numbers, values = pd.factorize(codes)
    first = np.empty(len(values), np.int64)
    first[numbers[::-1]] = np.arange(len(numbers) - 1, -1, -1)
    model = first[numbers]
    same = (sizes[model] == sizes).all()
    if same:
        back = np.arange(len(data)) - np.repeat(starts - starts[model], sizes)
        same = (data[back] == data).all()
    if not same:  # two chunks share a hash: compare the chunks themselves
        raw = data.tobytes()
        numbers, _ = pd.factorize(np.array([raw[a:b] for a, b in zip(starts, ends)] + [None], dtype=object)[:-1])
        first = np.empty(numbers.max() + 1, np.int64)
        first[numbers[::-1]] = np.arange(len(numbers) - 1, -1, -1)
    return numbers, first


def byte_alphabet() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = {b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174}
    rest = iter(range(256, 512))
    return {b: chr(b if b in plain else next(rest)) for b in range(256)}


class ChunkEncoder:
    """Ids of whole texts as little-endian bytes, equal to ``Tokenizer.encode(text, add_special_tokens=False).ids``.

    Null counts as empty. ``table_bytes`` bounds the remembered chunks, by about what they take in memory.
    """

    def __init__(self, tokenizer_path: str, table_bytes: int = 64 << 20):
        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        # the library takes an added token's string before it cuts units, so texts that hold one are encoded whole
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 65536 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.model = self.tokenizer.model
        self.table_bytes, self.held = table_bytes, 0
        self.chunks: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.alphabet = byte_alphabet()

    def _pack(self, ids) -> bytes:
        return array(self.code, ids).tobytes()

    def _whole(self, text: str) -> bytes:
        return self._pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _chunk(self, chunk: bytes) -> bytes:
        """Ids of a chunk; letters with at most one leading space are one unit for the library."""
        text = chunk.decode()
        if (text[1:] if text[0] == " " else text).isalpha():
            return self._pack([t.id for t in self.model.tokenize(chunk.decode("latin1").translate(self.alphabet))])
        return self._whole(text)

    def _known(self, distinct: list[bytes]) -> list[bytes]:
        found = list(map(self.chunks.get, distinct))
        if 2 * self.held > self.table_bytes:  # what is met again comes back from the older half
            self.chunks, self.older, self.held = {}, self.chunks, 0
        table, older = self.chunks, self.older
        for i, ids in enumerate(found):
            if ids is None:
                chunk = distinct[i]
                ids = older.get(chunk)
                found[i] = table[chunk] = ids = self._chunk(chunk) if ids is None else ids
                self.held += ENTRY + len(chunk) + len(ids)
        return found

    def _plain(self, text: str) -> bytes:
        first, *rest = _CUT.split(text)
        return self._whole(first) + b"".join(self._known([p.encode() for p in rest]))

    def _step(self, parts: list[bytes]) -> list[bytes]:
        """Ids of texts without odd white space, none of them empty."""
        raw = b"".join(parts)
        data = np.frombuffer(raw, np.uint8)
        begins = np.cumsum([0] + [len(p) for p in parts])
        kind = _KIND[data]
        border = np.ones(len(data), bool)
        before, here = kind[:-1], kind[1:]
        border[1:] = ((here == _SPACE) | (here == _BREAK) | (before == _BREAK)
                      | ((before == _LETTER) & (here == _MARK)))
        border[begins[:-1]] = True
        starts = np.flatnonzero(border)
        ends = np.append(starts[1:], len(data))
        numbers, first = equal_chunks(data, starts, ends)
        known = self._known([raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())])
        flat = np.frombuffer(b"".join(known), self.dtype)
        sizes = np.array([len(k) for k in known]) // self.dtype.itemsize
        places = np.cumsum(sizes) - sizes
        each = sizes[numbers]
        after = np.cumsum(each)
        out = flat[np.repeat(places[numbers] - (after - each), each) + np.arange(after[-1])]
        cuts = np.append((after - each)[np.searchsorted(starts, begins[:-1])], after[-1]).tolist()
        return [out[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]

    def encode_many(self, texts) -> list[bytes]:
        """The ids of each text; null counts as empty."""
        out: list[bytes] = [b""] * len(texts)
        rows, parts, size = [], [], 0
        for row, text in enumerate(texts):
            if not text:
                continue
            if self.added and self.added.search(text):
                out[row] = self._whole(text)
                continue
            if _ODD.search(text):
                out[row] = self._plain(text)
                continue
            rows.append(row)
            parts.append(text.encode())
            size += len(parts[-1])
            if size >= _BYTES:
                for r, ids in zip(rows, self._step(parts)):
                    out[r] = ids
                rows, parts, size = [], [], 0
        if rows:
            for r, ids in zip(rows, self._step(parts)):
                out[r] = ids
        return out

    def encode(self, text: str | None) -> bytes:
        return self.encode_many([text])[0]

    def ids(self, text: str | None) -> np.ndarray:
        return np.frombuffer(self.encode(text), dtype=self.dtype)


TABLE_BYTES = 64 << 20


def encoder(tokenizer_path: str, table_bytes: int = TABLE_BYTES) -> ChunkEncoder:
    """One encoder per worker process, so its tables outlive a task."""
    return storage.held((tokenizer_path, table_bytes), lambda: ChunkEncoder(tokenizer_path, table_bytes))
