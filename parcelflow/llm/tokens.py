"""Token ids of whole texts through the ``tokenizers`` library, word by word.

A text is cut at ASCII white space, which the tokenizers used here drop, so no
token reaches across a cut. Each distinct piece is encoded by the library once
per worker; its ids go to a pool, and a table from the piece's 64-bit hash to
its place there turns whole slices of texts into ids with NumPy gathers.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from codecs import charmap_decode
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa

from . import wordhash as W
from .worker import keep

#: Pieces a worker keeps between slices; beyond it the table starts anew (about 50 MB). A slice with more grows the table.
TABLE_BITS, KEPT_PIECES = 21, 1_200_000
#: Bytes of text turned into ids at once.
SLICE_BYTES = 2 << 20
#: Words in one string given to the library.
RUN = 256
#: A lower-case Latin word, perhaps with one sign behind it: the tokenizer's
#: normaliser leaves its letters as they are and its splitter takes the word
#: and the sign as one unit each. (UTF-8 of a-z, U+00DF-U+00FF but U+00F7, and U+0153.)
#: Matched over many pieces at once, one a line: (word, sign, any other piece).
PLAIN = re.compile(rb"(?m)^(?:((?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf]|\xc5\x93)++)([.,;:!?]?)$|(.+)$)")

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> str:
    """The letters by which byte-level vocabularies name the bytes: printable
    ASCII, 0xA1-0xAC and 0xAE-0xFF by the code point of the same number, the
    others by 256 and up in order of the byte. A space is left as it is, to
    part words."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    name = {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(sorted(set(range(256)) - set(own)))}
    return "".join(" " if b == 0x20 else name[b] for b in range(256))


class PieceTokenizer:
    """Ids of whole texts, equal to the library's.

    Distinct pieces are encoded once. Plain lower-case words go straight to the
    file's merges, without the normaliser and the splitter that would leave
    them as they are; every other piece goes through the whole tokenizer.
    """

    def __init__(self, path: str, kept: int = KEPT_PIECES, bits: int = TABLE_BITS):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            parts = json.load(f)
        self.library = Tokenizer.from_str(json.dumps(parts))
        self.library.no_truncation()
        self.library.no_padding()
        lowers = any(x.get("type") == "Lowercase" for x in (parts.get("normalizer") or {}).get("normalizers", []))
        self.end = parts["model"].get("end_of_word_suffix") or ""
        self.lower = bool(lowers and self.end)
        self.kept, self.first_bits = kept, bits
        self.signs = {b"": -1}
        self._clear()
        if self.lower:
            parts |= {"normalizer": None, "pre_tokenizer": {"type": "CharDelimiterSplit", "delimiter": " "}, "added_tokens": [], "post_processor": None}
            self.merges = Tokenizer.from_str(json.dumps(parts))
            vocabulary = parts["model"]["vocab"]
            self.letters = _byte_letters()
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends[[k for t, k in vocabulary.items() if t.endswith(self.end)]] = True
            self.signs |= {c.encode(): int(vocabulary[c + self.end]) for c in ".,;:!?"}

    def _clear(self) -> None:
        self._empty_table(self.first_bits)
        self.start, self.length = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.pool = np.zeros(1 << 20, np.uint32)
        self.n_pieces = self.n_pool = 0

    def _empty_table(self, bits: int) -> None:
        self.bits = bits
        self.keys = np.zeros(1 << bits, np.uint64)      # 0: free
        self.places = np.zeros(1 << bits, np.int32)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(64 - self.bits)).astype(np.int64)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key's piece, or -1."""
        at = self._slots(keys)
        seen = self.keys[at]
        out = np.where(seen == keys, self.places[at], -1)
        todo = np.flatnonzero((seen != keys) & (seen != 0))
        mask = (1 << self.bits) - 1
        while len(todo):
            at[todo] = (at[todo] + 1) & mask
            seen = self.keys[at[todo]]
            hit = seen == keys[todo]
            out[todo[hit]] = self.places[at[todo[hit]]]
            todo = todo[~hit & (seen != 0)]
        return out

    def _insert(self, keys: np.ndarray, places: np.ndarray) -> None:
        """Add distinct keys that are not in the table, which stays at most half full."""
        size = self.n_pieces + len(keys)
        if 2 * size > len(self.keys):
            old = np.flatnonzero(self.keys)
            old_keys, old_places = self.keys[old], self.places[old]
            self._empty_table((2 * size - 1).bit_length())
            self._insert_all(old_keys, old_places)
        self._insert_all(keys, places)

    def _insert_all(self, keys: np.ndarray, places: np.ndarray) -> None:
        at, mask = self._slots(keys), (1 << self.bits) - 1
        while len(keys):
            free = np.flatnonzero(self.keys[at] == 0)
            slot, first = np.unique(at[free], return_index=True)
            won = free[first]
            self.keys[slot], self.places[slot] = keys[won], places[won]
            left = np.ones(len(keys), bool)
            left[won] = False
            keys, places, at = keys[left], places[left], (at[left] + 1) & mask

    def _store(self, keys: np.ndarray, ids: np.ndarray, length: np.ndarray) -> None:
        """Put the ids of new pieces, ``length`` of each, into the pool and the table."""
        n, size = self.n_pieces + len(keys), self.n_pool + len(ids)
        while len(self.start) < n:
            self.start, self.length = np.resize(self.start, 2 * len(self.start)), np.resize(self.length, 2 * len(self.length))
        while len(self.pool) < size:
            self.pool = np.resize(self.pool, 2 * len(self.pool))
        self.pool[self.n_pool:size] = ids
        self.length[self.n_pieces:n] = length
        self.start[self.n_pieces:n] = self.n_pool + np.cumsum(length) - length
        self._insert(keys, np.arange(self.n_pieces, n, dtype=np.int32))
        self.n_pieces, self.n_pool = n, size

    def slices(self, column: pa.Array, end_id: int | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first text, ids, bounds) for slices of ``column``: text
        ``first + k`` has ids[bounds[k]:bounds[k + 1]], ``end_id`` included."""
        for w in W.slices(column, W.NOT_SPACE, W.LOWER if self.lower else W.SAME, SLICE_BYTES):
            if self.n_pieces > self.kept:
                self._clear()
            raw = w.data.tobytes()
            keys = np.maximum(w.hash, np.uint64(1))
            place = self._find(keys)
            new = np.flatnonzero(place < 0)
            if len(new):
                fresh, first = np.unique(keys[new], return_index=True)
                at = new[first]
                cased = raw.lower() if self.lower else raw
                self._store(fresh, *self.encode([cased[a:b] for a, b in zip(w.start[at].tolist(), w.end[at].tolist())]))
                place[new] = self._find(keys[new])
            length = self.length[place]
            ends = np.cumsum(length)
            begin = ends - length
            ids = self.pool[np.repeat(self.start[place] - begin, length) + np.arange(ends[-1] if len(ends) else 0)]
            bounds = np.concatenate([[0], ends])[w.bounds]
            if b"<|" in raw:
                ids, bounds = self._with_special(column, w, ids, bounds)
            if end_id is not None:
                ids = np.insert(ids, bounds[1:], end_id)
                bounds = bounds + np.arange(len(bounds))
            yield w.first, ids.astype("<u4", copy=False), bounds

    def _with_special(self, column: pa.Array, w: W.Words, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Texts that may hold a special string, by the library as they are."""
        parts = []
        for k in range(w.n_docs):
            t = column[w.first + k].as_py() or ""
            parts.append(np.array(self.library.encode(t, add_special_tokens=False).ids, np.uint32) if "<|" in t else ids[bounds[k]:bounds[k + 1]])
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces, one behind the other, and how many each has."""
        rows = PLAIN.findall(b"\n".join(pieces)) if self.lower else [(b"", b"", p) for p in pieces]
        if len(rows) != len(pieces):
            raise ValueError("a piece holds a line end")
        words, rest = dict.fromkeys(w for w, _, _ in rows if w), dict.fromkeys(r for _, _, r in rows if r)
        ids, lengths = array("I"), []
        if words:
            # Words go to the merges in runs, by the letters of their bytes.
            plain = list(words)
            runs = [plain[k:k + RUN] for k in range(0, len(plain), RUN)]
            encoded = self.merges.encode_batch_fast([charmap_decode(b" ".join(run), "strict", self.letters)[0] for run in runs], add_special_tokens=False)
            n_ids = []
            for e in encoded:
                ids.fromlist(e.ids)
                n_ids.append(len(ids))
            cuts = np.flatnonzero(self.ends[np.frombuffer(ids, np.uint32)]) + 1
            if np.searchsorted(cuts, n_ids, side="right").tolist() != np.cumsum([len(run) for run in runs]).tolist() or cuts[-1] != n_ids[-1]:
                raise ValueError("a word's last token is not marked as its end")
            lengths.append(np.diff(cuts, prepend=0))
        others = [e.ids for e in self.library.encode_batch_fast([p.decode("utf-8") for p in rest], add_special_tokens=False)] if rest else []
        for other in others:
            ids.fromlist(other)
        lengths.append(np.fromiter(map(len, others), np.int64, len(others)))
        length = np.concatenate(lengths)
        start = np.cumsum(length) - length
        number = {p: k for k, p in enumerate(chain(words, rest))}
        of = np.fromiter((number[w or r] for w, _, r in rows), np.int64, len(rows))
        sign = np.fromiter((self.signs[c] for _, c, _ in rows), np.int64, len(rows))
        many = length[of] + (sign >= 0)
        ends = np.cumsum(many)
        ids.append(0)               # the place behind the last, where a sign is put
        out = np.frombuffer(ids, np.uint32)[np.repeat(start[of] - (ends - many), many) + np.arange(ends[-1] if len(ends) else 0)]
        signed = np.flatnonzero(sign >= 0)
        out[ends[signed] - 1] = sign[signed]
        return out, many


def piece_tokenizer(path: str) -> PieceTokenizer:
    """The worker's own, one at a time. A task has one core, so the library's
    threads, one for each of the machine's, stay off."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return keep(("pieces", path), lambda: PieceTokenizer(path))
