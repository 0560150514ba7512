"""Token ids of whole texts by a public tokenizer, with a bounded memory of words."""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from docsync.llm.common import STEP_BYTES, encoded, steps, word_keys

SLOTS = 1 << 21
#: Ids held before the memory of words starts anew.
POOL = 1 << 23
#: Parts of words held by one worker.
PARTS = 200_000

# The split pattern of the lower-casing vocabulary, and the places of the bytes that
# its alphabet shows as themselves.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SHOWN = (*range(33, 127), *range(161, 173), *range(174, 256))

#: The same split for words of printable ASCII and the Latin-1 letters but sharp s.
_EASY = re.compile(r"[\x21-\x7eÀ-ÖØ-Þà-öø-ÿ]*")
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zà-öø-ÿ]+|[0-9]|[^a-z0-9à-öø-ÿ]+")


def _alphabet() -> dict[int, str]:
    """Byte to character: those not shown as themselves follow from 256 on, in order."""
    hidden = [b for b in range(256) if b not in SHOWN]
    return {b: chr(b) if b in SHOWN else chr(256 + hidden.index(b)) for b in range(256)}


class WordTokens:
    """Encodes texts word by word and remembers words.

    For a vocabulary that never merges over a space or a line feed, the ids of a text are those
    of its words. Words are told apart by 64-bit hash. Each hash has one slot; a word that loses
    its slot is encoded again when it comes again.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.keys = np.zeros(SLOTS, np.uint64)
        self.start = np.zeros(SLOTS, np.int32)
        self.count = np.zeros(SLOTS, np.int32)
        self.pool = np.zeros(POOL, np.uint32)
        self.used = 0
        self.model, self.alphabet, self.parts = self.tokenizer.model, _alphabet(), {}
        # Of these parts only: the whole as text is many times the vocabulary's size.
        normalizer, splitter = (json.loads(x.__getstate__()) if x else {} for x in (
            self.tokenizer.normalizer, self.tokenizer.pre_tokenizer))
        steps_ = splitter.get("pretokenizers", [])
        #: Whether easy words may skip the library's own normalising and splitting.
        self.easy = (
            [n["type"] for n in normalizer.get("normalizers", [])]
            == ["NFC", "Replace", "Lowercase"]
            and [p["type"] for p in steps_] == ["Split", "ByteLevel"]
            and steps_[0]["pattern"] == {"Regex": SPLIT})

    def _word(self, word: str) -> list[int]:
        """Ids of a word. Easy words are split here and merged by the library's model, which is
        the same and much faster than its whole way for one word."""
        if not (self.easy and _EASY.fullmatch(word)) or "<|" in word:
            return self.tokenizer.encode(word, add_special_tokens=False).ids
        out: list[int] = []
        for part in _PARTS.findall(word.lower()):
            ids = self.parts.get(part)
            if ids is None:
                if len(self.parts) >= PARTS:
                    self.parts.clear()
                shown = part if part.isascii() else \
                    part.encode("utf-8").decode("latin-1").translate(self.alphabet)
                ids = self.parts[part] = [t.id for t in self.model.tokenize(shown)]
            out += ids
        return out

    def _learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        raw = data.tobytes()
        ids = [self._word(raw[a:b].decode("utf-8"))
               for a, b in zip(starts.tolist(), ends.tolist())]
        count = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((i for x in ids for i in x), np.uint32, int(count.sum()))
        return flat, count

    def ids(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, first id of each text and the end)."""
        data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        gap = (data == 32) | (data == 10)
        edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
        if not gap[0]:
            edge = np.concatenate(([0], edge))
        starts, ends = edge[0::2], edge[1::2]
        bounds = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
        first = np.searchsorted(starts, bounds)
        h = word_keys(data, starts, ends) | np.uint64(1)
        slot = (h >> np.uint64(20)).astype(np.int64) & (SLOTS - 1)
        start, count = self.start[slot], self.count[slot]
        missing = np.flatnonzero(self.keys[slot] != h)
        pool = self.pool
        if len(missing):
            new, at, back = np.unique(h[missing], return_index=True, return_inverse=True)
            at = missing[at]
            flat, n = self._learn(data, starts[at], ends[at])
            if self.used + len(flat) > len(pool):
                # Start anew, with room for this step even if it is larger than the pool; what
                # the step already found still points into the old one, so find it again.
                self.keys[:] = 0
                self.used = 0
                if len(flat) > POOL or len(missing) < len(h):
                    return self._plain(texts)
            begin = self.used + np.concatenate(([0], np.cumsum(n)[:-1]))
            pool[self.used:self.used + len(flat)] = flat
            self.used += len(flat)
            start[missing], count[missing] = begin[back], n[back]
            to = slot[at]
            self.keys[to], self.start[to], self.count[to] = new, begin, n
        done = np.concatenate(([0], np.cumsum(count)))
        out = pool[np.repeat(start - done[:-1], count) + np.arange(done[-1])]
        return out, done[first]

    def _plain(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found = [self.tokenizer.encode(t.decode("utf-8"), add_special_tokens=False).ids
                 for t in texts]
        bounds = np.concatenate(([0], np.cumsum([len(f) for f in found])))
        return np.fromiter((i for f in found for i in f), np.uint32, int(bounds[-1])), bounds


@lru_cache(maxsize=2)
def word_tokens(path: str) -> WordTokens:
    """One per Python worker, which keeps it from task to task."""
    return WordTokens(path)


def pieces(path: str, capacity: int, end_id: int, with_ids: bool):
    """A ``mapInArrow`` function: rows (row, text) to pieces of at most ``capacity`` ids.

    A document's ids end with ``end_id``; a null or empty text is that one id.
    """
    names = ["row", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = word_tokens(path)
        for batch in batches:
            texts = encoded(batch["text"])
            for a, b in steps(texts, STEP_BYTES):
                flat, bounds = tokens.ids(texts[a:b])
                which, piece, start, length, crc, ids = [], [], [], [], [], []
                for i in range(b - a):
                    own = np.append(flat[bounds[i]:bounds[i + 1]], np.uint32(end_id)).astype("<u4")
                    for k, s in enumerate(range(0, len(own), capacity)):
                        part = own[s:s + capacity]
                        which.append(a + i)
                        piece.append(k)
                        start.append(s)
                        length.append(len(part))
                        crc.append(zlib.crc32(part.tobytes()))
                        if with_ids:
                            ids.append(part.astype("<u2" if part.max() < 65536 else "<u4")
                                       .tobytes())
                columns = [batch["row"].take(pa.array(which, pa.int64())),
                           pa.array(piece, pa.int32()), *(pa.array(c, pa.int64())
                                                          for c in (start, length, crc))]
                if with_ids:
                    columns.append(pa.array(ids, pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names)

    return cut
