"""Token ids of whole texts with a given tokenizer file of the ``tokenizers`` library.

The tokenizer splits a text into pieces that it encodes apart. Texts are cut into chunks where no piece can reach
across: before white space (in a run of it before the last character, which may belong to the next word) and
between an ASCII letter or digit and an ASCII sign after it. Chunks of a batch are found in its bytes with numpy
and looked up in a table by their bytes; only those not seen before are decoded and encoded, all together. Ids are
put together from the table with one gather.

A text with white space outside ASCII, where cutting would need more care, or with the text of a special token
goes to the library whole. The table has a fixed number of places and a bounded pool of ids, whatever it meets.

This holds for byte-level tokenizers with the usual pre-tokenizing pattern and no normalizer; ``encoder``
refuses others. The tests compare it with plain encoding.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa

from .words import mix, slices, text_bytes

# Places of the table (20 bytes each), chunks (8 bytes) and ids (4 bytes) that may be remembered before all are
# forgotten, and bytes of longer chunks remembered in a dict: 64 MB in all.
PLACES = 1 << 21
MOST_ENTRIES = 1_000_000
MOST_IDS = 3_000_000
MOST_LONG_BYTES = 4_000_000
LONGEST_KEPT = 64
# Bytes of texts that are worked on together.
TOGETHER = 1 << 20
_PROBES = 24

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_SIGN = np.zeros(256, bool)
_SIGN[0x21:0x7F] = True
_SIGN &= ~_ALNUM
# First bytes of white space outside ASCII, and separators in ASCII that some definitions of it hold.
_LEADS = np.zeros(256, bool)
_LEADS[[0xC2, 0xE1, 0xE2, 0xE3, 0x1C, 0x1D, 0x1E, 0x1F]] = True
# Bytes of new chunks that are encoded as one text.
_PART = 20_000
_MASK = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [(1 << 64) - 1], np.uint64)


def _odd_white(data: np.ndarray) -> np.ndarray:
    """Places of white space that is not in ``_WHITE``; a few other characters near it in Unicode count too."""
    at = np.flatnonzero(_LEADS[data])
    if not len(at):
        return at
    one = data[at]
    two, three = data[np.minimum(at + 1, len(data) - 1)], data[np.minimum(at + 2, len(data) - 1)]
    odd = one < 0x20
    odd |= (one == 0xC2) & ((two == 0x85) | (two == 0xA0))
    odd |= (one == 0xE1) & (((two == 0x9A) & (three == 0x80)) | ((two == 0xA0) & (three == 0x8E)))
    odd |= (one == 0xE2) & (two == 0x80) & ((three <= 0x8D) | ((three >= 0xA8) & (three <= 0xAF)))
    odd |= (one == 0xE2) & (two == 0x81) & (three >= 0x9F) & (three <= 0xAF)
    odd |= (one == 0xE3) & (two == 0x80) & (three == 0x80)
    return at[odd]


class ChunkTable:
    """Ids of texts from the ids of their chunks, in a table of bounded size. ``_chunks`` and ``_learn`` say how."""

    def __init__(self) -> None:
        self._forget()

    def _chunks(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of every chunk, and whether it must be encoded alone. Every text begins with a chunk."""
        raise NotImplementedError

    def _learn(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, alone: np.ndarray) -> np.ndarray:
        """Encode distinct chunks; returned are their entries."""
        raise NotImplementedError

    # Keys are 15 bytes and the length; an entry is the place of the ids in the pool.

    def _forget(self) -> None:
        self._low = np.zeros(PLACES, np.uint64)
        self._high = np.zeros(PLACES, np.uint64)  # 0: a free place, as every key has a length
        self._entry = np.zeros(PLACES, np.int32)
        self._long: dict[bytes, int] = {}
        self._long_bytes = self._entries = 0
        self._pool = np.zeros(1 << 16, "<u4")
        self._used = 0
        self._at, self._n = np.zeros(1 << 14, np.int32), np.zeros(1 << 14, np.int32)

    def _add(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Put the ids of chunks in the pool; returned are their entries."""
        first, used = self._entries, self._used
        while len(self._pool) < used + len(ids):
            self._pool = np.concatenate([self._pool, np.zeros_like(self._pool)])
        while len(self._at) < first + len(lengths):
            self._at, self._n = (np.concatenate([x, np.zeros_like(x)]) for x in (self._at, self._n))
        self._pool[used : used + len(ids)] = ids
        self._at[first : first + len(lengths)] = used + np.cumsum(lengths) - lengths
        self._n[first : first + len(lengths)] = lengths
        self._used, self._entries = used + len(ids), first + len(lengths)
        return np.arange(first, self._entries)

    def _find(self, low: np.ndarray, high: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The entry of each key, -1 where it has none."""
        out = np.full(len(low), -1, np.int64)
        left = np.arange(len(low))
        for _ in range(_PROBES):
            at = place[left]
            there = self._high[at]
            hit = (there == high[left]) & (self._low[at] == low[left])
            out[left[hit]] = self._entry[at[hit]]
            left = left[~hit & (there != 0)]
            if not len(left):
                break
            place[left] = (place[left] + 1) & (PLACES - 1)
        return out

    def _insert(self, low: np.ndarray, high: np.ndarray, place: np.ndarray, entry: np.ndarray) -> None:
        """Keys that find no free place within the probes are left out, and encoded again when they come back."""
        left = np.arange(len(low))
        for _ in range(_PROBES):
            free = left[self._high[place[left]] == 0]
            at, which = np.unique(place[free], return_index=True)
            which = free[which]
            self._low[at], self._high[at], self._entry[at] = low[which], high[which], entry[which]
            left = np.setdiff1d(left, which, assume_unique=True)
            if not len(left):
                return
            place[left] = (place[left] + 1) & (PLACES - 1)

    def _entries_of(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, alone: np.ndarray) -> np.ndarray:
        n = end - start
        padded = np.concatenate([data, np.zeros(16, np.uint8)])
        words = np.ndarray((len(data) + 8,), "<u8", padded, 0, (1,))
        out = np.full(len(start), -1, np.int64)
        short = np.flatnonzero(n <= 15)
        at, size = start[short], n[short]
        low = words[at] & _MASK[np.minimum(size, 8)]
        high = words[np.minimum(at + 8, len(data))] & _MASK[np.maximum(size - 8, 0)] | (size.astype(np.uint64) << np.uint64(56))
        place = (mix(low ^ mix(high)) & np.uint64(PLACES - 1)).astype(np.int64)
        found = self._find(low, high, place.copy())
        out[short] = found
        new = np.flatnonzero(found < 0)
        if len(new):
            new = new[np.lexsort((high[new], low[new]))]
            fresh = np.ones(len(new), bool)
            fresh[1:] = (low[new][1:] != low[new][:-1]) | (high[new][1:] != high[new][:-1])
            one = new[fresh]
            entry = self._learn(data, at[one], end[short[one]], alone[short[one]])
            out[short[new]] = entry[np.cumsum(fresh) - 1]
            self._insert(low[one], high[one], place[one], entry)
        long = np.flatnonzero(n > 15)
        if len(long):
            raw, unseen = data.tobytes(), {}
            keys = [raw[s:e] for s, e in zip(start[long].tolist(), end[long].tolist())]
            for i, k in enumerate(keys):
                if k not in self._long:
                    unseen.setdefault(k, i)
            one = long[[*unseen.values()]] if unseen else long[:0]
            own = dict(zip(unseen, self._learn(data, start[one], end[one], alone[one]).tolist()))
            out[long] = [own[k] if k in own else self._long[k] for k in keys]
            for k, entry in own.items():
                if len(k) <= LONGEST_KEPT:
                    self._long[k] = entry
                    self._long_bytes += len(k) + 100
        return out

    def flat(self, texts: pa.Array, end: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts on end as unsigned 32-bit integers, and the offset of each text in them (one more than texts).

        A null text is an empty one. With ``end`` each text's ids are followed by id 0.
        """
        ids, counts = [np.zeros(0, "<u4")], [np.zeros(0, np.int64)]
        for part in slices(texts, TOGETHER):
            if self._entries > MOST_ENTRIES or self._used > MOST_IDS or self._long_bytes > MOST_LONG_BYTES:
                self._forget()
            data, bounds = text_bytes(part)
            rows = len(bounds) - 1
            start = np.zeros(0, np.int64)
            entry = start
            if len(data):
                start, stop, alone = self._chunks(data, bounds)
                entry = self._entries_of(data, start, stop, alone)
            at, n = self._at[entry].astype(np.int64), self._n[entry].astype(np.int64)
            row = np.searchsorted(bounds, start, side="right") - 1
            own = np.bincount(row, n, rows).astype(np.int64)
            # Where each chunk's ids go, with one place more after each text for its end.
            to = np.cumsum(n) - n + (row if end else 0)
            out = np.zeros(int(own.sum()) + (rows if end else 0), "<u4")
            step = np.arange(int(n.sum()))
            base = np.cumsum(n) - n
            out[np.repeat(to - base, n) + step] = self._pool[np.repeat(at - base, n) + step]
            ids.append(out)
            counts.append(own + (1 if end else 0))
        return np.concatenate(ids), np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype(np.int64)


class Encoder(ChunkTable):
    """``plain_specials``: the strings of special tokens in a text are ordinary text."""

    def __init__(self, path: str, plain_specials: bool = False) -> None:
        # Spark gives a task its core; the library's own threads would take those of other tasks.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = plain_specials
        pre = self._tokenizer.pre_tokenizer
        if type(pre).__name__ != "ByteLevel" or pre.add_prefix_space or self._tokenizer.normalizer is not None:
            raise ValueError(f"{path}: only byte-level tokenizers without prefix space and normalizer can be used")
        # In a byte-level vocabulary each character of a token stands for one byte.
        vocabulary = self._tokenizer.get_vocab()
        self.token_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.token_bytes[i] = len(token)
        added = self._tokenizer.get_added_tokens_decoder().values()
        self._specials = [] if plain_specials else [t.content.encode() for t in added]
        super().__init__()

    @property
    def size(self) -> int:
        return len(self.token_bytes)

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _learn(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, alone: np.ndarray) -> np.ndarray:
        """Chunks that are not ``alone`` are encoded on end and cut apart again."""
        some = np.flatnonzero(~alone)
        # Without white space of its own a chunk gets a line feed, whose id is then left out.
        extra = (~_WHITE[data[start[some]]]).astype(np.int64)
        size = end[some] - start[some] + extra
        stop = np.cumsum(size)
        text = np.full(int(stop[-1]) if len(some) else 0, 0x0A, np.uint8)
        inner = size - extra
        step = np.arange(int(inner.sum())) - np.repeat(np.cumsum(inner) - inner, inner)
        text[np.repeat(stop - inner, inner) + step] = data[np.repeat(start[some], inner) + step]
        cuts = stop[np.unique(np.searchsorted(stop, np.arange(_PART, len(text) + _PART, _PART)).clip(max=len(stop) - 1))] if len(some) else stop
        raw = text.tobytes()
        parts = [raw[i:j].decode() for i, j in zip([0, *cuts[:-1].tolist()], cuts.tolist())]
        done = self._tokenizer.encode_batch_fast(parts, add_special_tokens=False)
        ids = np.concatenate([np.zeros(0, "<u4"), *[np.array(x.ids, "<u4") for x in done]])
        last = np.searchsorted(np.cumsum(self.token_bytes[ids]), stop) + 1
        before = np.concatenate([[0], last[:-1]])[: len(last)]
        keep = np.ones(len(ids), bool)
        keep[before[extra == 1]] = False
        own = [self._whole(data[s:e].tobytes().decode()) for s, e in zip(start[alone].tolist(), end[alone].tolist())]
        entry = np.empty(len(start), np.int64)
        entry[some] = self._add(ids[keep], last - before - extra)
        entry[alone] = self._add(np.concatenate([np.zeros(0, "<u4"), *own]), np.array([len(x) for x in own], np.int64))
        return entry

    def _chunks(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        white = _WHITE[data]
        first = np.zeros(len(data) + 1, bool)
        first[bounds] = True
        before = np.zeros(len(data), bool)
        before[1:] = white[:-1]
        seen_next = np.zeros(len(data), bool)
        seen_next[:-1] = ~white[1:] & ~first[1:-1]
        start = white & (~before | seen_next)
        start[1:] |= _SIGN[data[1:]] & _ALNUM[data[:-1]]
        start |= first[:-1]
        odd = [_odd_white(data)]
        for special in self._specials:
            raw, at = data.tobytes(), -1
            while (at := raw.find(special, at + 1)) >= 0:
                odd.append(np.array([at]))
        rows = np.unique(np.searchsorted(bounds, np.concatenate(odd), side="right") - 1)
        for row in rows.tolist():
            start[bounds[row] + 1 : bounds[row + 1]] = False
        at = np.flatnonzero(start)
        end = np.append(at[1:], len(data))[: len(at)]
        # Runs of white space, and texts that are not cut.
        alone = white[end - 1] | (end - at > 4096)
        alone[np.searchsorted(at, bounds[rows])] = True
        return at, end, alone

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        ids, bounds = self.flat(pa.array(texts, pa.large_string()))
        raw, edge = ids.tobytes(), (4 * bounds).tolist()
        return [raw[i:j] for i, j in zip(edge, edge[1:])]


@lru_cache(maxsize=4)
def encoder(path: str, plain_specials: bool = False) -> Encoder:
    """One encoder for each file and Python worker."""
    return Encoder(path, plain_specials)
