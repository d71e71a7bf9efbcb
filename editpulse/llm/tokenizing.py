"""Token ids of whole texts, by the tokenizers library, each distinct word encoded once per worker."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from tokenizers import Tokenizer

from editpulse.llm.batches import spread, words

# Distinct words a worker remembers: the first it meets, which the frequent ones are among.
REMEMBERED = 1_000_000
_WORDS_PER_CALL = 2_000
# A character for private use, as a word of its own between others.
_BETWEEN, _ANOTHER = "\ue000", "\ue001"


def _with_room(values: np.ndarray, used: int, more: int) -> np.ndarray:
    """The array, or a larger copy of its used part, with room for so many more."""
    if used + more <= len(values):
        return values
    grown = np.empty(max(2 * len(values), used + more), values.dtype)
    grown[:used] = values[:used]
    return grown


class _Places:
    """A hash table in arrays, from 128-bit word hashes to numbers; it takes about 40 bytes for a word."""

    def __init__(self):
        self.count = 0
        self._clear(1 << 15)

    def _clear(self, size: int) -> None:
        self.keys, self.held = np.zeros((size, 2), np.uint64), np.full(size, -1, np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The numbers of the keys, -1 where there is none."""
        out, at, left = np.full(len(keys), -1, np.int64), self._home(keys), np.arange(len(keys))
        while len(left):
            held = self.held[at]
            same = (held >= 0) & (self.keys[at] == keys[left]).all(axis=1)
            out[left[same]] = held[same]
            on = (held >= 0) & ~same
            left, at = left[on], (at[on] + 1) & (len(self.held) - 1)
        return out

    def add(self, keys: np.ndarray, numbers: np.ndarray) -> None:
        """Keys that differ and are not there yet."""
        self.count += len(keys)
        if 2 * self.count > len(self.held):
            filled = self.held >= 0
            keys, numbers = np.concatenate((self.keys[filled], keys)), np.concatenate((self.held[filled], numbers))
            self._clear(1 << (2 * self.count).bit_length())
        at, left = self._home(keys), np.arange(len(keys))
        while len(left):
            free = self.held[at] < 0
            # Of several keys that want one place, the last one written has it.
            self.held[at[free]] = numbers[left[free]]
            won = free & (self.held[at] == numbers[left])
            self.keys[at[won]] = keys[left[won]]
            left, at = left[~won], (at[~won] + 1) & (len(self.held) - 1)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return (keys[:, 0] & np.uint64(len(self.held) - 1)).astype(np.int64)


class WordEncoder:
    """Encodes texts word by word where that gives the same ids, and whole where it does not.

    The tokenizer must split at white space, whatever else it splits at, and drop it. Then a text's
    ids are those of its words, one after another. Only its special tokens could reach across, so
    texts in which one may occur are encoded whole. Words are known by 128-bit hashes.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        own, other = (self.tokenizer.encode(c, add_special_tokens=False).ids for c in (_BETWEEN, _ANOTHER))
        # A tokenizer that does not tell the characters apart has nothing to put between words.
        self.between = own if own and own != other else None
        self.places = _Places()
        # Ids of all remembered words one after another, and each word's place among them. The arrays have room to spare: new
        # words go behind the remembered ones, and those that are not remembered are written over by the next call.
        self.ids = np.zeros(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 14, np.int32)
        self.counts = np.zeros(1 << 14, np.int32)
        self.used = 0

    def _encoded(self, some: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all these words, number of ids of each)"""
        ids, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for at in range(0, len(some), _WORDS_PER_CALL):
            found = self._apart(some[at : at + _WORDS_PER_CALL])
            ids.append(found[0])
            counts.append(found[1])
        return np.concatenate(ids), np.concatenate(counts)

    def _apart(self, some: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for a few words: encoded as one text, with a word between any two whose ids no other word can have."""
        joined = f" {_BETWEEN} ".join(some)
        if self.between is None or joined.count(_BETWEEN) >= len(some):
            encoded = self.tokenizer.encode(some, is_pretokenized=True, add_special_tokens=False)
            return np.array(encoded.ids, np.uint32), np.bincount(np.array(encoded.word_ids, np.int64), minlength=len(some))
        ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.uint32)
        width = len(self.between)
        is_between = np.ones(max(0, len(ids) - width + 1), bool)
        for k, token in enumerate(self.between):
            is_between &= ids[k : k + len(is_between)] == token
        starts = np.flatnonzero(is_between)
        kept = np.ones(len(ids), bool)
        kept[spread(starts, np.full(len(starts), width))] = False
        counts = np.diff(np.concatenate(([-width], starts, [len(ids)]))) - width
        return ids[kept], counts

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets by text)"""
        lowered = pc.ascii_lower(texts)
        odd = np.zeros(len(texts), bool)
        for token in self.special:
            odd |= pc.match_substring(lowered, token.lower()).to_numpy(zero_copy_only=False)
        if odd.any():
            lowered = pc.if_else(pa.array(odd), pa.scalar("", lowered.type), lowered)
        split = words(lowered)
        vocabulary = split.vocabulary.to_numpy(zero_copy_only=False)
        keys = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, vocabulary)), np.uint64).reshape(-1, 2)
        slot = self.places.find(keys)
        new = np.flatnonzero(slot < 0)
        ids, counts = self._encoded(vocabulary[new].tolist())
        del vocabulary, lowered
        known = self.places.count
        slot[new] = known + np.arange(len(new))
        self.ids = _with_room(self.ids, self.used, len(ids))
        self.counts, self.starts = (_with_room(x, known, len(new)) for x in (self.counts, self.starts))
        self.ids[self.used : self.used + len(ids)] = ids
        self.counts[known : known + len(new)] = counts
        self.starts[known : known + len(new)] = self.used + np.cumsum(counts) - counts
        kept = new[: max(0, REMEMBERED - known)]
        self.places.add(keys[kept], slot[kept].astype(np.int32))
        self.used += int(counts[: len(kept)].sum())
        slot = slot[split.codes]
        counts = self.counts[slot].astype(np.int64)
        ids = self.ids[spread(self.starts[slot].astype(np.int64), counts)]
        offsets = np.concatenate(([0], np.cumsum(counts)))[split.offsets]
        if not odd.any():
            return ids, offsets
        parts = [ids[offsets[i] : offsets[i + 1]] for i in range(len(texts))]
        for i in np.flatnonzero(odd):
            whole = self.tokenizer.encode(texts[int(i)].as_py(), add_special_tokens=False)
            parts[i] = np.array(whole.ids, np.uint32)
        return np.concatenate(parts), np.concatenate(([0], np.cumsum([len(p) for p in parts])))


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One encoder for each worker process."""
    return WordEncoder(path)


def with_end(ids: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same ids with ``end_id`` after each text."""
    texts = len(offsets) - 1
    ended = np.full(len(ids) + texts, end_id, np.uint32)
    ended[np.arange(len(ids)) + np.repeat(np.arange(texts), np.diff(offsets))] = ids
    return ended, offsets + np.arange(texts + 1)
