"""Token ids of whole texts with a public tokenizer file, word by word.

The tokenizers used here never join text across ASCII white space: it is dropped, or ends
a piece. Then the ids of a text are the ids of its words, one after another, and each
distinct word needs to be encoded once. Words end at white space and between letters and
marks; :class:`WordEncoder` refuses a tokenizer that would not keep to that. Words are found in
numpy and looked up by a hash; then their bytes are compared with those of the word that was encoded,
and a word that merely has the same hash is encoded by itself. New ones are
encoded by the tokenizers library in one call. A worker keeps the ids of up to
``CACHED_WORDS`` words (of ``CACHED_BYTES`` bytes) between batches and tasks; when there are more, it starts anew.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa

from storytide.llm import textbytes

CACHED_WORDS = 3_000_000  # at about 60 bytes each, the word's included
CACHED_BYTES = 64 << 20
# An ASCII letter beside one of these marks always is the end of a piece.
KINDS = np.zeros(256, np.uint8)
KINDS[[*range(65, 91), *range(97, 123)]] = 1
KINDS[list(b'!"#$%&()*+,-./:;=?@[]^_`{}~')] = 2
WORD_BPE = "word_bpe_49k.json"


def tokenizer_path(name: str = WORD_BPE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder:
    """Ids of texts; :meth:`encode` gives one flat array and the offsets of the rows."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.bits = max(1, (self.tokenizer.get_vocab_size() - 1).bit_length())
        for text in ("ab cd", "Ab .,cd", *(f"ab {chr(c)} cd" for c in np.flatnonzero(KINDS == 2))):
            parts = [i for ids in self._raw(text.split(" ")) for i in ids]
            if not self._raw([text])[0] == self._raw([text.replace(" ", "" if len(text) > 5 else " ")])[0] == parts:
                raise ValueError(f"{path}: {text!r} has other ids than its words")
        # A mark with an id of its own tells where a word ends in a joined call.
        marks = ((mark, self._raw([mark])[0]) for mark in "¬§¦¶¤°±")
        self.mark, self.mark_id = next((m, ids[0]) for m, ids in marks if len(ids) == 1)
        self._clear()

    def _raw(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.uint32)
        self.bytes = np.zeros(0, np.uint8)
        self.byte_starts = np.zeros(0, np.int64)
        self.byte_lengths = np.zeros(0, np.int32)

    def _encode_words(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words one after another, and the number of ids of each."""
        lengths = np.zeros(len(new), np.int64)
        plain = [i for i, word in enumerate(new) if self.mark not in word]
        other = [i for i, word in enumerate(new) if self.mark in word]
        joined = f" {self.mark} ".join(new[i] for i in plain)
        found = np.array(self._raw([joined])[0] if plain else [], np.uint32)
        cuts = np.flatnonzero(found == self.mark_id)
        lengths[plain] = np.diff(np.concatenate(([-1], cuts, [len(found)])))[: len(plain)] - 1
        apart = self._raw([new[i] for i in other])
        lengths[other] = [len(ids) for ids in apart]
        ids = np.zeros(int(lengths.sum()), np.uint32)
        mine = np.zeros(len(new), bool)
        mine[plain] = True
        at = np.repeat(mine, lengths)
        ids[at] = found[found != self.mark_id]
        ids[~at] = np.array([i for x in apart for i in x], np.uint32)
        return ids, lengths

    def _learn(self, keys: np.ndarray, new: list[bytes]) -> None:
        ids, lengths = self._encode_words([word.decode() for word in new])
        starts = len(self.ids) + np.cumsum(lengths) - lengths
        sizes = np.array([len(word) for word in new], np.int64)
        byte_starts = len(self.bytes) + np.cumsum(sizes) - sizes
        self.ids = np.concatenate([self.ids, ids])
        self.bytes = np.concatenate([self.bytes, np.frombuffer(b"".join(new), np.uint8)])
        order = np.argsort(both := np.concatenate([self.keys, keys]), kind="stable")
        self.keys = both[order]
        self.starts = np.concatenate([self.starts, starts])[order]
        self.lengths = np.concatenate([self.lengths, lengths.astype(np.int32)])[order]
        self.byte_starts = np.concatenate([self.byte_starts, byte_starts])[order]
        self.byte_lengths = np.concatenate([self.byte_lengths, sizes.astype(np.int32)])[order]

    def _hashes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return textbytes.hashed(data, starts, ends)

    def _chunk(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts, ends, first = textbytes.words(data, offsets, kinds=KINDS)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        distinct, sample, inverse = np.unique(self._hashes(data, starts, ends), return_index=True, return_inverse=True)
        missing = ~self._known(distinct)
        if missing.any():
            size = int((ends - starts)[sample[missing]].sum())
            if len(self.keys) + int(missing.sum()) > CACHED_WORDS or len(self.bytes) + size > CACHED_BYTES:
                self._clear()
                missing[:] = True
            raw = data.tobytes()
            self._learn(distinct[missing], [raw[starts[i] : ends[i]] for i in sample[missing]])
        at = np.searchsorted(self.keys, distinct)[inverse]
        begins, lengths = self.starts[at], self.lengths[at].astype(np.int64)
        source, other = self.ids, self._other_words(data, starts, ends, at)
        if len(other):
            raw = data.tobytes()
            ids, lengths[other] = self._encode_words([raw[starts[i] : ends[i]].decode() for i in other])
            begins[other] = len(source) + np.cumsum(lengths[other]) - lengths[other]
            source = np.concatenate([source, ids])
        done = np.concatenate(([0], np.cumsum(lengths)))
        ids = source[np.repeat(begins - done[:-1], lengths) + np.arange(done[-1])]
        return ids, done[first]

    def _other_words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The words whose bytes are not those of the word they were looked up as."""
        lengths = ends - starts
        same = lengths == self.byte_lengths[at]
        some = np.flatnonzero(same)
        same[some] = textbytes.same_bytes(data, starts[some], self.bytes, self.byte_starts[at[some]], lengths[some])
        return np.flatnonzero(~same)

    def _known(self, keys: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.keys, keys)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == keys[known]
        return known

    def encode(self, texts: pa.Array):
        """Yields (first row, ids, offsets of the rows in ids) for chunks of the column."""
        for row, data, offsets in textbytes.chunks(texts):
            ids, bounds = self._chunk(data, offsets)
            yield row, ids, bounds


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One encoder for each worker and file; the library loads the file itself."""
    return WordEncoder(path)
