"""Whole texts to token ids with a public tokenizer, remembering the ids of words.

Byte-level tokenizers of this kind never join bytes across a blank that a visible
character follows: the blank opens a new word. So a text is cut at those blanks, the ids
of each word come from a bounded memory, and only new words go to the tokenizer, many at a
time. Words are cut, told apart and put together again as Arrow and numpy arrays of a block
of texts. The ids are those of the whole text in one call (tested), and a very long text
never sits in the tokenizer as a whole, unless it spells out one of the tokenizer's special
tokens: these are found first in the plain call, so such a text is given as it is.
"""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Words in each of two generations; a word with its ids takes about 200 bytes.
REMEMBERED = 250_000
# Words given to the tokenizer as one text, and texts given to it in one call.
TOGETHER = 100
CALLED = 50
WORD = re.compile(r" (?=\S)")
BLANK_RUN = re.compile(r" (?=\s|$)")
# Marks that end a word of letters and never begin a contraction.
MARKS = ".,;:!?*#$%&|-_)]}>/"
_encoders: dict[str, Encoder] = {}


def encoder_for(tokenizer_path: str) -> Encoder:
    """The worker's encoder: what one task has learnt serves the next one."""
    if tokenizer_path not in _encoders:
        _encoders[tokenizer_path] = Encoder(tokenizer_path)
    return _encoders[tokenizer_path]


class Encoder:
    """Ids of texts as bytes: little-endian, two bytes each if the vocabulary allows it."""

    def __init__(self, tokenizer_path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks fill the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if max(vocabulary.values()) < 1 << 16 else "<u4")
        self.opens = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.opens[[i for token, i in vocabulary.items() if token.startswith("Ġ")]] = True
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.heads: dict[str, bytes] = {}

    def ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=self.dtype).tobytes()

    def _head(self, text: str) -> bytes:
        """Ids of a text without a blank before it; short ones are remembered."""
        found = self.heads.get(text)
        if found is None:
            found = self.ids(text)
            if len(text) < 40:
                self.heads[text] = found
        return found

    def _tokenize(self, words: list[str]) -> None:
        """Learn words that begin with a blank, many in one call."""
        plain = [w for w in words if " " not in w]
        for first in range(0, len(plain), TOGETHER * CALLED):
            some = plain[first : first + TOGETHER * CALLED]
            texts = [" " + " ".join(some[i : i + TOGETHER]) for i in range(0, len(some), TOGETHER)]
            found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            ids = np.fromiter(chain.from_iterable(e.ids for e in found), self.dtype)
            starts = np.flatnonzero(self.opens[ids])
            if len(starts) == len(some):
                data, wide = ids.tobytes(), self.dtype.itemsize
                cuts = (starts * wide).tolist()
                self.words.update(zip(some, [data[i:j] for i, j in zip(cuts, [*cuts[1:], len(data)])]))
        for word in words:
            if word not in self.words:
                self.words[word] = self.ids(" " + word)

    def _learn(self, words: list[str]) -> None:
        """Words known to the older generation move up; marks after letters are cut off."""
        fresh, stems, split, older = [], set(), [], self.older
        for word in words:
            if word in older:
                self.words[word] = older[word]
            elif word[-1:] in MARKS and (stem := word.rstrip(MARKS)).isalpha():
                split.append((word, stem))
                stems.add(stem)
            else:
                fresh.append(word)
        for stem in stems.difference(self.words, fresh):
            if stem in older:
                self.words[stem] = older[stem]
            else:
                fresh.append(stem)
        self._tokenize(fresh)
        for word, stem in split:
            self.words[word] = self.words[stem] + self._head(word[len(stem) :])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text. A block's new words are learnt together."""
        if len(self.words) > REMEMBERED:
            self.older, self.words = self.words, {}
        if len(self.heads) > REMEMBERED // 5:
            self.heads.clear()
        out: list[bytes] = [b""] * len(texts)
        even, runs = [], []
        for i, text in enumerate(texts):
            if any(special in text for special in self.specials):
                out[i] = self.ids(text)
            else:
                (runs if BLANK_RUN.search(text) else even).append(i)
        if even:
            self._encode(even, pc.split_pattern(pa.array([texts[i] for i in even], pa.string()), " "), out)
        if runs:
            self._encode(runs, pa.array([WORD.split(texts[i]) for i in runs], pa.list_(pa.string())), out)
        return out

    def _encode(self, places: list[int], cut: pa.ListArray, out: list[bytes]) -> None:
        """Put the ids of texts that were cut into a head and words to their ``places``."""
        bounds = cut.offsets.to_numpy()
        coded = cut.flatten().dictionary_encode()
        slots, distinct = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        heads = bounds[:-1]
        held = np.ones(len(slots), dtype=bool)
        held[heads] = False
        used = np.flatnonzero(np.bincount(slots[held], minlength=len(distinct)))
        words = distinct.take(pa.array(used)).to_numpy(zero_copy_only=False).tolist()
        self._learn([w for w in words if w not in self.words])
        look = self.words.__getitem__
        found = [*map(look, words), *map(self._head, distinct.take(pa.array(slots[heads])).to_pylist())]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // self.dtype.itemsize
        starts = np.cumsum(sizes) - sizes
        slot_of = np.zeros(len(distinct), dtype=np.int64)
        slot_of[used] = np.arange(len(used))
        slots = slot_of[slots]
        slots[heads] = len(used) + np.arange(len(heads))
        lengths = sizes[slots]
        ends = np.cumsum(lengths)
        at = np.repeat(starts[slots] - (ends - lengths), lengths) + np.arange(ends[-1])
        ids = np.frombuffer(b"".join(found), dtype=self.dtype)[at]
        cuts = np.concatenate([[0], ends])[bounds].tolist()
        for place, a, b in zip(places, cuts, cuts[1:]):
            out[place] = ids[a:b].tobytes()


def blocks(texts: list, size: int = 2 << 20):
    """Consecutive (first, texts) blocks of about ``size`` characters; null is empty."""
    block, held, first = [], 0, 0
    for i, text in enumerate(texts):
        block.append(text or "")
        held += len(block[-1])
        if held >= size:
            yield first, block
            block, held, first = [], 0, i + 1
    if block:
        yield first, block
