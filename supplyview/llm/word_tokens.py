"""Token ids of the lower-casing word vocabulary, with a memo for recurring words.

Its normaliser and split pattern never join text across white space, so a text's ids are
those of its parts between ASCII white space, looked up one by one. A new part of letters with
punctuation behind them is lower-cased and split here, any other new part goes
through the whole tokenizer, which knows about composed letters and special tokens.
"""

from __future__ import annotations

import array
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from supplyview.llm.tokens import SETTLED, TAIL, byte_letters

# Parts kept in each of two generations; the older one goes when the newer is full.
MEMO_PARTS = 500_000
SPACES = bytes(range(9, 14))
TO_BLANK = bytes.maketrans(SPACES, b" " * len(SPACES))
CAPITALS = bytes(range(65, 91))
# Where no special token can be, letters lose their case at once, so fewer parts differ.
TO_LOWER = bytes.maketrans(SPACES + CAPITALS, b" " * len(SPACES) + CAPITALS.lower())


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class _Memo(dict):
    def __init__(self, make):
        self.make = make

    def __missing__(self, part: str) -> bytes:
        ids = self[part] = self.make(part)
        return ids


class WordEncoder:
    """Texts to ids."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self.memo, self.old = _Memo(self._part), {}
        self.tails = _Memo(self._whole)

    def _whole(self, text: str) -> bytes:
        return array.array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _part(self, part: str) -> bytes:
        ids = self.old.get(part)
        if ids is not None:
            return ids
        word = part.rstrip(TAIL)
        plain = word.isascii()
        low = word.lower()
        if not word.isalpha() or not (plain or max(word) < SETTLED) or len(low) != len(word):
            return self._whole(part)
        if len(word) < len(part):  # a run of punctuation is a word of its own
            return self.memo[word] + self.tails[part[len(word) :]]
        if low != word:
            return self.memo[low]
        shown = low if plain else low.encode().decode("latin-1").translate(self.letters)
        return array.array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids (unsigned 32-bit) of each text; null counts as empty."""
        if not len(texts):
            return []
        texts = pc.cast(pc.fill_null(texts, ""), pa.large_string())
        # White space is one byte each, so the texts keep their places.
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        raw = data.to_pybytes()[offsets[0] : offsets[-1]] if data else b""
        blank = raw.translate(TO_BLANK if b"<|" in raw else TO_LOWER)
        spread = pa.LargeStringArray.from_buffers(
            len(texts), pa.py_buffer((offsets - offsets[0]).tobytes()), pa.py_buffer(blank)
        )
        cut = pc.split_pattern(spread, " ")
        if len(self.memo) > MEMO_PARTS:
            self.old, self.memo = self.memo, _Memo(self._part)
        memo = self.memo
        parts = cut.flatten().dictionary_encode()
        known = [memo[x] if x else b"" for x in parts.dictionary.to_pylist()]
        joined = pa.array(known, pa.large_binary()).take(parts.indices)
        ids = np.frombuffer(joined.buffers()[2] or b"", "<u4")
        at = np.frombuffer(joined.buffers()[1], np.int64)[: len(joined) + 1] // 4
        ends = at[cut.offsets.to_numpy() - cut.offsets[0].as_py()].tolist()
        return [ids[a:b] for a, b in zip(ends, ends[1:])]


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    """One per worker process, so the memo lasts from task to task."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordEncoder(path)
