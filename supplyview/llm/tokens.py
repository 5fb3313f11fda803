"""Token ids by the tokenizers library, with a memo for recurring words.

A byte-level BPE with the usual split pattern never joins text across a single
space or line feed whose neighbours are no white space, nor a word of letters
and the punctuation after it. Texts are cut there and the ids of a piece are
looked up; a new word of letters goes to the library's BPE model, any other new piece through
the whole tokenizer. Texts with other white space are encoded whole.
"""

from __future__ import annotations

import array
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Words kept in each of two generations; the older one goes when the newer is full.
MEMO_WORDS = 600_000
# Any white space beside the space and the line feed, or a run of those two.
MIXED_SPACE = (
    r"[\t\x0b\x0c\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|[ \n][ \n]"
)
TAIL = ".,;:!?"
# Below this code point letters are the same in every Unicode version.
SETTLED = chr(0x250)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class _Memo(dict):
    def __init__(self, make):
        self.make = make

    def __missing__(self, piece: str) -> bytes:
        ids = self[piece] = self.make(piece)
        return ids


class Encoder:
    """Texts to ids."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self.blank = self.letters[ord(" ")]
        self.memo, self.old = _Memo(self._piece), {}
        self.tails = _Memo(self._whole)

    def vocabulary(self) -> int:
        return self.tokenizer.get_vocab_size(with_added_tokens=True)

    def _whole(self, text: str) -> bytes:
        return array.array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        """Ids of a piece: after a space, or after a line feed, or (marked \\r) after nothing."""
        ids = self.old.get(piece)
        if ids is not None:
            return ids
        if piece[:1] == "\n":
            return self.tails["\n"] + self.memo["\r" + piece[1:]]
        space, text = ("", piece[1:]) if piece[:1] == "\r" else (" ", piece)
        if not space + text:
            return b""
        word = text.rstrip(TAIL)
        plain = word.isascii()
        if not word.isalpha() or not (plain or max(word) < SETTLED):
            return self._whole(space + text)
        if len(word) < len(text):
            return self.memo[piece[: len(piece) - len(text) + len(word)]] + self.tails[text[len(word) :]]
        if plain:  # ASCII letters stand for themselves
            shown = self.blank + word if space else word
        else:
            shown = (space + word).encode().decode("latin-1").translate(self.letters)
        return array.array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids (unsigned 32-bit) of each text; null counts as empty."""
        texts = pc.fill_null(texts, "")
        mixed = pc.match_substring_regex(texts, MIXED_SPACE)
        plain = pc.if_else(mixed, "", texts)
        # Each piece but a text's first (marked) follows a space; a line feed starts its own.
        marked = pc.binary_join_element_wise("\r", pc.replace_substring(plain, "\n", " \n"), "")
        cut = pc.split_pattern(marked, " ")
        if len(self.memo) > MEMO_WORDS:
            self.old, self.memo = self.memo, _Memo(self._piece)
        memo = self.memo
        words = cut.flatten().dictionary_encode()
        known = pa.array([memo[x] for x in words.dictionary.to_pylist()], pa.large_binary())
        joined = known.take(words.indices)
        ids = np.frombuffer(joined.buffers()[2] or b"", "<u4")
        at = np.frombuffer(joined.buffers()[1], np.int64)[: len(joined) + 1] // 4
        ends = at[cut.offsets.to_numpy() - cut.offsets[0].as_py()].tolist()
        out = [ids[a:b] for a, b in zip(ends, ends[1:])]
        for i in np.flatnonzero(mixed.to_numpy(zero_copy_only=False)).tolist():
            out[i] = np.frombuffer(self._whole(texts[i].as_py()), "<u4")
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per worker process, so the memo lasts from task to task."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path)


def narrowest(vocabulary: int) -> np.dtype:
    """The smallest unsigned type that holds every id."""
    return np.dtype("<u2") if vocabulary <= 1 << 16 else np.dtype("<u4")


def slices(texts: pa.Array, most_bytes: int = 4_000_000):
    """Consecutive (start, length) of a batch with about ``most_bytes`` of text each."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64)
    number = np.cumsum(sizes) // most_bytes
    starts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(sizes)] if len(sizes) else []
    for a, b in zip(starts, starts[1:]):
        yield a, b - a
