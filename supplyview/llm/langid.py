"""Languages of words: script ranges narrow, per-word scores and Viterbi decide.

A word is a run of letters. Its score for a language is the log likelihood of its letter
trigrams (word ends included) under that language's counts. Languages that hardly use
the word's script are no candidates; a script that none uses says nothing. Viterbi over
the words of a text finds the best labels when each change of language costs
``SWITCH``, so a text is cut into spans of one language each.

Counts come from all training rows (text and lang not null) in one aggregate over
(language, trigram bucket), of a fixed number of buckets. A text's language is the one with
the most letters; its score is their share of all letters, so a text wholly in scripts that no
language uses has the language first in order with score 0. Null texts and texts without letters are
``und`` with score 0 and no spans; so is every text if there is no training row. Ties go
to the language first in order. Repeated rows are labelled each, very long texts whole; an empty table gives no
rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplyview.llm.common import free_name, schema_of

BUCKETS = 1 << 16
SWITCH = 12.0
SCRIPT_SHARE = 0.01
UND = "und"
# Characters whose trigrams are looked up at a time, and texts that share a Viterbi pass.
STEP_CHARS = 400_000
PASS_CHARS = 6_000_000

# First code points of script ranges in Unicode; a range ends where the next begins.
SCRIPTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"),
    (0x0590, "hebrew"), (0x0600, "arabic"), (0x0700, "syriac"), (0x0900, "devanagari"),
    (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "oriya"),
    (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"),
    (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"),
    (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"),
    (0x13A0, "other"), (0x1780, "khmer"), (0x1800, "mongolian"), (0x18B0, "other"),
    (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"),
    (0x3130, "hangul"), (0x3190, "other"), (0x31F0, "kana"), (0x3200, "other"),
    (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD800, "other"),
    (0xF900, "han"), (0xFB00, "latin"), (0xFB50, "arabic"), (0xFE00, "other"),
    (0x20000, "han"),
]
SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})
_STARTS = np.array([s for s, _ in SCRIPTS])
_SCRIPT = np.array([SCRIPT_NAMES.index(n) for _, n in SCRIPTS])
LAST = 0x20000


@lru_cache(maxsize=1)
def letter_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For code points up to ``LAST`` (which stands for all above): letter, lower case, script."""
    points = [chr(i) for i in range(LAST)]
    letter = np.array([c.isalpha() for c in points] + [True])
    low = [c.lower() for c in points]
    lower = np.array([ord(x) if len(x) == 1 else i for i, x in enumerate(low)] + [LAST], np.uint32)
    script = _SCRIPT[np.searchsorted(_STARTS, np.arange(LAST + 1), "right") - 1]
    return letter, lower, script.astype(np.int8)


class Words:
    """The words of some texts: trigram buckets, scripts and places, without a loop over words."""

    def __init__(self, texts: list[str | None]):
        letter, lower, script = letter_tables()
        joined = "\n".join(x or "" for x in texts) + "\n"
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
        capped = np.minimum(points, LAST)
        is_letter = letter[capped]
        low = np.where(points < LAST, lower[capped], points).astype(np.uint64)
        low[~is_letter] = 0
        before = np.concatenate([[np.uint64(0)], low[:-1]])
        after = np.concatenate([low[1:], [np.uint64(0)]])
        mix = low * np.uint64(0x9E3779B97F4A7C15) + before * np.uint64(0xC2B2AE3D27D4EB4F) + after * np.uint64(0x165667B19E3779F9)
        at = np.flatnonzero(is_letter)
        self.buckets = ((mix ^ (mix >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(48))[at].astype(np.int64)
        opens = np.flatnonzero(before[at] == 0)
        self.starts = opens  # in letters
        self.sizes = np.diff(np.append(opens, len(at)))
        first = at[opens]
        self.script = script[capped[first]]
        lengths = np.array([len(x or "") + 1 for x in texts], np.int64)
        ends = np.cumsum(lengths)
        self.text = np.searchsorted(ends, first, "right")
        self.begin = first - (ends - lengths)[self.text]  # in characters of the text
        self.count = np.bincount(self.text, minlength=len(texts))


class Model:
    def __init__(self, languages: list[str], trigrams: np.ndarray, scripts: np.ndarray):
        self.languages = languages
        total = trigrams.sum(axis=1, keepdims=True)
        # A tenth of a count for every bucket.
        self.score = np.log((trigrams + 0.1) / (total + 0.1 * BUCKETS)).T.astype(np.float32)
        share = scripts / np.maximum(scripts.sum(axis=1, keepdims=True), 1)
        self.uses = (share >= SCRIPT_SHARE).T

    def emissions(self, words: Words) -> np.ndarray:
        """(words, languages): 0 for all where no language uses the script."""
        out = np.add.reduceat(self.score[words.buckets], words.starts, axis=0)
        uses = self.uses[words.script]
        unused = ~uses.any(axis=1)
        out = np.where(uses, out, -np.inf)
        out[unused] = 0
        return out

    def viterbi(self, emission: np.ndarray, counts: np.ndarray, switch: float) -> np.ndarray:
        """Label of each word; ``counts`` are the texts' numbers of words.

        All texts advance together, word by word.
        """
        n_texts, n = len(counts), len(self.languages)
        order = np.argsort(-counts, kind="stable")
        count = counts[order]
        first = (np.cumsum(counts) - counts)[order]
        value = np.zeros((n_texts, n))
        moved = np.zeros((len(emission), n), bool)
        source = np.zeros(len(emission), np.int16)
        longest = int(count[0]) if n_texts else 0
        # Texts with more than t words are the first active[t].
        active = np.searchsorted(-count, -np.arange(longest), "left").tolist()
        for t in range(longest):
            a = active[t]
            now, at = value[:a], first[:a] + t
            come = (now.max(axis=1) - switch)[:, None]
            moved[at] = come > now
            source[at] = now.argmax(axis=1)
            value[:a] = np.maximum(now, come) + emission[at]
        label = np.zeros(len(emission), np.int16)
        state = value.argmax(axis=1)
        for t in range(longest - 1, -1, -1):
            a = active[t]
            at, s = first[:a] + t, state[:a]
            label[at] = s
            state[:a] = np.where(moved[at, s], source[at], s)
        return label


def _cut(text: str) -> Iterator[tuple[int, str]]:
    """A long text in pieces that end at a blank, with their places."""
    at = 0
    while len(text) - at > STEP_CHARS:
        blank = text.rfind(" ", at, at + STEP_CHARS)
        end = blank + 1 if blank > at else at + STEP_CHARS
        yield at, text[at:end]
        at = end
    yield at, text[at:]


def words_of(texts: list[str | None]) -> Iterator[tuple[Words, np.ndarray, np.ndarray]]:
    """Words of bounded pieces of the texts, with the text's number and the piece's place."""
    held: list[tuple[int, int, str]] = []
    size = 0
    for i, text in enumerate(texts):
        for at, piece in _cut(text or ""):
            held.append((i, at, piece))
            size += len(piece)
            if size >= STEP_CHARS:
                yield _words(held)
                held, size = [], 0
    if held:
        yield _words(held)


def _words(held: list[tuple[int, int, str]]) -> tuple[Words, np.ndarray, np.ndarray]:
    return (
        Words([piece for *_, piece in held]),
        np.array([i for i, *_ in held]),
        np.array([at for _, at, _ in held]),
    )


def _steps(texts: list[str | None]) -> Iterator[list[str | None]]:
    held: list[str | None] = []
    size = 0
    for text in texts:
        held.append(text)
        size += len(text or "")
        if size >= PASS_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def learn(rows: DataFrame) -> Model | None:
    """Counts of all (text, lang) rows; None without any."""
    labelled = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            texts = batch.column("text").to_pylist()
            for lang in dict.fromkeys(langs.tolist()):
                own = [texts[i] for i in np.flatnonzero(langs == lang).tolist()]
                total = sums.setdefault(lang, np.zeros(BUCKETS + len(SCRIPT_NAMES), np.int64))
                for words, *_ in words_of(own):
                    total[:BUCKETS] += np.bincount(words.buckets, minlength=BUCKETS)
                    total[BUCKETS:] += np.bincount(words.script, weights=words.sizes, minlength=len(SCRIPT_NAMES)).astype(np.int64)
        for lang, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(total[at])],
                ["lang", "feature", "n"],
            )

    # At most buckets + scripts rows per language.
    table = (
        labelled.mapInArrow(counts, "lang string, feature int, n long")
        .groupBy("lang", "feature").agg(F.sum("n").alias("n")).toPandas()
    )
    languages = sorted(table["lang"].unique())
    if not languages:
        return None
    all_counts = np.zeros((len(languages), BUCKETS + len(SCRIPT_NAMES)))
    at = {x: i for i, x in enumerate(languages)}
    all_counts[table["lang"].map(at), table["feature"]] = table["n"]
    return Model(languages, all_counts[:, :BUCKETS], all_counts[:, BUCKETS:])


def identify(
    docs: DataFrame, model: Model | None, keep: list[str], switch: float = SWITCH,
    spans: bool = False, names: tuple[str, str, str] = ("lang_pred", "score", "spans"),
) -> DataFrame:
    """``keep`` columns with lang_pred and score, and spans (start, end, lang) in characters."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.select(*keep)
    text = "text" if "text" in keep else free_name(kept, "_text")
    read = kept if "text" in keep else docs.select(*keep, F.col("text").alias(text))
    added = list(names[: 3 if spans else 2])
    kinds = ["string", "double", "array<struct<start:int,end:int,lang:string>>"]
    schema = ", ".join([schema_of(kept), *(f"`{n}` {k}" for n, k in zip(added, kinds))])
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            predicted, scores, found = [], [], []
            for some in _steps(batch.column(text).to_pylist()):
                for p, s, f in _labels(model, some, switch, spans):
                    predicted.append(p)
                    scores.append(s)
                    found.append(f)
            columns = [batch.column(c) for c in range(len(keep))]
            columns += [pa.array(predicted, pa.string()), pa.array(scores, pa.float64())]
            if spans:
                columns.append(pa.array(found, pa.list_(span)))
            yield pa.RecordBatch.from_arrays(columns, [*keep, *added])

    return read.mapInArrow(labelled, schema)


def _labels(model: Model | None, texts: list[str | None], switch: float, spans: bool):
    emissions, numbers, sizes, begins = [], [], [], []
    for words, text, at in words_of(texts) if model is not None else ():
        if len(words.starts):
            emissions.append(model.emissions(words))
            numbers.append(text[words.text])
            sizes.append(words.sizes)
            begins.append(words.begin + at[words.text])
    if not emissions:
        return [(UND, 0.0, [])] * len(texts)
    number, size, begin = (np.concatenate(x) for x in (numbers, sizes, begins))
    counts = np.bincount(number, minlength=len(texts))
    emission = np.concatenate(emissions)
    label = model.viterbi(emission, counts, switch)
    n = len(model.languages)
    # Log likelihoods are below 0: a word with 0 for all has a script that no language uses.
    known = np.where(emission.any(axis=1), size, 0)
    letters = np.bincount(number * n + label, weights=known, minlength=len(texts) * n).reshape(-1, n)
    total = np.bincount(number, weights=size, minlength=len(texts))
    best = letters.argmax(axis=1)
    share = letters.max(axis=1) / np.maximum(total, 1)
    found: list[list[dict]] = [[] for _ in texts]
    if spans:
        change = np.concatenate([[True], (label[1:] != label[:-1]) | (number[1:] != number[:-1])])
        opens = np.flatnonzero(change)
        closes = np.append(opens[1:], len(label)) - 1
        for i, j in zip(opens.tolist(), closes.tolist()):
            found[number[i]].append({
                "start": int(begin[i]), "end": int(begin[j] + size[j]),
                "lang": model.languages[label[i]],
            })
    return [
        (model.languages[b], float(s), f) if t else (UND, 0.0, [])
        for b, s, t, f in zip(best.tolist(), share.tolist(), total.tolist(), found)
    ]


def language_of(docs: DataFrame, train: Column, keep: list[str], **options) -> DataFrame:
    """Learn from the rows of ``docs`` where ``train`` holds, label all of them."""
    return identify(docs, learn(docs.filter(train)), keep, **options)
