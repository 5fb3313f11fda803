"""Ids by pieces against the library on whole texts; files and packing against them."""

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import awkward, awkward_rows, nothing

from supplyview.llm import arrow_tokens, packing, tokens

pytest.importorskip("public_tokenizers")
PATH = tokens.default_tokenizer()
CASES = [
    "", None, "a", " a", "a ", "\n", "\na", "a\n", " ", "a  b", "a\tb", "don't stop", "it's 5.5, ok?!", "x\n y",
    "été, ñandú. ß", "中文 字", "a²b", "Hello.World foo", "\rabc", "ab<|endoftext|> c", "é\xa0x", "a .b",
    "... x", "\r a", "\r", "a\nb c\n.\nd", "a　b", "word. Word, word", "a'b 'tis", "\x1c x", "x.y. z",
]


def whole(text):
    encoder = tokens.encoder(PATH)
    return encoder.tokenizer.encode(text or "", add_special_tokens=False).ids


def test_pieces_give_the_ids_of_whole_texts():
    for text, ids in zip(CASES, tokens.encoder(PATH).encode(pa.array(CASES))):
        assert ids.tolist() == whole(text), text


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab é'.,!? \n\t1ß中²\xa0"), max_size=12), max_size=5))
def test_random_texts(texts):
    found = tokens.encoder(PATH).encode(pa.array(texts, pa.string()))
    assert [x.tolist() for x in found] == [whole(t) for t in texts]


def test_a_full_memo_changes_nothing(monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_WORDS", 3)
    encoder = tokens.Encoder(PATH)
    for _ in range(3):
        for text in ("one two three four.", "five six, two", "one two"):
            assert encoder.encode(pa.array([text]))[0].tolist() == whole(text)


def expected():
    """Ids with the end id, by doc_id; rows of one id are equal in the fixture."""
    return {r[0]: [*whole(r[1]), 0] for r in awkward_rows()}


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_files_hold_all_documents_in_order(spark, tmp_path):
    shards = arrow_tokens.write(awkward(spark), str(tmp_path / "out"), length=64, shard_bytes=200_000)
    found = sorted(arrow_tokens.read(shards).collect(), key=lambda r: r["start"])
    ids = expected()
    keys = [r["doc_id"] for r in found]
    assert keys == [None, 1, 2, 2, *range(3, 12)]
    start = 0
    for r in found:
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids[r["doc_id"]]), crc(ids[r["doc_id"]]))
        start += r["n_tokens"]


def test_any_sequence_is_read_by_itself(spark, tmp_path):
    folder = str(tmp_path / "out")
    shards = arrow_tokens.write(awkward(spark), folder, length=64).collect()
    ids = expected()
    order = [None, 1, 2, 2, *range(3, 12)]
    stream = [i for k in order for i in ids[k]]
    at = 0
    for shard in sorted(shards, key=lambda s: s["shard"]):
        reader = arrow_tokens.open_shard(shard["ids_path"])
        total = sum(reader.get_batch(b).num_rows for b in range(reader.num_record_batches))
        assert total == -(-shard["n_tokens"] // 64)
        assert reader.schema.field("ids").type == pa.list_(pa.uint16(), 64)
        for i in (total - 1, 0, total // 2):
            got, mask = arrow_tokens.sequence(reader, i)
            want = stream[at + 64 * i : min(at + 64 * (i + 1), at + shard["n_tokens"])]
            assert got[: len(want)].tolist() == want and mask.sum() == len(want)
            assert not got[len(want) :].any()
            assert mask.dtype == np.uint8 and mask.tolist() == [1] * len(want) + [0] * (64 - len(want))
            # Views of the mapped file: no one owns or may change them.
            assert not any(x.flags.owndata or x.flags.writeable for x in (got, mask))
        at += shard["n_tokens"]


def test_no_documents_no_files(spark, tmp_path):
    shards = arrow_tokens.write(nothing(spark), str(tmp_path / "out"))
    assert shards.count() == 0 and arrow_tokens.read(shards).count() == 0


def checked(pieces, capacity):
    sequences, documents = defaultdict(list), defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append((p["offset"], p["length"], p["ids"]))
        documents[p["doc_id"]].append((p["start"], p["length"], bytes(p["ids"])))
    for parts in sequences.values():
        at = 0
        for offset, length, _ in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(sequences) == list(range(len(sequences)))
    return sequences, documents


@pytest.mark.parametrize("capacity", [16, 1024])
def test_pieces_cover_documents_and_fill_sequences(spark, capacity):
    packed = packing.pack(awkward(spark).repartition(3), capacity, with_ids=True)
    pieces = packed.collect()
    sequences, documents = checked(pieces, capacity)
    for p in pieces:
        assert zlib.crc32(p["ids"]) == p["ids_crc32"] and len(p["ids"]) == 4 * p["length"]
    for key, ids in expected().items():
        times = 2 if key == 2 else 1
        parts = sorted(documents[key])
        assert sum(length for _, length, _ in parts) == times * len(ids)
        assert b"".join(x for _, _, x in parts[::times]) == np.array(ids, "<u4").tobytes()
    used = sum(p["length"] for p in pieces)
    assert used / (capacity * len(sequences)) > 0.97
    whole_rows = packing.sequences(packed, capacity).collect()
    assert {r["sequence_id"]: len(r["ids"]) // 4 for r in whole_rows} == {
        k: sum(n for _, n, _ in v) for k, v in sequences.items()
    }


def test_cuts_fill_their_bins():
    for rest, lengths in enumerate(packing.cuts(1024, 0.02)):
        assert sum(lengths) == rest
        for n in lengths:
            assert 1024 - 1024 // n * n <= max(0.04 * 1024, n - 1)


def test_packing_nothing(spark):
    assert packing.pack(nothing(spark)).count() == 0
