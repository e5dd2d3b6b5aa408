import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tidemark.llm.packing import _Encoder, best_fit, sequences, sweeps
from tokenizers import Tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["a  b", "a   b", " \n x\n\n y", "foo\n bar  baz", " lead", "trail ", "\n", "it's 12 don't", "x  y  z", "<|endoftext|> hi",
       "été, Ça! 漢字 кот ", "a\tb \tc", " thin　wide x", "***!! 5$", "a  b", "\x1c x \x1cy"]


def plain(texts):
    tokenizer = Tokenizer.from_file(PATH)
    return [e.ids + [0] for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_ids_are_those_of_the_library(small):
    encoder, texts = _Encoder(PATH), ODD + list(small[1].values())[::5]
    for text, ids in zip(texts, plain(texts), strict=True):
        assert np.frombuffer(encoder.text(text), "<u4").tolist() + [0] == ids
    assert encoder.merge is not None


def test_round_trip_and_gapless_sequences(documents, small):
    texts = list(small[1].values()) + ODD + [None, "", "", "word " * 9000]
    packed = best_fit(documents([(i, t, "en") for i, t in enumerate(texts)])).cache()
    rows = packed.collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for doc, ids in enumerate(plain(texts)):
        pieces = sorted(by_doc[doc], key=lambda r: r["piece"])
        assert b"".join(bytes(p["ids"]) for p in pieces) == np.asarray(ids, "<u4").tobytes()
        assert [p["piece"] for p in pieces] == list(range(len(pieces)))
        assert all(p["length"] == 2048 for p in pieces[1:]) and len(pieces) == -(-len(ids) // 2048)
        for p in pieces:
            own = np.asarray(ids[p["start"] : p["start"] + p["length"]], "<u4").tobytes()
            assert p["ids_crc32"] == zlib.crc32(own)
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda r: r["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 2048
    total = sum(r["length"] for r in rows)
    assert len(by_sequence) <= 1.02 * total / 2048 + 1
    joined = {r["sequence_id"]: len(r["ids"]) // 4 for r in sequences(packed).collect()}
    assert joined == {s: sum(p["length"] for p in parts) for s, parts in by_sequence.items()}


def test_repeated_rows_null_ids_and_nothing(documents):
    table = documents([(1, "same", "en")] * 30 + [(None, "x", "en"), (2**60 + 1, "y", "en")])
    rows = best_fit(table, with_ids=False).collect()
    assert len(rows) == 32 and {r["doc_id"] for r in rows} == {1, None, 2**60 + 1}
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == 32
    assert best_fit(table.limit(0)).count() == 0


def test_sweeps_fill_as_best_fit_does():
    placed = sweeps({10: 3, 6: 4, 5: 3, 4: 2, 1: 7}, 10)
    seats = defaultdict(list)
    for length, first, end, sequence, offset in placed:
        for k in range(end - first):
            seats[sequence + k].append((offset, length))
    assert sum(e - f for _, f, e, _, _ in placed) == 19
    for parts in seats.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 10
    assert len(seats) == 9


def test_plain_texts_of_many_words_leave_nothing_in_memory(monkeypatch):
    text = " ".join(f"word{i}" for i in range(5000))
    whole = np.asarray(plain([text])[0][:-1], "<u4").tobytes()
    for chars in (100, 1 << 16):
        monkeypatch.setattr("tidemark.llm.packing.MERGED_CHARS", chars, raising=False)
        encoder = _Encoder(PATH)
        assert encoder.text(text) == whole and len(encoder) == 0
