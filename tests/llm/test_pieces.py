"""Pieces against the sentencepiece library."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from tidemark.llm import pieces


@pytest.fixture(scope="module")
def library():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=pieces.model_path())


@pytest.fixture(scope="module")
def model():
    return pieces._model(pieces.model_path())


def agree(model, library, texts):
    ids, counts = model.encode(texts)
    ends = np.cumsum(counts)
    for text, begin, end in zip(texts, ends - counts, ends, strict=True):
        own = ids[begin:end].tolist()
        assert own == library.encode(text), text[:80]
        assert model.decode(own) == library.decode(own), text[:80]


ODD = ["", " ", "a", "  a", " a  b ", "▁", "▁▁ ▁", "\0a\0", "�é漢字😀\n\t x", "<0x0A><s></s><unk>"]


def test_odd_texts(model, library):
    agree(model, library, ODD)
    agree(model, library, [" " * n for n in range(300)])


@pytest.mark.parametrize("seed", range(3))
def test_random_texts(model, library, seed):
    rng = random.Random(seed)
    parts = ["a", "b", "e", "t", "h", " ", "  ", "ing", "the", "▁", "\n", "é", "漢", "😀", "0", ".", "<s>"]
    held = [piece.replace("▁", " ") for piece in model.score]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(2000)]
    texts += ["".join(rng.choice(held) for _ in range(rng.randint(0, 30))) for _ in range(2000)]
    texts += [
        "".join(chr(rng.choice([rng.randint(32, 126), rng.randint(0, 0xD7FF), rng.randint(0xE000, 0x10FFFF)]))
                for _ in range(rng.randint(0, 40)))
        for _ in range(1000)
    ]
    agree(model, library, texts)


def test_long_segments_and_texts(model, library, monkeypatch):
    rng = random.Random(7)
    junk = "".join(rng.choice("abcdefgh") for _ in range(4000))
    texts = ["x" * 3000, " " * 5000 + "a", "ab" * 2000, junk, "aaaa b" * 1000, "", "漢字 😀 " * 2000]
    agree(model, library, texts)
    monkeypatch.setattr(pieces, "CHARACTERS", 1000)  # texts in parts, and segments beyond a part
    agree(model, library, texts)
    monkeypatch.setattr(pieces, "LONG", 3)
    agree(model, library, texts[-3:])


def test_a_very_long_text(model, library):
    rng = random.Random(8)
    words = [f"w{rng.randrange(5000)}" for _ in range(900_000)]
    text = " ".join(words)
    assert len(text) > pieces.CHARACTERS
    agree(model, library, ["before", text, "after"])


def test_any_ids_decode_alike(model, library):
    rng = random.Random(9)
    for _ in range(5000):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(300), 259, 28705]) for _ in range(rng.randint(0, 8))]
        assert model.decode(ids) == library.decode(ids), ids


def test_pairs_are_compatible_when_they_encode_to_themselves(model, library):
    rng = random.Random(10)
    common = [i for i in range(300, 3000) if i in model.reached and model.decode([259, i]).strip()]
    text = {i: p for p, i in model.ids.items()}
    pairs = [(rng.choice(common), rng.choice(common)) for _ in range(3000)]
    found = model.compatible(*(np.array(side) for side in zip(*pairs, strict=True)))
    for (a, b), apart in zip(pairs, found.tolist(), strict=True):
        if text[a].startswith("▁") and "▁" not in text[b]:
            assert apart == (library.encode((text[a] + text[b])[1:]) == [a, b])


def test_query_equals_library(spark, library, monkeypatch):
    texts = [*ODD, None, "the quick brown fox " * 50, "same", "same"]
    rows = [(i if i != 3 else None, t, 1, "d", 2) for i, t in enumerate(texts)]
    schema = "doc_id long, text string, ids int, decoded string, n_tokens int"
    frame = spark.createDataFrame(rows, schema).repartition(3)
    monkeypatch.setattr(pieces, "table", lambda *_: frame)

    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    want = []
    for doc_id, text, *_ in rows:
        ids = library.encode(text or "")
        want.append((doc_id, len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids))))
    got = [tuple(r) for r in pieces.op13_pieces(spark, "").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    ids = pieces.encoded(frame)
    assert ids.columns == ["doc_id", "ids"]
    back = {(r["doc_id"], r["decoded"]) for r in pieces.decoded(ids).collect()}
    assert back == {(r[0], library.decode(library.encode(r[1] or ""))) for r in rows}
    empty = spark.createDataFrame([], schema)
    assert pieces.op13_pieces(spark, "").columns[0] == "doc_id"
    assert pieces.round_trip(empty).collect() == []
