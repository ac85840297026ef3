from __future__ import annotations

import hashlib
import os
import random
import sys

import pytest

from tradewind.llm.piece_tokenizer import SHORT, PieceTokenizer, encode_documents, ids_of
from tradewind.llm.queries import piece_model

pytestmark = pytest.mark.skipif(not os.path.exists(piece_model()), reason="no vocabulary file")

ODD = [" ", "  ", "▁", "a", "the", "é", "\n", "\x00", "😀", "漢", "́", "<s>", "<0x41>", "\u3000", " " * 17, "퟿", "ab", "x" * 60]


@pytest.fixture(scope="module")
def tokenizer():
    return PieceTokenizer(piece_model(), table_bytes=20_000)


def test_encodes_and_decodes_as_the_library_does(tokenizer):
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choices(ODD, k=rng.randint(0, 9)))
        ids = tokenizer.library.encode(text)
        parts = tokenizer.encode_batch([text], check=True)[0]
        assert ids_of(parts) == ids
        assert tokenizer.decode_segments(parts) == tokenizer.decode(ids) == tokenizer.library.decode(ids)


def test_decodes_any_ids_as_the_library_does(tokenizer):
    rng = random.Random(2)
    for _ in range(3000):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(3, 259), 259]) for _ in range(rng.randint(0, 7))]
        assert tokenizer.decode(ids) == tokenizer.library.decode(ids)


def test_both_agendas_agree(tokenizer):
    rng = random.Random(3)
    for _ in range(300):
        segment = "▁" + "".join(rng.choices("abcdethin", k=rng.randint(1, SHORT * 2)))
        assert tokenizer._merge_short(segment) == tokenizer._merge_long(segment)


def test_documents(spark, documents):
    long_text = "word été " * 20000
    rows = [(1, "Hello  there"), (1, "Hello  there"), (2, None), (3, ""), (None, "x"), (4, long_text)]
    library = PieceTokenizer(piece_model()).library
    got = encode_documents(documents(rows), piece_model(), with_ids=True).collect()
    assert len(got) == len(rows)
    texts = {1: "Hello  there", 2: "", 3: "", None: "x", 4: long_text}
    for r in got:
        ids = library.encode(texts[r["doc_id"]])
        assert r["ids"] == ids and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    assert encode_documents(documents(rows).where("false"), piece_model()).collect() == []


def test_table_is_bounded_by_bytes_and_holds_no_long_segments():
    tokenizer = PieceTokenizer(piece_model(), table_bytes=100_000)
    rng = random.Random(4)
    texts = ["".join(rng.choices("漢字かな交じり文", k=rng.randint(1, 400))) for _ in range(300)]
    texts += [" ".join("".join(rng.choices("abcdefghij", k=9)) for _ in range(50)) for _ in range(100)]
    for text, parts in zip(texts, tokenizer.encode_batch(texts, check=True)):
        assert ids_of(parts) == tokenizer.library.encode(text)
    assert tokenizer._table and all(len(part) <= SHORT for part in tokenizer._table)
    held = sum(sum(map(sys.getsizeof, (part, found, *found[1:]))) for part, found in tokenizer._table.items())
    assert held + sys.getsizeof(tokenizer._table) < 200_000


def test_a_difference_from_the_library_stops():
    for text in ("word", "x" * (SHORT + 9)):
        tokenizer = PieceTokenizer(piece_model())
        tokenizer.merge = lambda segment: [7]
        with pytest.raises(ValueError):
            tokenizer.encode_batch([text], check=True)
