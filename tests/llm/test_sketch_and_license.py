"""The two native operators against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re

import pytest
import xxhash

from tests.conftest import SMALL
from tests.llm.conftest import LOWER, words_of
from tradewind.llm.license_index import BASE_PHRASES, LICENSES, scan_licenses
from tradewind.llm.sketch_fingerprint import SCALE, edited_likeness
from tradewind.llm.tables import read

ODD = ["", None, "x", "a b c d", "a b c d e", "É A  b\tc \n d e f g", "same same same same same same", "x" * 5000, "漢 " * 400]


def sketch(text):
    words = words_of(text)

    def hashed(some):
        value = 42
        for word in some:
            value = xxhash.xxh64_intdigest(word.encode(), seed=value)
        return value - (1 << 64) if value >> 63 else value

    shingles = [words[i : i + 5] for i in range(len(words) - 4)] if len(words) >= 5 else [words] if words else []
    return sorted({h for h in map(hashed, shingles) if h < -(1 << 63) + (1 << 64) // SCALE})


def likeness(a, b):
    x, y = set(sketch(a)), set(sketch(b))
    return len(x & y) / len(x | y) if x | y else float(a == b)


def rows_like(rows):
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: -r[0])
    for at, (doc_id, text) in enumerate(rows):
        following = rows[(at + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        yield (
            doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(),
            " ".join(f"{h % (1 << 64):X}" for h in sketch(text)),
            " ".join(f"{h % (1 << 64):X}" for h in sketch(edited)),
            round(likeness(text, edited), 9), round(likeness(text, following), 9),
        )


def fingerprints(frame):
    for r in edited_likeness(frame).collect():
        yield (*tuple(r)[:5], round(r["near_edited"], 9), round(r["near_next"], 9))


@pytest.mark.parametrize("count", [1, 2, len(ODD)])
def test_odd_texts(documents, count):
    rows = [(7 * i - 3, t) for i, t in enumerate(ODD[:count])]
    assert sorted(fingerprints(documents(rows))) == sorted(rows_like(rows))


def test_whole_table(spark):
    documents = read(spark, SMALL, "documents")
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    assert sorted(fingerprints(documents)) == sorted(rows_like(rows))


def test_null_ids_repeats_and_empty_tables(documents):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "z"), (None, "y"), (3, "x")]
    got = edited_likeness(documents(rows)).collect()
    assert sorted(str(r["doc_id"]) for r in got) == ["1", "1", "3", "None", "None"]
    assert len({r["fingerprint"] for r in got if r["doc_id"] == 1}) == 1
    assert edited_likeness(documents(rows).where("false")).collect() == []


# --- Licences ------------------------------------------------------------

TEXTS = [
    None, "", "MIT License", "the mit\nlicense, mit license", "licence mit", "Licensed under the Apache License, Version 2.0.",
    "This work is licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0.",
    "General public public license general-public_license", "mitlicense", "é mit license é", "0 by nc 4 0",
    "Released under the MIT License. Licensed under CC BY-NC 4.0.", "license version 2 0", "apache license version 2 1",
]


def base_of(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))

    def places(phrase):
        some = phrase.split()
        return [i for i in range(len(words)) if words[i : i + len(some)] == some]

    at = [(i, label) for phrase, label in BASE_PHRASES.items() for i in places(phrase)]
    found = {label for _, label in at} | {t.label for t in LICENSES if places(t.key)}
    return (
        len(words), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None),
        ",".join(sorted({x for _, x in at})), ",".join(sorted(found)),
    )


def test_labels_and_places(spark, documents):
    rows = list(enumerate(TEXTS)) + [(r["doc_id"] + 1000, r["text"]) for r in read(spark, SMALL, "documents").collect()]
    got = {r["doc_id"]: r for r in scan_licenses(documents(rows)).collect()}
    assert len(got) == len(rows)
    for doc_id, text in rows:
        assert tuple(got[doc_id])[1:7] == base_of(text), text
        assert 0 <= got[doc_id]["score"] <= 1
        assert (got[doc_id]["score"] > 0) == bool(got[doc_id]["labels"])
    assert got[5]["score"] == pytest.approx(1.0)


def test_licenses_of_repeated_and_no_rows(documents):
    rows = [(1, "mit license"), (1, "mit license"), (None, "mit license")]
    assert [r["labels"] for r in scan_licenses(documents(rows)).collect()] == ["mit"] * 3
    assert scan_licenses(documents(rows).where("false")).collect() == []


def twin(rows, licenses, phrases):
    """Labels and score by looking for every key at every place."""
    split = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER)) for _, t in rows]
    held = [set(words) for words in split]
    idf = {w: 1 + math.log((len(rows) + 1) / (sum(w in h for h in held) + 1)) for t in licenses for w in t.words}
    for (doc_id, _), words in zip(rows, split):
        labels, score = set(), 0.0
        for phrase, label in phrases.items():
            some = phrase.split()
            labels |= {label for i in range(len(words)) if words[i : i + len(some)] == some}
        for t in licenses:
            for i in range(len(words)):
                if words[i : i + len(t.key_words)] == t.key_words:
                    start = i - t.key_at
                    same = [w for q, w in enumerate(t.words) if 0 <= start + q < len(words) and words[start + q] == w]
                    labels.add(t.label)
                    score = max(score, sum(idf[w] for w in same) / sum(idf[w] for w in t.words))
        yield doc_id, ",".join(sorted(labels)), round(score, 9)


def scanned(frame, **options):
    return sorted((r["doc_id"], r["labels"], round(r["score"], 9)) for r in scan_licenses(frame, **options).collect())


@pytest.mark.parametrize("lookups, rare_share", [(1, 0.0), (3, 0.2), (8, 1.0)])
def test_index_finds_every_key(documents, lookups, rare_share):
    rng = random.Random(lookups)
    texts = [*TEXTS, *(t.text for t in LICENSES), *(t.key for t in LICENSES)]
    for _ in range(60):
        pieces = []
        for t in rng.choices(LICENSES, k=3):
            words = t.text.split()
            begin, end = rng.randrange(len(words)), rng.randrange(len(words) + 1)
            pieces.append(" ".join(words[min(begin, end) :] if rng.random() < 0.5 else words[: max(begin, end)]))
        texts.append(" word ".join(pieces))
    texts.append("permission is hereby granted " * 3000 + LICENSES[1].text)
    rows = list(enumerate(texts))
    got = scanned(documents(rows), lookups=lookups, rare_share=rare_share)
    assert got == sorted(twin(rows, LICENSES, BASE_PHRASES))


def test_near_misses_are_told_apart(documents):
    said = {
        "Licensed under the GNU Lesser General Public License": "gpl,lgpl",
        "the GNU Affero General Public License for details": "agpl,gpl",
        "the GNU General Public License for details": "gpl",
        "SPDX-License-Identifier: BSD-3-Clause": "bsd-3-clause",
        "SPDX-License-Identifier: BSD-2-Clause": "bsd-2-clause",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee": "isc",
        "This is free and unencumbered software released into the public domain.": "unlicense",
        "Distributed under the Boost Software License, Version 1.0.": "bsl-1.0",
        "Licensed under the EUPL": "eupl",
        "Permission is hereby granted, free of charge, to anyone": "mit",
        "permission to use and copy this software": "",
        "gnu lesser known general public": "",
    }
    rows = list(enumerate(said))
    assert [labels for _, labels, _ in scanned(documents(rows))] == list(said.values())


def test_whole_text_scores_one_and_a_changed_one_less(documents):
    whole = max(LICENSES, key=lambda t: len(t.words))
    rows = [(1, whole.text), (2, whole.text.replace("copy", "duplicate", 1)), (3, "x " * 50), (4, whole.key)]
    scores = [score for _, _, score in scanned(documents(rows))]
    assert scores[0] == 1.0 > scores[1] > scores[3] > scores[2] == 0.0


def test_scan_without_templates(documents):
    got = scanned(documents([(1, "MIT License"), (2, None)]), licenses=())
    assert got == [(1, "mit", 0.0), (2, "", 0.0)]
