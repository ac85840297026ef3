"""Licence scanning with a positional index of rare tokens.

Templates are licence texts of any length, each with a mandatory key phrase inside.
One aggregation counts the documents of every licence word, which gives its inverse
document frequency. The index posts (word, template, position) for the words that
few documents have, and for the rarest word of every key phrase.

A file looks up its own ``lookups`` licence words of highest idf, and the rarest key
words that it holds, so that no template whose key stands can be missed. Every
posting says where its template would start; equal (template, start) are brought
together by one sort, which intersects the postings by relative position: a start
stays when all looked-up words of the key phrase agree on it. There the key phrase
must stand word for word. The whole template is then compared at the same relative
positions and gives the score, the share of the template's idf that agrees.

Built-in functions only. Words stay an array in their row and the index is a literal
as large as the templates, a bound that does not depend on the corpus, so the scan
needs no shuffle; the counts before it have as many rows as the templates have words.

Defined results: a null text is empty and has no words, no labels (empty strings) and
score 0; a file with several templates has all their labels, sorted; of templates that
agree equally well the score is the same, and words of equal idf are looked up in the
order of the alphabet; repeated rows are scanned each; a null id stays null; an empty
table gives no rows; extra columns are ignored; a very long text is scanned whole, its
postings sorted once in its row.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.license_texts import LICENSES, LicenseText
from tradewind.llm.tables import ascii_lower, text_of

__all__ = ["BASE_PHRASES", "LICENSES", "LicenseText", "scan_licenses"]

# Fixed values of the contract.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

_TEMPLATES = "array<struct<label:string,words:array<string>,idf:array<double>,key:array<string>,key_at:int,total:double>>"
_POSTINGS = "map<string,array<struct<template:int,at:int,in_key:boolean>>>"


def file_words(text: Column) -> Column:
    """Runs of digits, a-z and characters beyond ASCII, after lower-casing A-Z."""
    return F.array_remove(F.split(ascii_lower(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def _rows(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    return documents.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text")).select(
        "doc_id", file_words(F.col("text")).alias("words")
    )


def word_counts(rows: DataFrame, licenses: tuple[LicenseText, ...]) -> tuple[int, dict[str, int]]:
    """Number of documents, and of those that hold each licence word."""
    vocabulary = sorted({w for t in licenses for w in t.words})
    own = F.array_distinct(F.filter("words", lambda w: w.isin(vocabulary)))
    counted = rows.select(F.explode(F.array_append(own, F.lit("")).alias("word")).alias("word")).groupBy("word").count()
    counts = {r["word"]: r["count"] for r in counted.collect()}
    return counts.get("", 0), {w: counts.get(w, 0) for w in vocabulary}


def _idf(total: int, count: int) -> float:
    return 1.0 + math.log((total + 1) / (count + 1))


def _stands(words: Column, at: Column, phrase: list[str]) -> Column:
    """Whether the phrase's words stand from the position on."""
    same = F.lit(True)
    for k, word in enumerate(phrase):
        same = same & F.coalesce(F.get(words, at + k) == word, F.lit(False))
    return same


def _base_places(words: Column, phrase: list[str], label: str) -> Column:
    places = F.filter("hits", lambda i: _stands(words, i, phrase))
    return F.transform(places, lambda i: F.struct(i.alias("at"), F.lit(label).alias("label")))


def _positions(last: Column) -> Column:
    """0 to ``last``; nothing if that is negative."""
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def _templates(licenses: tuple[LicenseText, ...], idf: dict[str, float]) -> Column:
    """All templates as one literal."""
    rows = [
        {
            "label": t.label, "words": t.words, "idf": [idf[w] for w in t.words], "key": t.key_words, "key_at": t.key_at,
            "total": sum(idf[w] for w in t.words),
        }
        for t in licenses
    ]
    return F.from_json(F.lit(json.dumps(rows)), _TEMPLATES)


def _postings(licenses: tuple[LicenseText, ...], posted: set[str]) -> Column:
    """Map from a posted word to its (template, position, whether it lies in the key), as one literal."""
    places: dict[str, list[dict]] = {}
    for number, t in enumerate(licenses):
        for at, word in enumerate(t.words):
            if word in posted:
                in_key = t.key_at <= at < t.key_at + len(t.key_words)
                places.setdefault(word, []).append({"template": number, "at": at, "in_key": in_key})
    return F.from_json(F.lit(json.dumps(places)), _POSTINGS)


def scan_licenses(
    documents: DataFrame,
    licenses: tuple[LicenseText, ...] = LICENSES,
    phrases: dict[str, str] | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    lookups: int = 8,
    rare_share: float = 0.01,
) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, matches``.

    ``lookups``: words that a file looks up beside rarest key words. ``rare_share``:
    words of a larger share of the documents are posted only as a key's rarest one.
    """
    phrases = BASE_PHRASES if phrases is None else phrases
    rows = _rows(documents, doc_id, text)
    total, counts = word_counts(rows, licenses)
    idf = {w: _idf(total, n) for w, n in counts.items()}
    anchors = sorted({max(t.key_words, key=lambda w: (idf[w], w)) for t in licenses})
    posted = {w for w, n in counts.items() if n <= rare_share * total}.union(anchors)
    looked_up = sorted(posted | {p.split()[0] for p in phrases})

    words = F.col("words")
    hits = F.filter(_positions(F.size(words) - 1), lambda i: F.get(words, i).isin(looked_up))
    found = rows.select("doc_id", "words", hits.alias("hits"))

    # Base: places where a phrase's words stand consecutively.
    base = [_base_places(words, phrase.split(), label) for phrase, label in phrases.items()]
    found = found.select("doc_id", "words", "hits", F.flatten(F.array(*base)).alias("base"))

    # The file's own rarest licence words, and the rarest key words that it holds.
    weights = F.from_json(F.lit(json.dumps({w: -idf[w] for w in sorted(posted)})), "map<string,double>")
    held = F.array_distinct(F.transform("hits", lambda i: F.get(words, i)))
    ranked = F.array_sort(F.transform(held, lambda w: F.struct(F.element_at(weights, w).alias("rank"), w.alias("word"))))
    ranked = F.filter(ranked, lambda r: r["rank"].isNotNull())
    found = found.select("doc_id", "words", "hits", "base", held.alias("held"), ranked.alias("ranked"))
    highest = F.transform(F.slice("ranked", 1, lookups), lambda r: r["word"])
    own = F.array_union(highest, F.filter("held", lambda w: w.isin(anchors)))
    found = found.select("doc_id", "words", "hits", "base", own.alias("own"))

    # Postings of every hit of these words, as (template, start), in order.
    index = _postings(licenses, posted)
    chosen = F.filter("hits", lambda i: F.array_contains("own", F.get(words, i)))
    votes = F.flatten(
        F.transform(
            chosen,
            lambda i: F.transform(
                F.element_at(index, F.get(words, i)),
                lambda p: F.struct(p["template"].alias("template"), (i - p["at"]).alias("start"), p["in_key"].alias("in_key")),
            ),
        )
    )
    found = found.select("doc_id", "words", "base", "own", F.array_sort(votes).alias("votes"))

    # Equal ones stand together. Of a group, those outside the key come first.
    def place(j: Column) -> Column:
        vote = F.get("votes", j)
        return F.struct(vote["template"], vote["start"])

    n = F.size("votes")
    first = F.filter(_positions(n - 1), lambda j: (j == 0) | (place(j) != place(j - 1)))
    in_key = F.filter(
        _positions(n - 1),
        lambda j: F.get("votes", j)["in_key"] & ((j == 0) | (place(j) != place(j - 1)) | ~F.get("votes", j - 1)["in_key"]),
    )
    last = F.filter(_positions(n - 1), lambda j: (j == n - 1) | (place(j) != place(j + 1)))
    found = found.select("doc_id", "words", "base", "own", "votes", first.alias("first"), in_key.alias("in_key"), last.alias("last"))
    # A group without a vote from its key cannot hold the key's rarest word.
    groups = F.filter(F.arrays_zip("first", "last"), lambda g: F.get("votes", g["last"])["in_key"])
    found = found.select("doc_id", "words", "base", "own", "votes", "in_key", groups.alias("groups"))
    candidates = F.transform(
        F.arrays_zip("groups", "in_key"),
        lambda g: F.struct(
            F.get("votes", g["in_key"])["template"].alias("template"),
            F.get("votes", g["in_key"])["start"].alias("start"),
            (g["groups"]["last"] - g["groups"]["first"] + 1).alias("votes"),
            (g["groups"]["last"] - g["in_key"] + 1).alias("key_votes"),
        ),
    )
    found = found.select("doc_id", "words", "base", "own", candidates.alias("candidates"))

    templates = _templates(licenses, idf)

    # Intersection of the looked-up key words' postings, then the key phrase itself.
    def stands(c: Column) -> Column:
        of = F.get(templates, c["template"])
        at = c["start"] + of["key_at"]
        expected = F.size(F.filter(of["key"], lambda w: F.array_contains("own", w)))
        there = F.slice("words", F.greatest(at, F.lit(0)) + 1, F.size(of["key"]))
        return (at >= 0) & (c["key_votes"] == expected) & (there == of["key"])

    def share(c: Column) -> Column:
        of = F.get(templates, c["template"])

        def agreeing(sum_: Column, q: Column) -> Column:
            there = F.get(words, F.when(c["start"] + q >= 0, c["start"] + q))
            return sum_ + F.when(F.coalesce(there == F.get(of["words"], q), F.lit(False)), F.get(of["idf"], q)).otherwise(0.0)

        weight = F.aggregate(_positions(F.size(of["words"]) - 1), F.lit(0.0), agreeing)
        return F.least(weight / of["total"], F.lit(1.0))

    matches = F.transform(
        F.filter("candidates", stands),
        lambda c: F.struct(
            F.get(templates, c["template"])["label"].alias("label"),
            c["start"].alias("start"),
            c["votes"].alias("votes"),
            share(c).alias("share"),
        ),
    )
    scanned = found.select("doc_id", F.size(words).cast("long").alias("n_words"), "base", matches.alias("matches"))
    places = F.transform("base", lambda b: b["at"])
    base_labels = F.array_distinct(F.transform("base", lambda b: b["label"]))
    own_labels = F.transform("matches", lambda m: m["label"])
    return scanned.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"),
        F.array_join(F.array_sort(base_labels), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base_labels, own_labels)), ",").alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["share"])), F.lit(0.0)).alias("score"),
        "matches",
    )
