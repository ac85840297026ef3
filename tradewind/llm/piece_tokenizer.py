"""Encoding and decoding with merge-type (BPE) SentencePiece vocabularies.

The vocabulary is read through the sentencepiece library, the merging is done
here: a text's symbols form a linked list, and an agenda (heap) of adjacent pairs
that make a piece is worked off by falling score, then from the left. Symbols
that are no piece are spelled with the byte pieces.

No piece of a supported vocabulary has a word mark after another character, so a
merge never crosses into the next run of word marks. Texts are therefore cut
there, and a segment's ids are worked out once and kept until the table holds
``table_bytes``; segments of more than ``SHORT`` characters, as texts without spaces
have, are not kept. With ``check`` on, the library's own encoding is compared with
every segment that enters the table, every long one, and one whole text per
megabyte; a difference stops the task. Short segments that are met when the table is
full are worked out in the same way without a comparison of their own: comparing
those too took 30 % more time on texts with many words that occur once.

Documents are independent, so nothing is shuffled. Defined results: a null or
empty text has no ids and decodes to an empty text; a text of any length is
encoded whole; repeated rows are encoded each; a null id stays null; an empty
table gives no rows; extra columns are ignored (``encode_documents``) or kept
(``encoded``).
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm import word_hashes
from tradewind.llm.worker_memory import kept

MARK = "▁"
SHORT = 48
# Bytes of an entry of the table beside its characters: three strings, a tuple, a slot.
ENTRY = 300
NEVER = float("inf")
_SEGMENT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


# How many ids, the ids in decimal with commas, and the text that they decode to.
Segment = tuple[int, str, str]


def shared_tokenizer(model_file: str) -> "PieceTokenizer":
    """One tokenizer, with its table, for the tasks of a Python worker."""
    return kept(("tokenizer", model_file), lambda: PieceTokenizer(model_file))


class PieceTokenizer:
    """A merge-type vocabulary: identity normalisation, dummy prefix, byte fallback."""

    def __init__(self, model_file: str, table_bytes: int = 80 << 20):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.free, self._table = table_bytes, {}
        size = self.library.get_piece_size()
        self.pieces = [self.library.id_to_piece(i) for i in range(size)]
        usable = [
            i
            for i in range(size)
            if not (
                self.library.is_control(i)
                or self.library.is_unknown(i)
                or self.library.is_byte(i)
                or self.library.is_unused(i)
            )
        ]
        self.ids = {self.pieces[i]: i for i in usable}
        # A lower rank is a higher score, and is merged earlier.
        self.rank = {self.pieces[i]: -self.library.get_score(i) for i in usable}
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in range(size) if self.library.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.control = {i for i in range(size) if self.library.is_control(i)}
        # From this id on there are neither bytes nor control pieces.
        self.first_plain = 1 + max(set(range(size)) - set(usable), default=-1)
        if len(self.bytes) != 256:
            raise ValueError("the vocabulary has no byte pieces")
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece has a word mark after another character")

    def merge(self, segment: str) -> list[int]:
        """Ids of one segment by the agenda of adjacent pairs."""
        symbols = self._merge_short(segment) if len(segment) <= SHORT else self._merge_long(segment)
        out = []
        for symbol in symbols:
            if (known := self.ids.get(symbol)) is not None:
                out.append(known)
            else:
                out.extend(self.bytes[b] for b in symbol.encode("utf-8"))
        return out

    def _merge_short(self, segment: str) -> list[str]:
        """The agenda as a plain list beside the symbols: its least entry is the next merge."""
        rank, symbols = self.rank.get, list(segment)
        agenda = [rank(a + b, NEVER) for a, b in zip(symbols, symbols[1:])]
        while agenda:
            best = min(agenda)
            if best == NEVER:
                break
            i = agenda.index(best)
            symbols[i] += symbols.pop(i + 1)
            del agenda[i]
            if i < len(agenda):
                agenda[i] = rank(symbols[i] + symbols[i + 1], NEVER)
            if i:
                agenda[i - 1] = rank(symbols[i - 1] + symbols[i], NEVER)
        return symbols

    def _merge_long(self, segment: str) -> list[str]:
        """The agenda as a heap over a linked list, for segments of any length."""
        rank, symbols = self.rank, list(segment)
        n = len(symbols)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = []

        def offer(i: int, j: int) -> None:
            pair = symbols[i] + symbols[j]
            if pair in rank:
                heapq.heappush(agenda, (rank[pair], i, j, pair))

        for i in range(n - 1):
            offer(i, i + 1)
        while agenda:
            _, i, j, pair = heapq.heappop(agenda)
            if symbols[i] is None or symbols[j] is None or right[i] != j or symbols[i] + symbols[j] != pair:
                continue
            symbols[i], symbols[j] = pair, None
            right[i] = right[j]
            if left[i] >= 0:
                offer(left[i], i)
            if right[i] < n:
                left[right[i]] = i
                offer(i, right[i])
        return [s for s in symbols if s is not None]

    def segments(self, text: str) -> list[str]:
        return _SEGMENT.findall(MARK + text.replace(" ", MARK)) if text else []

    def encode_batch(self, texts: Iterable[str], check: bool = False) -> list[list["Segment"]]:
        """The segments of each text, with their ids."""
        out, fresh = [], []
        table = self._table
        for text in texts:
            row = []
            for part in self.segments(text):
                found = table.get(part)
                if found is None:
                    ids = tuple(self.merge(part))
                    found = (len(ids), ",".join(map(str, ids)), self._spelled(ids))
                    if len(part) > SHORT:
                        if check:
                            fresh.append((part, ids))
                    elif self.free > 0:
                        table[part] = found
                        self.free -= ENTRY + 2 * len(part) + len(found[1]) + len(found[2])
                        if check:
                            fresh.append((part, ids))
                row.append(found)
            out.append(row)
        if fresh:
            # The library puts one mark in front, so a segment is given without its first.
            given = [part[1:].replace(MARK, " ") for part, _ in fresh]
            for (part, ids), expected in zip(fresh, self.library.encode(given, num_threads=1)):
                if part != MARK and list(ids) != expected:
                    raise ValueError(f"segment {part!r}: {list(ids)} differs from the library's {expected}")
        return out

    def encode(self, text: str) -> list[int]:
        return ids_of(self.encode_batch([text])[0])

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids: marks are spaces, a leading one goes, bytes are joined
        to characters, and a byte that belongs to none is U+FFFD."""
        ids = [i for i in ids if i not in self.control]
        text = self._spelled(ids)
        return text[1:] if ids and self.pieces[ids[0]].startswith(MARK) else text

    def decode_segments(self, parts: list["Segment"]) -> str:
        """The text of encoded segments. Each holds whole characters and only the
        first has the mark that encoding put in front."""
        return "".join([text for _, _, text in parts])[1:]

    def _spelled(self, ids: Iterable[int]) -> str:
        if min(ids, default=0) >= self.first_plain:
            return "".join([self.pieces[i] for i in ids]).replace(MARK, " ")
        out, raw = [], bytearray()

        def spell():
            at = 0
            while at < len(raw):
                size = next((w for w in (1, 2, 3, 4) if _is_character(raw[at : at + w], w)), 0)
                out.append(raw[at : at + size].decode("utf-8") if size else "�")
                at += size or 1
            raw.clear()

        for i in ids:
            if (byte := self.byte_of.get(i)) is not None:
                raw.append(byte)
                continue
            spell()
            out.append(" ⁇ " if self.library.is_unknown(i) else self.pieces[i].replace(MARK, " "))
        spell()
        return "".join(out)


def ids_of(parts: list[Segment]) -> list[int]:
    return [int(i) for _, digits, _ in parts for i in digits.split(",")]


def _is_character(raw: bytes, width: int) -> bool:
    if len(raw) < width:
        return False
    try:
        return len(raw.decode("utf-8")) == 1
    except UnicodeDecodeError:
        return False


def encode_documents(
    documents: DataFrame,
    model_file: str,
    doc_id: str = "doc_id",
    text: str = "text",
    check: bool = True,
    with_ids: bool = False,
) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` per row, with ``ids`` on request."""
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if with_ids:
        schema += ", ids array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = shared_tokenizer(model_file)
        # A megabyte of texts at a time: segments and ids are Python objects, many times its size.
        for batch in (piece for whole in batches for piece in word_hashes.slices(whole, "text")):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            counts, ids_digests, text_digests, all_ids = [], [], [], []
            for at, parts in enumerate(tokenizer.encode_batch(texts, check)):
                decoded = tokenizer.decode_segments(parts)
                if check and at == 0:
                    ids = ids_of(parts)
                    if ids != tokenizer.library.encode(texts[at]) or decoded != tokenizer.library.decode(ids):
                        raise ValueError("a text's ids or decoding differ from the library's")
                counts.append(sum([n for n, _, _ in parts]))
                ids_digests.append(hashlib.sha256(",".join([d for _, d, _ in parts]).encode()).hexdigest())
                text_digests.append(hashlib.sha256(decoded.encode("utf-8")).hexdigest())
                if with_ids:
                    all_ids.append(np.array(ids_of(parts), np.int32))
            columns = [
                batch.column("doc_id"),
                pa.array(counts, pa.int64()),
                pa.array(ids_digests, pa.string()),
                pa.array(text_digests, pa.string()),
            ]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns.append(pa.array(all_ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(run, schema)
