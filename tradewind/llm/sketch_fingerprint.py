"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch keeps every shingle hash below a fixed fraction of the hash range. Its
size follows the document, sketches of parts merge by union, and the share of one
sketch found in another estimates containment even between a page and a book.

Built-in functions only. Shingles are hashed by ``xxhash64`` over slices of the
word array, inside each row, so sketching needs no shuffle. ``with_next`` deals
rows once by doc_id range and reads the next row in a window of one range; each
range also gets a copy of the first row of the range that follows. Ranges come
from quantiles of doc_id, so they are even whatever the ids look like; the driver
sees one number per range.

Defined results: a null text is empty; a text without words has no shingles and
an empty sketch, one with fewer words than a shingle has its whole sequence as
one; two empty sketches are alike (1.0) only when their texts are equal; rows
that tie on doc_id are ordered by a hash of the text, a null doc_id comes last;
a table of one row is its own next; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.tables import ascii_lower, text_of

SHINGLE_WORDS = 5
SCALE = 4


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), r"[\x20\x09-\x0D]+"), "")


def shingle_hashes(word_array: Column, size: int = SHINGLE_WORDS) -> Column:
    n = F.size(word_array)
    full = F.transform(F.sequence(F.lit(1), n - (size - 1)), lambda i: F.xxhash64(F.slice(word_array, i, size)))
    return (
        F.when(n >= size, full)
        .when(n > 0, F.array(F.xxhash64(word_array)))
        .otherwise(F.array().cast("array<bigint>"))
    )


def sketch(word_array: Column, size: int = SHINGLE_WORDS, scale: int = SCALE) -> Column:
    """Sorted distinct hashes in the lowest 1/``scale`` of the range."""
    below = F.lit(-(1 << 63) + (1 << 64) // scale)
    return F.array_sort(F.array_distinct(F.filter(shingle_hashes(word_array, size), lambda h: h < below)))


def merged(a: Column, b: Column) -> Column:
    """The sketch of two documents together."""
    return F.array_sort(F.array_union(a, b))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the first document's shingles that the second has; null for an empty sketch."""
    return F.when(F.size(a) > 0, F.size(F.array_intersect(a, b)) / F.size(a))


def resemblance(a: Column, b: Column, same: Column) -> Column:
    """Estimated Jaccard similarity; ``same`` decides between two empty sketches."""
    common = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - common
    return F.when(union > 0, common / union).otherwise(F.when(same, 1.0).otherwise(0.0))


def fingerprint(sketch_column: Column) -> Column:
    """The sketch as text: hexadecimal hashes in order."""
    return F.array_join(F.transform(sketch_column, lambda h: F.hex(h)), " ")


def _range_of(value: Column, bounds: list[int]) -> Column:
    """How many bounds lie below the value, by binary search."""
    if not bounds:
        return F.lit(0)
    steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]
    array = F.lit(bounds).cast("array<bigint>")
    return F.aggregate(
        F.lit(steps),
        F.lit(0),
        lambda low, step: F.when(
            (low + step <= len(bounds)) & (F.get(array, low + step - 1) < value), low + step
        ).otherwise(low),
    )


def with_next(documents: DataFrame, columns: list[str], doc_id: str = "doc_id", ranges: int | None = None) -> DataFrame:
    """Every row with ``next_<column>`` of the following row by falling doc_id; the last is followed by the first."""
    spark = documents.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [k / ranges for k in range(1, ranges)]
    quantiles = F.percentile_approx(doc_id, shares, 10 * ranges) if shares else F.lit(None)
    bounds = sorted(set(documents.agg(quantiles.alias("q")).first()["q"] or []))
    at = F.when(F.col(doc_id).isNull(), F.lit(-1)).otherwise(_range_of(F.col(doc_id), bounds))

    firsts = {
        r["at"]: r["first"]
        for r in documents.select(at.alias("at"), F.col(doc_id)).groupBy("at").agg(F.max(doc_id).alias("first")).collect()
    }
    order = sorted(firsts, reverse=True)
    rows = documents.select("*", at.alias("__range"), F.lit(False).alias("__copy"))
    if not order:
        return rows.select(
            *documents.columns, *[F.col(c).alias(f"next_{c}") for c in columns]
        )
    before = {part: order[k - 1] for k, part in enumerate(order)}
    target = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])
    edges = [v for v in firsts.values() if v is not None]
    is_first = F.coalesce(F.col(doc_id).isin(edges), F.lit(False)) if edges else F.lit(False)
    copies = rows.where(is_first | F.col(doc_id).isNull()).withColumns(
        {"__range": F.element_at(target, F.col("__range")), "__copy": F.lit(True)}
    )
    follows = Window.partitionBy("__range").orderBy(
        F.col("__copy"), F.col(doc_id).desc_nulls_last(), F.col("__tie")
    )
    return (
        rows.unionByName(copies)
        .withColumn("__tie", F.xxhash64(*columns))
        .select("*", *[F.lead(c).over(follows).alias(f"next_{c}") for c in columns])
        .where(~F.col("__copy"))
        .drop("__range", "__copy", "__tie")
    )


def fingerprint_documents(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text, sketch`` of every row."""
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    return rows.withColumn("words", words(F.col("text"))).select("doc_id", "text", sketch(F.col("words")).alias("sketch"))


def edited_likeness(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each text against itself with the last half replaced from the next document, and against that document."""
    paired = with_next(fingerprint_documents(documents, doc_id, text), ["text", "sketch"])
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    with_edit = paired.select(
        "doc_id", "text", "sketch", "next_sketch",
        (F.col("text") == F.col("next_text")).alias("same_next"),
        n.cast("long").alias("n_chars"), edited.alias("edited"),
    )
    both = with_edit.withColumn("words", words(F.col("edited"))).select(
        "doc_id", "sketch", "next_sketch", "same_next", "n_chars",
        (F.col("text") == F.col("edited")).alias("same_edited"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        sketch(F.col("words")).alias("edited_sketch"),
    )
    own, changed, following = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return both.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprint(own).alias("fingerprint"),
        fingerprint(changed).alias("edited_fingerprint"),
        resemblance(own, changed, F.col("same_edited")).alias("near_edited"),
        resemblance(own, following, F.col("same_next")).alias("near_next"),
        containment(changed, own).alias("edited_contained"),
    )
