"""Merkle fingerprints of documents over sections and paragraphs, from DataFrame functions only.

A text is cut at line ends into paragraphs and a paragraph into pieces: up to six words, ending at a
punctuation mark. Leaves hash pieces, a paragraph's node hashes its leaves, a section's node hashes up
to eight paragraphs, and the root hashes the sections. Pieces cover the text without gaps, so equal
texts, and only those, have equal roots (up to hash collisions); where two trees differ, the first
differing section and paragraph locate the edit, and the share of common leaves is their likeness.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions

SECTION_PARAGRAPHS = 8
BUCKETS = 4  # ranges of ids for each shuffle partition
_PIECE = r"\s*(?:\S*[^\s.,!?;:|%*&#$]\s+){0,5}\S+\s*|\s+"


def paragraph_leaves(text: Column) -> Column:
    """For each paragraph the hashes of its pieces."""
    return F.transform(F.split(text, "\n", -1), lambda p: F.transform(F.regexp_extract_all(p, F.lit(_PIECE), F.lit(0)), lambda s: F.xxhash64(s)))


def paragraph_nodes(by_paragraph: Column) -> Column:
    return F.transform(by_paragraph, lambda leaves: F.sha2(F.array_join(F.transform(leaves, lambda x: F.hex(x)), ","), 256))


def section_nodes(nodes: Column) -> Column:
    starts = F.sequence(F.lit(1), F.size(nodes), F.lit(SECTION_PARAGRAPHS))
    return F.transform(starts, lambda i: F.sha2(F.array_join(F.slice(nodes, i, F.lit(SECTION_PARAGRAPHS)), ","), 256))


def root(sections: Column) -> Column:
    return F.sha2(F.array_join(sections, ","), 256)


def likeness(a: Column, b: Column) -> Column:
    """Share of common distinct leaves, 2|A & B| / (|A| + |B|); 1 for two trees without leaves."""
    total = F.size(a) + F.size(b)
    return F.when(total == 0, 1.0).otherwise(2.0 * F.size(F.array_intersect(a, b)) / total)


def first_difference(a: Column, b: Column) -> Column:
    """0-based place of the first differing entry of two lists; null if they are equal."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    place = F.array_position(same, False)
    return F.when(place > 0, place - 1)


def with_next(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` with ``next_text``, the text of the next row in descending doc_id (after the
    last the first); rows of one doc_id by descending text, rows without doc_id last.

    Ids are cut into ranges with about as many rows each, whatever their values; rows meet inside a range,
    and each range's last row meets the first one of the range below. Only the ranges, a fixed number for
    each shuffle partition, are ordered in one place.
    """
    parts = partitions(docs.sparkSession)
    n = BUCKETS * parts
    lowest = -(2**63)
    keyed = docs.select("doc_id", "text", F.coalesce("doc_id", F.lit(lowest)).alias("k"))
    cuts = keyed.agg(F.approx_percentile("k", F.array(*[F.lit((i + 1) / n) for i in range(n - 1)]), F.lit(10 * n)).alias("cuts")).first()["cuts"]
    cuts = sorted(set(cuts or []))  # n - 1 at most
    bucket = F.size(F.filter(F.array(*[F.lit(c).cast("long") for c in cuts]), lambda c: c < F.col("k"))) if cuts else F.lit(0)
    keyed = keyed.withColumn("bucket", bucket)
    heads = keyed.groupBy("bucket").agg(F.max(F.struct("k", "text")).alias("head")).select("bucket", F.col("head.text").alias("head_text"))
    ends = Window.orderBy(F.desc("bucket"))  # n rows at most
    after = heads.select("bucket", F.coalesce(F.lead("head_text").over(ends), F.first("head_text").over(ends)).alias("head_text"))
    order = Window.partitionBy("bucket").orderBy(F.desc("k"), F.desc("text"))
    rows = keyed.repartition(parts, "bucket").withColumn("next_text", F.lead("text").over(order))
    return rows.join(after, "bucket").select("doc_id", "text", F.coalesce("next_text", "head_text").alias("next_text"))


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """For each row of ``docs(doc_id, text)``: n_chars, the fingerprint of the text and of its edited text,
    the edited text's digest, and the likeness of the fingerprint to the edited one and to the next row's.

    The edited text has the last third of the characters replaced by as many of the first of the next
    row's text. A null text counts as empty; an empty text has one paragraph without leaves. The only row
    of a table is its own next. ``edit_section`` and ``edit_paragraph`` are the 0-based places where the trees
    first differ, null where they don't. Other columns are ignored; an empty table gives no rows.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    cut = F.expr("cast(floor(n_chars / 3) as int)")
    rows = with_next(texts).withColumn("n_chars", F.length("text")).withColumn("k", cut)
    rows = rows.withColumn("edited", F.concat(F.expr("substring(text, 1, n_chars - k)"), F.expr("substring(next_text, 1, k)")))
    for name, text in (("own", "text"), ("new", "edited")):
        rows = rows.withColumn(f"{name}_leaves", paragraph_leaves(F.col(text)))
        rows = rows.withColumn(f"{name}_paragraphs", paragraph_nodes(F.col(f"{name}_leaves")))
        rows = rows.withColumn(f"{name}_sections", section_nodes(F.col(f"{name}_paragraphs")))
    flat = lambda c: F.array_distinct(F.flatten(c))
    own = flat(F.col("own_leaves"))
    return rows.select(
        "doc_id",
        F.col("n_chars").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        root(F.col("own_sections")).alias("fingerprint"),
        root(F.col("new_sections")).alias("edited_fingerprint"),
        likeness(own, flat(F.col("new_leaves"))).alias("near_edited"),
        likeness(own, flat(paragraph_leaves(F.col("next_text")))).alias("near_next"),
        first_difference(F.col("own_sections"), F.col("new_sections")).alias("edit_section"),
        first_difference(F.col("own_paragraphs"), F.col("new_paragraphs")).alias("edit_paragraph"),
    )
