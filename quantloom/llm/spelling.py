"""Spelling variants: frequent words that differ by one code point, and the form each most likely stands for.

Pairs are found by asymmetric chunks. The shorter word of a pair is cut into two disjoint chunks; of the
longer one, the grams of the same length within shift one of a chunk's place are taken (the chunk before an
edit keeps its place, the chunk behind it moves by the difference of lengths). One edit leaves one chunk
whole, so both words share a key; what meets is verified. Keys with very many words are split again: the
edited half is cut into two chunks in its turn, and the key holds both whole ones, until a piece is one code
point long. So no pair is lost and no key keeps more words than an alphabet has pairs of letters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import forget, saved
from .manifest import lower_ascii

RUN = r"[A-Za-zÀ-ÿ]+"
MIN_LENGTH, MIN_COUNT = 6, 5
SLIP_MODULO = 199
RATIO = 5
MOST_MET = 10_000  # candidates of a key above which its words get longer keys


def occurrences(docs: DataFrame) -> DataFrame:
    """The words of the texts, a row each, with the slips that stand for misspellings: where 199 divides the crc32
    of ``<doc_id>:<run>``, the run loses the code point at (crc32 modulo its length). Null ids count as empty."""
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(lower_ascii(F.col("text").cast("string")), F.lit(RUN), F.lit(0))).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    slipped = F.concat(F.expr("substring(run, 1, cast(h % length(run) as int))"), F.expr("substring(run, cast(h % length(run) as int) + 2)"))
    return runs.withColumn("h", h).select(F.when(F.col("h") % SLIP_MODULO == 0, slipped).otherwise(F.col("run")).alias("word"))


def vocabulary(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words that are long and frequent enough."""
    words = occurrences(docs).where(F.length("word") >= min_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def _bound(piece: Column, pieces: Column, length: Column) -> Column:
    """Where a piece begins, if a word of ``length`` is cut into ``pieces`` chunks."""
    return F.floor(piece * length / pieces).cast("int")


def _keys(rows: DataFrame) -> DataFrame:
    """``rows(word, cut, pieces, piece)`` with the key: all chunks of a word of length ``cut`` but the edited ``piece``.

    ``cut`` is the shorter word's length, so a longer word's chunks behind the edit stand one place further.
    """
    start, end = _bound(F.col("piece"), F.col("pieces"), F.col("cut")), _bound(F.col("piece") + 1, F.col("pieces"), F.col("cut"))
    rows = rows.withColumn("a_", start).withColumn("b_", end + F.length("word") - F.col("cut"))
    before, behind = F.expr("substring(word, 1, a_)"), F.expr("substring(word, b_ + 1)")
    key = F.concat_ws(",", F.col("cut").cast("string"), F.col("pieces").cast("string"), F.col("piece").cast("string"), before, behind)
    return rows.withColumn("key", key).drop("a_", "b_")


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b), a pair once, of words in ``words(word)`` that differ by one inserted, deleted or replaced code point."""
    length = F.length("word")
    both = F.explode(F.array(F.lit(0), F.lit(1))).alias("piece")
    chunks = words.select("word", F.lit(True).alias("short"), length.alias("cut"), F.lit(2).alias("pieces"), both)
    grams = words.select("word", F.lit(False).alias("short"), F.explode(F.array(length - 1, length)).alias("cut"), F.lit(2).alias("pieces")).select("*", both)
    rows = saved(_keys(chunks.unionByName(grams)), "chunks")
    found = None
    while True:
        counts = rows.groupBy("key").agg(F.count_if("short").alias("r"), F.count_if(~F.col("short")).alias("s"), F.max(F.expr("cut > pieces")).alias("more"))
        met = counts.where("r > 0 AND s > 0").withColumn("split", F.col("more") & (F.col("r") * F.col("s") > MOST_MET))
        met = saved(met.select("key", "split"), "met")
        now = rows.join(met.where("NOT split"), "key")
        left, right = now.where("short").select("key", F.col("word").alias("a")), now.where("NOT short").select("key", F.col("word").alias("b"))
        apart = (F.length("a") < F.length("b")) | (F.col("a") < F.col("b"))
        pairs = left.join(right, "key").where(apart & (F.levenshtein("a", "b", 1) == 1)).select("a", "b")
        pairs = saved(pairs, "pairs")
        found = pairs if found is None else found.unionByName(pairs)
        last = rows
        if met.where("split").isEmpty():
            forget(last, met)
            return found.distinct()
        again = rows.join(met.where("split").select("key"), "key").drop("key").withColumn("pieces", F.col("pieces") * 2)
        rows = saved(_keys(again.select("word", "short", "cut", "pieces", F.explode(F.array(F.col("piece") * 2, F.col("piece") * 2 + 1)).alias("piece"))), "chunks")
        forget(last, met)


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for each row of ``forms(word, form)``: the last word that forms lead to. Each round doubles the
    hops; forms grow in count fivefold at least, so there are few."""
    at = saved(forms.select("word", F.coalesce("form", "word").alias("root")), "roots")
    while True:
        ahead = at.where("word <> root").select(F.col("word").alias("root"), F.col("root").alias("next"))
        last, at = at, saved(at.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        moved = not at.where("moved").isEmpty()
        at = at.drop("moved")
        forget(last)
        if not moved:
            return at


def spelling_variants(docs: DataFrame) -> DataFrame:
    """For each frequent word of ``docs(doc_id, text)``: n, how many near words it has, the form it stands for (its
    most frequent near word, if five times as frequent; ties to the first in code-point order), that form's n, and
    the root that forms lead to.

    Only A-Z are lower-cased, so accented capitals are letters of their own. Null and empty texts have no words; a
    text without end is one row of runs. Repeated rows count each time; null ids have the empty text as id. Other
    columns are ignored; an empty table gives no rows.
    """
    words = saved(vocabulary(docs), "vocabulary")
    pairs = saved(near_pairs(words.select("word")), "near")
    either = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    met = either.join(words.select(F.col("word").alias("b"), "n"), "b")
    best = met.groupBy(F.col("a").alias("word")).agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n")).alias("m"), F.col("b"))).alias("best"))
    forms = words.join(best, "word", "left")
    likely = F.col("best.m") * -1 >= RATIO * F.col("n")
    forms = saved(forms.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(likely, F.col("best.b")).alias("form"), F.when(likely, -F.col("best.m")).alias("form_n")), "forms")
    return forms.join(roots(forms), "word").select("word", "form", "root", "n", "n_near", "form_n")
