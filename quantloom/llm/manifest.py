"""Merkle manifest of a dataset: a digest a document, a subroot a source, one root, and a proof for each leaf.

A leaf hashes a document's fields. Per source the leaves stand by doc_id; 16 consecutive nodes become one
until one is left, the subroot; the subroots, by source, grow the same way to the root. Proofs come by
pointer jumping: every inner node holds its siblings on the way to an ancestor, left and right ones
apart, and joins of the nodes with themselves double the distance and concatenate the segments until the
ancestor is the root. A run of 16 leaves is one row, so its leaves take their last hop without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import forget, id_bucket, join_by_key, saved
from .places import Places

FAN_OUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_MODULO = 5
_HEX = 64
_SEGMENTS = "array<struct<left:string,right:string>>"


def leaf_digest(fields: dict[str, Column]) -> Column:
    """Hash of the five fields, each as ``-`` if null, else as its UTF-8 byte count, ``:`` and its value."""
    parts = []
    for name in FIELDS:
        text = fields[name].cast("string")
        parts.append(F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)))
    return F.sha2(F.concat(*parts), 256)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tampered(fields: dict[str, Column]) -> dict[str, Column]:
    """The fields with the text's A-Z lower-cased, in the rows that are tampered with; null ids count as the empty text."""
    changed = F.when(id_bucket() % TAMPER_MODULO == 0, lower_ascii(fields["text"].cast("string"))).otherwise(fields["text"])
    return fields | {"text": changed}


def _join(digests: Column) -> Column:
    return F.array_join(digests, "")


def _grow(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The next level over ``nodes(tree, level, pos, n, digest, key)``, and the links ``(key, up, segment)`` to it.

    ``n`` is the number of nodes of the tree on the level. ``key`` is what a link calls the node.
    """
    member = F.struct("pos", "digest", "key")
    runs = nodes.groupBy("tree", F.expr(f"pos div {FAN_OUT}").alias("pos")).agg(F.array_sort(F.collect_list(member)).alias("members"), F.first("level").alias("level"), F.first("n").alias("n"))
    runs = runs.select("tree", (F.col("level") + 1).alias("level"), "pos", F.expr(f"(n + {FAN_OUT - 1}) div {FAN_OUT}").alias("n"), "members")
    runs = runs.withColumn("key", F.struct("tree", "level", "pos")).withColumn("all_", _join(F.col("members.digest")))
    runs = saved(runs.withColumn("digest", F.sha2("all_", 256)), "runs")
    links = runs.select("all_", F.col("key").alias("up"), F.posexplode("members").alias("i", "m"))
    return runs.drop("members", "all_"), links.select(F.col("m.key").alias("key"), "up", F.array(_segment()).alias("segments"))


def _segment() -> Column:
    return F.struct(F.expr(f"substring(all_, 1, i * {_HEX})").alias("left"), F.expr(f"substring(all_, (i + 1) * {_HEX} + 1)").alias("right"))


def _most(nodes: DataFrame) -> int:
    return nodes.agg(F.max("n")).first()[0] or 0


def _jump(nodes: DataFrame, depth: int) -> DataFrame:
    """``nodes(key, up, segments, subroot, root)`` once all are led to the root, at most ``depth`` links away.

    Ancestors near the root are met by very many nodes; ``join_by_key`` deals those out.
    """
    reach = 1
    while reach < depth:
        waiting = nodes.where("up IS NOT NULL")
        met = waiting.groupBy("up").agg(F.count(F.lit(1)).alias("rows_"))
        ahead = nodes.select(F.col("key").alias("up"), F.col("up").alias("up2"), F.col("segments").alias("more"), F.col("subroot").alias("subroot2"), F.col("root").alias("root2"))
        ahead = saved(ahead.join(met, "up"), "ahead")
        led = join_by_key(waiting, ahead, "up").select("key", F.col("up2").alias("up"), F.concat("segments", "more").alias("segments"), F.coalesce("subroot", "subroot2").alias("subroot"), F.coalesce("root", "root2").alias("root"))
        last, nodes = nodes, saved(led.unionByName(nodes.where("up IS NULL")), "nodes")
        forget(last, ahead)
        reach *= 2
    return nodes


def manifest_proofs(docs: DataFrame, altered: dict[str, Column] | None = None) -> DataFrame:
    """For each row of ``docs`` (with the columns FIELDS): doc_id, leaf, subroot, root, its ``proof`` and ``claimed``.

    ``proof`` has the left and right siblings, level by level from the leaf's run to the root; a level whose
    tree has one node has none. ``claimed`` is the leaf of the fields as ``altered`` (the stored ones if not given).
    Leaves stand by doc_id, null first, rows of one doc_id by leaf; sources bytewise, null first. Equal rows
    are leaves of their own. Empty and null texts differ. An empty table gives no rows; other columns are ignored.
    """
    fields = {c: F.col(c) for c in FIELDS}
    group = F.when(F.col("source").isNull(), "0").otherwise(F.concat(F.lit("1"), F.col("source").cast("string")))
    leaves = saved(docs.select(F.col("doc_id").cast("long").alias("doc_id"), group.alias("g_"), leaf_digest(fields).alias("leaf"), leaf_digest(altered or fields).alias("claimed")), "leaves")
    places = Places(leaves, "g_", ["doc_id", "leaf"])
    forget(leaves)
    member = F.struct("pos_", "doc_id", "leaf", "claimed")
    runs = places.rows().groupBy(F.col("rank_").alias("tree"), F.expr(f"pos_ div {FAN_OUT}").alias("pos")).agg(F.array_sort(F.collect_list(member)).alias("members"), F.first("group_rows_").alias("leaves"))
    runs = runs.withColumn("level", F.lit(1)).withColumn("n", F.expr(f"(leaves + {FAN_OUT - 1}) div {FAN_OUT}")).withColumn("all_", _join(F.col("members.leaf")))
    runs = runs.withColumn("key", F.struct("tree", "level", "pos")).withColumn("digest", F.when(F.col("leaves") > 1, F.sha2("all_", 256)).otherwise(F.col("all_")))
    runs = saved(runs, "runs")
    places.forget()

    level = runs.select("tree", "level", "pos", "n", "digest", "key")
    levels, links, depth = [level], [], 1
    while _most(level) > 1:
        level, up = _grow(level.where("n > 1"))
        levels.append(level)
        links.append(up)
        depth += 1
    tops = [x.where("n = 1") for x in levels]
    subroots = tops[0]
    for x in tops[1:]:
        subroots = subroots.unionByName(x)
    subroots = saved(subroots, "subroots")
    sources = subroots.count()
    level = subroots.select(F.lit(-1).cast("long").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("pos"), F.lit(sources).cast("long").alias("n"), "digest", "key")
    while _most(level) > 1:
        level, up = _grow(level)
        levels.append(level)
        links.append(up)
        depth += 1

    held = None
    for x in levels:
        held = x.select("key", "tree", "n", "digest") if held is None else held.unionByName(x.select("key", "tree", "n", "digest"))
    held = held.select("key", F.when((F.col("n") == 1) & (F.col("tree") >= 0), F.col("digest")).alias("subroot"), F.when((F.col("n") == 1) & ((F.col("tree") < 0) | F.lit(sources == 1)), F.col("digest")).alias("root"))
    if links:
        joined = links[0]
        for x in links[1:]:
            joined = joined.unionByName(x)
        nodes = held.join(joined, "key", "left")
    else:
        nodes = held.withColumn("up", F.lit(None).cast("struct<tree:bigint,level:int,pos:bigint>")).withColumn("segments", F.lit(None).cast(_SEGMENTS))
    nodes = nodes.select("key", "up", F.coalesce("segments", F.array().cast(_SEGMENTS)).alias("segments"), "subroot", "root")
    nodes = _jump(saved(nodes, "nodes"), depth)

    out = runs.select("key", "leaves", "all_", "members").join(nodes.drop("up"), "key")
    out = out.select("leaves", "all_", "segments", "subroot", "root", F.posexplode("members").alias("i", "m"))
    proof = F.when(F.col("leaves") > 1, F.concat(F.array(_segment()), F.col("segments"))).otherwise(F.col("segments"))
    return out.select(F.col("m.doc_id").alias("doc_id"), F.col("m.leaf").alias("leaf"), "subroot", "root", proof.alias("proof"), F.col("m.claimed").alias("claimed"))


def proof_digest(proof: Column) -> Column:
    """Hash of a proof's siblings from left to right, level by level."""
    return F.sha2(_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"]))), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof lead to."""
    return F.aggregate(proof, leaf, lambda x, s: F.sha2(F.concat(s["left"], x, s["right"]), 256))


def manifest_digests(docs: DataFrame) -> DataFrame:
    """Leaf, subroot, root and proof of each row, and whether its leaf still leads to the root once every fifth text
    (by the id's crc32) has lost its capitals. Nulls, ties and empty tables: see ``manifest_proofs`` and ``tampered``."""
    proofs = manifest_proofs(docs, tampered({c: F.col(c) for c in FIELDS}))
    out = proofs.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), folded(F.col("claimed"), F.col("proof")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
