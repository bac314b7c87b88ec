"""Registered queries of the subpackage, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import score_toxicity

    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard_join import ngram_jaccard_join

    return ngram_jaccard_join(table(spark, sf_dir, "documents"))


OP2_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
sets AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY 1),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM sets a JOIN sets b USING (g) WHERE a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM met JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * i >= 75 * (x.n + y.n - i)),
ties AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, ties.b FROM reach JOIN ties ON reach.b = ties.a)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN (SELECT a, min(b) AS least FROM reach GROUP BY a) r ON r.a = d.doc_id
"""


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sentencepiece_codec import encode_digests

    return encode_digests(table(spark, sf_dir, "documents"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import find_leaks

    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chat_format import rotate_perspectives

    return rotate_perspectives(table(spark, sf_dir, "conversations"))


OP5_SQL = r"""
WITH t AS (
  SELECT conv_id::BIGINT AS conv_id, turn, coalesce(role, 'unknown') AS speaker,
    replace(replace(coalesce(text, ''), '<|im_start|>', '< |im_start|>'), '<|im_end|>', '< |im_end|>') AS body FROM conversations),
p AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> 'system'),
r AS (
  SELECT t.conv_id, perspective, turn, speaker, body,
    CASE WHEN speaker = perspective THEN 'assistant' WHEN speaker = 'system' THEN 'system' ELSE 'user' END AS role
  FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
h AS (SELECT *, '<|im_start|>' || role || CASE WHEN role = 'user' THEN ' name=' || replace(replace(translate(speaker, chr(13) || chr(10), '  '), '<|im_start|>', '< |im_start|>'), '<|im_end|>', '< |im_end|>') ELSE '' END || chr(10) AS head FROM r),
s AS (SELECT *, head || body || '<|im_end|>' || chr(10) AS segment FROM h),
w AS (
  SELECT *, row_number() OVER o - 1 AS seq, sum(length(segment)) OVER (o ROWS UNBOUNDED PRECEDING) AS end_at FROM s
  WINDOW o AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS LAST, speaker, body))
SELECT conv_id, perspective, seq::BIGINT AS seq, speaker, role, segment, (end_at - length(segment))::BIGINT AS start_at, end_at::BIGINT AS end_at,
  CASE WHEN speaker = perspective THEN (end_at - length(segment) + length(head))::BIGINT END AS mask_from,
  CASE WHEN speaker = perspective THEN (end_at - 1)::BIGINT END AS mask_until
FROM w
"""


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import score_quality

    return score_quality(table(spark, sf_dir, "documents"))


def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .merkle import fingerprint_edits

    return fingerprint_edits(table(spark, sf_dir, "documents"))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lm_scoring import lm_scores

    return lm_scores(table(spark, sf_dir, "documents"))


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secret_scan import secret_scan

    return secret_scan(table(spark, sf_dir, "documents"))


def op10_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .license_scan import scan_licenses

    return scan_licenses(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .manifest import manifest_digests

    return manifest_digests(table(spark, sf_dir, "documents"))


CRC_TABLE = "(SELECT list_transform(range(256), lambda x: list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, x)) AS t)"


def crc_sql(points: str) -> str:
    """Unsigned crc32 of the UTF-8 bytes of a list of code points below U+0100, with ``crc_table(t)`` joined."""
    step = "CASE WHEN b < 128 THEN [b] ELSE [192 + (b >> 6), 128 + (b & 63)] END"
    return f"xor(list_reduce(flatten(list_transform({points}, lambda b: {step})), lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8), 4294967295::BIGINT), 4294967295)"


def _op11_sql(levels: int = 6, tops: int = 3) -> str:
    """Level by level: nodes with their place; siblings left and right by windows; a tree of one node stays."""
    field = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c} END"
    leaf = lambda text: f"sha256({' || '.join(field(c) for c in ('doc_id', 'source', 'lang', 'n_chars'))} || {field(text)})"
    crc = crc_sql("list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)")
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    ctes = [
        f"crc_table AS MATERIALIZED {CRC_TABLE}",
        f"told AS (SELECT *, CASE WHEN {crc} % 5 = 0 THEN {lower} ELSE text END AS changed FROM documents, crc_table)",
        f"leaves AS (SELECT doc_id, coalesce('1' || source, '0') AS g, {leaf('text')} AS leaf, {leaf('changed')} AS claimed FROM told)",
        "l0 AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id, leaf) - 1 AS p0, leaf AS h0, claimed AS f0, '' AS proof0 FROM leaves)",
    ]
    # each row keeps its path: p is its ancestor's place, h that node's digest, f what the claimed leaf folds to
    for i in range(levels + tops):
        tree = "g" if i < levels else "1"
        if i == levels:
            ctes.append(f"s AS (SELECT *, dense_rank() OVER (ORDER BY g) - 1 AS place, h{i} AS subroot FROM l{i})")
        source, place = (f"l{i}", f"p{i}") if i < levels else ("s" if i == levels else f"l{i}", "place" if i == levels else f"p{i}")
        ctes.append(f"n{i} AS (SELECT DISTINCT {tree} AS tree, {place} AS p, h{i} AS h, count(*) OVER (PARTITION BY {tree}) AS n FROM (SELECT DISTINCT {tree} AS {'g' if i < levels else 'one'}, {place}, h{i} FROM {source}) x)".replace("DISTINCT 1 AS tree", "DISTINCT one AS tree").replace("PARTITION BY 1", "PARTITION BY one"))
        ctes.append(
            f"r{i} AS (SELECT tree, p, CASE WHEN n = 1 THEN h ELSE sha256(string_agg(h, '' ORDER BY p) OVER (PARTITION BY tree, p // 16)) END AS up, CASE WHEN n > 1 THEN coalesce(string_agg(h, '' ORDER BY p) OVER (PARTITION BY tree, p // 16 ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') END AS lft, CASE WHEN n > 1 THEN coalesce(string_agg(h, '' ORDER BY p) OVER (PARTITION BY tree, p // 16 ORDER BY p ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') END AS rgt FROM n{i})".replace(
                "string_agg(h, '' ORDER BY p) OVER", "string_agg(h, '') OVER"
            ).replace("OVER (PARTITION BY tree, p // 16))", "OVER (PARTITION BY tree, p // 16 ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))")
        )
        keep = "doc_id, g, leaf" + (", subroot" if i >= levels else "")
        ctes.append(f"l{i + 1} AS (SELECT {keep}, {place} // 16 AS p{i + 1}, up AS h{i + 1}, CASE WHEN lft IS NULL THEN f{i} ELSE sha256(lft || f{i} || rgt) END AS f{i + 1}, proof{i} || coalesce(lft || rgt, '') AS proof{i + 1} FROM {source} JOIN r{i} ON {'tree = g' if i < levels else 'true'} AND p = {place})")
    last = levels + tops
    return f"WITH {', '.join(ctes)} SELECT doc_id, leaf, subroot, h{last} AS root, sha256(proof{last}) AS proof_sha256, f{last} AS folded_root, f{last} = h{last} AS verified FROM l{last}"


OP11_SQL = _op11_sql()


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .spelling import spelling_variants

    return spelling_variants(table(spark, sf_dir, "documents"))


_RUN_CRC = crc_sql("list_transform(string_split(doc_id || ':' || run, ''), lambda x: unicode(x)::BIGINT)")
OP12_SQL = f"""
WITH RECURSIVE crc_table AS MATERIALIZED {CRC_TABLE},
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL),
hashed AS (SELECT run, n, {_RUN_CRC} AS h FROM counted, crc_table),
words AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n FROM (SELECT CASE WHEN h % 199 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
gaps AS MATERIALIZED (SELECT word, i, left(word, i::INT - 1) || substr(word, i::INT + 1) AS rest FROM words, LATERAL (SELECT unnest(range(1, length(word) + 1)) AS i)),
one AS (SELECT DISTINCT gaps.word AS a, words.word AS b FROM gaps JOIN words ON rest = words.word),
near AS (
  SELECT x.word AS a, y.word AS b FROM gaps x JOIN gaps y USING (i, rest) WHERE x.word <> y.word
  UNION SELECT a, b FROM one UNION SELECT b, a FROM one),
best AS (SELECT a AS word, count(*) AS n_near, max(n) AS m FROM near JOIN words ON b = word GROUP BY a),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * w.n THEN m END AS form_n,
    CASE WHEN m >= 5 * w.n THEN (SELECT min(encode(b)) FROM near JOIN words v ON v.word = b WHERE a = w.word AND v.n = m) END AS form_bytes
  FROM words w LEFT JOIN best ON best.word = w.word),
named AS (SELECT word, n, n_near, form_n, decode(form_bytes) AS form FROM forms),
walk AS (SELECT word, word AS at_word FROM named UNION SELECT walk.word, form FROM walk JOIN named ON at_word = named.word WHERE form IS NOT NULL)
SELECT named.word, form, at_word AS root, n, n_near, form_n
FROM named JOIN (SELECT walk.word, at_word FROM walk JOIN named ON at_word = named.word WHERE form IS NULL) r ON r.word = named.word
"""


def op13_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix_report

    return mix_report(table(spark, sf_dir, "documents"))


def _op13_sql() -> str:
    """The same weights, line of words, blocks and permutation; the shards, which don't change what is taken, are left out."""
    word = "4294967295::UBIGINT"
    mixed = f"((xor(s[2], (key + r * 2246822507) & {word}) * 2654435761::UBIGINT) & {word})"
    mixed = f"list_reduce([{mixed}, 0::UBIGINT], lambda x, z: (xor(x, x >> 15) * 739982445::UBIGINT) & {word})"
    turn = f"[s[2], xor(s[1], ({mixed} >> (32 - half)) & ((1::UBIGINT << half) - 1))]"
    step = lambda v: f"list_reduce(range(4)::UBIGINT[], lambda s, r: {turn}, [{v} >> half, {v} & ((1::UBIGINT << half) - 1)])"
    walked = lambda v: f"list_transform([{step(v)}], lambda p: (p[1] << half) | p[2])[1]"
    key = crc_sql("list_transform(string_split(g || '/' || pass, ''), lambda x: unicode(x)::BIGINT)")
    return f"""
WITH crc_table AS MATERIALIZED {CRC_TABLE},
sizes AS (SELECT doc_id, text, coalesce('1' || source, '2') AS g, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents),
lines AS (SELECT *, sum(size) OVER (PARTITION BY g ORDER BY doc_id, size, text ROWS UNBOUNDED PRECEDING) - size AS before, row_number() OVER (ORDER BY g, doc_id, size, text) AS id FROM sizes),
groups AS (SELECT g, sum(size)::BIGINT AS total, [5, 2, 1][((row_number() OVER (ORDER BY g) - 1) % 3)::INT + 1] AS w FROM sizes GROUP BY g),
levels AS (SELECT *, (1.5::DOUBLE * sum(total) OVER () - 2 * coalesce(sum(total) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM groups WINDOW o AS (ORDER BY total / w, g)),
targets AS (SELECT g, total, least(2::DOUBLE * total, w * coalesce((SELECT level FROM levels x WHERE x.w * x.level < 2 * x.total ORDER BY x.total / x.w, x.g LIMIT 1), 0)) AS target FROM levels),
blocked AS (SELECT *, greatest(1, least(256, total // 4096)) AS block FROM targets),
quotas AS (
  SELECT *, (total + block - 1) // block AS blocks, floor(target / greatest(1, total))::BIGINT AS passes FROM blocked),
quoted AS (SELECT *, passes * blocks + least(blocks, floor((target - passes * total) / block + 0.5)::BIGINT) AS quota FROM quotas),
pieces AS (
  SELECT id, g, before, size, block, blocks, quota, unnest(range((before // block)::BIGINT, ((before + size - 1) // block)::BIGINT + 1)) AS b FROM lines JOIN quoted USING (g) WHERE size > 0),
passed AS (SELECT *, greatest(1, (length(bin(blocks - 1)) + 1) // 2)::BIGINT AS half FROM pieces, (VALUES (0), (1)) v(pass)),
keys AS (SELECT g, pass, ({key})::UBIGINT AS key FROM (SELECT DISTINCT g, pass FROM passed), crc_table),
places AS (
  SELECT *, list_reduce(range(60)::UBIGINT[], lambda v, j: CASE WHEN v < blocks THEN v ELSE {walked('v')} END, {walked('b::UBIGINT')}) AS place
  FROM (SELECT DISTINCT g, pass, b, blocks, half, key FROM passed JOIN keys USING (g, pass))),
taken AS (
  SELECT id, sum(least(before + size, (b + 1) * block) - greatest(before, b * block)) AS taken
  FROM passed JOIN places USING (g, pass, b) WHERE pass * passed.blocks + place < quota GROUP BY id)
SELECT doc_id, size::BIGINT AS size, total AS source_size, target, coalesce(taken, 0)::BIGINT AS taken FROM lines JOIN quoted USING (g) LEFT JOIN taken USING (id)
"""


OP13_SQL = _op13_sql()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k.startswith("op") and callable(v)}


def oracle_sql() -> dict[str, str]:
    return {k: globals()[sql] for k in queries() if (sql := f"{k.split('_')[0].upper()}_SQL") in globals()}
