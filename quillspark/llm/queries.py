"""Queries over the training-data tables: one for each operator of this subpackage, with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    conversation_trie, decontaminate, e8_dedup, fill_middle, html_extract, language_id, license_scan, line_dedup, packing, piece_coding, quality_rules,
    simhash_dedup, suffix_dedup,
)
from .common import table


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), carry=["doc_id"])
    removed = F.col("n_bytes") - F.octet_length("kept")
    return out.select("doc_id", "n_bytes", removed.cast("long").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash_dedup.simhash_components(table(spark, sf_dir, "documents"))
    return out.select("doc_id", simhash_dedup.fingerprint_hex().alias("fingerprint"), "component_id")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return e8_dedup.dedup_embeddings(table(spark, sf_dir, "embeddings"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs.where(~language_id.held_out()))
    out = language_id.identify(docs, model, carry=["doc_id"])
    return out.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op9_piece_coding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_coding.code_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), carry=["doc_id"], clean=False)
    items = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), items.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.fill_in_middle(table(spark, sf_dir, "documents"), carry=["doc_id"], output=False, digests=True)


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = conversation_trie.turn_sequences(table(spark, sf_dir, "conversations"))
    return conversation_trie.prefix_trie(conversation_trie.spliced(turns)).drop("node")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_license_scan, op2_suffix_dedup, op3_packing, op4_html_extraction, op5_simhash_dedup, op6_quality_rules, op7_embedding_dedup, op8_language_id, op9_piece_coding, op10_line_dedup,
        op11_decontamination, op12_fill_middle, op13_conversation_trie,
    )
}

ORACLE_SQL = {
    "op2_suffix_dedup": """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
p AS (SELECT doc_id, x, unnest(range(0, greatest(length(x) // 2 - 49, 0))) AS a FROM d),
w AS (SELECT doc_id, a, substr(x, CAST(2 * a + 1 AS BIGINT), 100) AS v FROM p),
f AS (SELECT v, min(doc_id) AS m FROM w GROUP BY v),
hit AS (SELECT w.doc_id, w.a FROM w JOIN f USING (v) WHERE f.m < w.doc_id),
step AS (SELECT doc_id, a, CASE WHEN a - lag(a) OVER (PARTITION BY doc_id ORDER BY a) <= 50 THEN 0 ELSE 1 END AS new FROM hit),
isle AS (SELECT doc_id, a, sum(new) OVER (PARTITION BY doc_id ORDER BY a) AS g FROM step),
span AS (SELECT doc_id, g, min(a) AS a, max(a) + 50 AS b FROM isle GROUP BY doc_id, g),
edge AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS prev FROM span),
part AS (SELECT e.doc_id, string_agg(substr(d.x, CAST(2 * e.prev + 1 AS BIGINT), CAST(2 * (e.a - e.prev) AS BIGINT)), '' ORDER BY e.a) AS head, max(e.b) AS last,
  sum(e.b - e.a) AS gone, count(*) AS n FROM edge e JOIN d USING (doc_id) GROUP BY e.doc_id)
SELECT d.doc_id, CAST(length(d.x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(part.gone, 0) AS BIGINT) AS n_removed, CAST(coalesce(part.n, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(part.head || substr(d.x, CAST(2 * part.last + 1 AS BIGINT)), d.x))) AS kept_sha256
FROM d LEFT JOIN part USING (doc_id)""",
    "op7_embedding_dedup": """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE embedding IS NOT NULL),
u AS (SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS n FROM v
  WHERE len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  AND list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.95),
r AS (SELECT vec_id AS a, vec_id AS c FROM embeddings UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.a)
SELECT m.vec_id, (SELECT count(*) FROM l WHERE l.a = m.vec_id) AS n_links, m.c AS component_id, m.vec_id = m.c AS kept
FROM (SELECT a AS vec_id, min(c) AS c FROM r GROUP BY a) m""",
    "op10_line_dedup": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, string_split(text, chr(10)) AS l FROM documents),
p AS (SELECT doc_id, l, unnest(range(1, greatest(len(l) - 1, 1))) AS i FROM d),
w AS (SELECT doc_id, i, [l[i], l[i + 1], l[i + 2]] AS v FROM p
  WHERE length(trim(translate(l[i] || l[i + 1] || l[i + 2], chr(9) || chr(13), '  '))) > 0),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY v ORDER BY doc_id, i) AS k FROM w) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM later, (SELECT unnest([0, 1, 2]) AS k)),
sets AS (SELECT doc_id, list(i) AS g FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(len(l), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(g), 0) AS BIGINT) AS n_removed,
  sha256(CASE WHEN g IS NULL THEN text ELSE coalesce(array_to_string(list_transform(list_filter(range(1, len(l) + 1), lambda i: NOT list_contains(g, i)), lambda i: l[i]), chr(10)), '') END) AS kept_sha256
FROM d LEFT JOIN sets USING (doc_id)""",
    "op11_decontamination": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
s AS (SELECT item_id, w, least(10, len(w)) AS m FROM b WHERE len(w) > 0),
wins AS (SELECT DISTINCT item_id, m, list_slice(w, i, i + m - 1) AS v FROM (SELECT item_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM s)),
kinds AS (SELECT DISTINCT m FROM wins),
runs AS (SELECT doc_id, i, m, list_slice(w, i, i + m - 1) AS v FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, kinds)),
hit AS (SELECT runs.doc_id, runs.i, runs.m, wins.item_id FROM runs JOIN wins ON runs.m = wins.m AND runs.v = wins.v),
words AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + m)) AS j FROM (SELECT DISTINCT doc_id, i, m FROM hit)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(t, ',' ORDER BY t) AS t FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS t FROM hit WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(words.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(items.n, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items.t, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op12_fill_middle": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
  regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u FROM documents),
g AS (SELECT doc_id, t, u, len(u) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
  CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
f AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM g),
p AS (SELECT doc_id, t, n, form, coalesce(array_to_string(list_slice(u, 1, a), ''), '') AS x, coalesce(array_to_string(list_slice(u, a + 1, b), ''), '') AS y,
  coalesce(array_to_string(list_slice(u, b + 1, n), ''), '') AS z FROM f)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(x) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(y) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || x || '<S>' || z || '<M>' || y ELSE '<S>' || z || '<P>' || x || '<M>' || y END) AS output_sha256, sha256(t) AS restored_sha256
FROM p""",
    "op13_conversation_trie": r"""
WITH bits AS (SELECT list_transform(range(0, 256), lambda i: list_reduce(list_concat([CAST(i AS BIGINT)], [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
own AS (SELECT conv_id AS c, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS s FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT c, s, c - c % 100 AS b, xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda v, x: xor(v >> 8, tab[xor(v & 255, x) + 1])), 4294967295) % 6 AS h FROM own, bits),
r AS (SELECT h.c, list_concat(coalesce(list_slice(o.s, 1, h.h), []), coalesce(list_slice(h.s, h.h + 1, len(h.s)), [])) AS s FROM h LEFT JOIN own o ON o.c = h.b),
p AS (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM r),
q AS (SELECT c, d, list_slice(s, 1, d) AS k, len(s) = d AS ends, CASE WHEN d > 0 THEN length(s[d].t) ELSE 0 END AS chars FROM p),
node AS (SELECT d, k, min(c) AS c, count(*) AS n, max(chars) AS chars, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends) AS ids FROM q GROUP BY d, k),
kids AS (SELECT d - 1 AS d, list_slice(k, 1, d - 1) AS k, count(*) AS n FROM node WHERE d > 0 GROUP BY 1, 2),
whole AS (SELECT node.*, coalesce(kids.n, 0) AS children FROM node LEFT JOIN kids ON kids.d = node.d AND kids.k = node.k),
up AS (SELECT u.d, list_slice(whole.k, 1, u.d) AS k, count(*) FILTER (children = 0) AS leaves, sum((whole.n - 1) * chars) AS saved
  FROM whole JOIN (SELECT DISTINCT d FROM node) u ON u.d <= whole.d GROUP BY 1, 2)
SELECT whole.c AS conv_id, whole.d AS depth, par.c AS parent_conv_id, CAST(whole.n AS BIGINT) AS n_convs, CAST(whole.children AS BIGINT) AS n_children, CAST(up.leaves AS BIGINT) AS n_leaves,
  CAST(up.saved AS BIGINT) AS saved_tokens, sha256(coalesce(whole.ids, '')) AS ends_sha256
FROM whole JOIN up ON up.d = whole.d AND up.k = whole.k LEFT JOIN whole par ON par.d = whole.d - 1 AND par.k = list_slice(whole.k, 1, whole.d - 1)""",
}
