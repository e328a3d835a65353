"""The dealt operators on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowguard.llm import (bytebpe, decontaminate, jaccard, langid, pieces, preferences, quality, repair, runs, suffixes, surrogates,
                           tokenfile, toxicity)
from flowguard.llm.common import delete_at_exit
from flowguard.llm.registry import ORACLES, QUERIES, query, table  # noqa: F401
from flowguard.session import shared_dir

END_ID = 2


def vocabulary(name: str) -> str:
    """A public tokenizer file; the package lies on every machine."""
    import public_tokenizers
    return public_tokenizers.path(name)

@query("op2_jaccard")
def op2(spark, sf):
    return jaccard.similar_documents(table(spark, sf, "documents"))


@query("op3_suffix_dedup")
def op3(spark, sf):
    return suffixes.digests(suffixes.remove_repeats(table(spark, sf, "documents")))


OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_replace(x, '[\x20\x09-\x0D]+', '', 'g') <> '') AS l
  FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(w) - 3)) AS i, w FROM d WHERE len(w) >= 5),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i+1], w[i+2], w[i+3], w[i+4]) AS n FROM p),
r AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM g, (SELECT unnest(range(0, 5)) AS k) o WHERE g.n > 1 GROUP BY doc_id),
b AS (
  SELECT d.doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words, len(l) AS n_lines,
         len(list_filter(w, lambda x: regexp_matches(x, '\p{L}'))) AS n_letter_words
  FROM d LEFT JOIN r ON r.doc_id = d.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR 10 * n_symbols > n_words
            OR 2 * n_dup_lines > n_lines OR word_chars < 2 * n_words OR word_chars > 15 * n_words
            OR 10 * n_letter_words < 6 * n_words) AS kept
FROM b
"""


#: Key of the surrogates in the queries; a user keeps an own one secret.
SURROGATE_KEY = "example key"


@query("op1_surrogates")
def op1(spark, sf):
    docs = table(spark, sf, "documents")
    found = surrogates.count_entities(F.col("text"))
    counted = docs.select("doc_id", "text", found.alias("n_entities"))
    return surrogates.replace_entities(counted, SURROGATE_KEY)


@query("op4_quality_rules", OP4_SQL)
def op4(spark, sf):
    return quality.quality_rules(table(spark, sf, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op8_token_files")
def op8(spark, sf):
    folder = shared_dir(spark, "tokens")
    delete_at_exit(spark, folder)
    tokenfile.write_tokens(table(spark, sf, "documents"), folder, vocabulary("word_bpe_49k.json"), END_ID)
    return tokenfile.read_tokens(spark, folder).select(
        "doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


@query("op10_pieces")
def op10(spark, sf):
    return pieces.digests(pieces.encode_pieces(table(spark, sf, "documents"), vocabulary("piece_bpe_32k.model")))


OP5_SQL = r"""
WITH c AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
q AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, list_slice(w, i, i + least(10, len(w)) - 1) AS p, least(10, len(w)) AS k
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM q WHERE len(w) > 0)),
lens AS (SELECT DISTINCT k FROM win),
dw AS (
  SELECT doc_id, i, k, list_slice(w, i, i + k - 1) AS p
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM c, lens WHERE len(w) >= k)),
hit AS (SELECT dw.doc_id, dw.i, dw.k, win.item_id FROM dw JOIN win ON win.p = dw.p),
h AS (SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS place FROM hit) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS l
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT c.doc_id, len(c.w) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(it.n, 0) AS n_items,
       sha256(coalesce(it.l, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM c LEFT JOIN h ON h.doc_id = c.doc_id LEFT JOIN it ON it.doc_id = c.doc_id
"""


@query("op5_decontaminate", OP5_SQL)
def op5(spark, sf):
    found = decontaminate.match_phrases(decontaminate.build_index(table(spark, sf, "documents")),
                                        table(spark, sf, "benchmark"))
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    hit = decontaminate.n_hit()
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


@query("op6_toxicity")
def op6(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = toxicity.fit(docs, labels.filter(langid.fold("doc_id", 5) != 0))
    found = toxicity.score(docs, model)
    return found.select("doc_id", (langid.fold("doc_id", 5) == 0).alias("held_out"), "score",
                        (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op7_language")
def op7(spark, sf):
    docs = table(spark, sf, "documents")
    model = langid.fit(docs.filter(langid.fold("doc_id", 3) != 1))
    found = langid.predict(docs, model)
    return found.select("doc_id", (langid.fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


OP9_SQL = """
WITH t AS (
  SELECT conv_id, coalesce(role, 'user') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
ends AS (SELECT conv_id, min(i) AS a, max(i) AS z FROM t WHERE role = 'assistant' GROUP BY conv_id HAVING min(i) < max(i)),
said AS (SELECT e.conv_id, e.z, t.text AS first_text FROM ends e JOIN t ON t.conv_id = e.conv_id AND t.i = e.a),
both_there AS (SELECT conv_id // 2 AS k FROM t GROUP BY 1 HAVING count(DISTINCT conv_id) = 2),
p AS (
  SELECT 'own-' || t.conv_id AS pair_id, 'c' AS side, i, role, text FROM t JOIN said ON said.conv_id = t.conv_id
  UNION ALL
  SELECT 'own-' || t.conv_id, 'r', i, role, CASE WHEN i = z THEN first_text ELSE text END FROM t JOIN said ON said.conv_id = t.conv_id
  UNION ALL
  SELECT 'next-' || k, CASE WHEN conv_id % 2 = 0 THEN 'c' ELSE 'r' END, i, role, text FROM t JOIN both_there ON k = conv_id // 2),
sizes AS (SELECT pair_id, count(*) FILTER (side = 'c') AS nc, count(*) FILTER (side = 'r') AS nr FROM p GROUP BY pair_id),
same AS (
  SELECT a.pair_id, a.i FROM p a JOIN p b ON a.pair_id = b.pair_id AND a.i = b.i AND a.role = b.role AND a.text = b.text
  WHERE a.side = 'c' AND b.side = 'r'),
com AS (
  SELECT s.pair_id, coalesce(max(x.i), 0) AS n, any_value(nc) AS nc, any_value(nr) AS nr FROM sizes s
  LEFT JOIN (SELECT pair_id, i, row_number() OVER (PARTITION BY pair_id ORDER BY i) AS r FROM same) x
    ON x.pair_id = s.pair_id AND x.i = x.r GROUP BY s.pair_id),
r AS (
  SELECT p.pair_id, side, i, n, role, '<|' || role || '|>' || chr(10) AS h,
         '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS s
  FROM p JOIN com ON com.pair_id = p.pair_id),
w AS (SELECT *, sum(length(s)) OVER (PARTITION BY pair_id, side ORDER BY i) AS z FROM r WHERE i > n),
o AS (
  SELECT pair_id, string_agg(s, '' ORDER BY i) FILTER (side = 'c') AS c, string_agg(s, '' ORDER BY i) FILTER (side = 'r') AS r,
         string_agg(CAST(z - length(s) + length(h) AS VARCHAR) || '-' || CAST(z AS VARCHAR), ',' ORDER BY i)
           FILTER (side = 'c' AND role = 'assistant') AS cm,
         string_agg(CAST(z - length(s) + length(h) AS VARCHAR) || '-' || CAST(z AS VARCHAR), ',' ORDER BY i)
           FILTER (side = 'r' AND role = 'assistant') AS rm
  FROM w GROUP BY pair_id),
f AS (SELECT pair_id, string_agg(s, '' ORDER BY i) AS t FROM r WHERE i <= n AND side = 'c' GROUP BY pair_id)
SELECT com.pair_id, CAST(com.n AS INTEGER) AS n_common, coalesce(o.c, '') <> coalesce(o.r, '') AS differs,
       sha256(coalesce(f.t, '')) AS prompt_sha256, sha256(coalesce(o.c, '')) AS chosen_sha256,
       sha256(coalesce(o.r, '')) AS rejected_sha256, coalesce(o.cm, '') AS chosen_mask, coalesce(o.rm, '') AS rejected_mask
FROM com LEFT JOIN o ON o.pair_id = com.pair_id LEFT JOIN f ON f.pair_id = com.pair_id
"""


@query("op9_preferences", OP9_SQL)
def op9(spark, sf):
    talks = preferences.conversations(table(spark, sf, "conversations"))
    made = preferences.format_preferences(preferences.retold(talks).unionByName(preferences.neighbours(talks)))
    mask = lambda c: F.array_join(F.transform(c, lambda s: F.concat(
        s["start"].cast("string"), F.lit("-"), s["end"].cast("string"))), ",")
    return made.select("pair_id", "n_common", "differs", F.sha2("prompt", 256).alias("prompt_sha256"),
                       F.sha2("chosen", 256).alias("chosen_sha256"), F.sha2("rejected", 256).alias("rejected_sha256"),
                       mask("chosen_mask").alias("chosen_mask"), mask("rejected_mask").alias("rejected_mask"))


@query("op13_periodic_runs")
def op13(spark, sf):
    return runs.digests(runs.periodic_runs(table(spark, sf, "documents"), prepare=runs.planted))


@query("op12_byte_bpe")
def op12(spark, sf):
    import public_tokenizers
    path = vocabulary("byte_bpe_50k.tiktoken")
    encoded = bytebpe.encode_bytes(table(spark, sf, "documents"), path, public_tokenizers.PATTERN)
    return bytebpe.digests(bytebpe.decode_bytes(encoded, path))


@query("op11_repair")
def op11(spark, sf):
    return repair.summaries(repair.repair_conversations(repair.damaged(table(spark, sf, "conversations"))))
