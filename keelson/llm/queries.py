"""Registered queries of the operators, and their SQL where SQL can express them.

Every query runs its operator with production parameters over its whole table and
derives the digest columns of its contract from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.llm import chat, counts, embeddings, html, mixing, packing, pii, quality, ranked, repair, sentencepieces, simhash, urls
from keelson.llm.common import table

#: Vocabulary files of public tokenizers, by the folder's own lookup.
BPE_RANKS = "byte_bpe_50k.tiktoken"
PIECES = "piece_bpe_32k.model"

RULES = [
    urls.Rule("allow", "com", "/"),
    urls.Rule("block", "example.com", "/en/"),
    urls.Rule("allow", "www.example.com", "/en/"),
    urls.Rule("block", "net", "/es/"),
    urls.Rule("block", "net", "/fr/"),
]


def vocabulary(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def bpe_ranks(path: str | None = None) -> bytes:
    with open(path or vocabulary(BPE_RANKS), "rb") as f:
        return f.read()


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.quality_report(table(spark, sf_dir, "documents"))
    counted = [F.col(f"_q.{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return out.select("doc_id", *counted, "base_failed", "kept")


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken, _ = mixing.mix_sources(table(spark, sf_dir, "documents"))
    each = mixing.shares(taken)
    return each.select("doc_id", "size", "source_size", "target", "taken", "copies").withColumn("_", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("doc_id", "size", "source_size", "target", "taken")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.url_filter(table(spark, sf_dir, "pages"), RULES).select("page_id", "host", "path", "rule", "verdict")


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.simhash_components(table(spark, sf_dir, "documents"))
    return out.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.count_tokens(table(spark, sf_dir, "documents"), counts.load_pieces(vocabulary(PIECES)))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = pii.find_pii(docs)
    n = lambda kind: F.size(F.filter("base_spans", lambda x: x.kind == pii.KINDS.index(kind))).cast("long").alias(f"n_{kind}")
    return out.select("doc_id", *map(n, pii.PATTERNS), F.sha2(pii.written(F.col("base_spans")), 256).alias("base_sha256"), pii.written(F.col("all_spans")).alias("spans"))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    chats = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(chat.format_turns(chats.unionByName(more)))


def op8_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_pages(table(spark, sf_dir, "pages"))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), bpe_ranks())


def piece_digests(docs: DataFrame, model: bytes) -> DataFrame:
    """Number and digest of each row's ids, and the digest of the text they decode to."""
    out = sentencepieces.decode(sentencepieces.encode(docs, model), model)
    written = F.array_join(F.transform("ids", lambda i: i.cast("string")), ",")
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(written, 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_conversations(repair.damage(table(spark, sf_dir, "conversations")))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(table(spark, sf_dir, "documents"), sentencepieces.load_model(vocabulary(PIECES)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_mix_sources,
        op3_url_filter,
        op4_simhash_dedup,
        op5_token_counts,
        op6_pii,
        op7_chat_format,
        op8_html_extract,
        op9_embedding_dedup,
        op10_packing,
        op11_conversation_repair,
        op12_ranked_search,
        op13_sentencepiece,
    )
}

#: Only what SQL can state in full: fitted models, graph iterations, hash functions
#: that SQL engines lack and tokenizers are tested against plain versions instead.
ORACLE: dict[str, str] = {
    # the shuffle's order restated, blocks and slots replaced by plain arithmetic
    "op2_mix_sources": r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    CAST('0x' || substr(md5(concat_ws(chr(31), doc_id, source, text)), 1, 15) AS BIGINT) AS h
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 2.0 * sum(size) AS cap,
    CAST([3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS w
  FROM d GROUP BY source),
capped AS (
  SELECT coalesce(sum(cap) OVER before, 0) AS fixed, sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free
  FROM s WINDOW before AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT max((1.5 * (SELECT sum(source_size) FROM s) - fixed) / free) AS l FROM capped),
t AS (SELECT source, source_size, least(cap, CAST(l AS DOUBLE) * w) AS target FROM s, level),
line AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY h % (SELECT greatest(1, count(*) // 4096) FROM d), h, doc_id) - size AS start FROM d),
k AS (
  SELECT doc_id, size, source_size, target, start, CAST(floor(target) AS BIGINT) // greatest(source_size, 1) AS whole,
    CAST(floor(target) AS BIGINT) % greatest(source_size, 1) AS rest
  FROM line JOIN t ON line.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, CAST(target AS DOUBLE) AS target,
  CAST(whole * size + greatest(0, least(start + size, rest) - start) AS BIGINT) AS taken
FROM k
""",
    "op7_chat_format": r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
  SELECT *, length(regexp_replace(replace(text, chr(92), chr(92) || chr(92)),
    '(<)(\||s>|/s>|<SYS>>|</SYS>>|start_of_turn>|end_of_turn>)|(\[)(INST\]|/INST\])', '\1\3~\2\4', 'g'))
    + length(role) + length('<|im_start|>') + length('<|im_end|>') + 2 AS n FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  CAST(sum(n) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
""",
    "op9_embedding_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (
  SELECT vec_id AS x, vec_id AS y FROM embeddings
  UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
roots AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
degrees AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT e.vec_id, CAST(coalesce(d.n, 0) AS BIGINT) AS n_links, r.component_id,
  e.vec_id = r.component_id AS kept
FROM embeddings e JOIN roots r ON r.x = e.vec_id LEFT JOIN degrees d ON d.x = e.vec_id
""",
    "op12_ranked_search": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
q AS (
  SELECT item_id, term, CAST(count(*) AS BIGINT) AS repeats FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) t GROUP BY item_id, term),
n AS (SELECT doc_id, CAST(len(terms) AS BIGINT) AS n FROM d WHERE len(terms) > 0),
g AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM n),
tf AS (
  SELECT doc_id, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT doc_id, unnest(terms) AS term FROM d) t
  WHERE term IN (SELECT term FROM q) GROUP BY doc_id, term),
w AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term) f, g),
s AS (
  SELECT item_id, tf.doc_id, CAST(sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM q JOIN tf ON tf.term = q.term JOIN w ON w.term = q.term JOIN n ON n.doc_id = tf.doc_id, g
  GROUP BY item_id, tf.doc_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
""",
    # CRC-32 by its table, the cheapest repair by a recursion over a conversation's rows:
    # a weight is the cost in digits and the audit, so that the least string is the lightest
    "op11_conversation_repair": r"""
WITH RECURSIVE t AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS crcs
  FROM (SELECT unnest(range(256)) AS i) b),
k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
      lambda x: CAST(ord(x) AS BIGINT))),
    lambda c, b: xor(c >> 8, crcs[1 + (xor(c, b) & 255)]))) % 20 AS kind FROM conversations, t),
d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN kind = 0 THEN [] WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy FROM k),
o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS seen,
    left(role, 1) AS c, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS before FROM d),
f AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN seen THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault FROM o),
ins(q, to_q, n, role1, role2) AS (VALUES (0, 0, 0, NULL, NULL), (1, 1, 0, NULL, NULL), (2, 2, 0, NULL, NULL), (3, 3, 0, NULL, NULL),
  (0, 2, 1, 'user', NULL), (1, 2, 1, 'user', NULL), (3, 2, 1, 'user', NULL), (2, 3, 1, 'assistant', NULL),
  (0, 3, 2, 'user', 'assistant'), (1, 3, 2, 'user', 'assistant')),
edits(q, edit, c, to_q, price, role) AS (VALUES (0, 'K', 's', 1, 0, NULL), (0, 'K', 'u', 2, 0, NULL), (1, 'K', 'u', 2, 0, NULL), (3, 'K', 'u', 2, 0, NULL),
  (2, 'K', 'a', 3, 0, NULL), (0, 'R', NULL, 2, 1, 'user'), (1, 'R', NULL, 2, 1, 'user'), (3, 'R', NULL, 2, 1, 'user'), (2, 'R', NULL, 3, 1, 'assistant'),
  (0, 'D', NULL, 0, 2, NULL), (1, 'D', NULL, 1, 2, NULL), (2, 'D', NULL, 2, 2, NULL), (3, 'D', NULL, 3, 2, NULL)),
p AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, to_q AS q, printf('%09d', 5 * n) || repeat('I', n) AS w,
    list_transform(list_filter([role1, role2], lambda x: x IS NOT NULL), lambda x: x || ':') AS made
  FROM (SELECT DISTINCT conv_id FROM conversations) c, ins WHERE ins.q = 0
  UNION ALL
  SELECT conv_id, i, q, min(w), arg_min(made, w) FROM (
    SELECT p.conv_id, f.i, ins.to_q AS q,
      printf('%09d', CAST(left(w, 9) AS INTEGER) + price + CASE WHEN edit <> 'D' AND fault = 'truncated' THEN 5 ELSE 0 END + 5 * n)
        || substr(w, 10) || edit || repeat('I', n) AS w,
      made || CASE WHEN edit = 'D' THEN [] ELSE [coalesce(e.role, f.role) || ':' || text] END
        || list_transform(list_filter([role1, role2], lambda x: x IS NOT NULL), lambda x: x || ':') AS made
    FROM p JOIN f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.i + 1
    JOIN edits e ON e.q = p.q AND (e.c IS NULL OR e.c = f.c) AND (edit = 'D' OR fault NOT IN ('blank', 'duplicate'))
    JOIN ins ON ins.q = e.to_q) s GROUP BY conv_id, i, q),
n AS (
  SELECT c.conv_id, count(f.i) AS n, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps,
    count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
    count(*) FILTER (WHERE fault = 'truncated') AS truncated,
    count(*) FILTER (WHERE before || f.c NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM c.conv_id GROUP BY c.conv_id),
best AS (
  SELECT n.conv_id, min(w) AS w, arg_min(made, w) AS made FROM n JOIN p ON p.conv_id IS NOT DISTINCT FROM n.conv_id AND p.i = n.n
  WHERE q IN (0, 3) GROUP BY n.conv_id)
SELECT n.conv_id, gaps, blank, duplicate, truncated, illegal, CAST(left(w, 9) AS BIGINT) AS cost, substr(w, 10) AS audit,
  sha256(array_to_string(made, chr(10))) AS repaired_sha256
FROM n JOIN best ON best.conv_id IS NOT DISTINCT FROM n.conv_id
""",
}
