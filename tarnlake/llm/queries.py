"""Queries of the training-data operators, with SQL where SQL expresses them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.llm import chat, decontam, langid, line_dedup, lm, mixing, mtree, ngram_join, phrases, repair, simhash, substring, warc

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back."""
    folder, manifest = warc.write_archives(_table(spark, sf_dir, "pages"))
    return warc.read_archives(folder, manifest, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "verified")


OP1_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to,
       true AS verified
FROM f
"""


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that later copies of three-line windows cover."""
    out = line_dedup.dedup_lines(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


OP2_SQL = """
WITH d AS (SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
w AS (SELECT doc_id, i, l[i] AS a, l[i + 1] AS b, l[i + 2] AS c FROM d, unnest(range(1, len(l) - 1)) AS t(i)),
v AS (SELECT doc_id, i, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, i) AS n FROM w WHERE trim(a) <> '' OR trim(b) <> '' OR trim(c) <> ''),
g AS (SELECT DISTINCT doc_id, i + k AS i FROM v, unnest(range(0, 3)) AS t(k) WHERE n > 1),
k AS (SELECT d.doc_id, t.i, l[t.i] AS line, g.i IS NULL AS kept FROM d CROSS JOIN unnest(range(1, len(l) + 1)) AS t(i) LEFT JOIN g ON g.doc_id = d.doc_id AND g.i = t.i),
s AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE NOT kept) AS n_removed, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE kept), '') AS text FROM k GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN 0 ELSE n_lines END::BIGINT AS n_lines, n_removed::BIGINT AS n_removed,
       CASE WHEN d.text IS NOT NULL THEN sha256(s.text) END AS kept_sha256
FROM d JOIN s ON s.doc_id = d.doc_id
"""


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that aren't held out."""
    docs = _table(spark, sf_dir, "documents")
    out = langid.identify(docs.select("doc_id", "text"), langid.train(docs))
    return out.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in the mix of all sources, weighted by the square root of their rows."""
    return mixing.mix_sources(_table(spark, sf_dir, "documents").select("doc_id", "source", "text")).drop("text")


def op5_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations 2k and 2k + 1 as chosen and rejected: prompt, completions and masks."""
    turns = _table(spark, sf_dir, "conversations").select(F.floor(F.col("conv_id") / 2).alias("pair_id"), (F.pmod("conv_id", F.lit(2)) == 1).alias("rejected"), "turn", "role", "text")
    pairs = chat.format_preferences(turns)
    sha = lambda c: F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256")
    masks = [chat.mask_spans(F.col(f"{side}_segments")).alias(f"{side}_mask") for side in ("chosen", "rejected")]
    return pairs.select("pair_id", *[F.col(f"n_{x}_turns").cast("long").alias(f"n_{x}_turns") for x in ("prompt", "chosen", "rejected")], sha("prompt"), sha("chosen"), sha("rejected"), *masks)


OP5_SQL = """
WITH t AS (SELECT DISTINCT conv_id // 2 AS pair_id, conv_id % 2 AS side, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT *, row_number() OVER (PARTITION BY pair_id, side ORDER BY turn NULLS FIRST, role, text) AS i,
      '<|im_start|>' || role || chr(10) AS head, text || '<|im_end|>' || chr(10) AS body FROM t),
j AS (SELECT pair_id, i, count(*) = 2 AND min(role) = max(role) AND min(text) = max(text) AS same FROM o GROUP BY pair_id, i),
n AS (SELECT pair_id, coalesce(min(i) FILTER (WHERE NOT same) - 1, max(i)) AS n FROM j GROUP BY pair_id)
SELECT pair_id::BIGINT AS pair_id, any_value(n)::BIGINT AS n_prompt_turns,
       count(*) FILTER (WHERE side = 0 AND i > n)::BIGINT AS n_chosen_turns, count(*) FILTER (WHERE side = 1 AND i > n)::BIGINT AS n_rejected_turns,
       sha256(coalesce(string_agg(head || body, '' ORDER BY i) FILTER (WHERE side = 0 AND i <= n), '')) AS prompt_sha256,
       sha256(coalesce(string_agg(head || body, '' ORDER BY i) FILTER (WHERE side = 0 AND i > n), '')) AS chosen_sha256,
       sha256(coalesce(string_agg(head || body, '' ORDER BY i) FILTER (WHERE side = 1 AND i > n), '')) AS rejected_sha256,
       coalesce(string_agg(length(head) || ' ' || CASE WHEN role = 'assistant' THEN '+' ELSE '' END || length(body), ' ' ORDER BY i) FILTER (WHERE side = 0 AND i > n), '') AS chosen_mask,
       coalesce(string_agg(length(head) || ' ' || CASE WHEN role = 'assistant' THEN '+' ELSE '' END || length(body), ' ' ORDER BY i) FILTER (WHERE side = 1 AND i > n), '') AS rejected_mask
FROM o JOIN n USING (pair_id) GROUP BY pair_id
"""


def op6_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words that windows of 13 words of smaller documents cover."""
    out = substring.dedup_substrings(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


OP6_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, s, array_to_string(list_slice(w, s, s + 12), ' ') AS x FROM d, unnest(range(1, len(w) - 11)) AS t(s)),
f AS (SELECT x, min(doc_id) AS least FROM g GROUP BY x HAVING min(doc_id) < max(doc_id)),
c AS (SELECT DISTINCT g.doc_id, s + k AS i FROM g JOIN f ON f.x = g.x AND g.doc_id > f.least, unnest(range(0, 13)) AS t(k)),
k AS (SELECT d.doc_id, i, w[i] AS word FROM d, unnest(range(1, len(w) + 1)) AS t(i)),
s AS (SELECT k.doc_id, count(c.i) AS n_removed, string_agg(word, ' ' ORDER BY k.i) FILTER (WHERE c.i IS NULL) AS kept
      FROM k LEFT JOIN c ON c.doc_id = k.doc_id AND c.i = k.i GROUP BY k.doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN s ON s.doc_id = d.doc_id
"""


def op7_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document scored by word counts and by the attention model, both learned from the other four folds."""
    out = lm.score_texts(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", lm.held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op8_mtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 largest integer inner products of every vector whose id is divisible by 20, among all others."""
    return mtree.top_k(_table(spark, sf_dir, "embeddings"))


OP8_SQL = """
WITH v AS (SELECT row_number() OVER () AS i, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (SELECT q.i, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
      FROM v q JOIN v c ON c.i <> q.i AND len(c.v) = len(q.v) WHERE q.vec_id % 20 = 0),
r AS (SELECT query_id, row_number() OVER (PARTITION BY i ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint of three-word shingles, and its component of fingerprints that differ in two bits or fewer."""
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op10_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words inside windows of benchmark items."""
    out = decontam.mark_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_CONTENT = rf"list_filter(string_split_regex({_LOWER}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
OP10_SQL = rf"""
WITH b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_CONTENT} AS w FROM benchmark),
win AS (SELECT item_id, list_slice(w, s, least(s + 12, len(w))) AS x FROM b, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS t(s) WHERE len(w) > 0),
lens AS (SELECT DISTINCT len(x) AS n FROM win),
d AS (SELECT doc_id, {_CONTENT} AS w FROM documents),
h AS (SELECT d.doc_id, s, n, list_slice(w, s, s + n - 1) AS x FROM d, lens, unnest(range(1, len(w) - n + 2)) AS t(s)),
m AS (SELECT h.doc_id, h.s, h.n, win.item_id FROM h JOIN win ON h.x = win.x),
p AS (SELECT doc_id, count(DISTINCT s + k) AS n_hit FROM m, unnest(range(0, n)) AS t(k) GROUP BY doc_id),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN p ON p.doc_id = d.doc_id LEFT JOIN i ON i.doc_id = d.doc_id
"""


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation damaged, and repaired by its cheapest edits."""
    return repair.digest(repair.repair_conversations(repair.damage(_table(spark, sf_dir, "conversations"))))


OP11_SQL = r"""
WITH RECURSIVE c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
h AS (SELECT *, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, 8 * strlen(k)), lambda j: CAST((ascii(k[j // 8 + 1]) >> (j % 8)) & 1 AS BIGINT))),
             lambda x, b: CASE WHEN xor(x & 1, b) = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END), 4294967295) % 20 AS f FROM c),
d AS (SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role, CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
      FROM h, unnest(range(0, CASE f WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS t(copy)),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS tail FROM d),
r AS (SELECT *, tail = '' AS blank, tail <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS duplicate,
      role[1] AS x, lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) AS before, row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1 AS final FROM o),
e AS (SELECT *, NOT blank AND NOT duplicate AND tail NOT IN ('.', '!', '?') AS truncated FROM r),
s AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE duplicate) AS duplicate,
      count(*) FILTER (WHERE truncated) AS truncated, count(*) FILTER (WHERE before IS NOT NULL AND before || x NOT IN ('su', 'ua', 'au')) AS illegal FROM e GROUP BY conv_id),
ins(f, g, n, lines) AS (VALUES ('', '', 0, CAST([] AS VARCHAR[])), ('', 'u', 1, ['user:']), ('', 'a', 2, ['user:', 'assistant:']), ('s', 's', 0, []), ('s', 'u', 1, ['user:']), ('s', 'a', 2, ['user:', 'assistant:']),
      ('u', 'u', 0, []), ('u', 'a', 1, ['assistant:']), ('a', 'a', 0, []), ('a', 'u', 1, ['user:'])),
m AS (SELECT f, n, lines, g, code, CASE code WHEN 'D' THEN g WHEN 'K' THEN k ELSE CASE WHEN g = 'u' THEN 'a' ELSE 'u' END END AS t, k FROM ins, (VALUES ('D'), ('K'), ('R')) AS a(code), (VALUES (''), ('s'), ('u'), ('a')) AS b(k)
      WHERE CASE WHEN code = 'K' THEN (k = 's' AND g = '') OR (k = 'u' AND g <> 'u') OR (k = 'a' AND g = 'u') ELSE k = '' END),
p AS (SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, '' AS st, CAST(0 AS BIGINT) AS cost, '' AS audit, CAST([] AS VARCHAR[]) AS lines, false AS final FROM e
      UNION ALL
      SELECT conv_id, i, st, cost, audit, lines, final FROM (
        SELECT p.conv_id, e.i, m.t AS st, p.cost + 5 * m.n + CASE m.code WHEN 'D' THEN 2 WHEN 'R' THEN 1 ELSE 0 END + CASE WHEN m.code <> 'D' AND e.truncated THEN 5 ELSE 0 END AS cost,
               p.audit || repeat('I', m.n) || m.code AS audit,
               p.lines || m.lines || CASE m.code WHEN 'D' THEN [] WHEN 'K' THEN [e.role || ':' || e.text] ELSE [CASE m.t WHEN 'u' THEN 'user:' ELSE 'assistant:' END || e.text] END AS lines, e.final,
               row_number() OVER (PARTITION BY p.conv_id, m.t ORDER BY p.cost + 5 * m.n + CASE m.code WHEN 'D' THEN 2 WHEN 'R' THEN 1 ELSE 0 END + CASE WHEN m.code <> 'D' AND e.truncated THEN 5 ELSE 0 END, p.audit || repeat('I', m.n) || m.code) AS best
        FROM p JOIN e ON e.conv_id IS NOT DISTINCT FROM p.conv_id AND e.i = p.i + 1 JOIN m ON m.f = p.st AND (m.code = 'D' OR NOT e.blank AND NOT e.duplicate) AND (m.code <> 'K' OR m.k = e.x)) WHERE best = 1),
z AS (SELECT conv_id, cost + 5 * n AS cost, audit || repeat('I', n) AS audit, p.lines || q.lines AS lines, row_number() OVER (PARTITION BY conv_id ORDER BY cost + 5 * n, audit || repeat('I', n)) AS best
      FROM p JOIN (VALUES ('', 0, CAST([] AS VARCHAR[])), ('s', 2, ['user:', 'assistant:']), ('u', 1, ['assistant:']), ('a', 0, [])) AS q(st, n, lines) ON q.st = p.st WHERE final)
SELECT a.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(s.blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN z ON z.conv_id IS NOT DISTINCT FROM a.conv_id AND z.best = 1
"""


def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's set of three-word shingles, and its component of sets that share nine tenths."""
    return ngram_join.join_documents(_table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
h AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(list_slice(w, i, i + 2), ' ')) END) AS s FROM d),
s AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS s FROM h),
p AS MATERIALIZED (SELECT x, y FROM (SELECT a.doc_id AS x, b.doc_id AS y, a.n AS n, b.n AS m, count(*) AS common FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n) GROUP BY ALL) WHERE 100 * common >= 90 * (n + m - common)),
e AS MATERIALIZED (SELECT x, y FROM p UNION ALL SELECT y, x FROM p),
r AS (SELECT x AS doc_id, x AS y FROM e UNION SELECT r.doc_id, e.y FROM r JOIN e ON e.x = r.y),
c AS (SELECT doc_id, min(y) AS least FROM r GROUP BY doc_id)
SELECT h.doc_id, len(h.s)::BIGINT AS n_shingles, coalesce(least, h.doc_id) AS component_id FROM h LEFT JOIN c ON c.doc_id = h.doc_id
"""


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's 2,000 best collocations of two to four words."""
    return phrases.collocations(_table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS p FROM d),
w AS MATERIALIZED (SELECT lang, list_filter(string_split_regex(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda s: array_to_string(list_slice(w, s, s + k - 1), ' '))) AS phrase FROM w CROSS JOIN (VALUES (1), (2), (3), (4)) AS v(k)),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY lang, k, phrase HAVING count(*) >= 30),
c AS MATERIALIZED (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
h AS (SELECT lang, phrase, a, w, k, unnest(range(1, k)) AS j FROM c),
s AS (SELECT h.lang, h.phrase, a, j, l.f AS l, r.f AS r, CAST(CAST(2000000 AS HUGEINT) * a // (l.f + r.f) AS BIGINT) AS score
      FROM h JOIN f l ON l.lang = h.lang AND l.phrase = array_to_string(list_slice(w, 1, j), ' ') JOIN f r ON r.lang = h.lang AND r.phrase = array_to_string(list_slice(w, j + 1, h.k), ' ')),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS best FROM s) WHERE best = 1),
m AS (SELECT lang, a, w, k, unnest(range(2, k)) AS m FROM c),
u AS (SELECT lang, a, unnest(list_transform(range(1, k - m + 2), lambda s: array_to_string(list_slice(w, s, s + m - 1), ' '))) AS phrase FROM m),
i AS (SELECT lang, phrase, max(a) AS longer FROM u GROUP BY lang, phrase),
k AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank FROM b LEFT JOIN i ON i.lang = b.lang AND i.phrase = b.phrase WHERE longer IS NULL OR 100 * longer < 80 * a)
SELECT k.lang, rank, phrase, a, l, r, n, score FROM k JOIN n ON n.lang = k.lang WHERE rank <= 2000
"""

QUERIES: dict[str, Query] = {
    "op1_warc": op1_warc,
    "op2_line_dedup": op2_line_dedup,
    "op3_langid": op3_langid,
    "op4_mixing": op4_mixing,
    "op5_preferences": op5_preferences,
    "op6_substring": op6_substring,
    "op7_lm": op7_lm,
    "op8_mtree": op8_mtree,
    "op9_simhash": op9_simhash,
    "op10_decontam": op10_decontam,
    "op11_repair": op11_repair,
    "op12_ngram_join": op12_ngram_join,
    "op13_phrases": op13_phrases,
}
ORACLE_SQL: dict[str, str] = {"op1_warc": OP1_SQL, "op2_line_dedup": OP2_SQL, "op5_preferences": OP5_SQL, "op6_substring": OP6_SQL, "op8_mtree": OP8_SQL, "op10_decontam": OP10_SQL, "op11_repair": OP11_SQL, "op12_ngram_join": OP12_SQL, "op13_phrases": OP13_SQL}
