"""The registered queries of the subpackage, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerometer.llm import chat, dialogue, exact_dedup, fingerprints, licenses, mixing, packing, passages, scoring, secrets, simhash, spelling, toxicity
from aerometer.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(function):
    QUERIES[function.__name__] = function
    return function


def id_remainder(parts: int) -> Column:
    """crc32 of doc_id as text, modulo parts."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts


def vocabulary() -> str:
    """The word vocabulary's file, where the public tokenizer files are installed."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@_query
def op1_ppm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by a model of those whose crc32 modulo 7 is not 2."""
    return scoring.scores(read(spark, sf_dir, "documents"), id_remainder(7) == 2)


@_query
def op2_pack_nnls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 tokens."""
    return packing.pack(read(spark, sf_dir, "documents"), vocabulary(), window=2048)


@_query
def op3_mix_pfair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in blocks of 64 Ki characters, sources weighted by the square root of their size."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", F.length("text").cast("long").alias("n_text"))
    return mixing.mix(docs, power=0.5, block=1 << 16, period=1024, size=F.col("n_text"))


@_query
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of the documents that holds a license anchor, with its family."""
    return licenses.scan(read(spark, sf_dir, "documents"))


@_query
def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint over 3-word shingles and its component at 2 bits."""
    return simhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=3, radius=2)


@_query
def op6_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that documents share, at a similarity of 0.8."""
    return passages.near_passages(read(spark, sf_dir, "documents"), words=50, likeness=0.8)


@_query
def op7_weighted_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, their edited texts and the next documents, by 16 weighted samples."""
    return fingerprints.edit_report(read(spark, sf_dir, "documents"), samples=16)


@_query
def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, formatted and read back."""
    extra = spark.createDataFrame(
        [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")],
        "conv_id long, turn long, role string, text string")
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.digests(chat.format_chats(turns))


SQL["op8_chat_format"] = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -7, turn, role, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(turn, role)
), near AS (
  SELECT *, lag(role) OVER w AS before,
         length(replace(replace(replace(text, '\', '\b'), '<', '\l'), '#', '\h')) AS n_text,
         length(replace(replace(replace(replace(role, '\', '\b'), '<', '\l'), '#', '\h'), ':', '\c')) AS n_role
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       cast(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       cast(sum(n_text + CASE WHEN before IS NOT DISTINCT FROM role AND before IS NOT NULL THEN 8 ELSE n_role + 14 END) AS BIGINT)
         AS formatted_chars
FROM near GROUP BY conv_id
"""


@_query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by a model of the labelled rows that are not held out."""
    return toxicity.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), id_remainder(5) == 0)


@_query
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole documents table as the first batch of an index."""
    return exact_dedup.label(read(spark, sf_dir, "documents"))


SQL["op10_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@_query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All words of six letters and five occurrences in the documents, with their near words and forms."""
    return spelling.variants(read(spark, sf_dir, "documents"))


#: The CRC-32 of an ASCII or UTF-8 text as a DuckDB expression, over the CTE crc_bytes.
CRC_TABLE = """crc_bytes AS (
  SELECT list(list_reduce([c, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, _: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)
              ORDER BY c) AS t
  FROM (SELECT unnest(range(256)) AS c))"""


def crc_sql(text: str) -> str:
    hexed = f"lower(hex(encode({text})))"
    digit = lambda at: f"(instr('0123456789abcdef', substr(h, {at}, 1)) - 1)"
    return (f"(SELECT xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(h) + 1, 2), "
            f"lambda i: (16 * {digit('i')} + {digit('i + 1')})::BIGINT)), lambda a, b: xor(t[1 + (xor(a, b) & 255)], a >> 8)), 4294967295) "
            f"FROM crc_bytes, (SELECT {hexed} AS h))")


SQL["op11_spelling_variants"] = f"""
WITH RECURSIVE {CRC_TABLE}, runs AS (
  SELECT coalesce(cast(doc_id AS VARCHAR), '') AS id,
         translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents
), counted AS (SELECT id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY ALL
), hashed AS (SELECT run, n, {crc_sql("id || ':' || run")} AS h FROM counted
), cut AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, 2 + h % length(run)) ELSE run END AS word, n FROM hashed
), words AS (
  SELECT word, cast(sum(n) AS BIGINT) AS n FROM cut WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), less AS (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)
), pairs AS (
  SELECT a.word, b.word AS other FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT l.word, w.word FROM less l JOIN words w ON l.rest = w.word
  UNION SELECT w.word, l.word FROM less l JOIN words w ON l.rest = w.word
), best AS (
  SELECT pairs.word, count(*) AS n_near, max(o.n) AS top, first(other ORDER BY o.n DESC, other) AS other
  FROM pairs JOIN words o ON o.word = other GROUP BY pairs.word
), judged AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 5 * w.n THEN other END AS form,
         CASE WHEN top >= 5 * w.n THEN top END AS form_n
  FROM words w LEFT JOIN best b USING (word)
), chain AS (
  SELECT word, word AS root, form FROM judged
  UNION ALL SELECT c.word, j.word, j.form FROM chain c JOIN judged j ON j.word = c.form
)
SELECT j.word, j.n, j.n_near, j.form, j.form_n, c.root FROM judged j JOIN chain c ON c.word = j.word AND c.form IS NULL
"""


@_query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations after damage, with their faults and cheapest edits."""
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return dialogue.report(dialogue.damage(turns), turns)


SQL["op12_conversation_repair"] = rf"""
WITH RECURSIVE {CRC_TABLE}, keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {crc_sql("coalesce(cast(conv_id AS VARCHAR), ' ') || ':' || coalesce(cast(turn AS VARCHAR), ' ')")} % 20 AS how
  FROM conversations
), hurt AS (
  SELECT conv_id, turn, CASE WHEN how = 4 THEN 'user' ELSE role END AS role,
         CASE how WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN how = 3 THEN 2 ELSE 1 END)) AS copy
  FROM keyed WHERE how <> 0
), rows AS (
  SELECT *, row_number() OVER c AS i, row_number() OVER same AS said, lag(role) OVER c AS before,
         right(regexp_replace(text, '[ 	-
]', '', 'g'), 1) AS final
  FROM hurt WINDOW c AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy),
                   same AS (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy)
), marked AS (
  SELECT *, left(role, 1) AS c, CASE WHEN final = '' THEN 'blank' WHEN said > 1 THEN 'duplicate'
         WHEN final NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM rows
), facts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
         count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE before IS NOT NULL AND left(before, 1) || c NOT IN ('su', 'ua', 'au')) AS illegal
  FROM marked GROUP BY conv_id
), steps(q, letter, c, q2, cost) AS (
  VALUES (0, 'K', 's', 1, 0), (0, 'K', 'u', 2, 0), (1, 'K', 'u', 2, 0), (2, 'K', 'a', 3, 0), (3, 'K', 'u', 2, 0),
         (0, 'R', NULL, 2, 1), (1, 'R', NULL, 2, 1), (2, 'R', NULL, 3, 1), (3, 'R', NULL, 2, 1),
         (0, 'D', NULL, 0, 2), (1, 'D', NULL, 1, 2), (2, 'D', NULL, 2, 2), (3, 'D', NULL, 3, 2)
), inserts(q, letters, q2, roles) AS (
  VALUES (0, '', 0, []::VARCHAR[]), (1, '', 1, []), (2, '', 2, []), (3, '', 3, []), (0, 'I', 2, ['user:']), (1, 'I', 2, ['user:']),
         (2, 'I', 3, ['assistant:']), (3, 'I', 2, ['user:']), (0, 'II', 3, ['user:', 'assistant:']), (1, 'II', 3, ['user:', 'assistant:'])
), ways AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS q, {{'cost': 0, 'audit': '', 'rows': []::VARCHAR[]}} AS way FROM facts
  UNION ALL
  SELECT w.conv_id, w.i + 1, s.q2, min({{'cost': w.way.cost + 5 * length(a.letters) + s.cost
           + CASE WHEN s.letter <> 'D' AND m.fault = 'truncated' THEN 5 ELSE 0 END, 'audit': w.way.audit || a.letters || s.letter,
         'rows': w.way.rows || a.roles || CASE s.letter WHEN 'D' THEN [] WHEN 'K' THEN [m.role || ':' || m.text]
           ELSE [CASE s.q2 WHEN 2 THEN 'user:' ELSE 'assistant:' END || m.text] END}})
  FROM ways w JOIN marked m ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.i = w.i + 1
       JOIN inserts a ON a.q = w.q JOIN steps s ON s.q = a.q2
  WHERE (s.letter <> 'K' OR s.c = m.c) AND (s.letter = 'D' OR m.fault NOT IN ('blank', 'duplicate'))
  GROUP BY w.conv_id, w.i, s.q2
), ended AS (
  SELECT w.conv_id, min({{'cost': w.way.cost + 5 * length(a.letters), 'audit': w.way.audit || a.letters, 'rows': w.way.rows || a.roles}}) AS way
  FROM ways w JOIN facts f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.n = w.i JOIN inserts a ON a.q = w.q
  WHERE a.q2 IN (0, 3) GROUP BY w.conv_id
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(e.way.cost, 0)::BIGINT AS cost,
       coalesce(e.way.audit, '') AS audit, sha256(coalesce(array_to_string(e.way.rows, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM o.conv_id
     LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""


@_query
def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the spans of credentials, by patterns and by learned formats."""
    return secrets.digests(secrets.scan(read(spark, sf_dir, "documents")))
