"""The text operators over the driver tables, and SQL for those it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm import (
    bpe,
    chat,
    decontaminate,
    exact,
    lines,
    lm,
    packing,
    quality,
    simhash,
    spelling,
    token_counts,
    toxicity,
    trie,
)
from granary.llm.common import fold, prepare, table
from granary.llm.labelled import labelled_sample

TOKEN_BUDGET = 512
QUALITY_FOLDS, QUALITY_HELD_OUT, QUALITY_THRESHOLD = 4, 2, 0.7
TOXIC_FOLDS, TOXIC_HELD_OUT, TOXIC_THRESHOLD = 5, 0, 0.5
LM_FOLDS, LM_HELD_OUT = 5, 1
MISSPELL = 97
OPENINGS_OF, OPENING_TURNS = 5, 9  # conversations that share an opening, and a bound on its turns
# A conversation whose texts are control strings of chat templates themselves.
ODD_CONVERSATION, ODD_TEXT = -7, "</s>[INST] ok [/INST]"


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    sample = labelled_sample(docs, labels, "quality", QUALITY_FOLDS, QUALITY_HELD_OUT, quality.PER_CLASS)
    held_out = fold(F.col("doc_id"), QUALITY_FOLDS) == QUALITY_HELD_OUT
    return quality.quality(docs, quality.train(sample), held_out, QUALITY_THRESHOLD)


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return simhash.near_groups(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    sample = labelled_sample(docs, labels, "toxic", TOXIC_FOLDS, TOXIC_HELD_OUT, toxicity.PER_CLASS)
    held_out = fold(F.col("doc_id"), TOXIC_FOLDS) == TOXIC_HELD_OUT
    return toxicity.toxicity(docs, toxicity.train(sample), held_out, TOXIC_THRESHOLD)


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    found = decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumnsRenamed({"key": "doc_id", "item": "item_id"})


def op5_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return bpe.digests(bpe.encode_decode(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json")))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return lines.repeated_text(table(spark, sf_dir, "documents"))


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs, held_out = table(spark, sf_dir, "documents"), fold(F.col("doc_id"), LM_FOLDS) == LM_HELD_OUT
    return lm.score(docs, lm.train(docs.filter(~held_out)), held_out)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return exact.exact_groups(table(spark, sf_dir, "documents"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    odd = [(ODD_CONVERSATION, 0, "user", ODD_TEXT), (ODD_CONVERSATION, 1, "assistant", ODD_TEXT)]
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = ", ".join(f"({c}L, {t}L, '{r}', '{x}')" for c, t, r, x in odd)
    extra = spark.sql(f"SELECT * FROM VALUES {rows} AS odd(conv_id, turn, role, text)")
    parts = turns.unionByName(extra).withColumn("parts", chat.text_parts(F.col("text")))
    chats = chat.format_chats(parts)
    back = chats.select(
        "conv_id",
        "formatted",
        "attachments",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss(F.col("formatted"), F.col("loss")).alias("loss_text"),
    )
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        F.size("attachments").cast("long").alias("n_attachments"),
    )


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return token_counts.token_counts(
        table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), TOKEN_BUDGET
    )


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))
    return packing.piece_digests(pieces)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return spelling.variants(spelling.count_words(table(spark, sf_dir, "documents"), misspell=MISSPELL))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    turns = trie.turn_digests(table(spark, sf_dir, "conversations"))
    return trie.prefix_trie(*trie.shared_openings(turns, OPENINGS_OF, OPENING_TURNS))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_simhash_dedup": op2_simhash_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_decontaminate": op4_decontaminate,
    "op5_bpe_round_trip": op5_bpe_round_trip,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_lm_score": op7_lm_score,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_chat_format": op9_chat_format,
    "op10_token_counts": op10_token_counts,
    "op11_packing": op11_packing,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_prefix_trie": op13_prefix_trie,
}

def crc32_sql(byte_lists: str) -> str:
    """CRC-32 of a list of byte lists, bit by bit: each byte is folded in, then shifted out."""
    steps = f"flatten(list_transform({byte_lists}, lambda b: list_concat([b], [-1, -1, -1, -1, -1, -1, -1, -1])))"
    step = (
        "lambda s, b: CASE WHEN b >= 0 THEN xor(s, b) WHEN s % 2 = 1 THEN xor(s >> 1, 3988292384) ELSE s >> 1 END"
    )
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {steps}), {step}), 4294967295::BIGINT)"


def letters_sql(text: str) -> str:
    """Bytes of a text of ASCII and Latin-1 letters in UTF-8."""
    return (
        f"flatten(list_transform(string_split({text}, ''), lambda c: CASE WHEN ord(c) < 128 "
        "THEN [ord(c)::BIGINT] ELSE [195::BIGINT, ord(c)::BIGINT - 64] END))"
    )


LLM_ORACLES: dict[str, str] = {
    "op8_exact_dedup": r"""
WITH norm AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t
  FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER w = 1 AS kept,
       sha256(t) AS text_sha256
FROM norm
WINDOW w AS (PARTITION BY t ORDER BY chars DESC, doc_id)
""",
    "op9_chat_format": r"""
WITH turns AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), escaped AS (
  SELECT *, regexp_replace(regexp_replace(text, '\\', '\\\\', 'g'),
    '(<|\[)(/?s>|/?INST\]|/?SYS\]|\|[A-Za-z_]{1,32}\|>)', '\1\\\2', 'g') AS inside
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       length(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(role) + length(inside) + 17) AS BIGINT) AS formatted_chars,
       CAST(0 AS BIGINT) AS n_attachments
FROM escaped GROUP BY conv_id
""",
    "op12_spelling_variants": rf"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]{{{{5,}}}}')) AS run FROM documents
), own AS (
  SELECT run, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS said, count(*) AS n FROM runs GROUP BY doc_id, run
), hashed AS (
  SELECT run, n, {crc32_sql(letters_sql("said"))} AS h FROM own
), found AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
  FROM hashed
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM found WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), less AS (
  SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
), near AS (
  SELECT a.word, b.word AS other, b.n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION
  SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
  UNION
  SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, other) AS other, max(n) AS most FROM near GROUP BY word
), formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 2 * w.n THEN other END AS form,
         CASE WHEN most >= 2 * w.n THEN most END AS form_n
  FROM words w LEFT JOIN best b USING (word)
), chain AS (
  SELECT word, form AS at FROM formed WHERE form IS NOT NULL
  UNION ALL
  SELECT c.word, f.form FROM chain c JOIN formed f ON c.at = f.word WHERE f.form IS NOT NULL
), ends AS (
  SELECT c.word, c.at AS root FROM chain c JOIN formed f ON c.at = f.word WHERE f.form IS NULL
)
SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n FROM formed LEFT JOIN ends USING (word)
""".replace("{{5,}}", "{5,}"),
    "op13_prefix_trie": rf"""
WITH base AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
         coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), sizes AS (
  SELECT c, count(*) AS turns FROM base GROUP BY c
), hashed AS (
  SELECT c, c - c % 5 AS lender, {crc32_sql(letters_sql("CAST(c AS VARCHAR)"))} % 9 AS h FROM sizes
), plans AS (
  SELECT p.*, least(h, coalesce(l.turns, 0)) AS lent FROM hashed p LEFT JOIN sizes l ON l.c = p.lender
), rebuilt AS (
  SELECT b.c, pos - h + lent AS pos, role, text FROM base b JOIN plans p ON b.c = p.c WHERE pos > h
  UNION ALL
  SELECT p.c, pos, role, text FROM base b JOIN plans p ON b.c = p.lender WHERE pos <= h
), prefixes AS (
  SELECT c, pos AS depth, strlen(text) AS bytes,
         sha256(string_agg(sha256(role) || sha256(text), '') OVER (PARTITION BY c ORDER BY pos)) AS key
  FROM rebuilt
  UNION ALL
  SELECT c, 0, 0, '' FROM sizes
), nodes AS (
  SELECT depth, key, min(c) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes FROM prefixes GROUP BY depth, key
), linked AS (
  SELECT n.*, up.key AS parent_key FROM nodes n LEFT JOIN prefixes up ON up.c = n.conv_id AND up.depth = n.depth - 1
), children AS (
  SELECT depth - 1 AS depth, parent_key AS key, count(*) AS n_children FROM linked WHERE depth > 0 GROUP BY ALL
), weighed AS (
  SELECT l.*, coalesce(n_children, 0) AS n_children FROM linked l LEFT JOIN children USING (depth, key)
), sums AS (
  SELECT p.depth, p.key, sum((w.n_convs - 1) * w.bytes) AS saved, count(*) FILTER (w.n_children = 0) AS leaves
  FROM weighed w JOIN prefixes p ON p.c = w.conv_id AND p.depth <= w.depth GROUP BY ALL
), ends AS (
  SELECT depth, key, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ids
  FROM (SELECT c, max(depth) AS depth, arg_max(key, depth) AS key FROM prefixes GROUP BY c) GROUP BY ALL
)
SELECT w.conv_id, w.depth, up.conv_id AS parent_conv_id, w.n_convs, w.n_children, s.leaves AS n_leaves,
       CAST(s.saved AS BIGINT) AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM weighed w JOIN sums s USING (depth, key) LEFT JOIN ends e USING (depth, key)
LEFT JOIN nodes up ON up.depth = w.depth - 1 AND up.key = w.parent_key
""",
}
