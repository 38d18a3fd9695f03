"""The corpus operators as queries on whole tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableward.llm import blocks, bpe, credentials, hostrules, langid, mixing, phrases, pii, recipes, simhash, suffixes, tokencounts, whitening
from tableward.llm.common import documents

WORDS_SQL = "regexp_extract_all(coalesce(text, ''), '[^ \\x09-\\x0D]+')"


def op1_rank_order_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    return langid.identify(documents(spark, sf_dir))


def op2_semicrf_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    found = pii.personal_data(documents(spark, sf_dir))
    base = F.col("base")
    return found.select(
        "doc_id", *[credentials.counted(base, k).alias(f"n_{k}") for k in pii.KINDS],
        F.sha2(credentials.listed(base), 256).alias("base_sha256"), credentials.listed(F.col("spans")).alias("spans"),
    )


def op3_linked_credentials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    return credentials.digests(credentials.secrets(documents(spark, sf_dir)))


def op4_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rule and host verdict of every document."""
    found = hostrules.judge(documents(spark, sf_dir))
    return found.drop("n_soft", "host_rate", "verdict")


def op5_block_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the passages that a document with a smaller id has."""
    found = blocks.without_repeats(documents(spark, sf_dir))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    return mixing.mix_sizes(documents(spark, sf_dir)).drop("copies")


def op7_previous_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without byte strings that occur earlier."""
    found = suffixes.without_repeats(documents(spark, sf_dir))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_covering_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of near copies of every document."""
    return simhash.near_duplicates(documents(spark, sf_dir))


def token_digests(docs: DataFrame) -> DataFrame:
    """``doc_id, n_tokens``, and digests of the ids and of what they decode to."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = bpe.decode(bpe.encode(docs.select("doc_id", "text"), path, public_tokenizers.PATTERN).drop("text"), path)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded to token ids and decoded again."""
    return token_digests(documents(spark, sf_dir))


def op10_chunk_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact duplicates of every document."""
    return recipes.exact_duplicates(documents(spark, sf_dir))


#: Tokens beyond which a document is over the limit.
TOKEN_LIMIT = 4096


def op11_prefix_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document, and how many of its characters fit the limit."""
    import public_tokenizers

    docs = documents(spark, sf_dir).select("doc_id", "text")
    counts = F.col("counts")
    n_tokens = tokencounts.total(counts).cast("long")
    return tokencounts.prefix_counts(docs, public_tokenizers.path("piece_bpe_32k.model")).select(
        "doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), n_tokens.alias("n_tokens"),
        (n_tokens > TOKEN_LIMIT).alias("over_limit"), tokencounts.characters_within(counts, TOKEN_LIMIT).cast("long").alias("n_chars_within"),
    )


def op12_exact_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first components of every embedding, whitened."""
    return whitening.components(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding")


def op13_trie_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best collocations of every language."""
    return phrases.collocations(documents(spark, sf_dir))


OP4_SQL = rf"""
WITH listed AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text, {WORDS_SQL} AS words FROM documents),
lines AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM listed) WHERE regexp_matches(line, '[^ \x09-\x0D]') GROUP BY r),
windows AS (
  SELECT r, p, words[p:p + 2] AS w FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS p FROM listed)),
twice AS (SELECT r, p FROM windows QUALIFY count(*) OVER (PARTITION BY r, w) > 1),
covered AS (
  SELECT r, sum(least(3, coalesce(next - p, 3))) AS n_repeat_words
  FROM (SELECT r, p, lead(p) OVER (PARTITION BY r ORDER BY p) AS next FROM twice) GROUP BY r),
counted AS (
  SELECT doc_id, source, len(words) AS n_words,
    length(regexp_replace(text, '[ \x09-\x0D]', '', 'g')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_lines, 0) AS n_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM listed LEFT JOIN lines USING (r) LEFT JOIN covered USING (r)),
failed AS (
  SELECT *, n_words < {hostrules.LEAST_WORDS} OR 100 * n_repeat_words > {hostrules.REPEATED_PERCENT} * n_words AS base_failed,
    {" + ".join(f"CAST(n_symbols > {m} * n_words AS INT)" for m in hostrules.SYMBOLS_PER_WORD)}
      + {" + ".join(f"CAST(n_dup_lines > {m} * n_lines AS INT)" for m in hostrules.LINES_REPEATED)}
      + CAST(word_chars < {hostrules.WORD_LENGTH[0]} * n_words OR word_chars > {hostrules.WORD_LENGTH[1]} * n_words AS INT) AS n_soft
  FROM counted),
hosts AS (
  SELECT source, CAST(count(*) AS DOUBLE) AS docs, CAST(sum(CAST(base_failed OR n_soft > 0 AS INT)) AS DOUBLE) AS failed
  FROM failed GROUP BY source),
moments AS (
  SELECT sum(failed) / sum(docs) AS mean,
    sum(failed * failed / docs) / sum(docs) - pow(sum(failed) / sum(docs), 2)
      - sum(failed) / sum(docs) * (1 - sum(failed) / sum(docs)) * count(*) / sum(docs) AS between
  FROM hosts),
prior AS (
  SELECT greatest(least(mean, 1 - 1e-9), 1e-9) AS mean,
    CASE WHEN between > 0 THEN least(greatest(mean * (1 - mean) / between - 1, 1.0), 1e6) ELSE 1e6 END AS worth FROM moments),
rates AS (SELECT source, mean, (failed + mean * worth) / (docs + worth) AS rate FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND n_soft <= CASE WHEN rate > {hostrules.BLOCKED} THEN -1 WHEN rate > {hostrules.WATCHED} * mean THEN 0 ELSE 1 END AS kept
FROM failed JOIN rates ON failed.source IS NOT DISTINCT FROM rates.source
"""

OP5_SQL = f"""
WITH listed AS (SELECT row_number() OVER () AS r, doc_id, {WORDS_SQL} AS words FROM documents),
runs AS (
  SELECT r, doc_id, p, array_to_string(words[p:p + {blocks.RUN - 1}], ' ') AS run
  FROM (SELECT *, unnest(range(1, len(words) - {blocks.RUN - 2})) AS p FROM listed)),
firsts AS (SELECT run, min(doc_id) AS first FROM runs GROUP BY run),
gone AS (SELECT DISTINCT r, unnest(range(p, p + {blocks.RUN})) AS i FROM runs JOIN firsts USING (run) WHERE first < doc_id),
kept AS (
  SELECT r, count(*) AS n_kept, string_agg(word, ' ' ORDER BY i) AS kept
  FROM (SELECT r, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM listed) ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n_kept, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM listed LEFT JOIN kept USING (r)
"""

OP6_SQL = f"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, len({WORDS_SQL}) AS size,
    CAST(('0x' || substr(md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), md5(coalesce(text, '')))), 1, 12)) AS BIGINT)
      / pow(16, 12) AS draw
  FROM documents),
sources AS (
  SELECT source, source_size, [{", ".join(map(str, mixing.WEIGHTS))}][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)}] AS weight
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source)),
rounds AS (
  SELECT -1 AS capped, CAST(0 AS DOUBLE) AS level
  UNION ALL
  SELECT n, ((SELECT sum(source_size) FROM sources) - given) / w
  FROM (
    SELECT r.capped, count(*) FILTER (full_up) AS n, coalesce(sum({mixing.MOST_REPEATS} * source_size) FILTER (full_up), 0) AS given,
      CAST(sum(weight) FILTER (NOT full_up) AS DOUBLE) AS w
    FROM (SELECT rounds.capped, source_size, weight, rounds.capped >= 0 AND {mixing.MOST_REPEATS} * source_size < level * weight AS full_up
          FROM rounds, sources) AS r
    GROUP BY r.capped) WHERE n <> capped AND w > 0),
plan AS (
  SELECT source, source_size, least(CAST({mixing.MOST_REPEATS} * source_size AS DOUBLE), (SELECT level FROM rounds ORDER BY capped DESC LIMIT 1) * weight) AS target
  FROM sources),
rated AS (
  SELECT doc_id, size, source_size, target, draw, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate
  FROM sized JOIN plan ON sized.source IS NOT DISTINCT FROM plan.source)
SELECT doc_id, size, source_size, target, CAST(size * (floor(rate) + CAST(draw < rate - floor(rate) AS INT)) AS BIGINT) AS taken FROM rated
"""

OP10_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

OP13_SQL = f"""
WITH named AS (
  SELECT coalesce(lang, '{phrases.UNKNOWN}') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^ \\x09]+') AS words
  FROM (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM named)),
sizes AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM pieces GROUP BY lang),
runs AS (
  SELECT lang, w, array_to_string(words[i:i + w - 1], ' ') AS phrase
  FROM (SELECT lang, words, w, unnest(range(1, len(words) - w + 2)) AS i FROM pieces, (SELECT unnest(range(1, {phrases.WORDS + 1})) AS w))),
counted AS (SELECT lang, w, phrase, count(*) AS f FROM runs GROUP BY lang, w, phrase HAVING count(*) >= {phrases.LEAST}),
candidates AS (SELECT lang, w, phrase, string_split(phrase, ' ') AS words, f AS a FROM counted WHERE w > 1),
cuts AS (SELECT *, unnest(range(1, w)) AS k FROM candidates),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, l.f AS l, r.f AS r, CAST(CAST({phrases.SCALE} AS HUGEINT) * c.a // (CAST(l.f AS HUGEINT) + r.f) AS BIGINT) AS score
  FROM cuts AS c
  JOIN counted AS l ON l.lang = c.lang AND l.phrase = array_to_string(c.words[1:c.k], ' ')
  JOIN counted AS r ON r.lang = c.lang AND r.phrase = array_to_string(c.words[c.k + 1:c.w], ' ')
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, c.k) = 1),
inside AS (
  SELECT lang, array_to_string(words[s:s + v - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, w - v + 2)) AS s FROM (SELECT *, unnest(range(2, w)) AS v FROM candidates)) GROUP BY ALL),
ranked AS (
  SELECT scored.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM scored LEFT JOIN inside USING (lang, phrase)
  WHERE longer IS NULL OR CAST(100 AS HUGEINT) * longer < CAST({phrases.COVERED} AS HUGEINT) * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN sizes USING (lang) WHERE rank <= {phrases.TOP}
"""

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "op1_rank_order_language": (op1_rank_order_language, None),
    "op2_semicrf_pii": (op2_semicrf_pii, None),
    "op3_linked_credentials": (op3_linked_credentials, None),
    "op4_host_rules": (op4_host_rules, OP4_SQL),
    "op5_block_anchors": (op5_block_anchors, OP5_SQL),
    "op6_source_mix": (op6_source_mix, OP6_SQL),
    "op7_previous_factors": (op7_previous_factors, None),
    "op8_covering_simhash": (op8_covering_simhash, None),
    "op9_byte_bpe": (op9_byte_bpe, None),
    "op10_chunk_recipes": (op10_chunk_recipes, OP10_SQL),
    "op11_prefix_counts": (op11_prefix_counts, None),
    "op12_exact_whitening": (op12_exact_whitening, None),
    "op13_trie_phrases": (op13_trie_phrases, OP13_SQL),
}
