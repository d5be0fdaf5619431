"""The operators on the given tables, with production parameters, and SQL to compare where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from deedflow.llm import (
    conversation_repair,
    decontaminate,
    line_dedup,
    mixing,
    near_dedup,
    oracles,
    pii,
    pu_quality,
    sharding,
    spelling,
    substring_dedup,
    token_counts,
    tree_rules,
    warc,
)
from deedflow.llm.rows import read, written

Query = Callable[[SparkSession, str], DataFrame]


# The mixture: four domains by the number of the source, weights by domain and language.
MIX_LEVELS = ("domain", "lang", "source")
MIX_WEIGHTS = {
    "domain": {"domain0": 4, "domain1": 3, "domain2": 2, "domain3": 1},
    "lang": {"en": 5, "de": 2, "fr": 2, "es": 1},
}
SHARDS = 40
VOCABULARY, TOKEN_LIMIT = public_tokenizers.path("byte_bpe_50k.json"), 512
DOMAIN = "coalesce(concat('domain', cast(regexp_extract(source, '([0-9]+)$', 1) AS int) % 4), 'none')"


def op1_mix(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "lang", "source", mixing.word_count().alias("n_tokens"))
    sized = written(docs.withColumn("domain", F.expr(DOMAIN)), "mix-sizes")
    rows = mixing.mix(sized, MIX_LEVELS, MIX_WEIGHTS, share=(8, 10), max_epochs=2, seed=17)
    return rows.select("doc_id", *MIX_LEVELS, "epoch", "n_tokens", "taken_tokens")


def op2_pu_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    return pu_quality.score_documents(docs, pu_quality.train(docs, labels)[0])


def op3_tree_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    return tree_rules.judge_quality(docs, tree_rules.train(docs, labels))


def op4_substrings(spark: SparkSession, folder: str) -> DataFrame:
    rows = substring_dedup.without_repeats(read(spark, folder, "documents"), with_text=False)
    return rows.drop("kept_text")


def op5_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find_overlaps(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


def op6_line_chunks(spark: SparkSession, folder: str) -> DataFrame:
    rows = line_dedup.without_repeated_chunks(read(spark, folder, "documents"))
    return rows.select("doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op7_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(read(spark, folder, "documents"))


def op8_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    found = pii.find_personal_data(docs, pii.learn(docs))
    base = pii.span_list(*pii.BASE)
    return found.select(
        "doc_id",
        *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in pii.BASE],
        F.sha2(base, 256).alias("base_sha256"),
        pii.span_list(*pii.BASE, *pii.ADDED).alias("spans"),
    )


def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    pages = warc.warc_round_trip(read(spark, folder, "pages"))
    return pages.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_kd_shards(spark: SparkSession, folder: str) -> DataFrame:
    rows = sharding.shard_documents(read(spark, folder, "documents"), shards=SHARDS)
    return rows.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def op11_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, folder, "documents"), VOCABULARY, TOKEN_LIMIT)


def op12_repair(spark: SparkSession, folder: str) -> DataFrame:
    given = read(spark, folder, "conversations")
    found = conversation_repair.repair(conversation_repair.damaged(given))
    digests = conversation_repair.digests(found.messages)
    rows = given.select("conv_id").distinct()
    for part in (found.reports, digests):
        part = part.withColumnRenamed("conv_id", "_id")
        rows = rows.join(part, F.col("conv_id").eqNullSafe(F.col("_id")), "left").drop("_id")
    # Conversations of which no message is left.
    return rows.select(
        "conv_id",
        *[F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in conversation_repair.COUNTS],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op13_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_variants(read(spark, folder, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_mix, op2_pu_quality, op3_tree_rules, op4_substrings, op5_decontaminate, op6_line_chunks, op7_near_duplicates, op8_pii, op9_warc, op10_kd_shards, op11_token_counts, op12_repair, op13_spelling)}

_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(hex, {5 * i + 1}, 5))::BIGINT >> {s}) & 31)::INT, 1)"
    for i in range(8)
    for s in (15, 10, 5, 0)
)

_ROLLING = " + ".join(
    f"CASE WHEN i > {j} THEN hashes[i - {j}] * {factor} ELSE 0 END" for j, factor in enumerate(line_dedup.FACTORS)
)


def _case(level: str) -> str:
    whens = " ".join(f"WHEN {level} = '{value}' THEN {weight}" for value, weight in MIX_WEIGHTS.get(level, {}).items())
    return f"(CASE {whens} ELSE 1 END)" if whens else "1"


def _shares(depth: int) -> str:
    """The budgets of the children at one depth of the mixture's tree."""
    path, above = ", ".join(MIX_LEVELS[:depth]), ", ".join(MIX_LEVELS[: depth - 1])
    node, name = f"PARTITION BY {above}" if above else "", MIX_LEVELS[depth - 1]
    join = f"JOIN (SELECT {above}, given AS budget FROM given{depth - 1}) USING ({above})" if above else ", top"
    return f"""
a{depth} AS (
  SELECT *, CASE WHEN weight > 0 THEN room::DOUBLE / weight::DOUBLE END AS ratio FROM room{depth} {join}
), b{depth} AS (
  SELECT *, weight > 0 AND room * sum(weight) OVER ({node} ORDER BY ratio NULLS LAST, {name} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
    <= weight * (budget - coalesce(sum(room) OVER ({node} ORDER BY ratio NULLS LAST, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS filled
  FROM a{depth}
), c{depth} AS (
  SELECT *, budget - sum(CASE WHEN filled THEN room ELSE 0 END) OVER ({node}) AS spare,
    sum(CASE WHEN filled THEN 0 ELSE weight END) OVER ({node}) AS open_weight FROM b{depth}
), d{depth} AS (
  SELECT *, CASE WHEN filled OR weight = 0 THEN 0 ELSE (weight * spare) // open_weight END AS part FROM c{depth}
), given{depth} AS (
  SELECT {path}, room, CASE WHEN filled THEN room ELSE part + CASE WHEN weight > 0
    AND row_number() OVER ({node} ORDER BY filled, ratio NULLS LAST, {name}) <= spare - sum(part) OVER ({node}) THEN 1 ELSE 0 END
    END AS given FROM d{depth}
)"""


ORACLES: dict[str, str] = {
    "op1_mix": f"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    coalesce('domain' || (regexp_extract(source, '([0-9]+)$', 1)::INT % 4)::VARCHAR, 'none') AS domain,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS n_tokens
  FROM documents
), leaves AS (
  SELECT domain, lang, source, sum(n_tokens)::HUGEINT AS tokens FROM docs GROUP BY ALL
), room3 AS (
  SELECT domain, lang, source, {_case("source")}::HUGEINT AS weight, CASE WHEN {_case("source")} > 0 THEN tokens * 2 ELSE 0 END::HUGEINT AS room FROM leaves
), room2 AS (
  SELECT domain, lang, {_case("lang")}::HUGEINT AS weight, CASE WHEN {_case("lang")} > 0 THEN sum(room) ELSE 0 END::HUGEINT AS room FROM room3 GROUP BY domain, lang
), room1 AS (
  SELECT domain, {_case("domain")}::HUGEINT AS weight, CASE WHEN {_case("domain")} > 0 THEN sum(room) ELSE 0 END::HUGEINT AS room FROM room2 GROUP BY domain
), top AS (
  SELECT least((SELECT sum(tokens) * 8 // 10 FROM leaves), sum(room)) AS budget FROM room1
), {", ".join(_shares(depth) for depth in (1, 2, 3))}, plan AS (
  SELECT domain, lang, source, given // tokens AS whole, given % tokens AS rest
  FROM given3 JOIN leaves USING (domain, lang, source) WHERE given > 0
), placed AS (
  SELECT docs.*, whole, rest,
    ('0x' || substr(md5('17:' || whole::VARCHAR || ':' || coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS place
  FROM docs JOIN plan USING (domain, lang, source)
), summed AS (
  SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY place, doc_id, n_tokens
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM placed
)
SELECT doc_id, domain, lang, source, unnest(range(whole::BIGINT)) AS epoch, n_tokens, n_tokens AS taken_tokens FROM placed
UNION ALL
SELECT doc_id, domain, lang, source, whole::BIGINT, n_tokens, least(n_tokens, rest - before)::BIGINT FROM summed WHERE before < rest
""",
    "op5_decontaminate": f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
), t AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words FROM benchmark
), dw AS (
  SELECT doc_id, len(words) AS n, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM d
), tw AS (
  SELECT item_id, len(words) AS m, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS j FROM t
), diagonals AS (
  SELECT doc_id, item_id, i - j AS shift, n, m, list(j) AS places FROM dw JOIN tw USING (word) WHERE m >= {decontaminate.SPAN}
  GROUP BY doc_id, item_id, i - j, n, m HAVING count(*) * 5 >= least(m, {decontaminate.STRETCH}) * 4
), stretches AS (
  SELECT *, least(m, {decontaminate.STRETCH}) AS need,
    unnest(range(greatest(1, 1 - shift), least(m, n - shift) - least(m, {decontaminate.STRETCH}) + 2)) AS first FROM diagonals
), counted AS (
  SELECT doc_id, item_id, need, len(places) AS total, len([x FOR x IN places IF x >= first AND x < first + need]) AS most FROM stretches
), best AS (
  SELECT doc_id, item_id, max({{'most': most, 'total': total}}) AS top FROM counted WHERE most * 5 >= need * 4 GROUP BY doc_id, item_id
)
SELECT doc_id, item_id, top.most::BIGINT AS n_equal, top.total::BIGINT AS n_equal_total FROM best
""",
    "op4_substrings": """
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
), e AS (
  SELECT doc_id, unnest(range(1, len(words) - 11)) AS i, words FROM w
), k AS (
  SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS edge FROM e
), cut AS (
  SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY edge) AS first FROM k) WHERE first < doc_id
), gone AS (
  SELECT doc_id, list(DISTINCT j) AS places FROM (SELECT doc_id, unnest(range(i, i + 13)) AS j FROM cut) GROUP BY doc_id
), marks AS (
  SELECT doc_id, words, coalesce(places, []) AS places FROM w LEFT JOIN gone USING (doc_id)
)
SELECT doc_id, len(words)::BIGINT AS n_words, len(places)::BIGINT AS n_removed,
  sha256(array_to_string([words[j] FOR j IN range(1, len(words) + 1) IF NOT list_contains(places, j)], ' ')) AS kept_sha256
FROM marks
""",
    "op7_near_duplicates": """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
    ELSE list_distinct([array_to_string(words[i:i + 3], ' ') FOR i IN range(1, len(words) - 2)]) END AS shingles
  FROM w
), e AS (
  SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM s
), links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM e AS a JOIN e AS b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 80 * (min(a.n) + min(b.n) - count(*))
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM s UNION SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y
), c AS (
  SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x
)
SELECT doc_id, len(shingles)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN c USING (doc_id)
""",
    "op6_line_chunks": f"""
WITH lined AS (
  SELECT doc_id, CASE WHEN coalesce(text, '') = '' THEN [] ELSE string_split(text, chr(10)) END AS lines FROM documents
), hashed AS (
  SELECT *, [('0x' || substr(md5(x), 1, 7))::BIGINT FOR x IN lines] AS hashes FROM lined
), ended AS (
  SELECT doc_id, lines,
    [i FOR i IN range(1, len(lines) + 1) IF (({_ROLLING}) // 8) % {line_dedup.SHARE} = 0 OR i = len(lines)] AS ends
  FROM hashed
), bounds AS (
  SELECT doc_id, lines, ends, unnest(range(1, len(ends) + 1)) AS j FROM ended
), chunks AS (
  SELECT doc_id, CASE WHEN j = 1 THEN 1 ELSE ends[j - 1] + 1 END AS a, ends[j] AS b,
    array_to_string(lines[(CASE WHEN j = 1 THEN 1 ELSE ends[j - 1] + 1 END):ends[j]], chr(10)) AS chunk
  FROM bounds
), judged AS (
  SELECT doc_id, a, b, row_number() OVER (PARTITION BY chunk ORDER BY doc_id, a) AS place FROM chunks
  WHERE b > a AND regexp_matches(chunk, '[^\\x20\\x09-\\x0D]')
), cuts AS (
  SELECT doc_id, list(i) AS gone FROM (SELECT doc_id, unnest(range(a, b + 1)) AS i FROM judged WHERE place > 1) GROUP BY doc_id
), kept AS (
  SELECT doc_id, lines, [lines[i] FOR i IN range(1, len(lines) + 1) IF NOT list_contains(coalesce(gone, []), i)] AS kept
  FROM lined LEFT JOIN cuts USING (doc_id)
)
SELECT doc_id, len(lines)::BIGINT AS n_lines, (len(lines) - len(kept))::BIGINT AS n_removed,
  sha256(array_to_string(kept, chr(10))) AS kept_sha256
FROM kept
""",
    "op9_warc": f"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), d AS (
  SELECT page_id, payload_bytes, {_BASE32} AS payload_digest, max(page_id) OVER (PARTITION BY hex) AS owner FROM p
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = owner THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> owner THEN owner END AS refers_to
FROM d
""",
    "op12_repair": oracles.CONVERSATIONS,
    "op13_spelling": oracles.SPELLING,
}
