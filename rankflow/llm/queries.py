"""One named query for each operator, over its whole table, with SQL twins where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.llm import (
    chat,
    decontaminate,
    hard_negatives,
    license_scan,
    lpf_dedup,
    ngram_lm,
    phrases,
    quality,
    sentencepiece_codec,
    sharding,
    simhash,
    topk,
    toxicity,
)

SENTENCEPIECE_MODEL = "piece_bpe_32k.model"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    encoded = sentencepiece_codec.encode(table(spark, folder, "documents"), public_tokenizers.path(SENTENCEPIECE_MODEL))
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2(F.col("ids").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan(table(spark, folder, "documents"))


def op4_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = lpf_dedup.remove_repeats(table(spark, folder, "documents"), keep_first=False)
    return found.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op5_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_lm.score(table(spark, folder, "documents"), order=ngram_lm.ORDER)


def op6_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    return chat.rotate(table(spark, folder, "conversations"))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contained(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op9_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(table(spark, folder, "documents"))


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(table(spark, folder, "documents"))


def op11_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"), "vec_id % 50 = 0")


def op12_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"))


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    embeddings = table(spark, folder, "embeddings")
    shifted = F.expr("IF(vec_id % 7 = 0, (label + 1) % 10, label)")
    return hard_negatives.mine(embeddings.withColumn("label", shifted), "vec_id % 100 = 0")


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words_sql(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"


def license_sql() -> str:
    rules = sorted(license_scan.RULES, key=lambda r: -len(r[2]))
    known = " ".join(f"WHEN '{license_scan.plain(s)}' THEN {i}" for i, s in license_scan.SENTENCES.items())
    rule = " ".join(f"WHEN ids[i:i + {len(q) - 1}] = {q} THEN {k}" for k, (_, _, q) in enumerate(rules, 1))
    longest = len(rules[0][2])
    lengths = [0, *[len(r[2]) for r in rules]]
    free = " AND ".join(
        f"coalesce({lengths}[found[greatest(i - {b}, 1)] + 1], 0) * (i > {b})::INT <= {b}" for b in range(1, longest)
    )
    names, licences = ["", *[r[0] for r in rules]], ["", *[r[1] for r in rules]]
    stems = " OR ".join(f"contains(lower(coalesce(text, '')), '{x}')" for x in license_scan.STEMS)
    return f"""
WITH s AS (
  SELECT row_number() OVER () AS row, doc_id, CASE WHEN {stems} THEN list_transform(
    string_split(regexp_replace(coalesce(text, ''), '{license_scan.SENTENCE_END}', chr(10), 'g'), chr(10)),
    lambda x: trim(regexp_replace(lower(x), '{license_scan.OUTSIDE}', ' ', 'g'))) ELSE [] END AS sentences
  FROM documents),
d AS (SELECT row, doc_id, list_transform(sentences, lambda x: CASE x {known} ELSE 0 END) AS ids FROM s),
a AS (SELECT *, list_transform(range(1, len(ids) + 1), lambda i: CASE {rule} ELSE 0 END) AS found FROM d),
h AS (SELECT *, list_filter(range(1, len(found) + 1), lambda i: found[i] > 0 AND {free}) AS hits FROM a)
SELECT doc_id, len(list_filter(ids, lambda x: x > 0))::BIGINT AS n_sentences_known,
  array_to_string(list_transform(hits, lambda i: {names}[found[i] + 1] || '@' || (i - 1)), ',') AS rules,
  array_to_string(list_sort(list_distinct(list_transform(hits, lambda i: {licences}[found[i] + 1]))), ',') AS licences
FROM h"""


CHAT_SQL = r"""
WITH r AS (
  SELECT conv_id, turn,
    regexp_replace(coalesce(nullif(trim(role), ''), 'unknown'), '[^A-Za-z0-9_-]', '_', 'g') AS speaker,
    replace(coalesce(text, ''), '<|', '< |') AS said
  FROM conversations),
p AS (SELECT DISTINCT conv_id, speaker AS perspective FROM r WHERE speaker <> 'system'),
j AS (
  SELECT r.*, perspective,
    CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant' ELSE 'user' END AS role
  FROM r JOIN p ON r.conv_id IS NOT DISTINCT FROM p.conv_id),
h AS (
  SELECT *, CASE WHEN role = 'user' THEN speaker END AS name,
    '<|im_start|>' || role || CASE WHEN role = 'user' THEN ' name=' || speaker ELSE '' END || chr(10) AS head FROM j),
s AS (SELECT *, head || said || '<|im_end|>' || chr(10) AS segment FROM h),
w AS (
  SELECT *, row_number() OVER o - 1 AS seq, sum(length(segment)) OVER (o ROWS UNBOUNDED PRECEDING) AS stop
  FROM s WINDOW o AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, said))
SELECT conv_id, perspective, seq::BIGINT AS seq, turn, role, name, segment,
  (role = 'assistant')::INT AS mask, (stop - length(segment))::BIGINT AS begin, stop::BIGINT AS end,
  CASE WHEN role = 'assistant' THEN (stop - length(segment) + length(head))::BIGINT END AS train_begin,
  CASE WHEN role = 'assistant' THEN (stop - 1)::BIGINT END AS train_end
FROM w"""


def decontamination_sql() -> str:
    size = decontaminate.SIZE
    shingles = (
        f"unnest(list_transform(range(1, len(w) - {size - 2}), lambda i: array_to_string(w[i:i + {size - 1}], ' ')))"
    )
    return f"""
WITH d AS (SELECT DISTINCT doc_id, {shingles} AS s FROM (SELECT doc_id, {_words_sql(_LOWER)} AS w FROM documents)),
i AS (SELECT DISTINCT item_id, {shingles} AS s FROM (SELECT item_id, {_words_sql(_LOWER)} AS w FROM benchmark)),
n AS (SELECT item_id, count(*) AS n_shingles FROM i GROUP BY 1)
SELECT doc_id, item_id, count(*) AS n_shared, any_value(n_shingles) AS n_shingles
FROM d JOIN i USING (s) JOIN n USING (item_id)
GROUP BY doc_id, item_id HAVING count(*) * 100 >= any_value(n_shingles) * {decontaminate.THRESHOLD}"""


def quality_sql() -> str:
    keep, window = quality.KEEP_BITS, quality.WINDOW
    pairs = " UNION ALL ".join(
        f"SELECT lang_key, group_key, '{m}' AS measure, {m} AS v FROM m WHERE NOT base_failed" for m in quality.MEASURES
    )
    spans = []
    verdict = ["NOT base_failed"]
    for name, (_, low, slack) in quality.MEASURES.items():
        most = f"high + (high - middle) * {quality.REACH} + {slack}"
        spans.append(f"max(CASE WHEN measure = '{name}' THEN {most} END) AS {name}_most")
        verdict.append(f"{name} <= {name}_most")
        if low is not None:
            least = f"low - (middle - low) * {quality.REACH} - {slack}"
            spans.append(f"max(CASE WHEN measure = '{name}' THEN {least} END) AS {name}_least")
            verdict.append(f"{name} >= {name}_least")
    side = {
        c: "CASE measure " + " ".join(f"WHEN '{m}' THEN {row[i] or 'NULL'}" for m, row in quality.MEASURES.items()) + " END"
        for c, i in (("high", 0), ("low", 1))
    }
    names = ("low", "middle", "high")
    levels = []
    for level, keys in (("own", "lang_key, group_key, "), ("wide", "lang_key, "), ("every", "")):
        by = f"{keys}measure"
        marks = ", ".join(
            f"min(CASE WHEN run * 1000 >= docs * {side.get(c, 500)} THEN bucket END) AS {c}" for c in names
        )
        levels.append(f"""
{level}_n AS (SELECT {by}, bucket, sum(n) AS n FROM sketch GROUP BY {by}, bucket),
{level}_r AS (SELECT *, sum(n) OVER (PARTITION BY {by} ORDER BY bucket) AS run, sum(n) OVER (PARTITION BY {by}) AS docs FROM {level}_n),
{level} AS (SELECT {by}, max(docs) AS docs, {marks} FROM {level}_r GROUP BY {by})""")
    least = quality.LEAST_DOCS
    picks = ", ".join(
        f"CASE WHEN own.docs >= {least} THEN own.{c} WHEN wide.docs >= {least} THEN wide.{c} ELSE every.{c} END AS {c}" for c in names
    )
    return f"""
WITH t AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce('=' || lang, '0') AS lang_key,
    coalesce('=' || lang, '0') || chr(1) || coalesce('=' || source, '0') AS group_key,
    coalesce(text, '') AS text, {_words_sql("coalesce(text, '')")} AS w FROM documents),
win AS (SELECT row, unnest(range(1, len(w) - {window - 2})) AS i, w FROM t),
keyed AS (SELECT row, i, array_to_string(w[i:i + {window - 1}], ' ') AS k FROM win),
twice AS (SELECT row, i FROM (SELECT *, count(*) OVER (PARTITION BY row, k) AS c FROM keyed) WHERE c > 1),
rep AS (SELECT row, count(DISTINCT i + j) AS n FROM twice, unnest(range({window})) AS x(j) GROUP BY row),
lines AS (
  SELECT row, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM t),
c AS (
  SELECT t.row, doc_id, lang_key, group_key, len(w)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, len(l)::BIGINT AS n_lines,
    coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM t JOIN lines USING (row) LEFT JOIN rep USING (row)),
m AS (
  SELECT *, n_symbols * 1000 // greatest(n_words, 1) AS symbol_rate, n_dup_lines * 1000 // greatest(n_lines, 1) AS dup_line_rate,
    n_repeat_words * 1000 // greatest(n_words, 1) AS repeat_rate, word_chars * 100 // greatest(n_words, 1) AS word_length,
    n_words < 20 OR n_repeat_words * 100 > n_words * 30 AS base_failed FROM c),
v AS (SELECT *, greatest(0, length(bin(v)) - {keep}) AS cut FROM ({pairs})),
sketch AS (SELECT lang_key, group_key, measure, (v >> cut) << cut AS bucket, count(*) AS n FROM v GROUP BY ALL),
{",".join(levels)},
picked AS (
  SELECT group_key, measure, {picks} FROM own JOIN wide USING (lang_key, measure) JOIN every USING (measure)),
fence AS (SELECT group_key, {", ".join(spans)} FROM picked GROUP BY group_key)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  coalesce({" AND ".join(verdict)}, false) AS kept, {", ".join(quality.MEASURES)}
FROM m LEFT JOIN fence USING (group_key)"""


def phrases_sql(longest: int = phrases.LONGEST) -> str:
    grams = " UNION ALL ".join(
        f"SELECT lang, {k} AS n_words, array_to_string(w[i:i + {k - 1}], ' ') AS phrase FROM p, unnest(range(1, len(w) - {k - 2})) AS x(i)"
        for k in range(1, longest + 1)
    )
    cuts = " UNION ALL ".join(
        f"SELECT lang, phrase, a, {k} AS k, array_to_string(w[:{k}], ' ') AS head, array_to_string(w[{k + 1}:], ' ') AS tail"
        f" FROM c WHERE n_words > {k}"
        for k in range(1, longest)
    )
    inside = " UNION ALL ".join(
        f"SELECT lang, a, array_to_string(w[{i}:{i + size - 1}], ' ') AS phrase FROM c WHERE n_words >= {max(i + size - 1, size + 1)}"
        for size in range(2, longest)
        for i in range(1, longest - size + 2)
    )
    return f"""
WITH p AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM (
    SELECT coalesce(lang, '{phrases.UNKNOWN}') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents)),
s AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM p GROUP BY lang),
f AS (SELECT lang, n_words, phrase, count(*) AS n FROM ({grams}) GROUP BY ALL HAVING count(*) >= {phrases.LEAST}),
c AS (SELECT lang, n_words, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE n_words > 1),
cuts AS ({cuts}),
scored AS (
  SELECT cuts.lang, cuts.phrase, a, k, h.n AS l, t.n AS r, s.n, 1000::HUGEINT * a * s.n // (h.n::HUGEINT * t.n) AS score
  FROM cuts JOIN f h ON cuts.lang = h.lang AND head = h.phrase JOIN f t ON cuts.lang = t.lang AND tail = t.phrase
  JOIN s ON cuts.lang = s.lang),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (SELECT lang, phrase, max(a) AS longer FROM ({inside}) GROUP BY ALL),
best AS (
  SELECT lowest.*, row_number() OVER (PARTITION BY lowest.lang ORDER BY score DESC, a DESC, lowest.phrase) AS rank
  FROM lowest LEFT JOIN longer USING (lang, phrase) WHERE longer IS NULL OR longer * 100 < a * {phrases.COVER})
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM best WHERE rank <= {phrases.FIRST}"""


_INTEGERS_SQL = """
  SELECT *, row_number() OVER () AS row, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""

TOPK_SQL = f"""
WITH e AS ({_INTEGERS_SQL}),
s AS (
  SELECT q.row, q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM e q JOIN e c ON q.row <> c.row WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5"""

NEGATIVES_SQL = f"""
WITH e AS (
  SELECT row, vec_id, v, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
  FROM ({_INTEGERS_SQL}) WHERE label IS NOT NULL),
s AS (
  SELECT a.row, a.vec_id AS anchor_id, c.row AS other, c.vec_id, a.label = c.label AS same, list_inner_product(a.v, c.v)::BIGINT AS score
  FROM e a JOIN e c ON a.row <> c.row WHERE a.vec_id % 100 = 0),
p AS (
  SELECT * FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id NULLS LAST) <= {hard_negatives.POSITIVES}),
n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.row, p.other ORDER BY s.score DESC, s.vec_id NULLS LAST) AS rank
  FROM p JOIN s ON p.row = s.row AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= {hard_negatives.NEGATIVES}"""


QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_simhash": op2_simhash,
    "op3_license_scan": op3_license_scan,
    "op4_suffix_array_dedup": op4_suffix_array_dedup,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_chat_format": op6_chat_format,
    "op7_toxicity": op7_toxicity,
    "op8_decontamination": op8_decontamination,
    "op9_sharding": op9_sharding,
    "op10_quality_rules": op10_quality_rules,
    "op11_topk": op11_topk,
    "op12_phrases": op12_phrases,
    "op13_hard_negatives": op13_hard_negatives,
}

SQL = {
    "op3_license_scan": license_sql(),
    "op6_chat_format": CHAT_SQL,
    "op8_decontamination": decontamination_sql(),
    "op10_quality_rules": quality_sql(),
    "op11_topk": TOPK_SQL,
    "op12_phrases": phrases_sql(),
    "op13_hard_negatives": NEGATIVES_SQL,
}
