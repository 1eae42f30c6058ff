"""The registered queries of the training-data operators: thin digests of the operators' outputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from trolley.llm.common import table


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trolley.llm.mixing import mix

    return mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source"
    )


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trolley.llm.html_text import extract

    return extract(table(spark, sf_dir, "pages"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trolley.llm.token_output import token_files
    from trolley.llm.tokens import vocabulary

    return token_files(spark, table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trolley.llm.packing import pack
    from trolley.llm.tokens import vocabulary

    return pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json")).drop("ids")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trolley.llm.toxicity import toxicity

    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_hamming_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trolley.llm.hamming_search import nearest

    return nearest(table(spark, sf_dir, "embeddings"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trolley.llm.near_dedup import near_dedup

    return near_dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trolley.llm.quality_model import quality

    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trolley.llm.quality_rules import quality_rules

    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trolley.llm.token_counts import token_counts
    from trolley.llm.tokens import vocabulary

    return token_counts(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op11_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trolley.llm.parity_join import parity_join

    return parity_join(table(spark, sf_dir, "documents"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trolley.llm.lexical_search import search

    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trolley.llm.spelling import spelling_variants

    return spelling_variants(table(spark, sf_dir, "documents"))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_source_mix": op1_source_mix,
        "op2_html_text": op2_html_text,
        "op3_token_files": op3_token_files,
        "op4_packing": op4_packing,
        "op5_toxicity": op5_toxicity,
        "op6_quality_rules": op6_quality_rules,
        "op7_hamming_search": op7_hamming_search,
        "op8_token_counts": op8_token_counts,
        "op9_near_dedup": op9_near_dedup,
        "op10_quality": op10_quality,
        "op11_parity_join": op11_parity_join,
        "op12_lexical_search": op12_lexical_search,
        "op13_spelling_variants": op13_spelling_variants,
    }


#: A search that scores every document for every item.
OP12_SQL = """
WITH cut AS (
  SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ts
  FROM documents
), d AS (SELECT doc_id, rid, ts, len(ts) AS n FROM cut WHERE len(ts) > 0),
all_docs AS (SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM d),
tf AS (SELECT rid, doc_id, n, term, count(*) AS tf FROM (SELECT rid, doc_id, n, unnest(ts) AS term FROM d) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
item AS (
  SELECT item_id, row_number() OVER () AS iid, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM benchmark
), asked AS (SELECT iid, item_id, term, count(*) AS k FROM item GROUP BY ALL),
weighed AS (
  SELECT iid, item_id, term, k, CAST(floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * df + 1))) AS BIGINT) AS w
  FROM asked JOIN df USING (term), all_docs
), scored AS (
  SELECT iid, item_id, rid, doc_id,
    CAST(sum(k * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * big_n) // big_l)))) AS BIGINT) AS score
  FROM weighed JOIN tf USING (term), all_docs GROUP BY ALL
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""


#: Every pair of documents that share a shingle is compared.
OP11_SQL = """
WITH RECURSIVE cut AS (
  SELECT doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), made AS (
  SELECT doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')))) END AS s
  FROM cut
), reps AS MATERIALIZED (SELECT s, min(doc_id) AS rep, len(s) AS n FROM made WHERE len(s) > 0 GROUP BY s),
one AS MATERIALIZED (SELECT rep, n, unnest(s) AS x FROM reps),
links AS MATERIALIZED (
  SELECT a.rep AS a, b.rep AS b FROM one a JOIN one b ON a.x = b.x AND a.rep <> b.rep
  WHERE 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), reach AS (
  SELECT rep AS a, rep AS b FROM reps UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), root AS (SELECT a AS rep, min(b) AS component_id FROM reach GROUP BY a)
SELECT m.doc_id, CAST(len(m.s) AS BIGINT) AS n_shingles, coalesce(root.component_id, m.doc_id) AS component_id
FROM made m LEFT JOIN reps USING (s) LEFT JOIN root USING (rep)
"""

#: The checksum is written out by its polynomial; near words meet in what is left of them without one letter.
OP13_SQL = """
WITH RECURSIVE crc_table AS MATERIALIZED (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2)
    ELSE c // 2 END) ORDER BY i) AS t FROM range(256) AS r(i)
), runs AS (
  SELECT doc_id, run, count(*) AS k FROM (
    SELECT doc_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\\x{C0}-\\x{FF}]{7,}')) AS run
    FROM documents) GROUP BY ALL
), coded AS (
  SELECT run, k, hex(encode(doc_id || ':' || run)) AS h FROM runs
), summed AS (
  SELECT run, k, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(1, len(h), 2), lambda i: CAST('0x' || h[i:i + 1] AS BIGINT))),
    lambda c, b: xor(c // 256, t[1 + xor(c, b) % 256]))) AS crc
  FROM coded, crc_table
), kept AS (
  SELECT CASE WHEN crc % 31 = 0 THEN run[1:CAST(crc % len(run) AS INT)] || run[CAST(crc % len(run) AS INT) + 2:] ELSE run END
    AS word, k FROM summed
), vocabulary AS MATERIALIZED (
  SELECT word, CAST(sum(k) AS BIGINT) AS n FROM kept WHERE len(word) >= 7 GROUP BY word HAVING sum(k) >= 2
), less AS MATERIALIZED (
  SELECT word, i, word[1:i - 1] || word[i + 1:] AS rest FROM vocabulary, LATERAL (SELECT unnest(range(1, len(word) + 1)) AS i)
), near AS MATERIALIZED (
  SELECT a.word, b.word AS other FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT l.word, v.word FROM less l JOIN vocabulary v ON l.rest = v.word
  UNION SELECT v.word, l.word FROM less l JOIN vocabulary v ON l.rest = v.word
), ranked AS (
  SELECT x.word, x.other, v.n AS m, row_number() OVER (PARTITION BY x.word ORDER BY v.n DESC, x.other) AS r,
    count(*) OVER (PARTITION BY x.word) AS n_near
  FROM near x JOIN vocabulary v ON x.other = v.word
), formed AS MATERIALIZED (
  SELECT v.word, v.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.m >= 10 * v.n THEN r.other END AS form,
    CASE WHEN r.m >= 10 * v.n THEN r.m END AS form_n
  FROM vocabulary v LEFT JOIN (SELECT * FROM ranked WHERE r = 1) r USING (word)
), up AS (
  SELECT word, word AS at FROM formed UNION ALL SELECT u.word, f.form FROM up u JOIN formed f ON u.at = f.word WHERE f.form IS NOT NULL
), root AS (SELECT u.word, u.at AS root FROM up u JOIN formed f ON u.at = f.word WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN root USING (word)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op11_parity_join": OP11_SQL,
        "op12_lexical_search": OP12_SQL,
        "op13_spelling_variants": OP13_SQL,
    }
