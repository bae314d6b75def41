"""The registered queries of the corpus operators: thin, with production parameters, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.llm import decontaminate, langid, lm, mixing, negatives, periodic, rules, sharding, simhash, substring, tokens, topk, toxicity

QUERIES = {}
SQL = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql:
            SQL[name] = sql.strip()
        return build

    return register


@query("op1_simhash_near_dedup")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"), width=4, radius=4)


_HIT_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query("op10_benchmark_decontamination", f"""
WITH d AS (SELECT doc_id, {_HIT_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_HIT_WORDS} AS w FROM benchmark),
p AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(list_slice(w, i, i + 9), ' ') AS g
      FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
s AS (SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g
      FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
            FROM d, (SELECT DISTINCT n FROM p) WHERE len(w) >= n)),
h AS (SELECT doc_id, s.n, i, item_id FROM s JOIN p ON s.n = p.n AND s.g = p.g),
hit AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit
        FROM (SELECT doc_id, i, unnest(range(0, n)) AS k FROM (SELECT DISTINCT doc_id, n, i FROM h)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(t, ',' ORDER BY t)) AS digest
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS t FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(digest, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
""")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.report(table(spark, folder, "documents"), table(spark, folder, "benchmark"), width=10)


@query("op8_token_id_output")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.round_trip(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


@query("op6_mix_sources")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.report(table(spark, folder, "documents"), weights=(5, 2, 1), cap=3)


@query("op7_sharding")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.report(table(spark, folder, "documents"), shards=24)


@query("op2_substring_dedup", r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, i, list_slice(w, i, i + 12) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
f AS (SELECT g, min(doc_id) AS first FROM s GROUP BY g HAVING min(doc_id) < max(doc_id)),
r AS (SELECT DISTINCT doc_id, i + k AS pos FROM (SELECT s.doc_id, i, unnest(range(0, 13)) AS k FROM s JOIN f ON s.g = f.g WHERE first < doc_id)),
k AS (SELECT d.doc_id, d.pos, word FROM (SELECT doc_id, unnest(range(1, len(w) + 1)) AS pos, unnest(w) AS word FROM d) d
      ANTI JOIN r ON r.doc_id = d.doc_id AND r.pos = d.pos),
t AS (SELECT doc_id, count(*) AS n, sha256(string_agg(word, ' ' ORDER BY pos)) AS digest FROM k GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed, coalesce(digest, sha256('')) AS kept_sha256
FROM d LEFT JOIN t USING (doc_id)
""")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return substring.without_repeats(table(spark, folder, "documents"), width=13, texts=False)


@query("op4_quality_rules")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return rules.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op3_language_id")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return langid.report(table(spark, folder, "documents"), of=4, fold=2)


@query("op5_lm_scoring")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return lm.report(table(spark, folder, "documents"), of=10, fold=0, deleted=1)


@query("op9_toxicity")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.report(table(spark, folder, "documents"), table(spark, folder, "labels"))


#: crc32 of the decimal doc_id, by its table of bytes.
_CRC = """
crc AS (SELECT list_transform(range(256), lambda x: list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0],
               lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS bytes),
coded AS (SELECT doc_id, text, xor(4294967295, list_reduce(list_prepend(4294967295,
                 list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
                 lambda c, b: xor(c >> 8, bytes[xor(c % 256, b) + 1]))) AS h FROM documents, crc)"""


@query("op12_periodic_runs", rf"""
WITH {_CRC},
d AS (SELECT doc_id, h, h // 10 AS g, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM coded),
e AS (SELECT *, len(w) AS n, CASE WHEN len(w) > 0 THEN g % len(w) END AS a FROM d),
f AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM e),
v AS (SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
      THEN list_transform(range(n), lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % p + 1] END) ELSE w END AS w FROM f),
x AS (SELECT doc_id, n, unnest(w) AS word, unnest(range(n)) AS i FROM v),
m AS (SELECT x.doc_id, y.i - x.i AS q, x.i FROM x JOIN x y ON x.doc_id = y.doc_id AND x.word = y.word
      AND y.i > x.i AND 3 * (y.i - x.i) <= x.n),
s AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM m),
r AS (SELECT doc_id, min(i) AS s, count(*) + q AS l, q FROM s GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(24, 3 * q)),
u AS (SELECT doc_id, s, l, min(q) AS q FROM r GROUP BY doc_id, s, l),
best AS (SELECT doc_id, count(*) AS n_runs, first(struct_pack(s := s, l := l, q := q) ORDER BY l / q DESC, s, q) AS b,
         sha256(string_agg(concat(s, ',', l, ',', q, chr(10)), '' ORDER BY s, q)) AS digest FROM u GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + l)) AS i FROM u),
kept AS (SELECT doc_id, sha256(string_agg(word, ' ' ORDER BY i)) AS digest FROM x ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT v.doc_id, coalesce(n_runs, 0) AS n_runs, b.s AS start, b.l AS length, b.q AS period, 1000 * b.l // b.q AS exponent_milli,
       coalesce(best.digest, sha256('')) AS runs_sha256, coalesce(kept.digest, sha256('')) AS collapsed_sha256
FROM v LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)
""")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return periodic.report(periodic.with_cycles(table(spark, folder, "documents")), least=24, times=3)


_WHOLE = """list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE)))"""
_FIT = """embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""


@query("op11_exact_top_k", f"""
WITH v AS (SELECT row_number() OVER () AS place, vec_id, {_WHOLE} AS e FROM embeddings WHERE {_FIT}),
s AS (SELECT q.place, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.place <> c.place WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY place ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"), asks=F.col("vec_id") % 50 == 0, k=5)


@query("op13_hard_negatives", f"""
WITH v AS (SELECT row_number() OVER () AS place, vec_id, {_WHOLE} AS e,
                  CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
           FROM embeddings WHERE label IS NOT NULL AND {_FIT}),
s AS (SELECT a.place, a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id, CAST(list_dot_product(a.e, c.e) AS BIGINT) AS score
      FROM v a JOIN v c ON a.place <> c.place WHERE a.vec_id % 100 = 0),
p AS (SELECT *, row_number() OVER (PARTITION BY place ORDER BY score DESC, vec_id NULLS LAST) AS n FROM s WHERE same),
r AS (SELECT s.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
             row_number() OVER (PARTITION BY s.place, p.n ORDER BY s.score DESC, s.vec_id NULLS LAST) AS rank
      FROM s JOIN p ON s.place = p.place AND p.n <= 5
      WHERE NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM r WHERE rank <= 10
""")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, label, positives=5, k=10,
                                    lowest=30, highest=90)
