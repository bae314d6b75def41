"""The columns that SQL can state, of queries whose other columns it cannot: against DuckDB over whole small tables."""

import os
import zlib

import pytest

from waybill.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"

duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    connection.create_function("crc32", lambda text: zlib.crc32(text.encode()), ["VARCHAR"], "BIGINT")
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    return connection


def same(spark, con, operator, sql):
    """Whole numbers and texts are equal, doubles to nine digits, on every document."""
    name = next(n for n in QUERIES if n.startswith(operator + "_"))
    stated = con.execute(sql)
    columns = [d[0] for d in stated.description]
    plain = lambda row: tuple(f"{v:.9g}" if isinstance(v, float) else str(v) for v in row)
    want = sorted(plain(r) for r in stated.fetchall())
    got = sorted(plain(r) for r in QUERIES[name](spark, FOLDER).select(*columns).collect())
    assert got == want and want


def test_counts_of_quality_rules(spark, con):
    same(spark, con, "op4", rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {WORDS} AS w FROM documents),
windows AS (SELECT r, i, array_to_string(w[i:i + 7], ' ') AS s FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM d)),
repeated AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, s) > 1),
covered AS (SELECT r, count(DISTINCT place) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS place FROM repeated) GROUP BY r),
lines AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)
          WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r)
SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
       len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, coalesce(lines.n, 0) AS n_dup_lines,
       coalesce(covered.n, 0) AS n_repeat_words,
       len(w) < 20 OR 100 * coalesce(covered.n, 0) > 30 * len(w) AS base_failed
FROM d LEFT JOIN covered USING (r) LEFT JOIN lines USING (r)""")


def test_base_score_of_lm_scoring(spark, con):
    same(spark, con, "op5", rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, crc32(CAST(doc_id AS VARCHAR)) % 10 = 0 AS held_out,
                  list_append({WORDS.replace('text', LOWER)}, '') AS w FROM documents),
tokens AS (SELECT r, doc_id, held_out, unnest(w) AS t FROM d),
counts AS (SELECT t, count(*) AS c FROM tokens WHERE NOT held_out GROUP BY t),
totals AS (SELECT sum(c) AS n, count(*) AS v FROM counts)
SELECT doc_id, held_out, count(*) AS n_tokens, count(c) AS n_known, CAST(max(n) AS BIGINT) AS train_tokens,
       CAST(sum(log10((coalesce(c, 0) + 0.1::DOUBLE) / (n + 0.1::DOUBLE * (v + 1)))) AS DOUBLE) AS base_score
FROM tokens LEFT JOIN counts USING (t), totals GROUP BY r, doc_id, held_out""")


def test_sizes_of_mixing(spark, con):
    same(spark, con, "op6", f"""
SELECT doc_id, len({WORDS}) AS size, CAST(sum(len({WORDS})) OVER (PARTITION BY source) AS BIGINT) AS source_size FROM documents""")


def test_sizes_of_sharding(spark, con):
    same(spark, con, "op7", """
SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 8 AS size, crc32(coalesce(text, '')) AS text_crc32, 'bytes' AS law
FROM documents""")
