"""The columns of op2, op4, op5, op6 and op8 that SQL can express, as queries of their own with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.llm import fingerprints, licenses, media, secrets, sharding
from quern.llm.storage import durable

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def edited_texts(spark, sf_dir):
    """Of op2: the sizes, and the digests of the edited texts."""
    return fingerprints.query(spark, sf_dir).select("doc_id", "n_chars", "edited_sha256")


EDITED_TEXTS = """WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
n AS (SELECT doc_id, t, coalesce(lead(t) OVER (ORDER BY doc_id DESC), first_value(t) OVER (ORDER BY doc_id DESC)) AS following FROM d)
SELECT doc_id, length(t)::BIGINT AS n_chars, sha256(substr(t, 1, (length(t) - length(t) // 3)::INT) || substr(following, 1, (length(t) // 3)::INT)) AS edited_sha256 FROM n"""


def secret_counts(spark, sf_dir):
    """Of op4: how many base spans there are of each kind."""
    return secrets.query(spark, sf_dir).select("doc_id", "n_assign", "n_access", "n_hex")


_EITHER = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token")) + "|[aA][pP][iI]_?[kK][eE][yY]"
SECRET_COUNTS = rf"""SELECT doc_id, len(list_filter(regexp_extract_all(coalesce(text, ''), '({_EITHER})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2), lambda x: length(x) >= 6))::BIGINT AS n_assign,
len(list_filter(regexp_extract_all(coalesce(text, ''), 'AKIA[A-Z0-9]+'), lambda x: length(x) >= 20))::BIGINT AS n_access,
len(list_filter(regexp_extract_all(coalesce(text, ''), '[0-9a-f]+'), lambda x: length(x) >= 24))::BIGINT AS n_hex FROM documents"""


def sharded_sizes(spark, sf_dir):
    """Of op5: sizes and the law; whether equal texts are in one shard, slots are gapless, and no shard is over 1.02 of a fair share or the largest group."""
    rows = sharding.query(spark, sf_dir)
    rows = durable(rows)
    groups = rows.groupBy("text_crc32", "size").agg(F.count_distinct("shard").alias("s"), F.sum("size").alias("b")).agg(F.max("b").alias("b"), F.max("s").alias("s")).first()
    shards = rows.groupBy("shard").agg(F.sum("size").alias("b"), F.min("slot").alias("lo"), F.max("slot").alias("hi"), F.count_distinct("slot").alias("n")).collect()  # 24 rows at most
    even = all(r["b"] <= max(1.02 * sum(x["b"] for x in shards) / 24, groups["b"]) for r in shards)
    gapless = all(r["lo"] == 0 and r["hi"] == r["n"] - 1 for r in shards)
    return rows.select("doc_id", "size", "law", F.lit(even).alias("even"), F.lit(gapless).alias("gapless"), F.lit(groups["s"] in (None, 1)).alias("together"))


SHARDED_SIZES = "SELECT doc_id, strlen(coalesce(text, ''))::BIGINT + 8 AS size, 'bytes' AS law, true AS even, true AS gapless, true AS together FROM documents"


def licence_phrases(spark, sf_dir):
    """Of op6: words, places of the base phrases, and their labels."""
    return licenses.query(spark, sf_dir).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


LICENCE_PHRASES = rf"""WITH w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
p AS (SELECT doc_id, w, list_filter(range(1, len(w)), lambda i: w[i] = 'mit' AND w[i + 1] = 'license') AS m, list_filter(range(1, len(w)), lambda i: w[i] = 'apache' AND w[i + 1] = 'license') AS a,
 list_filter(range(1, len(w) - 1), lambda i: w[i] = 'general' AND w[i + 1] = 'public' AND w[i + 2] = 'license') AS g FROM w),
q AS (SELECT *, list_concat(list_concat(m, a), g) AS every FROM p)
SELECT doc_id, len(w)::BIGINT AS n_words, len(every)::BIGINT AS n_base, (list_min(every) - 1)::BIGINT AS first_word, (list_max(every) - 1)::BIGINT AS last_word,
concat_ws(',', CASE WHEN len(a) > 0 THEN 'apache' END, CASE WHEN len(g) > 0 THEN 'gpl' END, CASE WHEN len(m) > 0 THEN 'mit' END) AS base_labels FROM q"""


def media_payloads(spark, sf_dir):
    """Of op8: payloads, and the files they are stored as."""
    return media.query(spark, sf_dir).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "media_bytes", "media_sha256")


MEDIA_PAYLOADS = """WITH d AS (SELECT doc_id, coalesce(text, '') AS t, strlen(coalesce(text, '')) AS n FROM documents),
p AS (SELECT doc_id, n, t || repeat(' ', (greatest(192, ((n + 191) // 192) * 192) - n)::BIGINT) AS p FROM d),
f AS (SELECT *, 'P5' || chr(10) || '192 ' || (strlen(p) // 192) || chr(10) || '255' || chr(10) || p AS f FROM p)
SELECT doc_id, n::BIGINT AS n_bytes, strlen(p)::BIGINT AS payload_bytes, sha256(p) AS payload_sha256, strlen(f)::BIGINT AS media_bytes, sha256(f) AS media_sha256 FROM f"""

QUERIES = {f.__name__: f for f in (edited_texts, secret_counts, sharded_sizes, licence_phrases, media_payloads)}
ORACLE = {"edited_texts": EDITED_TEXTS, "secret_counts": SECRET_COUNTS, "sharded_sizes": SHARDED_SIZES, "licence_phrases": LICENCE_PHRASES, "media_payloads": MEDIA_PAYLOADS}
