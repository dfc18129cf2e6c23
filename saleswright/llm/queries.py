"""The registered query of each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure
from . import language, secrets
from .common import table
from .decontaminate import find_leaks
from .embeddings import near_vectors
from .html_text import extract
from .html_text import train as train_chain
from .licenses import scan_licenses
from .packing import pack
from .pii import BASE_KINDS, find_pii
from .quality import COUNTS, RATIOS, quality
from .runs import find_runs
from .search import rank_documents
from .sharding import assign_shards
from .simhash import near_duplicates


#: Cosines of all pairs, and what links reach from each vector.
EMBEDDINGS_SQL = """
    WITH RECURSIVE vector AS (
        SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
        WHERE embedding IS NOT NULL AND list_bool_and([x IS NOT NULL AND isfinite(x) FOR x IN embedding])
              AND list_bool_or([x <> 0 FOR x IN embedding])),
    link AS (
        SELECT a.vec_id AS a, b.vec_id AS b FROM vector a JOIN vector b
        ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9),
    reached AS (
        SELECT a, b FROM link UNION SELECT reached.a, link.b FROM reached JOIN link ON reached.b = link.a),
    least AS (SELECT a, MIN(b) AS b FROM reached GROUP BY a),
    direct AS (SELECT a, COUNT(*) AS n FROM link GROUP BY a)
    SELECT vec_id, COALESCE(direct.n, 0) AS n_links, LEAST(vec_id, COALESCE(least.b, vec_id)) AS component_id,
           vec_id <= COALESCE(least.b, vec_id) AS kept
    FROM embeddings LEFT JOIN least ON least.a = vec_id LEFT JOIN direct ON direct.a = vec_id
"""

#: Ranked search in plain SQL: terms, weights, scores of all pairs, the first 50 of each item.
SEARCH_SQL = r"""
    WITH word AS (
        SELECT doc_id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM documents),
    doc AS (SELECT doc_id, COUNT(*) AS n FROM word GROUP BY doc_id),
    total AS (SELECT COUNT(*) AS docs, CAST(SUM(n) AS BIGINT) AS words FROM doc),
    bag AS (SELECT doc_id, term, COUNT(*) AS tf FROM word GROUP BY doc_id, term),
    weight AS (
        SELECT term, CAST(FLOOR(1000 * LN((2 * MIN(docs) + 2) / (2 * COUNT(*) + 1))) AS BIGINT) AS w
        FROM bag, total GROUP BY term),
    asked AS (
        SELECT DISTINCT item_id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM benchmark),
    scored AS (
        SELECT item_id, doc_id,
               CAST(SUM(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // words)))) AS BIGINT) AS score
        FROM asked JOIN bag USING (term) JOIN weight USING (term) JOIN doc USING (doc_id), total
        GROUP BY item_id, doc_id),
    ranked AS (
        SELECT item_id, CAST(ROW_NUMBER() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
               doc_id, score
        FROM scored WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(configure(spark), sf_dir, "documents")
    return quality(docs).select("doc_id", *COUNTS[:5], "base_failed", "kept", "lang", "source", *RATIOS)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("tiles")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(configure(spark), sf_dir, "documents")
    return assign_shards(docs, shards=16).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(configure(spark), sf_dir, "documents")
    found = secrets.find_secrets(docs, secrets.train(docs))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE_KINDS))
    return found.select(
        "doc_id", *map(count, secrets.BASE_KINDS), F.sha2(joined(base), 256).alias("base_sha256"), joined("spans").alias("spans")
    )


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(configure(spark), sf_dir, "documents")
    return near_duplicates(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(configure(spark), sf_dir, "documents")
    fold = language.remainder(F.col("doc_id"))
    model = language.train(docs.filter(fold != 1))
    held_out = F.coalesce(fold == 1, F.lit(False)).alias("held_out")
    return language.identify(docs, model).select("doc_id", held_out, "lang_pred", "score")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(configure(spark), sf_dir, "documents").select("doc_id", "text")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    spans = F.col("pii")
    base = F.filter(spans, lambda s: s["kind"].isin(*BASE_KINDS))

    def count(kind):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return find_pii(docs).select(
        "doc_id",
        *map(count, BASE_KINDS),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(spans).alias("spans"),
    )


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of a tree: source, thousands, twenty-fives of the id.

    Those with an even id that speak of a licence lie one folder up as licence
    files, so that the folders below inherit from them.
    """
    docs = table(configure(spark), sf_dir, "documents")
    doc_id = F.coalesce(F.col("doc_id"), F.lit(0))
    up = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.floor(doc_id / 1000).cast("string"))
    as_license = F.coalesce(F.col("text").rlike("(?i)licen[sc]"), F.lit(False)) & (doc_id % 2 == 0)
    path = F.when(as_license, F.concat(up, F.lit("/LICENSE."), doc_id.cast("string"))).otherwise(
        F.concat_ws("/", up, F.floor(doc_id / 25).cast("string"), F.concat(doc_id.cast("string"), F.lit(".txt")))
    )
    return scan_licenses(docs.select("doc_id", path.alias("path"), "text"))


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(configure(spark), sf_dir, "pages")
    return extract(pages, train_chain(pages))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(configure(spark), sf_dir, "documents"))


def op11_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(configure(spark), sf_dir, "embeddings"))


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs and collapsed text, after the repeated endings that the contract plants by id."""
    docs = table(configure(spark), sf_dir, "documents").select("doc_id", F.col("text").cast("string").alias("text"))
    h = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(1))
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    planted = docs.withColumns({"words": F.when(h % 10 == 0, words), "g": F.floor(h / 10)})
    planted = planted.withColumn("n", F.size("words"))
    n, g = F.col("n"), F.col("g")
    planted = planted.withColumn("a", F.when(n > 0, F.try_mod(g, n)).cast("int"))
    left = n - F.col("a")
    planted = planted.withColumn("p", (1 + F.floor(left / (3 + g % 8))).cast("int"))
    root = F.slice("words", F.col("a") + 1, F.col("p"))
    ending = F.flatten(F.array_repeat(root, F.ceil(left / F.col("p")).cast("int")))
    both = F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(ending, F.lit(1), left))
    text = F.when(F.col("a").isNotNull(), F.array_join(both, " ")).otherwise(F.col("text"))
    found = find_runs(planted.select("doc_id", text.alias("text")))

    def better(x, y):
        """The run with more periods, then the earlier, then the shorter period."""
        mine, other = x["length"] * y["period"], y["length"] * x["period"]
        earlier = (x["start"] < y["start"]) | ((x["start"] == y["start"]) & (x["period"] < y["period"]))
        return F.when((mine > other) | ((mine == other) & earlier), x).otherwise(y)

    runs = F.col("runs")
    best = F.aggregate(runs, F.get(runs, F.lit(0)), better)
    lines = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality": op1_quality,
        "op2_decontaminate": op2_decontaminate,
        "op3_sharding": op3_sharding,
        "op4_secrets": op4_secrets,
        "op5_simhash": op5_simhash,
        "op6_language": op6_language,
        "op7_pii": op7_pii,
        "op8_licenses": op8_licenses,
        "op9_html": op9_html,
        "op10_packing": op10_packing,
        "op11_embeddings": op11_embeddings,
        "op12_search": op12_search,
        "op13_runs": op13_runs,
    }


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for the queries that it can express; tests restate the others plainly."""
    return {"op11_embeddings": EMBEDDINGS_SQL, "op12_search": SEARCH_SQL}
