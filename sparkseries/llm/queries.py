"""Registered queries of this subpackage: each operator over its whole table, with its SQL twin
where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkseries.llm import sql
from sparkseries.llm.articles import articles
from sparkseries.llm.decontaminate import contaminated
from sparkseries.llm.divergence import divergences
from sparkseries.llm.infill import infilled, restored
from sparkseries.llm.language import language_of
from sparkseries.llm.licenses import license_scan
from sparkseries.llm.lines import cleaned
from sparkseries.llm.lm import lm_scores
from sparkseries.llm.mixing import mixed
from sparkseries.llm.neardup import near_duplicates
from sparkseries.llm.passages import repeated_passages
from sparkseries.llm.ranking import quality_scores
from sparkseries.llm.warc import round_trip

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(text: str | None = None):
    """Register a function under its own name, with its SQL twin if there is one."""

    def register(fn):
        QUERIES[fn.__name__] = fn
        if text is not None:
            ORACLE[fn.__name__] = text
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def fold(k: int, id_: str = "doc_id") -> Column:
    """Remainder of the id's checksum; a null id is in no fold (-1)."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_).cast("string").cast("binary")), F.lit(k)), F.lit(-1))


# Targets of the mixture: the first ten sources are the web, the others are books.
MIX_WEIGHTS = {"domain": {"web": 0.6, "books": 0.4}, "lang": {"en": 0.45, "de": 0.35, "fr": 0.15, "es": 0.05}}
MIX = {"share": 1.2, "max_epochs": 3, "seed": 17}


def mix_levels(lang: str = "lang", source: str = "source") -> dict[str, Column]:
    web = F.col(source).rlike("^src[0-9]$")
    return {"domain": F.when(web, "web").otherwise("books"), "lang": F.col(lang), "source": F.col(source)}


MIX_SQL = {"domain": "CASE WHEN regexp_matches(source, '^src[0-9]$') THEN 'web' ELSE 'books' END", "lang": "lang", "source": "source"}


@query(sql.mixing(MIX_SQL, MIX_WEIGHTS, **MIX))
def op1_mixing(spark, sf):
    return mixed(table(spark, sf, "documents").select("doc_id", "text", "lang", "source"), mix_levels(), MIX_WEIGHTS, **MIX)


@query()
def op2_language_id(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    out = language_of(docs, ~fold(3).isin(1, -1))
    return out.select("doc_id", (fold(3) == 1).alias("held_out"), "lang_pred", "score")


@query()
def op3_repeated_passages(spark, sf):
    return repeated_passages(table(spark, sf, "documents").select("doc_id", "text"))


@query()
def op4_lm_scores(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    out = lm_scores(docs, ~fold(10).isin(0, -1))
    return out.withColumn("held_out", fold(10) == 0).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query(sql.LICENSES)
def op5_license_scan(spark, sf):
    out = license_scan(table(spark, sf, "documents").select("doc_id", "text"))
    return out.drop("text")


@query(sql.NEAR_DUPLICATES)
def op6_minhash_near_dedup(spark, sf):
    return near_duplicates(table(spark, sf, "documents").select("doc_id", "text"), shingle=3, least=(85, 100))


@query(sql.LINES)
def op7_quality_rules(spark, sf):
    out = cleaned(table(spark, sf, "documents").select("doc_id", "text"), with_text=False)
    return out.drop("text", "n_clean_words")


@query(sql.WARC)
def op8_warc_round_trip(spark, sf):
    back = round_trip(table(spark, sf, "pages"))
    number = lambda c: F.col(c).cast("long")
    return back.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"))


@query(sql.CONTAMINATION)
def op9_decontamination(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    out = contaminated(docs, table(spark, sf, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query()
def op10_quality_ranking(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    out = quality_scores(docs, table(spark, sf, "labels"), ~fold(4).isin(2, -1))
    return out.withColumn("held_out", fold(4) == 2).select("doc_id", "held_out", "score", "predicted")


@query(sql.DIVERGENCE)
def op11_source_divergence(spark, sf):
    return divergences(table(spark, sf, "documents"))


@query()
def op12_html_extraction(spark, sf):
    return articles(table(spark, sf, "pages").select("page_id", "url", "html")).drop("n_blocks")


@query(sql.INFILL)
def op13_fill_in_middle(spark, sf):
    out = infilled(table(spark, sf, "documents").select("doc_id", "text"))
    back = restored(F.col("output"), F.col("form"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(back, 256).alias("restored_sha256"))
