"""The queries of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm import alignment, line_dedup, media, mixing, ngram_join, pieces, pii, quality_rules, spelling, suffix_dedup, token_store, toxicity, warc
from quillon.llm.common import cut, table


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return quality_rules.apply_rules(docs, drop_text=True).select("doc_id", *quality_rules.RESULT)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.plan(mixing.token_rows(docs), max_repetition=2.0).select("doc_id", "source", F.col("tokens").alias("n_tokens"), *mixing.PLAN)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(docs, length=400, keep_bytes=False, drop_text=True)


def op3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = pieces.encode(docs, pieces.model_path(), nbest=4, drop_text=True, as_bytes=True)
    best = ["doc_id", "n_pieces", F.crc32("ids").alias("ids_crc32"), "score", F.size("scores").alias("n_best"), F.get("scores", F.lit(1)).alias("second_score"), F.get("scores", F.size("scores") - 1).alias("last_score"), "round_trip"]
    return done.select(*best, F.concat_ws(",", "scores").alias("nbest_scores"), F.concat_ws(",", F.transform("nbest", lambda i: F.crc32(i).cast("string"))).alias("nbest_crc32"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, drop_text=True)
    counts = [F.expr(f"size(filter(all_spans, x -> x.k = {k}))").cast("long").alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, F.sha2(pii.listed("base"), 256).alias("base_sha256"), pii.listed("all_spans").alias("spans"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(~held_out)
    done = toxicity.score(docs, toxicity.train(docs, labels), drop_text=True)
    return done.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op6_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_store.round_trip(docs, token_store.model_path(), end=1)


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ngram_join.similar_groups(docs, n=3, pct=90)


def op8_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector as two recordings of a melody, 2 * vec_id and the next number: a member row gives a recording's class; a match row two classes that align, the first of them with a query. Queries: first takes of vectors whose id is divisible by 50."""
    sound = media.rendered(table(spark, sf_dir, "embeddings"))
    found = cut(media.classes(cut(media.fingerprints(sound), "fingerprints")), "classes")
    matches = media.align(found, F.col("id") % 100 == 0)
    members = found.select(F.lit("member").alias("kind"), "id", "class_id", F.coalesce(F.size("fingerprint"), F.lit(0)).cast("long").alias("n_frames"), F.lit(None).cast("int").alias("offset"), F.lit(None).cast("double").alias("bit_errors"))
    pairs = matches.select(F.lit("match"), "query_class", "class_id", (F.col("n_bits") / 32).cast("long"), "offset", F.round(F.col("n_errors") / F.col("n_bits"), 6))
    return members.union(pairs)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = line_dedup.dedup_lines(docs)
    return done.select("doc_id", "n_lines", "n_deleted", "n_runs", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return alignment.align(docs, alignment.a_path(), alignment.b_path())


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling.group_variants(docs, least=5, often=3, slips=97, ratio=2)


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_mixing, op2_suffix_dedup, op3_pieces, op4_pii, op5_toxicity, op6_token_store, op7_ngram_join, op8_media, op9_line_dedup, op10_quality_rules, op11_alignment, op12_spelling, op13_warc)}
