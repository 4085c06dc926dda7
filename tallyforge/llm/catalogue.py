"""Registered queries of the training-data operators, each over its whole
table with production parameters, and their SQL where SQL can tell."""

from __future__ import annotations

import uuid

from . import (collocations, decontam, lang_id, license_scan, line_dedup, mixing, parity_join, pii, quality, secret_scan, spelling,
               token_planes, url_cascade)
from .oracles import SQL
from .util import read, shared_folder

# (host, path, verdict)
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]
PII_KEY = b"catalogue key; a deployment passes its own"


def op1_decontaminate(spark, sf_dir):
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return decontam.decontaminate(docs, read(spark, sf_dir, "benchmark", "item_id", "text")).drop("text")


def op2_secrets(spark, sf_dir):
    found = secret_scan.scan_secrets(read(spark, sf_dir, "documents", "doc_id", "text"))
    return found.drop("text", "findings")


def op3_url_filter(spark, sf_dir):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_cascade.judge_urls(read(spark, sf_dir, "pages", "page_id", "url"), rules).drop("url")


def op4_mix(spark, sf_dir):
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "source", "size", "source_size", "target", "taken")


def op5_quality(spark, sf_dir):
    judged = quality.judge(read(spark, sf_dir, "documents", "doc_id", "text", "lang", "source"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_language(spark, sf_dir):
    return lang_id.identify(read(spark, sf_dir, "documents", "doc_id", "text", "lang"))


def op7_line_dedup(spark, sf_dir):
    return line_dedup.dedup_lines(read(spark, sf_dir, "documents", "doc_id", "text"))


def op8_jaccard_join(spark, sf_dir):
    found = parity_join.near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", "n_shingles", "component_id")


def op9_licenses(spark, sf_dir):
    return license_scan.scan_licenses(read(spark, sf_dir, "documents", "doc_id", "text")).drop("text")


def op10_pseudonyms(spark, sf_dir):
    return pii.pseudonymise(read(spark, sf_dir, "documents", "doc_id", "text"), PII_KEY)


def op11_spelling(spark, sf_dir):
    return spelling.group_variants(spelling.vocabulary(read(spark, sf_dir, "documents", "doc_id", "text")))


def op12_token_planes(spark, sf_dir):
    import public_tokenizers

    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    folder = f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"
    token_planes.write_tokens(docs, folder, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_planes.read_tokens(spark, folder, dict(docs.dtypes)["doc_id"], with_ids=False)


def op13_collocations(spark, sf_dir):
    return collocations.mine(read(spark, sf_dir, "documents", "text", "lang"))


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_decontaminate, op2_secrets, op3_url_filter, op4_mix, op5_quality, op6_language,
                                   op7_line_dedup, op8_jaccard_join, op9_licenses, op10_pseudonyms, op11_spelling, op12_token_planes, op13_collocations, pipeline)}
ORACLE_SQL = {k: v for k, v in SQL.items() if k in QUERIES}
