"""Queries of the training-data operators: name -> ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from storelake.llm import (bpe, decontaminate, embed_dup, hard_negatives, html_text, licenses, line_dedup, near_dup, pii, quality,
                           repetition, token_align, token_store)
from storelake.llm.common import table

QUERIES = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


@register
def op1_pii(spark, sf_dir):
    return pii.pii_report(table(spark, sf_dir, "documents"))


@register
def op2_bpe(spark, sf_dir):
    return bpe.encode_report(table(spark, sf_dir, "documents"))


@register
def op4_line_dedup(spark, sf_dir):
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


@register
def op5_token_store(spark, sf_dir):
    return token_store.store_report(table(spark, sf_dir, "documents"))


@register
def op6_licenses(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


@register
def op10_quality(spark, sf_dir):
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register
def op3_decontaminate(spark, sf_dir):
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register
def op7_near_dup(spark, sf_dir):
    return near_dup.classes(table(spark, sf_dir, "documents"))


@register
def op8_embed_dup(spark, sf_dir):
    return embed_dup.near_vectors(table(spark, sf_dir, "embeddings"))


@register
def op9_html_text(spark, sf_dir):
    return html_text.extract(table(spark, sf_dir, "pages"))


@register
def op11_quality_rules(spark, sf_dir):
    return repetition.quality_rules(table(spark, sf_dir, "documents"))


@register
def op12_hard_negatives(spark, sf_dir):
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


@register
def op13_token_align(spark, sf_dir):
    return token_align.alignment_report(table(spark, sf_dir, "documents"))
