"""Columns of the input that carry the names of an operator's own columns."""

import pytest
from loanloom.llm import (
    alignment,
    bit_planes,
    context_tree,
    decontaminate,
    hilbert,
    keyed_ids,
    minhash,
    packing,
    quality,
    suffix_dedup,
    token_counts,
    toxicity,
)
from loanloom.llm.queries import BYTE_BPE, PIECE_BPE, WORD_BPE
from loanloom.llm.scratch import Scratch
from pyspark.sql import functions as F

from .samples import documents, prose

NAMES = (
    "id doc runs row start length n_bytes n_tokens text_ n_words score kept key place component_id"
    " pairs rare node vector planes slot distance cluster first values part v at query toxic quality"
).split()


def operators(spark):
    items = spark.createDataFrame([("q", prose(2, 300)[:200])], "item_id string, text string")
    good = spark.createDataFrame([(0, 1), (1, 0)], "doc_id long, quality int")
    toxic = spark.createDataFrame([(0, 1), (1, 0)], "doc_id long, toxic int")

    def stored(df):
        folder = Scratch(spark, "clash").path("store")
        keyed_ids.write_ids(df, folder, WORD_BPE, 2, shards=2)
        return keyed_ids.read_ids(spark, folder)

    return {
        "minhash": minhash.near_duplicates,
        "quality": lambda df: quality.judge(df, good),
        "suffix": suffix_dedup.remove_repeats,
        "packing": lambda df: packing.pack(df, BYTE_BPE, 1),
        "decontaminate": lambda df: decontaminate.find_test_items(df, items),
        "counts": lambda df: token_counts.count_tokens(df, BYTE_BPE),
        "context": context_tree.score,
        "toxicity": lambda df: toxicity.score(df, toxic),
        "ids": stored,
        "alignment": lambda df: alignment.link_statistics(df, BYTE_BPE, PIECE_BPE),
    }


@pytest.mark.parametrize(
    "name",
    "minhash quality suffix packing decontaminate counts context toxicity ids alignment".split(),
)
def test_texts_with_clashing_columns(spark, name):
    plain = documents(spark, [prose(1, 120), prose(2, 300), prose(1, 120), None, "", "one"])
    plain = plain.select("doc_id", "text").coalesce(1)
    clashing = plain.select("*", *[F.lit("clash").alias(n) for n in NAMES])
    run = operators(spark)[name]
    a, b = ([tuple(map(str, r)) for r in run(df).collect()] for df in (plain, clashing))
    assert sorted(a) == sorted(b)


def test_vectors_with_clashing_columns(spark):
    plain = spark.range(40).select(
        F.col("id").alias("vec_id"),
        F.transform(F.sequence(F.lit(1), F.lit(64)), lambda i: F.sin(i * (F.col("id") + 1))).alias("embedding"),
    )
    clashing = plain.select("*", *[F.lit("clash").alias(n) for n in NAMES])
    for run in (bit_planes.cluster, lambda df: hilbert.search(df, F.col("vec_id") % 5 == 0, 3)):
        a, b = (sorted(map(str, run(df).collect())) for df in (plain, clashing))
        assert a == b
