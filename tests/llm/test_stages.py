"""Stages of the pipeline keep every column of their input, whatever its name."""

import pytest
from pyspark.sql import functions as F

from flowtables.llm import language, leaks, mixing, near_texts, shards

NAMES = ["_key", "_size", "_tie", "_range", "_part", "_cell", "_in", "_cells", "_id", "_source", "_copies", "_copy", "_n", "_h", "_gone", "_th",
         "_twin", "_row", "_leak", "own0", "own1", "th", "tie", "copies", "size", "target", "kept", "lang_pred", "h", "r", "l"]


@pytest.fixture(scope="module")
def docs(spark):
    words = "one two three four five six seven eight nine ten eleven twelve".split()
    text = lambda i: " ".join(words[(i * 7 + j * (i % 5 + 1)) % 12] + str(i % 9 * j) for j in range(30))
    rows = [(i, text(i), ("en", None)[i % 2], f"s{i % 3}") for i in range(40)] + [(40, text(3), "en", "s0"), (3, text(3), "en", "s0"), (41, None, None, None), (42, "", "en", "s1")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return df.select("*", *[F.concat(F.lit(n), F.col("doc_id")).alias(n) for n in NAMES]).repartition(3)


def unchanged(found, docs):
    assert found.columns[: len(docs.columns)] == docs.columns
    rows = found.collect()
    assert rows and all(r[n] == f"{n}{r.doc_id}" for r in rows for n in NAMES)
    return rows


def test_language(docs):
    unchanged(language.of_known_language(docs), docs)


def test_language_without_labels_keeps_all(docs):
    none = docs.withColumn("lang", F.lit(None).cast("string"))
    assert len(unchanged(language.of_known_language(none), docs)) == 44


def test_near_copies(docs):
    rows = unchanged(near_texts.one_of_each(docs), docs)
    assert sum(r.doc_id in (3, 40) for r in rows) == 1


def test_one_of_equal_ids_and_texts_is_the_first_by_all_columns(docs):
    several = docs.where("doc_id = 3").limit(1).select(*docs.columns[:-1], F.explode(F.array(*map(F.lit, "cab"))).alias("l"))
    for part in (several, several.orderBy("l"), several.orderBy(F.desc("l"))):
        assert [r["l"] for r in near_texts.one_of_each(part).collect()] == ["a"]


def test_decontamination(spark, docs):
    item = docs.where("doc_id = 5").first().text
    rows = unchanged(leaks.without_leaks(docs, spark.createDataFrame([(1, item)], "item_id long, text string")), docs)
    assert len(rows) == 43 and 5 not in {r.doc_id for r in rows}


def test_mix(docs):
    assert len(unchanged(mixing.mix_documents(docs), docs)) > 44


def test_shards(docs):
    rows = unchanged(shards.shard_documents(docs, 4), docs)
    assert len(rows) == 44 and {r.shard for r in rows} == {0, 1, 2, 3}
    again = shards.shard_documents(docs.withColumn("shard", F.lit("x")), 4)
    assert again.columns == [*docs.columns, "shard", "slot"] and again.where("shard < 4").count() == 44
