"""What the pipeline's language stage drops, and that clean documents stay."""

from __future__ import annotations

import random

import corpus_pipeline as cp
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"
UNLEARNED = [
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem",
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto",
    "Minden emberi lény szabadon születik és egyenlő méltósága és joga van. Az emberek, ésszel és lelkiismerettel bírván",
]


def test_letter_junk_and_unlearned_languages_go_and_clean_documents_stay(spark):
    rng = random.Random(5)
    junk = [" ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 10))) for _ in range(n)) for n in (20, 100, 400, 400)]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    # clean documents that the model does not learn from: their label is taken away
    docs = docs.withColumn("lang", F.when(F.col("doc_id") % 3 > 0, F.col("lang")))
    extra = spark.createDataFrame([(-1 - k, t) for k, t in enumerate(junk + UNLEARNED)], "doc_id long, text string")
    kept = {r["doc_id"] for r in cp.identify_language(spark, docs.unionByName(extra, allowMissingColumns=True), SF).select("doc_id").collect()}
    assert not any(k < 0 for k in kept)
    assert kept == {r["doc_id"] for r in docs.collect() if any(c.isalpha() for c in r["text"] or "")}
