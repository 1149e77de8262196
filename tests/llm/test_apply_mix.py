"""The mixed corpus does not depend on how its input is split at each read."""

import re

from tessera.llm import mixing


def test_apply_mix_when_splits_change(spark, docs, tmp_path):
    docs.repartition(16).write.parquet(f"{tmp_path}/docs")
    stored = spark.read.parquet(f"{tmp_path}/docs")
    want = sorted((r["doc_id"], t["words"]) for r in mixing.mix(stored).collect() for t in r["turns"] if t["words"] > 0)
    mixed = mixing.apply_mix(stored)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        got = mixed.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted((r["doc_id"], len(re.findall(mixing.WORD, r["text"]))) for r in got) == want
