"""How op1's work is cut: what a task holds does not grow with the family."""

import random

from redactory.llm.suffix_dedup import SuffixIndex


def test_a_bucket_stands_for_at_most_8_mb_of_text(spark, tmp_path):
    rng = random.Random(3)
    docs = spark.createDataFrame([(k, rng.randbytes(1 << 19).hex()) for k in range(20)], "doc_id long, text string")
    index = SuffixIndex(spark, str(tmp_path / "family"), buckets=1)
    index.add(docs)
    assert index.levels[0].n_bytes == 20 << 20 and index.levels[0].n_bytes / index.levels[0].buckets <= 8 << 20
