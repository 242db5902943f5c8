from collections import Counter

import pytest

from wardflow.llm import langid

GOOD = 60


@pytest.mark.parametrize("bad", ["null", "letterless", "repeated"])
def test_sample_is_full_whatever_else_is_labelled(spark, bad):
    """Null, letterless and repeated rows take no place of a document with letters."""
    more = {"null": spark.range(100_000).selectExpr("id + 1000 as id", "cast(null as string) as text"),
            "letterless": spark.range(100_000).selectExpr("id + 1000 as id", "concat(id, ' ²') as text"),
            "repeated": spark.range(100_000).selectExpr("1000L as id", "'same words' as text")}[bad]
    good = spark.range(GOOD).selectExpr("id", "concat('words ', id) as text")
    df = good.unionByName(more).selectExpr("*", "'xx' as lang").unionByName(good.selectExpr("id", "text", "'yy' as lang"))
    sample = langid.training_sample(df, 40, 1)
    assert Counter(s[0] for s in sample) == {"xx": 40, "yy": 40}
    if bad != "repeated":
        # the documents of the smallest id hashes, as if the other rows were not there
        same = [{block for name, block in sample if name == lang} for lang in ("xx", "yy")]
        assert same[0] == same[1]
