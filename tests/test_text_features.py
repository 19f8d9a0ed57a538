"""Hashed character grams against the feature stages they follow."""

from pyspark.ml import Pipeline
from pyspark.ml.feature import HashingTF, NGram, RegexTokenizer
from pyspark.sql import functions as F

from replyloom.operators import models as m


def test_vectors_are_those_of_the_feature_stages(spark):
    texts = ["", "a", "ab", "abc", "Hello, World! hello", "Grüße aus Köln  und Łódź", "日本語のテキスト日本語の", "tab\tline\nend " * 40, "x" * 5000]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(2)
    stages = [RegexTokenizer(inputCol="text", outputCol="c", pattern="", minTokenLength=1), NGram(n=3, inputCol="c", outputCol="g"), HashingTF(numFeatures=4096, inputCol="g", outputCol="features")]
    want = {r.id: r.features for r in Pipeline(stages=stages).fit(df).transform(df).collect()}
    got = m.text_features(df).collect()
    assert {r.id: r.features for r in got} == want and [r.text for r in sorted(got)] == texts
    two = Pipeline(stages=[stages[0], NGram(n=2, inputCol="c", outputCol="g"), HashingTF(numFeatures=100, inputCol="g", outputCol="features")]).fit(df).transform(df)
    assert {r.id: r.features for r in m.text_features(df, n=2, dims=100).collect()} == {r.id: r.features for r in two.collect()}


def test_missing_texts_and_characters_beyond_sixteen_bits(spark):
    df = spark.createDataFrame([(1, None), (2, "a💡b💡"), (2, "a💡b💡"), (None, "xyz")], "id int, text string")
    rows = m.text_features(df).select("id", F.aggregate(F.unwrap_udt("features")["values"], F.lit(0.0), lambda s, v: s + v).alias("n")).collect()
    # a character is a code point, as in the SQL
    assert sorted((r.id or 0, r.n) for r in rows) == [(0, 1.0), (1, 0.0), (2, 2.0), (2, 2.0)]
