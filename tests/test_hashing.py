import hashlib

from pyspark.sql import functions as F

from strongroom.functions.hashing import hash_diff, hash_key


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def test_hash_key_normalises(spark):
    df = spark.createDataFrame([(" abc ",), ("ABC",), (None,)], "k string")
    out = [r[0] for r in df.select(hash_key("k")).collect()]
    assert out[0] == out[1] == sha("ABC")
    assert out[2] is None


def test_composite_key_order_and_null(spark):
    df = spark.createDataFrame([("a", "b"), ("b", "a"), ("a", None)], "x string, y string")
    out = [r[0] for r in df.select(hash_key("x", "y")).collect()]
    assert out[0] == sha("A|B") and out[1] == sha("B|A")
    assert out[2] is None  # a NULL part nulls the key (concat, not concat_ws)


def test_hash_diff_literal_and_strict(spark):
    df = spark.createDataFrame([(None, "x"), ("", "x"), ("a|b", "c"), ("a", "b|c")], "p string, q string")
    lit = [r[0] for r in df.select(hash_diff("p", "q")).collect()]
    strict = [r[0] for r in df.select(hash_diff("p", "q", strict=True)).collect()]
    assert lit[0] == lit[1] == sha("|x")  # literal recipe: NULL == ''
    assert lit[2] == lit[3]  # literal recipe: unescaped delimiter collides
    assert strict[0] != strict[1] and strict[2] != strict[3]


def test_md5(spark):
    df = spark.range(1).select(F.lit("k1").alias("k"))
    assert df.select(hash_key("k", algo="md5")).first()[0] == hashlib.md5(b"K1").hexdigest()
