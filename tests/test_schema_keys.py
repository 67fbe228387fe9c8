import itertools

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from branchlake.defs import TableDef, normal
from branchlake.functions import keys as K
from branchlake.functions import schema as S

KINDS = [T.NullType(), T.StringType(), T.BooleanType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(), T.DecimalType(4, 0), T.DecimalType(18, 4), T.DecimalType(38, 14), T.DateType(), T.TimestampNTZType(), T.TimestampType(), T.BinaryType()]


@pytest.mark.parametrize(
    ("a", "b", "want"),
    [
        (T.StringType(), T.LongType(), T.StringType()), (T.IntegerType(), T.LongType(), T.DecimalType(18, 0)), (T.LongType(), T.DoubleType(), T.DoubleType()),
        (T.DecimalType(38, 0), T.DecimalType(38, 14), T.DecimalType(38, 14)), (T.DecimalType(2, 0), T.DecimalType(3, 2), T.DecimalType(4, 2)), (T.DateType(), T.TimestampNTZType(), T.StringType()),
        (T.BinaryType(), T.StringType(), T.StringType()), (T.BooleanType(), T.IntegerType(), T.StringType()), (T.NullType(), T.DateType(), T.DateType()), (T.FloatType(), T.DecimalType(4, 0), T.DoubleType()),
    ],
)
def test_widen(a, b, want):
    assert S.widen(a, b) == want


def test_widen_is_commutative_over_all_pairs():
    for a, b in itertools.product(KINDS, KINDS):
        assert S.widen(a, b) == S.widen(b, a)
        assert S.widen(S.widen(a, b), b) == S.widen(a, b)


@settings(max_examples=30, deadline=None)
@given(st.lists(st.lists(st.tuples(st.sampled_from("abc"), st.sampled_from(KINDS)), unique_by=lambda x: x[0], min_size=1), min_size=1, max_size=4))
def test_unify_covers_every_branch(schemas):
    made = [T.StructType([T.StructField(n, t, False) for n, t in s]) for s in schemas]
    got = {f.name: f for f in S.unify_schemas(made).fields}
    assert set(got) == {n for s in schemas for n, _ in s}
    for n, f in got.items():
        assert f.nullable == any(n not in {x for x, _ in s} for s in schemas)


def test_unify_branches_casts_before_the_union(spark):
    a = spark.createDataFrame([(1,)], "id bigint")
    b = spark.createDataFrame([("x",)], "id string")
    c = spark.createDataFrame([(2,)], "id bigint").withColumn("extra", F.lit(None))
    assert sorted(map(tuple, S.unify_branches([a, b, c]).collect())) == [("1", None), ("2", None), ("x", None)]


def test_void_takes_the_stored_type():
    s = T.StructType().add("ios", "long").add("code", T.NullType())
    stored = T.StructType().add("code", "double")
    assert S.fill_void(s, stored)["code"].dataType == T.DoubleType()
    assert S.fill_void(s)["code"].dataType == T.StringType()


def test_destination_widening_adds_no_columns():
    got = S.widen_to_destination(T.StructType().add("rule", "decimal(38,0)"), T.StructType().add("rule", "string").add("contract", "long"))
    assert got.fieldNames() == ["rule"] and got["rule"].dataType == T.StringType()


def test_require_keys_raises_on_null(spark):
    df = spark.createDataFrame([(1,), (None,)], "id bigint")
    with pytest.raises(PySparkException, match="null in key"):
        S.require_keys(df, ["id"]).collect()


def test_names():
    assert normal("  Cust--ID (x) ") == "cust_id_x"
    with pytest.raises(ValueError):
        TableDef("(SELECT 1)")


@pytest.mark.parametrize(("raw", "kind"), [("2024-01-01", "date"), ("2024-01-01 10:00:00", "timestamp_ntz"), ("12", "int"), ("1.5", "decimal(2,1)"), ("abc", "string"), ("date_add(date'2024-01-01', 1)", "date")])
def test_literal_types(spark, raw, kind):
    assert spark.range(1).select(S.literal(raw).alias("x")).schema["x"].dataType.simpleString() == kind


def test_canonical_decimals(spark):
    df = spark.createDataFrame([("123.40",), ("100.00",), ("0.00",), ("-5.50",), ("0.10",), (None,)], "s string").select(F.col("s").cast("decimal(12,2)").alias("d"))
    got = [r[0] for r in df.select(K.canon(F.col("d"), df.schema["d"].dataType)).collect()]
    assert got == ["123.4", "100", "0", "-5.5", "0.1", K.NULL]
    whole = df.select(F.col("d").cast("decimal(12,0)").alias("d"))
    assert whole.select(K.canon(F.col("d"), whole.schema["d"].dataType)).first()[0] == "123"


def test_canonical_floats_and_times(spark):
    df = spark.sql("SELECT 123.0D AS a, -0.0D AS b, 1.5D AS c, TIMESTAMP_NTZ'2024-01-02 03:04:05.678' AS t, X'0aFF' AS x")
    got = df.select(*[K.canon(F.col(n), df.schema[n].dataType).alias(n) for n in df.columns]).first()
    assert tuple(got) == ("123", "0", "1.5", "2024-01-02 03:04:05", "0aff")


def test_key_framing_is_injective(spark):
    df = spark.createDataFrame([("a", "bc"), ("ab", "c"), (None, ""), ("", None), ("", "")], "x string, y string")
    assert df.select(K.serialize_keys(df, ["x", "y"]).alias("s")).distinct().count() == 5


@settings(max_examples=10, deadline=None)
@given(rows=st.lists(st.tuples(st.one_of(st.none(), st.text(max_size=4)), st.one_of(st.none(), st.text(max_size=4))), min_size=1, max_size=12))
def test_key_framing_property(spark, rows):
    df = spark.createDataFrame(rows, "x string, y string")
    assert df.select(K.serialize_keys(df, ["x", "y"]).alias("s")).distinct().count() == len(set(rows))


def test_merge_hash_is_type_independent(spark):
    a = spark.sql("SELECT 123L AS id, 7L AS b")
    b = spark.sql("SELECT CAST(123 AS DECIMAL(18,0)) AS id, 7L AS b")
    ha, hb = (d.select(K.merge_hash(d, ["id", "b"])).first()[0] for d in (a, b))
    assert ha == hb and len(ha) == 16


def test_unstable_keys_are_refused(spark):
    with pytest.raises(ValueError, match="not run-stable"):
        K.serialize_keys(spark.sql("SELECT CAST(1.5 AS DECIMAL(18,2)) AS id"), ["id"])


def test_stabilize_keys(spark):
    df = spark.sql("SELECT * FROM VALUES (1.0D, CAST(3.185 AS DECIMAL(20,14))), (4500001.0D, CAST(114945 AS DECIMAL(20,14))), (NULL, NULL) t(k, p)")
    out = K.stabilize_keys(df, ["k", "p"])
    assert out.schema["k"].dataType == T.DecimalType(38, 0)
    assert [r["p"] for r in out.collect()] == ["3.185", "114945", None]
    with pytest.raises(PySparkException, match="fraction"):
        K.stabilize_keys(spark.sql("SELECT 1.5D AS k"), ["k"]).collect()


def test_julian(spark):
    r = spark.sql("SELECT DATE'2000-01-01' AS d").select(K.julian_day(F.col("d")).alias("j"), K.from_julian(K.julian_day(F.col("d"))).alias("d")).first()
    assert r["j"] == 2451545 and str(r["d"]) == "2000-01-01"


def test_safe_cast_keeps_text_if_any_value_is_lost(spark):
    df = spark.createDataFrame([("1", "1"), ("x", None)], "a string, b string")
    out = K.safe_cast(K.safe_cast(df, "a", "bigint"), "b", "bigint")
    assert (out.schema["a"].dataType, out.schema["b"].dataType) == (T.StringType(), T.LongType())


@pytest.mark.parametrize("zone", ["America/New_York", "UTC", "Asia/Kathmandu"])
def test_instants_are_told_in_utc(spark, zone):
    """Also in a daylight-saving gap (02:30 on 8 March 2026 in New York) and before 1970."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        texts = ["2026-01-01 00:00:00", "2026-03-08 02:30:00.5", "2026-11-01 05:30:00", "1969-12-31 23:59:59.000001"]
        df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.concat("t", F.lit("Z")).cast("timestamp").alias("z"), F.col("t").cast("timestamp_ntz").alias("n"))
        for r in df.select(K.naive_utc(F.col("z")).alias("got"), "n", K.canon(F.col("z"), df.schema["z"].dataType).alias("a"), K.canon(F.col("n"), df.schema["n"].dataType).alias("b")).collect():
            assert r["got"] == r["n"] and r["a"] == r["b"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_safe_cast_infers_what_fits(spark):
    df = spark.createDataFrame([("1.5", "2026-01-02", None), ("2", "2026-01-03", None)], "a string, b string, c string")
    for name, want in (("a", "decimal(38,10)"), ("b", "date"), ("c", "bigint")):
        assert K.safe_cast(df, name, "bigint").schema[name].dataType.simpleString() == want
