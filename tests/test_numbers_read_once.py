"""Text that is no number is told without a cast, and type inference casts every column once."""

from pyspark.sql import functions as F

from quadrata.functions.numeric import try_double
from quadrata.operators import schema

TEXTS = [
    None, "", " ", ".", "+", "-", "e5", "1", " 1 ", "\t1\n", "1.", ".5", "-.5e-3", "1e400", "1E+5", "1e", "1.2.3", "1,5", "1_000", "--1", "+1", "1 2",
    "1d", "1F", "1d\t", "1.5D ", "0x1p3", "0X1.8P-1", "0x1p3d", "0x1.8", "inf", "-Inf", "Infinity", "+INFINITY", " infinity\r", "NaN", "nan", "-nan",
    "1996-01-02", "true", "?", " 1", "١", "\x001",
]


def test_text_that_is_no_number_is_never_cast(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    plain, suffix = F.col("t").try_cast("double"), F.lower(F.right(F.rtrim("t"), F.lit(1))).isin("d", "f")
    both = df.select("t", try_double("t").alias("a"), F.when(~suffix & ~F.isnan(plain), plain).alias("b"))
    assert [(r.t, r.a) for r in both.collect() if r.a != r.b] == []
    assert "RLIKE" in both._jdf.queryExecution().optimizedPlan().toString()
    other = spark.range(2).select((F.col("id") == 1).alias("flag"), "id").select(try_double("flag").alias("flag"), try_double("id").alias("id"))
    assert [tuple(r) for r in other.collect()] == [(0.0, 0.0), (1.0, 1.0)]


def test_type_inference_reads_every_column_once(spark):
    df = spark.createDataFrame([("1", "x"), ("2.5", None)], "a string, b string")
    found = schema.infer_types(df)
    assert [tuple(r) for r in found.collect()] == [("a", "double", 2), ("b", "text", 1)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    aggregate = next(line for line in plan.splitlines() if "Aggregate" in line)
    assert "as double" not in aggregate
