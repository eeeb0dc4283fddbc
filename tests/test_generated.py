"""Generated code that the JVM compiles: methods beyond 8,000 bytes are interpreted."""

from checks import tables as t
from forecourt.operators.cleaning import bound, cleaning_audit

SMALL = "/root/testdata/sf0.001"


def largest_method(spark, df):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df._jdf.queryExecution().executedPlan()
        debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
        found = debug.codegenStringSeq(plan)
        return max(found.apply(i)._3().maxMethodCodeSize() for i in range(found.size()))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_cleaning_of_computed_columns_is_compiled(spark):
    assert largest_method(spark, t.clean(spark, SMALL)) < 8000
    assert largest_method(spark, t.split(spark, SMALL).select("listing_id", "split")) < 8000
    assert largest_method(spark, cleaning_audit(t.raw(spark, SMALL), t.rules())) < 8000


def test_bound_columns_keep_their_places_and_values(spark):
    df = spark.range(3).selectExpr("id", "id * 2 AS `a b`", "CAST(NULL AS STRING) AS c")
    assert bound(df, ["a b", "c"]).columns == df.columns and bound(df, ["c"]).collect() == df.collect()
    assert bound(df, []) is df
