"""Declared raw types go with the table to the stage."""

from pyspark.sql import functions as F

from siltline.plans import layers


def test_declared_width_survives_the_catalog(spark):
    raw = spark.createDataFrame([("x" * 300, "y" * 300)], "a string, b string")
    raw = raw.select(F.col("a").alias("a", metadata={layers.DECLARED: "varchar(max)"}), F.col("b").alias("b", metadata={layers.DECLARED: "VARCHAR(4000)"}))
    layers.write_table(raw, "raw.declared")
    stored = layers.layer_table(spark, "raw.declared")
    profiled = spark.createDataFrame(
        [(1, "a", "VARCHAR(100)", "VARCHAR(4000)"), (2, "b", "VARCHAR(100)", "VARCHAR(4000)")],
        "ordinal_position int, column_name string, recommended_sql_type string, defined_sql_type string",
    )
    layout = layers.stage_columns(profiled, stored)
    assert [c.sql_type for c in layout] == ["VARCHAR(MAX)", "VARCHAR(100)"]
    row = layers.stage(stored, layout).first()
    assert len(row.a) == 300 and len(row.b) == 100
    numbers = profiled.withColumn("recommended_sql_type", F.lit("INT"))
    assert [c.sql_type for c in layers.stage_columns(numbers, stored)] == ["INT", "INT"]
    narrow = layers.stage_columns(profiled, stored, raw_types={"a": "VARCHAR(4000)"})
    assert [c.sql_type for c in narrow] == ["VARCHAR(100)", "VARCHAR(100)"]
