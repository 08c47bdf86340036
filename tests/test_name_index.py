"""How the name index is laid out."""

from pyspark.sql import functions as F

from scorelake.operators import board
from scorelake.plans import builders


def _sorted(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_postings_of_a_card_stand_in_one_file_in_order(spark, tmp_path, monkeypatch):
    root = f"file://{tmp_path}"
    monkeypatch.setattr(builders, "INDEX_CARDS", 5, raising=False)
    cards = spark.range(40).select(
        F.concat(F.lit("Customer#"), F.lpad(F.col("id").cast("string"), 9, "0")).alias("full_name"),
        F.col("id").cast("double").alias("value"), F.lit("India").alias("country"),
        F.when(F.col("id") < 20, "ODI").otherwise("Test").alias("format"),
        (F.col("id") % 20 + 1).alias("position"), F.lit(0).cast("long").alias("block"))
    cards.write.partitionBy("format", "block").parquet(f"{root}/gold/cards_batsmen")
    builders.name_index(spark, root, root, "batsmen")
    index = spark.read.parquet(f"{root}/gold/name_index_batsmen")
    columns = ["gram", "format", "position", "full_name", "value", "country"]
    assert _sorted(index.select(*columns)) == _sorted(board.postings(cards).select(*columns))
    files = index.groupBy("format", "position").agg(F.count_distinct("_metadata.file_path").alias("files"))
    assert {r.files for r in files.collect()} == {1}
    for name in index.inputFiles():
        grams = [r.gram for r in spark.read.parquet(name).coalesce(1).collect()]
        assert grams == sorted(grams)


def test_a_file_holds_one_run_of_cards(spark, tmp_path, monkeypatch):
    root = f"file://{tmp_path}"
    monkeypatch.setattr(builders, "INDEX_CARDS", 4)
    cards = spark.range(96).select(
        F.concat(F.lit("Customer#"), F.lpad(F.col("id").cast("string"), 9, "0")).alias("full_name"),
        F.col("id").cast("double").alias("value"), F.lit("India").alias("country"),
        F.when(F.col("id") < 48, "T20").otherwise("Test").alias("format"),
        (F.col("id") % 48 + 1).alias("position"), F.lit(0).cast("long").alias("block"))
    cards.write.partitionBy("format", "block").parquet(f"{root}/gold/cards_bowler")
    builders.name_index(spark, root, root, "bowler")
    index = spark.read.parquet(f"{root}/gold/name_index_bowler")
    held = index.groupBy("_metadata.file_path").agg(F.count_distinct("position").alias("cards")).collect()
    assert len(held) == 26 and max(r.cards for r in held) == 4  # positions 1 to 3, 4 to 7, ..., 48 of each format
    assert index.select("format", "position").distinct().count() == 96


def test_index_of_no_cards(spark, tmp_path):
    root = f"file://{tmp_path}"
    none = spark.createDataFrame([], "full_name string, value double, country string, format string, position long, "
                                     "block long")
    none.write.parquet(f"{root}/gold/cards_fielder")
    builders.name_index(spark, root, root, "fielder")
    schema = builders.schema(spark, "fielder", "name_index")
    assert spark.read.schema(schema).parquet(f"{root}/gold/name_index_fielder").count() == 0
