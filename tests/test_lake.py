"""CSV files -> refresh -> lake equals the lazy pipeline."""

import csv
import os
import uuid

import pytest

from pyspark.sql import functions as F

from scorelake.plans import registry
from scorelake.plans.layers import Scorecards
from scorelake.plans.refresh import drop_derived, refresh, refresh_derived
from scorelake.sources import fixture, lake
from scorelake.specs import FORMATS, ROLES
from tests.conftest import SMOKE


def _write_csvs(spark, src):
    cards = fixture.scorecards(spark, SMOKE)
    for role in ROLES:
        for fmt in FORMATS:
            rows = fixture.format_raw(cards, role, fmt).collect()
            path = os.path.join(src, lake.RAW_FILES[(role, fmt)])
            os.makedirs(os.path.dirname(path), exist_ok=True)
            with open(path, "w", newline="") as fh:
                w = csv.writer(fh)
                # a blank-header index column, as a spreadsheet export writes it
                w.writerow([""] + list(rows[0].__fields__) if rows else [""])
                for i, r in enumerate(rows):
                    w.writerow([i] + [("" if v is None else v) for v in r])


def _canon(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_csv_refresh_matches_lazy(spark, smoke_cards, tmp_path):
    src = str(tmp_path / "dump")
    _write_csvs(spark, src)
    root = f"{spark.conf.get('spark.checkpoint.dir')}/lake-{uuid.uuid4().hex}"
    report = refresh(spark, root, src=src)
    assert len(report.written) == 30
    stored = Scorecards.from_lake(spark, root)
    for role in ROLES:
        assert _canon(stored.player_table(role)) == _canon(smoke_cards.player_table(role))
        assert _canon(stored.country_stats(role, "All")) == _canon(smoke_cards.country_stats(role, "All"))
    # refreshing again gives the same tables
    refresh(spark, root, src=src)
    again = Scorecards.from_lake(spark, root)
    assert _canon(again.silver("bowler")) == _canon(smoke_cards.silver("bowler"))


def test_bronze_partition_pruning(spark, smoke_cards):
    root = f"{spark.conf.get('spark.checkpoint.dir')}/lake-{uuid.uuid4().hex}"
    lake.write_bronze(smoke_cards.raw("fielder"), root, "fielder")
    df = lake.read_bronze(spark, root, "fielder", "ODI")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(format" in plan and "ODI" in plan
    assert df.where(F.col("format") != "ODI").count() == 0


def test_dynamic_overwrite_keeps_other_formats(spark, smoke_cards):
    root = f"{spark.conf.get('spark.checkpoint.dir')}/lake-{uuid.uuid4().hex}"
    raw = smoke_cards.raw("fielder")
    lake.write_bronze(raw, root, "fielder")
    before = lake.read_bronze(spark, root, "fielder").count()
    lake.write_dataset(raw.where(F.col("format") == "T20"), f"{root}/bronze/fielder",
                       only_present_partitions=True)
    assert lake.read_bronze(spark, root, "fielder").count() == before


def test_schema_report_and_preview(spark, smoke_cards):
    s = smoke_cards.silver("batsmen")
    assert lake.schema_report(s, "batsmen")[:2] == ["full_name", "country"]
    assert lake.preview(s).count() == 2


def test_write_table_lake_path_and_jdbc_check(spark, smoke_cards):
    import pytest
    root = f"{spark.conf.get('spark.checkpoint.dir')}/lake-{uuid.uuid4().hex}"
    s = smoke_cards.silver("fielder")
    lake.write_table(s, root, "fielder_silver")
    assert spark.read.parquet(f"{root}/fielder_silver").count() == s.count()
    with pytest.raises(ValueError):
        lake.write_table(s, "jdbc:postgresql://unused/db")  # no table name: refused before any IO


def _root(spark):
    return f"{spark.conf.get('spark.checkpoint.dir')}/lake-{uuid.uuid4().hex}"


def test_refresh_of_one_role_leaves_the_others(spark, smoke_cards):
    root, raw = _root(spark), {r: smoke_cards.raw(r) for r in ROLES}
    first = refresh(spark, root, raw=raw)
    open_reader = Scorecards.from_lake(spark, root)
    before = _canon(open_reader.rankings("bowler"))
    again = refresh(spark, root, raw={"fielder": raw["fielder"]}, roles=("fielder",))
    assert again.dropped == []
    lake_now = Scorecards.from_lake(spark, root)
    assert _canon(lake_now.rankings("bowler")) == before and lake_now.rankings("fielder").count() > 0
    third = refresh(spark, root, raw=raw, keep=1, min_age=0)
    assert sorted(third.dropped) == sorted([first.version, again.version])
    assert _canon(Scorecards.from_lake(spark, root).rankings("bowler")) == before


def test_an_open_reader_survives_refreshes(spark, smoke_cards):
    root, raw = _root(spark), {"bowler": smoke_cards.raw("bowler")}
    refresh(spark, root, raw=raw, roles=("bowler",))
    reader = Scorecards.from_lake(spark, root)
    before = _canon(reader.rankings("bowler"))
    half = {"bowler": raw["bowler"].where(F.col("format") == "ODI")}
    for _ in range(2):  # replaced twice over, but less than min_age ago
        assert refresh(spark, root, raw=half, roles=("bowler",)).dropped == []
    assert _canon(reader.rankings("bowler")) == before
    assert _canon(reader.country_stats("bowler", "All")) == _canon(smoke_cards.country_stats("bowler", "All"))
    now = Scorecards.from_lake(spark, root)
    assert now.silver("bowler").select("format").distinct().count() == 1 and _canon(now.rankings("bowler")) != before
    # keep counts whatever the age; the ledger holds an entry per version that is left
    assert len(refresh(spark, root, raw=half, roles=("bowler",), keep=2, min_age=0).dropped) == 2
    assert len(lake.folders(spark, f"{root}/_published")) == len(lake.folders(spark, f"{root}/versions")) == 2


def test_folders_of_failed_runs_go_after_a_while(spark, smoke_cards):
    root = _root(spark)
    refresh(spark, root, raw={"fielder": smoke_cards.raw("fielder")}, roles=("fielder",))
    spark.range(1).write.parquet(f"{lake.version_root(root, lake.new_version())}/bronze/fielder")  # never published
    for age, left in ((86400.0, 2), (0.0, 1)):
        lake.drop_versions(spark, root, orphan_age=age)
        assert len(lake.folders(spark, f"{root}/versions")) == left
    assert Scorecards.from_lake(spark, root).rankings("fielder").count() > 0


def test_refresh_of_one_derived_name_and_what_hangs_on_it(spark, smoke_cards):
    import pytest
    root, raw = _root(spark), {r: smoke_cards.raw(r) for r in ("batsmen", "fielder")}
    refresh(spark, root, raw=raw, roles=tuple(raw))
    before = lake.Ledger(spark, root)
    report = refresh_derived(spark, root, "player_stats_all_formats_batsmen")
    assert report.written == ["gold/player_stats_all_formats_batsmen", "gold/ranking_batsmen"]
    after = lake.Ledger(spark, root)
    for role in raw:
        for dataset in registry.parents(role):
            moved = before.root_of(role, dataset) != after.root_of(role, dataset)
            assert moved == (dataset in report.written), dataset
    cards = Scorecards.from_lake(spark, root)
    assert _canon(cards.rankings("batsmen")) == _canon(smoke_cards.rankings("batsmen"))
    # one per-format country name stands for its dataset and the "All" rollup over it
    gone = drop_derived(spark, root, "odi_batsmen_stats_country_wise")
    assert gone == ["gold/country_wise_batsmen", "gold/country_all_batsmen"]
    assert _canon(cards.country_stats("batsmen", "All")) == _canon(smoke_cards.country_stats("batsmen", "All"))
    now = Scorecards.from_lake(spark, root)
    for ask in (lambda: now.country_stats("batsmen", "All"), lambda: now.table("odi_batsmen_stats_country_wise")):
        with pytest.raises(ValueError, match="dropped"):
            ask()
    assert now.rankings("batsmen").count() > 0 and now.country_stats("fielder", "All").count() > 0
    refresh_derived(spark, root, "odi_batsmen_stats_country_wise")
    again = Scorecards.from_lake(spark, root)
    assert _canon(again.country_stats("batsmen", "All")) == _canon(smoke_cards.country_stats("batsmen", "All"))
    for name in ("batsmen_stats", "nothing"):
        with pytest.raises(ValueError):
            refresh_derived(spark, root, name)


def test_a_failed_refresh_leaves_the_lake_serving(spark, smoke_cards):
    import pytest
    root, raw = _root(spark), {r: smoke_cards.raw(r) for r in ROLES}
    refresh(spark, root, raw=raw)
    before = _canon(Scorecards.from_lake(spark, root).country_stats("batsmen", "All"))
    with pytest.raises(Exception):
        refresh(spark, root, src=f"{root}/no-such-folder")
    broken = dict(raw, bowler=raw["bowler"].withColumn("Span", F.raise_error(F.lit("broken input"))))
    with pytest.raises(Exception, match="broken input"):
        refresh(spark, root, raw=broken)
    assert _canon(Scorecards.from_lake(spark, root).country_stats("batsmen", "All")) == before


def test_refresh_writes_every_table_to_a_target(spark, smoke_cards):
    root = _root(spark)
    refresh(spark, root, raw={"fielder": smoke_cards.raw("fielder")}, roles=("fielder",), table_target=f"{root}/tables")
    cards = Scorecards.from_lake(spark, root)
    for name in ("fielder_t20", "fielder_stats", "odi_fielder_stats_country_wise", "player_stats_all_formats_fielder"):
        stored = spark.read.parquet(f"{root}/tables/{name}")
        assert stored.count() > 0
    assert stored.count() == cards.player_table("fielder").count()


def test_csv_columns_bind_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Player,Span\nA,2000-2010\n")
    (tmp_path / "b.csv").write_text(",Span,Player\n0,1990-1999,B\n")
    df = lake.read_csv(spark, str(tmp_path))
    assert sorted((r.Player, r.Span) for r in df.collect()) == [("A", "2000-2010"), ("B", "1990-1999")]


def test_json_records_keep_null_keys(spark):
    import json
    from scorelake.operators import serve
    df = spark.createDataFrame([("A B", None, 1)], "full_name string, runs int, matches int")
    assert json.loads(serve.json_records(df).first().json) == {"full_name": "A B", "runs": None, "matches": 1}


def test_schema_report_checks_types(spark, smoke_cards):
    import pytest
    s = smoke_cards.silver("batsmen")
    with pytest.raises(ValueError, match="another type"):
        lake.schema_report(s.withColumn("matches_played", F.col("matches_played").cast("string")), "batsmen")


def test_headers_of_a_folder_come_in_one_aggregation(spark, tmp_path):
    folder = tmp_path / "many files"
    folder.mkdir()
    for i in range(40):
        head = "a,b" if i % 3 else "\nb,c"  # a blank line first
        (folder / f"part {i:02d}.csv").write_text(f"{head}\n{i},x\n{i},y\n")
    (folder / "zz-empty.csv").write_text("")
    found = lake.headers(spark, str(folder))
    assert [(h, len(f)) for h, f in found] == [("b,c", 14), ("a,b", 26)]
    sc = spark.sparkContext
    sc.setJobGroup("headers", "headers")
    try:
        df = lake.read_csv(spark, str(folder))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(sc.statusTracker().getJobIdsForGroup("headers")) < 12  # not one a file
    rows = sorted(tuple(r) for r in df.select("a", "b", "c").na.fill("-").collect())
    assert rows == sorted([(str(i), v, "-") if i % 3 else ("-", str(i), v) for i in range(40) for v in "xy"])


def test_type_report_finds_what_the_cleaning_loses(spark):
    from scorelake.operators import drift
    cols = "Player string, Span string, Mat string, Inns string, Dis string, Ct string, St string, `Ct Wk` string, MD string, format string"
    rows = [("A (SL)", "1990-1999", "3", "1", "-", "4", " 7 ", "1.5", "x", "ODI"), ("B (XYZ)", "soon", "4", None, "", "n/a", "8", "2", "y", "ODI"),
            ("C (SL)", None, "3.5", "-", "-", "zz", "9", "3", None, "ODI"), ("D (SL)", "1990-1991", "5", "5", "6", "7", "8", "9", None, "Test")]
    raw = spark.createDataFrame(rows, cols)
    got = {(r.format, r.raw_column): (r.kind, r.filled, r.unfit, r.example) for r in drift.type_report(raw, "fielder").collect()}
    assert len(got) == 16 and ("ODI", "MD") not in got
    assert got["ODI", "Player"] == ("text", 3, 1, "B (XYZ)")
    assert got["ODI", "Span"] == ("text", 2, 1, "soon")
    assert got["ODI", "Mat"] == ("decimal", 3, 1, "3.5")
    assert got["ODI", "Inns"] == ("int", 1, 0, None)
    assert got["ODI", "Dis"] == ("empty", 0, 0, None)
    assert got["ODI", "Ct"] == ("text", 3, 2, "n/a")
    assert got["ODI", "Ct Wk"] == ("decimal", 3, 1, "1.5")
    assert all(unfit == 0 for (fmt, _), (_, _, unfit, _) in got.items() if fmt == "Test")
    assert {r.raw_column for r in drift.drifted(raw, "fielder", 0.5).collect()} == {"Ct"}
    bare = drift.type_report(raw.select("Player", "format"), "fielder").where("raw_column = 'Ct'").first()
    assert bare.kind == "empty" and drift.type_report(raw.where("false"), "fielder").count() == 0


def test_catalog_name_keeps_its_rows_after_a_failed_write(spark):
    database = f"scorelake_{uuid.uuid4().hex[:12]}"
    target = f"catalog:{database}"
    first = spark.range(5).select(F.col("id").alias("10"), F.lit("x").alias("format"))
    lake.write_table(first, target, "t")
    held = spark.sql(f"SELECT * FROM {database}.t")
    broken = spark.range(5).select(F.raise_error(F.lit("lost")).cast("long").alias("10"), F.lit("y").alias("format"))
    try:
        lake.write_table(broken, target, "t")
        raise AssertionError("the write should have failed")
    except Exception as e:
        assert "lost" in str(e)
    assert spark.table(f"{database}.t").count() == 5
    assert len(spark.catalog.listTables(database, "t__*")) == 1
    lake.write_table(first.limit(2), target, "t")  # another number of rows; the one before stays for its readers
    assert spark.table(f"{database}.t").count() == 2 and held.count() == 5
    for _ in range(2):
        lake.write_table(first.limit(3), target, "t")
    assert spark.table(f"{database}.t").count() == 3 and len(spark.catalog.listTables(database, "t__*")) == 2
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_named_tables_are_written_side_by_side(spark, tmp_path, monkeypatch):
    import threading

    from scorelake.plans import refresh
    both, write = threading.Barrier(2, timeout=60), lake.write_table

    def waits_for_another(*args):
        both.wait()
        write(*args)

    monkeypatch.setattr(refresh.lake, "write_table", waits_for_another)
    named = [(f"t{n}", spark.range(n)) for n in range(1, 5)]
    assert refresh.write_tables(spark, named, f"file://{tmp_path}") == ["t1", "t2", "t3", "t4"]
    assert [spark.read.parquet(f"file://{tmp_path}/t{n}").count() for n in range(1, 5)] == [1, 2, 3, 4]


def test_a_failed_named_table_fails_the_write(spark, tmp_path):
    from scorelake.plans import refresh
    bad = spark.range(2).select(F.raise_error(F.lit("torn")).alias("x"))
    with pytest.raises(Exception, match="torn"):
        refresh.write_tables(spark, [("t1", spark.range(1)), ("t2", bad)], f"file://{tmp_path}")
