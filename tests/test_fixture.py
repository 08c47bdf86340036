"""How the tables are dealt to tasks."""

import datetime

from scorelake.sources import fixture


def _tables(spark, at):
    day = datetime.datetime(1995, 5, 17)
    lines = [(None if i % 41 == 0 else i % 60, i % 4 + 1, float(i % 50 + 1), 0.01 * (i % 10), 0.01 * (i % 7),
              "ANR"[i // 5 % 3], "OF"[i % 2], day + datetime.timedelta(days=17 * i)) for i in range(400)]
    spark.createDataFrame(lines + lines[:30], (
        "l_orderkey long, l_linenumber int, l_quantity double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp")).write.parquet(f"{at}/lineitem.parquet")
    orders = [(None if i == 7 else i, None if i == 9 else i % 12) for i in range(55)]
    spark.createDataFrame(orders + orders[:3], "o_orderkey long, o_custkey long").write.parquet(f"{at}/orders.parquet")
    spark.createDataFrame([(i, f"Customer#{i:09d}", i % 25) for i in range(11)],
                          "c_custkey long, c_name string, c_nationkey int").write.parquet(f"{at}/customer.parquet")


def _sorted(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_many_line_items_are_dealt_into_tasks_of_bounded_size(spark, tmp_path, monkeypatch):
    at = f"file://{tmp_path}"
    _tables(spark, at)
    few = fixture.scorecards(spark, at)
    assert "REPARTITION_BY_NUM" not in few._jdf.queryExecution().toString()
    want = _sorted(few)
    monkeypatch.setattr(fixture, "TASK_ROWS", 10)
    many = fixture.scorecards(spark, at)
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert plan.count(", 43), REPARTITION_BY_NUM") == 2  # 430 line items
    assert len(want) > 20 and _sorted(many) == want
