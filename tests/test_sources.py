import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keepwell import session
from keepwell.sources import fixtures, readers, schemas, sinks

HEADER = "msno,transaction_date,membership_expire_date,payment_method_id,payment_plan_days,plan_list_price,actual_amount_paid,is_auto_renew,is_cancel"


def write(tmp_path, *lines):
    path = tmp_path / "t.csv"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_csv_types_come_from_the_schema(spark, tmp_path):
    path = write(tmp_path, HEADER, "a1,20170101,20170201,41,30,149,149,1,0", "b2,20170102,,,30,0,0,0,1")
    rows = readers.read_csv(spark, path, schemas.transactions()).collect()
    assert (rows[0]["msno"], rows[0]["plan_list_price"]) == ("a1", 149)
    assert rows[1]["payment_method_id"] is None


def test_malformed_row_fails_the_job(spark, tmp_path):
    path = write(tmp_path, HEADER, "a1,not-a-date,20170201,41,30,149,149,1,0")
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        readers.read_csv(spark, path, schemas.transactions()).collect()


def test_wrong_header_fails(spark, tmp_path):
    path = write(tmp_path, HEADER.replace("is_cancel", "cancelled"), "a1,20170101,20170201,41,30,149,149,1,0")
    with pytest.raises(Exception, match="header|Header"):
        readers.read_csv(spark, path, schemas.transactions()).collect()


def test_scenario_json(spark, tmp_path):
    path = tmp_path / "scenario.json"
    path.write_text(
        json.dumps(
            {
                "campaign_capacity_percent": 10,
                "offer_cost_per_customer": 30.0,
                "assumed_save_rate": 0.1,
                "value_months": 6,
                "monetary_unit_label": "units",
                "value_proxy_multiplier": 1.0,
                "maximum_campaign_budget": 1000000.0,
                "capacity_grid_percent": [1, 2, 5],
                "sensitivity_capacity_percent": [5],
                "sensitivity_save_rates": [0.05, 0.1],
            },
            indent=2,
        )
    )
    row = readers.read_scenario(spark, str(path)).first()
    assert row["campaign_capacity_percent"] == 10.0
    assert row["capacity_grid_percent"] == [1.0, 2.0, 5.0]


def test_parquet_projection_is_pruned_in_the_scan(spark, tmp_path):
    path = str(tmp_path / "p")
    sinks.write_parquet(spark.range(5).selectExpr("id", "id * 2 AS a", "id * 3 AS b"), path)
    plan = readers.read_parquet(spark, path, ["id", "b"])._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint,b:bigint>" in plan


def test_parquet_view(spark, tmp_path):
    path = str(tmp_path / "v")
    sinks.write_parquet(spark.range(5).toDF("id"), path)
    readers.parquet_view(spark, path, "numbers")
    assert spark.sql("SELECT sum(id) AS s FROM numbers").first()["s"] == 10


def test_csv_and_json_sinks(spark, tmp_path):
    table = spark.createDataFrame([("a", 1.5), (None, 2.0)], "k string, v double")
    sinks.write_small_csv(table, str(tmp_path / "c"))
    assert readers.read_csv(spark, str(tmp_path / "c"), table.schema).exceptAll(table).count() == 0
    sinks.write_json(table, str(tmp_path / "j"))
    assert spark.read.schema(table.schema).json(str(tmp_path / "j")).exceptAll(table).count() == 0


def test_schema_report(spark):
    rows = sinks.schema_report(spark.range(3).selectExpr("id", "cast(id AS string) AS s")).collect()
    assert [(r["column_name"], r["column_type"], r["row_count"]) for r in rows] == [("id", "bigint", 3), ("s", "string", 3)]


def test_fixture_shapes(spark):
    d = "/root/testdata/sf0.01"
    assert fixtures.transactions(spark, d).count() == 14_743
    assert fixtures.members(spark, d).count() == 1_400
    labels = fixtures.labels(spark, d)
    assert labels.count() == 1_500
    assert labels.agg(F.avg("is_churn")).first()[0] == pytest.approx(0.108)
    assert isinstance(fixtures.transactions(spark, d).schema["msno"].dataType, T.LongType)


def test_staged_tables_go_below_the_scratch_root(spark):
    path = session.scratch_path(spark, "x")
    assert path.startswith(session.scratch_root(spark) + "/keepwell-x-")
    assert path != session.scratch_path(spark, "x")
    kept = session.staged(spark.range(4).toDF("id"), "numbers")
    assert kept.count() == 4
    assert kept.inputFiles()[0].removeprefix("file://").startswith(session.scratch_root(spark))


class BareSession:
    """What the scratch folder is chosen from."""

    def __init__(self, master, setting=None):
        self.setting = setting
        self.conf = self
        self.sparkContext = self
        self.master = master
        self.applicationId = f"app-{master}"

    def get(self, key, default=None):
        return self.setting or default

    def getCheckpointDir(self):
        return None


def test_the_session_setting_names_the_folder():
    assert session.scratch_root(BareSession("spark://host", "hdfs:///shared/")) == "hdfs:///shared"
    assert session.scratch_root(BareSession("local[2]", "/elsewhere")) == "/elsewhere"


def test_only_local_mode_may_do_without():
    local = BareSession("local[2]")
    assert session.scratch_root(local) == session.scratch_root(local)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_root(BareSession("spark://host"))


def _values(spark, path):
    return sorted(r["id"] for r in sinks.published(spark, path).collect())


def test_publish_keeps_the_table_until_the_next_one_is_whole(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.publish(spark.range(3), path)
    # A writer that stops while it writes: a folder without a pointer.
    stopped = f"{path}/v{2:012d}-{'0' * 32}"
    spark.range(9).write.parquet(stopped)
    assert _values(spark, path) == [0, 1, 2]

    def refuse(written, seen):
        assert written.count() == 4 and seen == {"rows": 4, "top": 3}
        raise ValueError("refused")

    with pytest.raises(ValueError, match="refused"):
        sinks.publish(spark.range(4), path, refuse, {"rows": F.count(F.lit(1)), "top": F.max("id")})
    assert _values(spark, path) == [0, 1, 2]
    reader = sinks.published(spark, path)
    # The new version may read the old one; a reader that has resolved the old one still finds it.
    sinks.rewrite_parquet(spark, path, lambda t: t.filter("id > 0"))
    assert _values(spark, path) == [1, 2] and reader.count() == 3
    sinks.rewrite_parquet(spark, path, lambda t: t.filter("id > 1"))
    assert _values(spark, path) == [2]
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("v")]) == 2


def test_publish_observes_an_empty_table(spark, tmp_path):
    found = []
    sinks.publish(
        spark.range(5).filter("id > 9"), str(tmp_path / "e"), lambda _, s: found.append(s), {"rows": F.count(F.lit(1))}
    )
    assert found == [{"rows": 0}] and _values(spark, str(tmp_path / "e")) == []
