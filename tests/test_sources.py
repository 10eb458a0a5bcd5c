import json

import pytest
from pyspark.sql import functions as F

from quarterdeck.operators.contracts import ContractError
from quarterdeck.sources import readers, writers


def test_csv_by_header_name(spark, rows, tmp_path):
    path = tmp_path / "activity.csv"
    path.write_text('contact_role,deal_id,extra,activity_date,activity_type\n,D1,z,2026-01-01,Call\n"Buyer, ""new""",D2,z,x,Email\n')
    df = readers.read_csv(spark, str(path), "activity")
    assert rows(df, "deal_id", "activity_type", "activity_date", "contact_role") == [
        ("D1", "Call", "2026-01-01", None),
        ("D2", "Email", "x", 'Buyer, "new"'),
    ]
    assert [r["deal_id"] for r in df.orderBy("ordinal").collect()] == ["D1", "D2"] and "extra" not in df.columns


def test_emails_keep_line_breaks(spark, tmp_path):
    path = tmp_path / "mail.csv"
    path.write_text('deal_id,from,to,subject,body,timestamp\nD,a,b,s,"one\ntwo",2026-01-01 08:00:00\nD,a,b,s,,\n')
    got = readers.read_csv(spark, str(path), "emails").orderBy("ordinal").collect()
    assert [(r["body"], r["timestamp"]) for r in got] == [("one\ntwo", "2026-01-01 08:00:00"), (None, None)]


def test_csv_contract(spark, tmp_path):
    short = tmp_path / "short.csv"
    short.write_text("deal_id,arr\nD,1\n")
    with pytest.raises(ContractError, match="stage, close_date, rep_name, account_name"):
        readers.read_csv(spark, str(short), "deals")
    empty = tmp_path / "empty.csv"
    empty.write_text("deal_id,stage,close_date,arr,rep_name,account_name\n")
    with pytest.raises(ContractError, match="no data rows"):
        readers.read_csv(spark, str(empty), "deals")


def test_json_array(spark, tmp_path):
    record = {"deal_id": "D", "call_date": "2026-01-01", "call_num": 1, "turn_num": 1, "speaker": "B (Buyer)", "turn_text": "hi é"}
    path = tmp_path / "calls.json"
    path.write_text(json.dumps([record, record | {"turn_num": 2}], indent=2), encoding="utf-8")
    got = readers.read_json_array(spark, str(path)).orderBy("ordinal").collect()
    assert [r["turn_num"] for r in got] == [1, 2] and got[0]["turn_text"] == "hi é"
    loose = tmp_path / "loose.json"
    loose.write_text(json.dumps([record | {"call_num": "3", "turn_num": "x"}, {"deal_id": 7, "more": 1}]))
    rows = readers.read_json_array(spark, str(loose)).orderBy("ordinal").collect()
    assert [(r["deal_id"], r["call_num"], r["turn_num"]) for r in rows] == [("D", 3, None), ("7", None, None)]
    single = tmp_path / "single.json"
    single.write_text(json.dumps(record))
    with pytest.raises(ContractError, match="must be a JSON array"):
        readers.read_json_array(spark, str(single))
    bad = tmp_path / "bad.json"
    bad.write_text("[{broken")
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_json_array(spark, str(bad)).collect()


def test_landing_replaces(spark, tmp_path):
    out = str(tmp_path / "raw")
    for n in (3, 1):
        path = tmp_path / f"sales{n}.csv"
        path.write_text("Order Date,Segment,Sales\n" + "2024-01-01,SMB,1.5\n" * n)
        table = readers.land_csv(spark, str(path), out)
        assert table.count() == n and dict(table.dtypes)["Sales"] == "double"
    none = tmp_path / "none.csv"
    none.write_text("Order Date,Segment,Sales\n")
    with pytest.raises(ContractError, match="no data rows"):
        readers.land_csv(spark, str(none), out)
    assert readers.read_table(spark, out).count() == 1


def test_run_log_takes_each_run_once(spark, rows, tmp_path):
    row = spark.createDataFrame([("007", "told")], "run_id string, narrative string")
    path = str(tmp_path / "runs")
    assert writers.append_run(row, path, dry_run=True).count() == 1 and not (tmp_path / "runs").exists()
    writers.append_run(row, path)
    writers.append_run(row, path)
    stop = F.raise_error(F.lit("lost")).cast("string")
    with pytest.raises(Exception, match="lost"):
        writers.append_run(row.withColumns({"run_id": F.lit("8"), "narrative": stop}), path)
    assert rows(writers.read_runs(spark, path, row.schema), "run_id", "narrative") == [("007", "told")]
    writers.append_run(row.withColumn("run_id", F.lit("8")), path)
    assert rows(writers.read_runs(spark, path, row.schema), "run_id") == [("007",), ("8",)]
