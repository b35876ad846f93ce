"""Readers on small files of the source shapes."""

from __future__ import annotations

import datetime as dt
import time
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomhouse.bindings import QUERIES, staging
from loomhouse.functions import fixed_width as fw
from loomhouse.functions import labels
from loomhouse.plans.warehouse import stage_customers
from loomhouse.schemas import TRADE_FILE, WAREHOUSE
from loomhouse.session import materialize
from loomhouse.sources import xml
from loomhouse.sources.catalog import catalog_of, register_files, session_catalog
from loomhouse.sources.files import (
    read_batch_dates,
    read_delimited,
    read_whole_texts,
    read_wire_lines,
    split_wire_lines,
    write_folders,
)
from loomhouse.sources.xml import column_names, flatten_actions, read_actions, read_any_actions

ACTIONS = """<?xml version="1.0" encoding="UTF-8"?>
<TPCDI:Actions xmlns:TPCDI="http://www.tpc.org/tpc-di">
  <TPCDI:Action ActionType="NEW" ActionTS="2007-07-07T02:56:25">
    <Customer C_ID="0" C_TAX_ID="923-54-6498" C_GNDR="f" C_TIER="3" C_DOB="1940-12-02">
      <Name><C_L_NAME>Joannis</C_L_NAME><C_F_NAME>Adara</C_F_NAME><C_M_NAME/></Name>
      <Address><C_ADLINE1>4779 Weller Way</C_ADLINE1><C_ADLINE2></C_ADLINE2>
        <C_ZIPCODE>92624</C_ZIPCODE><C_CITY>Columbus</C_CITY>
        <C_STATE_PROV>Ontario</C_STATE_PROV><C_CTRY>Canada</C_CTRY></Address>
      <ContactInfo>
        <C_PRIM_EMAIL>a@moose-mail.com</C_PRIM_EMAIL><C_ALT_EMAIL/>
        <C_PHONE_1><C_CTRY_CODE>1</C_CTRY_CODE><C_AREA_CODE>872</C_AREA_CODE>
          <C_LOCAL>523-8928</C_LOCAL><C_EXT/></C_PHONE_1>
        <C_PHONE_2><C_CTRY_CODE/><C_AREA_CODE/><C_LOCAL>492-3961</C_LOCAL><C_EXT>77</C_EXT></C_PHONE_2>
        <C_PHONE_3><C_CTRY_CODE/><C_AREA_CODE/><C_LOCAL/><C_EXT/></C_PHONE_3>
      </ContactInfo>
      <TaxInfo><C_LCL_TX_ID>CA3</C_LCL_TX_ID><C_NAT_TX_ID>YT3</C_NAT_TX_ID></TaxInfo>
      <Account CA_ID="0" CA_TAX_ST="1"><CA_B_ID>17713</CA_B_ID><CA_NAME>CJlmMUFy</CA_NAME></Account>
    </Customer>
  </TPCDI:Action>
  <TPCDI:Action ActionType="INACT" ActionTS="2008-01-01T00:00:00"><Customer C_ID="x"/></TPCDI:Action>
</TPCDI:Actions>
"""


def test_xml_actions_to_customer_stage(spark, tmp_path):
    (tmp_path / "CustomerMgmt.xml").write_text(ACTIONS)
    flat = flatten_actions(read_actions(spark, str(tmp_path)))
    new, gone = flat.orderBy("ActionTS").collect()
    assert (new["C_LOCAL"], new["C_LOCAL_1"], new["CA_NAME"]) == ("523-8928", "492-3961", "CJlmMUFy")
    assert gone["C_LOCAL"] is None and gone["C_ID"] == "x"
    staged, inactive = stage_customers(flat).orderBy("update_ts").collect()
    assert (staged["phone1"], staged["phone2"], staged["phone3"]) == (
        "+1 (872) 523-8928",
        "492-396177",
        None,
    )
    assert staged["gender"] == "F" and staged["dob"] == dt.date(1940, 12, 2)
    assert staged["middleinitial"] is None and staged["status"] == "Active"
    assert inactive["customerid"] is None and inactive["status"] == "Inactive"


ASIDES = """<Log xmlns:T="u">
<!-- <T:Action A="0"><N>no</N></T:Action> -->
<T:Action A="1"><Customer C_ID="7 > 6" T:EXTRA="x"><Name><L>one <![CDATA[</T:Action> <b>]]> end</L></Name></Customer></T:Action>
<T:Action A='2' Odd="y/"><New><Deep><Deeper><L>two</L></Deeper></Deep></New><!-- </T:Action> --><L>three</L></T:Action>
<T:Action A="3"/><T:Action A="4"><N/></T:Action>
<T:Action A="5"><![CDATA[</T:Action></T:Action> <!-- </T:Action>]]><L>four</L></T:Action>
<T:Action A="6"><L>five</T:Action>
<T:Action A="7"><N>last</N></T:Action>
</Log>"""


def test_cdata_comments_and_unknown_columns(spark, tmp_path):
    (tmp_path / "a.xml").write_text(ASIDES)
    flat, rejects = read_any_actions(spark, str(tmp_path), "T:Action")
    assert flat.columns == ["A", "C_ID", "EXTRA", "L", "Odd", "L_1", "L_2", "N"]
    got = {r["A"]: tuple(r)[1:] for r in flat.collect()}
    none = (None,) * 7
    assert got == {
        "1": ("7 > 6", "x", "one </T:Action> <b> end", None, None, None, None),
        "2": (None, None, None, "y/", "two", "three", None),
        "3": none,
        "4": none,
        "5": (None, None, None, None, None, "four", None),
        "7": (None, None, None, None, None, None, "last"),
    }
    (bad,) = rejects.collect()
    assert "mismatched" in bad["reason"] and bad["record"].startswith('<T:Action A="6">')


def test_a_section_left_open_rejects_the_rest_of_the_file(spark, tmp_path):
    (tmp_path / "a.xml").write_text('<L><A n="1"/><A n="2"><x><![CDATA[</A> <A n="3"/></A>')
    (tmp_path / "b.xml").write_text('<L><A n="4"><y>z</y></A></L>')
    flat, rejects = read_any_actions(spark, str(tmp_path), "A")
    assert sorted(r["n"] for r in flat.collect()) == ["1", "4"]
    assert rejects.count() == 1


def test_fixed_columns_survive_cdata(spark, tmp_path):
    text = ACTIONS.replace("4779 Weller Way", "<![CDATA[4779 </TPCDI:Action> Way]]>")
    (tmp_path / "CustomerMgmt.xml").write_text(text)
    flat = flatten_actions(read_actions(spark, str(tmp_path)))
    new, gone = flat.orderBy("ActionTS").collect()
    assert new["C_ADLINE1"] == "4779 </TPCDI:Action> Way" and new["CA_NAME"] == "CJlmMUFy"
    assert gone["ActionType"] == "INACT"


def test_xml_splits_with_asides_in_many_blocks(spark, tmp_path):
    one = '<A n="%d"><x><![CDATA[%s</A>]]></x></A>\n'
    text = "<L>" + "".join(one % (k, "y" * (k % 700)) for k in range(600)) + "</L>"
    (tmp_path / "c.xml").write_text(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        flat, rejects = read_any_actions(spark, str(tmp_path), "A")
        rows = {int(r["n"]): r["x"] for r in flat.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert rows == {k: "y" * (k % 700) + "</A>" for k in range(600)} and rejects.isEmpty()


def test_stored_leaves_keep_no_texts_and_few_places(spark, tmp_path, monkeypatch):
    """Of each file only the records that are first with a path are sorted; columns as the files show them."""
    kept = []
    monkeypatch.setattr(xml, "materialize", lambda df, name: kept.append(materialize(df, name)) or kept[-1])
    (tmp_path / "a.xml").write_text('<L><A n="0"><z>1</z></A><A n="0"><x.</A></L>')
    # the larger file is read first
    more = "".join(f'<A n="{k}"><y>{k}</y><z>{k}</z><v>{"long" * 9}</v></A>' for k in range(1, 500))
    (tmp_path / "b.xml").write_text(f"<L>{more}</L>")
    flat, rejects = read_any_actions(spark, str(tmp_path), "A")
    assert flat.columns == ["n", "z", "y", "v"] and flat.count() == 500
    assert [r["record"] for r in rejects.collect()] == ['<A n="0"><x.</A>']
    (leaves,) = kept
    assert leaves.where("reason is null and x is not null").isEmpty()
    assert leaves.where("first is not null").count() <= 2


def test_first_places_hold_in_any_order_and_with_few_paths_remembered(monkeypatch):
    monkeypatch.setattr(xml, "MOST_COLUMNS", 1)
    rows = [("b", 0, 1, 0, "<A><p/><q/></A>"), ("b", 0, 0, 1, "<A><q/></A>"), ("a", 9, 9, 0, "<A><r/><p/></A>")]
    batch = pa.RecordBatch.from_pylist(
        [{"file": f, "piece": {"block": b, "at": at}, "k": k, "x": x} for f, b, at, k, x in rows]
    )
    found = [r for b in xml._parsed([batch, batch]) for r in b.to_pylist()]
    first = {}
    for r in found:
        for i in r["first"] or []:
            place = (r["file"], r["piece"]["block"], r["piece"]["at"], r["k"], i)
            path = r["leaves"][i][0]
            first[path] = min(first.get(path, place), place)
    assert first == {"p": ("a", 9, 9, 0, 1), "q": ("b", 0, 0, 1, 0), "r": ("a", 9, 9, 0, 0)}


def test_action_files_are_packed_and_small(spark, monkeypatch):
    monkeypatch.setattr(staging, "ACTIONS_PER_FILE", 20)
    nested = staging.nested_actions(spark, "/root/testdata/sf0.001").limit(70).coalesce(1)
    folder = Path(staging.action_files(nested).removeprefix("file:"))
    packed = list(folder.glob("*.xml.gz"))
    assert len(packed) == 4 and not list(folder.glob("*.xml"))
    want = nested.select("_ActionTS", "Customer._C_ID").collect()
    got = read_actions(spark, str(folder), "Action").select("_ActionTS", "Customer._C_ID").collect()
    assert sorted(got) == sorted(want)


def test_column_names_are_numbered():
    assert column_names(["A.x", "B.x", "x", "A.y"]) == ["x", "x_1", "x_2", "y"]


def test_one_xml_file_is_read_by_many_tasks(spark, tmp_path):
    head, body = ACTIONS.split("<TPCDI:Action ", 1)
    body = "<TPCDI:Action " + body.replace("</TPCDI:Actions>\n", "")
    empty = '<TPCDI:Action ActionType="INACT" ActionTS="2009-01-01T00:00:00"/>'
    text = head + body * 400 + empty + body + empty + "</TPCDI:Actions>"
    (tmp_path / "c.xml").write_text(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        actions = read_actions(spark, str(tmp_path))
        assert actions.rdd.getNumPartitions() > 3
        kinds = {r["_ActionType"]: r["count"] for r in actions.groupBy("_ActionType").count().collect()}
        named = actions.where("Customer.Name.C_L_NAME = 'Joannis'").count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert kinds == {"NEW": 401, "INACT": 403} and named == 401


def test_wire_files_by_name(spark, tmp_path):
    line = "19670401-123456CMP" + "Acme".ljust(60) + "0000000012"
    for name in ("FINWIRE1967Q2", "FINWIRE1967Q2_audit.csv", "finwire1967Q3", "OTHER"):
        (tmp_path / name).write_text(line + "\n")
    folder = tmp_path / "FINWIRE1967Q4"
    folder.mkdir()
    (folder / "part-0").write_text(line + "\n")
    (folder / "FINWIRE1967Q4_audit.csv").write_text(line + "\n")
    path = str(tmp_path)
    assert read_wire_lines(spark, path).count() == 2
    assert read_wire_lines(spark, path, case_sensitive=False).count() == 3
    row = split_wire_lines(read_wire_lines(spark, path)).first()
    assert (row["rectype"], row["recdate"]) == ("CMP", dt.date(1967, 4, 1))
    assert row["value"].startswith("Acme ")


@pytest.mark.parametrize("tail, kind", [("0000000042", "FIN_COMPANYID"), ("Acme Corp", "FIN_NAME")])
def test_financial_lines_by_company_key(spark, tail, kind):
    value = "1967" + "2" + "19670401" + " " * 155 + tail.ljust(60)
    line = "19670501-120000FIN" + value
    df = split_wire_lines(spark.createDataFrame([(line,)], "line string"))
    assert df.first()["rectype"] == kind


def test_layouts_are_contiguous():
    for layout in (fw.COMPANY, fw.SECURITY):
        assert all(a.start + a.length == b.start for a, b in zip(layout, layout[1:]))
    assert fw.FINANCIAL[-1].start + fw.FINANCIAL[-1].length == 169


def test_blank_dates_and_numbers_are_null_unless_strict(spark):
    df = spark.createDataFrame([(" " * 142,)], "value string")
    row = fw.decode(df, "value", fw.SECURITY, []).first()
    assert row["firsttrade"] is None and row["sharesoutstanding"] is None
    with pytest.raises(Exception):
        fw.decode(df, "value", fw.FINANCIAL, []).collect()


def test_company_key_forms(spark):
    df = spark.createDataFrame(
        [("x" * 5 + "0000000120",), ("x" * 5 + "Name 12".ljust(60),)], "v string"
    )
    v = F.col("v")
    rows = df.select(
        labels.company_id_text(v).alias("i"), labels.company_name(v).alias("n"), labels.company_key(v).alias("k")
    ).collect()
    assert [tuple(r) for r in rows] == [("120", None, "120"), (None, "Name 12", "Name 12")]


def test_tolerant_delimited_read(spark, tmp_path):
    (tmp_path / "Trade.txt").write_text(
        "1|2012-07-06 09:00:00|CMPT|TMB|1|SYM|ten|5.5|7|Jo|5.4||0.1|0\n2|bad\n"
    )
    a, b = read_delimited(spark, str(tmp_path / "Trade.txt"), TRADE_FILE).orderBy("tradeid").collect()
    assert a["quantity"] is None and a["fee"] is None and a["bidprice"] == 5.5
    assert a["t_dts"] == dt.datetime(2012, 7, 6, 9)
    assert b["tradeid"] == 2 and b["t_dts"] is None


def test_delimited_files_are_packed_and_small(spark, monkeypatch):
    monkeypatch.setattr(staging, "LINES_PER_FILE", 20)
    rows = [(k, None if k % 3 else "", f"é \"{k}\"") for k in range(70)]
    df = spark.createDataFrame(rows, "a long, b string, c string").coalesce(1)
    folder = Path(staging.write_delimited(df, "packed").removeprefix("file:"))
    assert len(list(folder.glob("*.csv.gz"))) == 4 and not list(folder.glob("*.csv"))
    got = read_delimited(spark, str(folder), df.schema).select("a", "b").collect()
    assert sorted(r["a"] for r in got) == list(range(70)) and {r["b"] for r in got} == {None}


def test_wire_files_are_packed(spark):
    lines = staging.staged_wire(spark, "/root/testdata/sf0.001")
    assert lines.count() > 0 and all(f.endswith(".txt.gz") for f in lines.inputFiles() if "_audit" not in f)


def test_stored_tables_leave_no_shuffle_files(spark):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}

    before = shuffled()
    counts = materialize(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    for _ in range(100):
        if not (left := shuffled() - before):
            break
        time.sleep(0.1)
    assert not left and counts.count() == 7


def test_date_file_into_its_table(spark, tmp_path):
    (tmp_path / "Date.txt").write_text(
        "19500101|1950-01-01|January 1, 1950|1950|1950|19501|1950 Q1|19501|1950 January"
        "|19501|1950-W1|7|Sunday|1950|1950|19503|1950 Q3|true\n"
    )
    row = read_delimited(spark, str(tmp_path), WAREHOUSE["DimDate"]).first()
    assert row["datevalue"] == dt.date(1950, 1, 1) and row["holidayflag"] is True


def test_batch_dates_by_folder(spark, tmp_path):
    for n, day in ((1, "2017-07-07"), (12, "2017-07-08")):
        (tmp_path / f"Batch{n}").mkdir()
        (tmp_path / f"Batch{n}" / "BatchDate.txt").write_text(day + "\n")
    rows = {tuple(r) for r in read_batch_dates(spark, str(tmp_path)).collect()}
    assert rows == {(dt.date(2017, 7, 7), 1), (dt.date(2017, 7, 8), 12)}


def test_whole_texts(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.sql").write_text("SELECT 1\nFROM t")
    (tmp_path / "y.txt").write_text("no")
    row = read_whole_texts(spark, str(tmp_path), "*.sql").collect()
    assert [(r["name"], r["content"]) for r in row] == [("x.sql", "SELECT 1\nFROM t")]
    assert row[0]["path"].endswith("/a/x.sql")


def test_folders_are_written_as_by_partitions_and_listed_by_few_tasks(spark, tmp_path):
    rows = [(k, f"é {k}\nend") for k in range(200)] + [(7, None), (7, ""), (7, "é 7\nend"), (None, "none")]
    df = spark.createDataFrame(rows, "k long, value string").coalesce(1)
    df.write.partitionBy("k").text(f"{tmp_path}/plain")
    write_folders(df, "k", f"{tmp_path}/own")
    write_folders(df.limit(0), "k", f"{tmp_path}/empty")

    def found(folder):
        read = read_whole_texts(spark, f"{tmp_path}/{folder}", "*.txt")
        return sorted((p.split("/")[-2], text) for _, p, text in read.collect())

    spark.sparkContext.setJobGroup("listing", "one listing of 201 folders")
    try:
        read_whole_texts(spark, f"{tmp_path}/own", "*.txt")
    finally:
        spark.sparkContext.setJobGroup("", "")
    tracker = spark.sparkContext.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    assert 0 < sum(tracker.getStageInfo(s).numTasks for s in stages) < 100
    assert found("own") == found("plain") and len(found("own")) == 201 and found("empty") == []
    assert dict(found("own"))["k=7"] == "é 7\nend\n\n\né 7\nend\n"


@pytest.mark.parametrize("query", ["lineage_docs_read", "script_files_read"])
def test_files_of_their_own_are_written_by_many_tasks(spark, tmp_path, monkeypatch, query):
    """Tasks by the number of folders, though the table is one small file."""
    monkeypatch.setattr("loomhouse.sources.files.FOLDERS_PER_TASK", 5)
    spark.createDataFrame(
        [(k, f"s{k}", k % 25, 1.5) for k in range(100)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"
    ).coalesce(1).write.parquet(f"{tmp_path}/supplier.parquet")
    spark.sparkContext.setJobGroup(query, query)
    try:
        rows = QUERIES[query](spark, str(tmp_path)).count()
    finally:
        spark.sparkContext.setJobGroup("", "")
    tracker = spark.sparkContext.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup(query) for s in tracker.getJobInfo(j).stageIds]
    known = [i for i in map(tracker.getStageInfo, stages) if i]
    # the writing tasks are the only ones of that number: 100 // 5 + 1
    assert rows in (100, 200) and 21 in {i.numTasks for i in known}


def test_catalog_lists_columns(spark):
    df = spark.range(1).withColumn("v", F.lit("x"))
    rows = catalog_of(spark, {"s.t": df}, {"s.t": ["id"]}).orderBy("position").collect()
    assert [(r["column"], r["type"], r["description"]) for r in rows] == [
        ("id", "bigint", "Primary Key: true"),
        ("v", "string", None),
    ]
    df.createOrReplaceTempView("catalog_view")
    assert "default.catalog_view" not in session_catalog(spark, "default")


def test_phone_rating_and_tags(spark):
    row = spark.sql("SELECT '' AS none, CAST(NULL AS string) AS nul, 'BBB+' AS good, 'CC' AS low").select(
        labels.phone(F.col("none"), F.col("nul"), F.lit("5"), F.col("nul")).alias("p"),
        labels.phone(F.lit("1"), F.lit("2"), F.col("none"), F.lit("9")).alias("q"),
        labels.is_low_grade(F.col("good")).alias("g"),
        labels.is_low_grade(F.col("low")).alias("l"),
        labels.is_low_grade(F.lit("ZZ")).alias("z"),
        labels.tag_list({"A": F.col("nul") == "x", "B": F.lit(True), "C": F.lit(True)}).alias("t"),
        labels.tag_list({"A": F.lit(False)}).alias("n"),
    ).first()
    assert tuple(row) == ("5", None, False, True, None, "B+C", None)


def test_comments_go_through_the_catalog(spark, tmp_path):
    spark.range(3).selectExpr("id", "'x' AS s").write.parquet(str(tmp_path / "t"))
    register_files(
        spark, "noted", str(tmp_path / "db"), {"t": str(tmp_path / "t")}, {"t": {"s": "it's a text"}}
    )
    try:
        found = session_catalog(spark, "noted")
        assert found["noted.t"].count() == 3
        rows = {r["column"]: r["comment"] for r in catalog_of(spark, found).collect()}
        assert rows == {"id": None, "s": "it's a text"}
    finally:
        spark.sql("DROP DATABASE noted CASCADE")
