"""Readers and decoders, on files and records written from the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomhouse.bindings.registry import query, row_count, stamp, table, text
from loomhouse.functions import fixed_width as fw
from loomhouse.functions import labels
from loomhouse.plans.warehouse import stage_customers, stage_prospects
from loomhouse.schemas import CUSTOMER_EXTRACT, HR_FILE, PROSPECT_FILE, TRADE_FILE
from loomhouse.session import fresh_folder
from loomhouse.sources.files import (
    read_batch_dates,
    read_delimited,
    read_wire_lines,
    read_with_rejects,
    split_wire_lines,
)
from loomhouse.sources.xml import flatten_actions, read_actions, read_any_actions


# Packed files are read whole by one task, so they are kept small: about 25 to 100 MB of text.
LINES_PER_FILE = 500_000
ACTIONS_PER_FILE = 25_000


def write_delimited(df: DataFrame, name: str, sep: str = "|") -> str:
    """Write header-less delimited files, packed, and return their folder."""
    folder = fresh_folder(df.sparkSession, name)
    limited = df.write.option("maxRecordsPerFile", LINES_PER_FILE)
    limited.csv(folder, sep=sep, header=False, quote="", emptyValue="", compression="gzip")
    return folder


@query("load_reference_delimited", "SELECT * FROM part")
def q_load_reference(spark, sf):
    part = table(spark, sf, "part")
    return read_delimited(spark, write_delimited(part, "part"), part.schema)


HR_SELECT = """
    s_suppkey AS employeeid, CAST(s_nationkey AS BIGINT) AS managerid,
    'F' || s_suppkey AS employeefirstname, s_name AS employeelastname,
    CASE WHEN s_acctbal < 0 THEN NULL ELSE 'M' END AS employeemi,
    CASE WHEN s_acctbal < 6000 THEN '314' ELSE '527' END AS employeejobcode,
    'Branch ' || s_nationkey AS employeebranch, 'OFFICE' || s_nationkey AS employeeoffice,
    '(' || s_nationkey || ') 555' AS employeephone"""


def hr_rows(spark, sf) -> DataFrame:
    """Suppliers as employees, written as ``HR.csv`` and read back."""
    rows = spark.sql(f"SELECT {HR_SELECT} FROM {{t}}", t=table(spark, sf, "supplier"))
    return read_delimited(spark, write_delimited(rows, "HR.csv", ","), HR_FILE, ",")


@query(
    "broker_stage",
    f"SELECT * FROM (SELECT {HR_SELECT} FROM supplier) WHERE employeejobcode = '314'",
)
def q_broker_stage(spark, sf):
    return hr_rows(spark, sf).where("employeejobcode = '314'")


# Customers as prospects; an income of 0 is left out of the file.
PROSPECT_SELECT = """
    'A' || c_nationkey AS agencyid, c_name AS lastname, 'Jo' AS firstname,
    CAST(NULL AS VARCHAR(9)) AS middleinitial,
    CASE WHEN c_acctbal < 0 THEN 'F' ELSE 'M' END AS gender,
    'Street ' || c_custkey AS addressline1,
    CASE WHEN c_mktsegment = 'BUILDING' THEN 'Flat 1' END AS addressline2,
    'Z' || c_nationkey AS postalcode, 'City' AS city, 'ST' AS state, 'Land' AS country,
    '555-' || c_custkey AS phone,
    CASE WHEN c_nationkey > 0 THEN c_nationkey * 10000 END AS income,
    CAST(c_custkey % 5 AS INT) AS numbercars, CAST(c_custkey % 6 AS INT) AS numberchildren,
    'S' AS maritalstatus, CAST(18 + c_custkey % 60 AS INT) AS age,
    CAST(500 + c_custkey % 350 AS INT) AS creditrating, 'O' AS ownorrentflag,
    c_mktsegment AS employer, CAST(c_custkey % 9 AS INT) AS numbercreditcards,
    CAST(floor(c_acctbal) * 150 AS INT) AS networth"""

def nameplate_sql() -> str:
    """The tags of ``NAMEPLATE_RULES`` on the columns of a prospect."""
    arms = []
    for tag, (how, tests) in labels.NAMEPLATE_RULES.items():
        holds = f" {how} ".join(f"{field} {sign} {limit}" for field, sign, limit in tests)
        arms.append(f"CASE WHEN {holds} THEN '{tag}' END")
    return f"nullif(concat_ws('+', {', '.join(arms)}), '')"


NAMEPLATE_SQL = nameplate_sql()


def prospect_rows(spark, sf, batch: int = 1) -> DataFrame:
    """Customers written as ``Prospect.csv``, read back and staged."""
    rows = spark.sql(f"SELECT {PROSPECT_SELECT} FROM {{t}}", t=table(spark, sf, "customer"))
    read = read_delimited(spark, write_delimited(rows, "Prospect.csv", ","), PROSPECT_FILE, ",")
    return stage_prospects(read, batch)


@query(
    "prospect_stage",
    f"""
    SELECT * REPLACE (CAST(income AS VARCHAR) AS income),
           {NAMEPLATE_SQL} AS marketingnameplate, 1 AS recordbatchid, 1 AS batchid
    FROM (SELECT {PROSPECT_SELECT} FROM customer)""",
)
def q_prospect_stage(spark, sf):
    return prospect_rows(spark, sf)


@query(
    "trade_stage",
    """
    SELECT o_orderkey AS tradeid, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS t_dts,
           o_orderstatus AS status,
           'TMB' AS t_tt_id, CAST(1 AS TINYINT) AS cashflag, 'SYM' AS t_s_symb,
           CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey % 1000 END AS quantity,
           o_totalprice AS bidprice, o_custkey AS t_ca_id, 'Jo' AS executedby,
           o_totalprice AS tradeprice, CAST(0.5 AS DOUBLE) AS fee,
           CAST(0.25 AS DOUBLE) AS commission, CAST(0 AS DOUBLE) AS tax
    FROM orders""",
)
def q_trade_stage(spark, sf):
    """Orders as ``Trade.txt``; a quantity that is no number reads as null."""
    trades = read_delimited(spark, trade_files(spark, sf), TRADE_FILE)
    return trades.withColumn("t_dts", stamp("t_dts"))


@query(
    "trade_stage_rejects",
    """
    SELECT o_orderkey AS tradeid, 'quantity: n/a' AS reason, true AS is_line FROM orders
    WHERE o_orderstatus = 'P'""",
)
def q_trade_stage_rejects(spark, sf):
    """The same lines; those that do not fit, with their place in their file."""
    path = trade_files(spark, sf)
    _, rejects = read_with_rejects(spark, path, TRADE_FILE)
    return rejects.select(
        F.split("record", r"\|")[0].cast("long").alias("tradeid"),
        "reason",
        ((F.col("line") > 0) & F.col("file").contains("part-")).alias("is_line"),
    )


def trade_files(spark, sf) -> str:
    bad = F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(
        (F.col("o_custkey") % 1000).cast("string")
    )
    rows = table(spark, sf, "orders").select(
        "o_orderkey", stamp("o_orderdate"), "o_orderstatus",
        F.lit("TMB"), F.lit(1), F.lit("SYM"), bad, "o_totalprice", "o_custkey", F.lit("Jo"),
        "o_totalprice", F.lit(0.5), F.lit(0.25), F.lit(0.0),
    )
    positional = rows.toDF(*[f"c{i}" for i in range(14)])
    return write_delimited(positional, "Trade.txt")


def wire_lines(spark, sf) -> DataFrame:
    """Suppliers, parts and orders as company, security and financial lines."""
    cmp = fw.encode(company_source(spark, sf), fw.COMPANY, "value", ["day"])
    sec = fw.encode(security_source(spark, sf), fw.SECURITY, "value", ["day", "tail"])
    fin = fw.encode(financial_source(spark, sf), fw.FINANCIAL, "value", ["day", "tail"])

    def lines(df: DataFrame, kind: str, *tail: str) -> DataFrame:
        return df.select(
            F.concat(
                F.date_format("day", "yyyyMMdd"), F.lit("-120000"), F.lit(kind), "value", *tail
            ).alias("value")
        )

    return (
        lines(cmp, "CMP")
        .unionByName(lines(sec, "SEC", "tail"))
        .unionByName(lines(fin, "FIN", "tail"))
    )


def _tail(number, name, numbered):
    """Company reference: a zero-padded number, or a padded name."""
    return F.when(
        numbered, F.rpad(F.lpad(number.cast("string"), 10, "0"), 10, " ")
    ).otherwise(F.rpad(name, 60, " "))


_STATUS = ["ACTV", "CMPT", "CNCL", "PNDG", "SBMT", "INAC"]


def company_source(spark, sf) -> DataFrame:
    """Two company records per supplier, with columns as in the record layout."""
    key = F.col("s_suppkey")
    grades = F.array(*[F.lit(g) for g in labels.HIGH_GRADES + labels.LOW_GRADES])
    versions = table(spark, sf, "supplier").withColumn(
        "v", F.explode(F.array(F.lit(0), F.lit(1)))
    )
    return versions.select(
        F.date_add(F.lit("1994-01-01").cast("date"), (key % 300 + 900 * F.col("v")).cast("int")).alias("day"),
        F.col("s_name").alias("companyname"),
        F.lpad((key + 1).cast("string"), 10, "0").alias("cik"),
        F.element_at(F.array(*[F.lit(s) for s in _STATUS]), (key % 6 + 1).cast("int")).alias("status"),
        F.concat(F.lit("I"), (F.col("s_nationkey") % 10).cast("string")).alias("industryid"),
        F.get(grades, (key % 25).cast("int")).alias("sprating"),
        F.date_add(F.lit("1950-01-01").cast("date"), key.cast("int")).alias("foundingdate"),
        F.concat(F.lit("Line "), key).alias("addrline1"),
        F.lit("").alias("addrline2"),
        F.concat(F.lit("P"), key).alias("postalcode"),
        F.lit("Town").alias("city"),
        F.lit("State").alias("stateprovince"),
        F.concat(F.lit("N"), "s_nationkey").alias("country"),
        F.concat(F.lit("CEO "), F.col("v")).alias("ceoname"),
        F.concat(F.lit("About "), "s_name").alias("description"),
    )


COMPANY_SQL = f"""
    SELECT DATE '1994-01-01' + CAST(s_suppkey % 300 + 900 * v AS INTEGER) AS day,
           s_name AS companyname, lpad(CAST(s_suppkey + 1 AS VARCHAR), 10, '0') AS cik,
           [{", ".join(f"'{s}'" for s in _STATUS)}][s_suppkey % 6 + 1] AS status,
           'I' || s_nationkey % 10 AS industryid,
           coalesce([{", ".join(f"'{g}'" for g in labels.HIGH_GRADES + labels.LOW_GRADES)}][
               s_suppkey % 25 + 1], '') AS sprating,
           DATE '1950-01-01' + CAST(s_suppkey AS INTEGER) AS foundingdate,
           'Line ' || s_suppkey AS addrline1, '' AS addrline2, 'P' || s_suppkey AS postalcode,
           'Town' AS city, 'State' AS stateprovince, 'N' || s_nationkey AS country,
           'CEO ' || v AS ceoname, 'About ' || s_name AS description, s_suppkey, v
    FROM supplier, (VALUES (0), (1)) t(v)"""


def security_source(spark, sf) -> DataFrame:
    """One security per part; its company is named or numbered by size."""
    key = F.col("p_partkey")
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("company"), "s_name"
    )
    parts = table(spark, sf, "part").withColumn("company", key % row_count(suppliers))
    issued = parts.join(suppliers, "company")
    return issued.select(
        F.date_add(F.lit("1994-03-01").cast("date"), (key % 700).cast("int")).alias("day"),
        F.concat(F.lit("S"), (key / 2).cast("bigint")).alias("symbol"),
        F.lit("COMMON").alias("issue"),
        F.lit("ACTV").alias("status"),
        F.col("p_name").alias("name"),
        F.col("p_type").substr(1, 6).alias("exchangeid"),
        F.when(F.col("p_size") > 5, key * 10).alias("sharesoutstanding"),
        F.when(F.col("p_size") > 9, F.date_add(F.lit("1980-01-01").cast("date"), F.col("p_size"))).alias("firsttrade"),
        F.date_add(F.lit("1985-01-01").cast("date"), F.col("p_size")).alias("firsttradeonexchange"),
        (F.col("p_size") / 4).alias("dividend"),
        _tail(F.col("company") + 1, F.col("s_name"), F.col("p_size") % 2 == 0).alias("tail"),
    )


SECURITY_SQL = """
    SELECT DATE '1994-03-01' + CAST(p_partkey % 700 AS INTEGER) AS day,
           'S' || p_partkey // 2 AS symbol, 'COMMON' AS issue, 'ACTV' AS status,
           p_name AS name, trim(substr(p_type, 1, 6)) AS exchangeid,
           CASE WHEN p_size > 5 THEN p_partkey * 10 END AS sharesoutstanding,
           CASE WHEN p_size > 9 THEN DATE '1980-01-01' + p_size END AS firsttrade,
           DATE '1985-01-01' + p_size AS firsttradeonexchange, p_size / 4 AS dividend,
           CASE WHEN p_size % 2 = 0 THEN CAST(s_suppkey + 1 AS VARCHAR) ELSE s_name END AS k,
           s_suppkey
    FROM part JOIN supplier ON p_partkey % (SELECT count(*) FROM supplier) = s_suppkey"""


def financial_source(spark, sf) -> DataFrame:
    """One quarterly record per order; its company is named or numbered."""
    key = F.col("o_orderkey")
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("company"), "s_name"
    )
    reported = table(spark, sf, "orders").repartition("o_orderkey").withColumn(
        "company", F.col("o_custkey") % row_count(suppliers)
    )
    at = F.to_date("o_orderdate")
    price = F.col("o_totalprice")
    return reported.join(suppliers, "company").select(
        at.alias("day"),
        F.year(at).alias("fi_year"),
        F.quarter(at).alias("fi_qtr"),
        F.trunc(at, "quarter").alias("fi_qtr_start_date"),
        price.alias("fi_revenue"),
        (price / 4).alias("fi_net_earn"),
        (key % 100 / 4).alias("fi_basic_eps"),
        (key % 100 / 8).alias("fi_dilut_eps"),
        F.lit(0.25).alias("fi_margin"),
        key.cast("double").alias("fi_inventory"),
        (key + 0.5).alias("fi_assets"),
        (key + 0.25).alias("fi_liability"),
        (key * 3).alias("fi_out_basic"),
        (key * 5).alias("fi_out_dilut"),
        _tail(F.col("company") + 1, F.col("s_name"), F.col("o_orderstatus") == "F").alias("tail"),
    )


FINANCIAL_SQL = """
    SELECT o_orderdate::DATE AS day, CAST(year(o_orderdate) AS INTEGER) AS fi_year,
           CAST(quarter(o_orderdate) AS INTEGER) AS fi_qtr,
           date_trunc('quarter', o_orderdate)::DATE AS fi_qtr_start_date,
           o_totalprice AS fi_revenue, o_totalprice / 4 AS fi_net_earn,
           o_orderkey % 100 / 4 AS fi_basic_eps, o_orderkey % 100 / 8 AS fi_dilut_eps,
           CAST(0.25 AS DOUBLE) AS fi_margin, CAST(o_orderkey AS DOUBLE) AS fi_inventory,
           CAST(o_orderkey + 0.5 AS DOUBLE) AS fi_assets,
           CAST(o_orderkey + 0.25 AS DOUBLE) AS fi_liability,
           o_orderkey * 3 AS fi_out_basic, o_orderkey * 5 AS fi_out_dilut,
           s_suppkey, s_name, o_orderstatus, o_orderkey
    FROM orders JOIN supplier ON o_custkey % (SELECT count(*) FROM supplier) = s_suppkey"""


def staged_wire(spark, sf) -> DataFrame:
    """Wire lines written as a quarterly file set, read back and split.

    The lines are also written under an audit name, which the reader skips.
    """
    root = fresh_folder(spark, "wire")
    lines = wire_lines(spark, sf)
    limited = lines.write.option("maxRecordsPerFile", LINES_PER_FILE)
    limited.text(f"{root}/FINWIRE1995Q1", compression="gzip")
    table(spark, sf, "supplier").select("s_name").write.text(f"{root}/FINWIRE1995Q1_audit")
    return split_wire_lines(read_wire_lines(spark, root))


@query(
    "finwire_stage",
    f"""
    SELECT rectype, CAST(day AS VARCHAR) AS recdate, count(*) AS n FROM (
        SELECT 'CMP' AS rectype, day FROM ({COMPANY_SQL})
        UNION ALL SELECT 'SEC', day FROM ({SECURITY_SQL})
        UNION ALL SELECT CASE WHEN o_orderstatus = 'F' THEN 'FIN_COMPANYID' ELSE 'FIN_NAME' END,
                         day FROM ({FINANCIAL_SQL}))
    GROUP BY ALL""",
)
def q_finwire_stage(spark, sf):
    staged = staged_wire(spark, sf)
    return staged.groupBy("rectype", text("recdate")).agg(F.count("value").alias("n"))


def _dated(df: DataFrame) -> DataFrame:
    """Dates as text."""
    return df.select(*[text(c) if t == "date" else F.col(c) for c, t in df.dtypes])


@query(
    "fixed_width_company",
    f"""
    SELECT * REPLACE (CAST(foundingdate AS VARCHAR) AS foundingdate, CAST(day AS VARCHAR) AS day)
    FROM (SELECT * EXCLUDE (s_suppkey, v) FROM ({COMPANY_SQL}))""",
)
def q_fixed_width_company(spark, sf):
    records = fw.encode(company_source(spark, sf), fw.COMPANY, "value", ["day"])
    return _dated(fw.decode(records, "value", fw.COMPANY, ["day"]))


@query(
    "fixed_width_security",
    f"""
    SELECT * REPLACE (CAST(firsttrade AS VARCHAR) AS firsttrade,
                      CAST(firsttradeonexchange AS VARCHAR) AS firsttradeonexchange,
                      CAST(day AS VARCHAR) AS day)
    FROM (SELECT * EXCLUDE (s_suppkey) FROM ({SECURITY_SQL}))""",
)
def q_fixed_width_security(spark, sf):
    encoded = fw.encode(security_source(spark, sf), fw.SECURITY, "value", ["day", "tail"])
    records = encoded.select("day", F.concat("value", "tail").alias("value"))
    keyed = records.withColumn("k", labels.company_key(F.col("value")))
    return _dated(fw.decode(keyed, "value", fw.SECURITY, ["day", "k"]))


@query(
    "fixed_width_financial",
    f"""
    SELECT * EXCLUDE (s_suppkey, s_name, o_orderstatus, o_orderkey)
             REPLACE (CAST(fi_qtr_start_date AS VARCHAR) AS fi_qtr_start_date,
                      CAST(day AS VARCHAR) AS day),
           CASE WHEN o_orderstatus = 'F' THEN CAST(s_suppkey + 1 AS VARCHAR) END AS id_text,
           CASE WHEN o_orderstatus <> 'F' THEN s_name END AS conm
    FROM ({FINANCIAL_SQL})""",
)
def q_fixed_width_financial(spark, sf):
    encoded = fw.encode(financial_source(spark, sf), fw.FINANCIAL, "value", ["day", "tail"])
    records = encoded.select("day", F.concat("value", "tail").alias("value"))
    keyed = records.withColumns(
        {
            "id_text": labels.company_id_text(F.col("value")),
            "conm": labels.company_name(F.col("value")),
        }
    )
    return _dated(fw.decode(keyed, "value", fw.FINANCIAL, ["day", "id_text", "conm"]))


_ACTIONS = ["NEW", "ADDACCT", "UPDACCT", "UPDCUST", "CLOSEACCT", "INACT"]


def nested_actions(spark, sf) -> DataFrame:
    """Orders as customer actions with nested elements.

    The first order of a customer is a NEW action and carries all attributes;
    later orders carry some.
    """
    customer, orders = table(spark, sf, "customer"), table(spark, sf, "orders")
    firsts = orders.groupBy("o_custkey").agg(
        F.min(F.struct("o_orderdate", "o_orderkey"))["o_orderkey"].alias("first_key")
    )
    rows = (
        orders.repartition("o_orderkey")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(firsts, "o_custkey")
        .withColumn("is_new", F.col("o_orderkey") == F.col("first_key"))
    )
    key, order = F.col("o_custkey"), F.col("o_orderkey")
    new = F.col("is_new")
    rest = F.array(*[F.lit(a) for a in _ACTIONS[1:]])
    action = F.when(new, "NEW").otherwise(F.element_at(rest, (order % 5 + 1).cast("int")))
    some = new | (order % 3 == 0)

    def phone(*parts):
        names = ("C_CTRY_CODE", "C_AREA_CODE", "C_LOCAL", "C_EXT")
        return F.struct(*[F.lit(p).alias(n) if isinstance(p, str) else p.alias(n) for p, n in zip(parts, names)])

    nested = rows.select(
        action.alias("_ActionType"),
        F.replace(
            (F.col("o_orderdate") + F.make_dt_interval(secs=(order % 86400).cast("decimal(18,6)"))).cast("string"),
            F.lit(" "), F.lit("T"),
        ).alias("_ActionTS"),
        F.struct(
            key.cast("string").alias("_C_ID"),
            F.when(new, F.concat(F.lit("T"), key)).alias("_C_TAX_ID"),
            F.when(new, F.element_at(F.array(F.lit("m"), F.lit("f"), F.lit("x"), F.lit("")), (key % 4 + 1).cast("int"))).alias("_C_GNDR"),
            F.when(some, (order % 3 + 1).cast("string")).alias("_C_TIER"),
            F.when(new, F.lit("1970-01-02")).alias("_C_DOB"),
            F.struct(
                F.when(new, F.col("c_name")).alias("C_L_NAME"),
                F.when(new, F.lit("Jo")).alias("C_F_NAME"),
                F.lit("").alias("C_M_NAME"),
            ).alias("Name"),
            F.struct(
                F.when(new, F.concat(F.lit("Street "), key)).alias("C_ADLINE1"),
                F.when(F.col("c_mktsegment") == "BUILDING", "Flat 1").otherwise("").alias("C_ADLINE2"),
                F.when(new, F.concat(F.lit("Z"), "c_nationkey")).alias("C_ZIPCODE"),
                F.when(some, F.concat(F.lit("City "), order)).alias("C_CITY"),
                F.lit("ST").alias("C_STATE_PROV"),
                F.lit("Land").alias("C_CTRY"),
            ).alias("Address"),
            F.struct(
                F.when(some, F.concat(F.lit("c"), order, F.lit("@x.org"))).alias("C_PRIM_EMAIL"),
                F.lit("").alias("C_ALT_EMAIL"),
                phone("1", F.when(order % 2 == 0, "716"), order.cast("string"), "99").alias("C_PHONE_1"),
                phone("", "716", F.when(some, F.concat(order, F.lit("-2"))), F.lit(None).cast("string")).alias("C_PHONE_2"),
                phone("44", "", F.when(new, "777").otherwise(""), "").alias("C_PHONE_3"),
            ).alias("ContactInfo"),
            F.struct(
                F.when(new, F.concat(F.lit("L"), F.col("c_nationkey"))).alias("C_LCL_TX_ID"),
                F.when(new, F.concat(F.lit("N"), F.col("c_nationkey") % 5)).alias("C_NAT_TX_ID"),
            ).alias("TaxInfo"),
            F.struct(
                (key * 2 + order % 2).cast("string").alias("_CA_ID"),
                F.when(some, (order % 3).cast("string")).alias("_CA_TAX_ST"),
                F.when(some, (key % 10).cast("string")).alias("CA_B_ID"),
                F.when(some, F.concat(F.lit("Account "), order)).alias("CA_NAME"),
            ).alias("Account"),
        ).alias("Customer"),
    )
    return nested


def action_files(nested: DataFrame) -> str:
    """The actions as packed XML files in a folder."""
    folder = fresh_folder(nested.sparkSession, "CustomerMgmt.xml")
    options = {
        "rowTag": "Action", "rootTag": "Actions", "compression": "gzip",
        "maxRecordsPerFile": ACTIONS_PER_FILE,
    }
    nested.write.format("xml").options(**options).save(folder)
    return folder


def action_log(spark, sf) -> DataFrame:
    """The actions written as XML and read back."""
    return flatten_actions(read_actions(spark, action_files(nested_actions(spark, sf)), "Action"))


def without_nulls(value: Column, kind: T.DataType) -> Column:
    """Nested text with blanks for nulls, so that every element is written."""
    if isinstance(kind, T.StructType):
        return F.struct(*[without_nulls(value[f.name], f.dataType).alias(f.name) for f in kind])
    return F.coalesce(value, F.lit(""))


# The same actions, with blanks as nulls.
ACTIONS_CTE = """
    f AS (SELECT o_custkey AS fk, min({'d': o_orderdate, 'k': o_orderkey}).k AS first_key
               FROM orders GROUP BY o_custkey),
    a AS (SELECT *, o_orderkey = first_key AS nw, o_orderkey = first_key OR o_orderkey % 3 = 0 AS sm
          FROM orders JOIN customer ON o_custkey = c_custkey JOIN f ON o_custkey = fk),
    act AS (
    SELECT o_orderkey,
           CASE WHEN nw THEN 'NEW' ELSE ['ADDACCT', 'UPDACCT', 'UPDCUST', 'CLOSEACCT', 'INACT'][
               o_orderkey % 5 + 1] END AS actiontype,
           o_orderdate + to_seconds(o_orderkey % 86400) AS update_ts, o_custkey AS customerid,
           o_custkey * 2 + o_orderkey % 2 AS accountid,
           CASE WHEN sm THEN o_custkey % 10 END AS brokerid,
           CASE WHEN nw THEN 'T' || o_custkey END AS taxid,
           CASE WHEN sm THEN 'Account ' || o_orderkey END AS accountdesc,
           CASE WHEN sm THEN CAST(o_orderkey % 3 AS TINYINT) END AS taxstatus,
           CASE WHEN nw THEN c_name END AS lastname, CASE WHEN nw THEN 'Jo' END AS firstname,
           CAST(NULL AS VARCHAR) AS middleinitial,
           CASE WHEN nw THEN ['M', 'F', 'X', NULL][o_custkey % 4 + 1] END AS gender,
           CASE WHEN sm THEN CAST(o_orderkey % 3 + 1 AS TINYINT) END AS tier,
           CASE WHEN nw THEN DATE '1970-01-02' END AS dob,
           CASE WHEN nw THEN 'Street ' || o_custkey END AS addressline1,
           CASE WHEN c_mktsegment = 'BUILDING' THEN 'Flat 1' END AS addressline2,
           CASE WHEN nw THEN 'Z' || c_nationkey END AS postalcode,
           CASE WHEN sm THEN 'City ' || o_orderkey END AS city,
           'ST' AS stateprov, 'Land' AS country,
           '+1 ' || CASE WHEN o_orderkey % 2 = 0 THEN '(716) ' ELSE '' END || o_orderkey || '99'
               AS phone1,
           CASE WHEN sm THEN '(716) ' || o_orderkey || '-2' END AS phone2,
           CASE WHEN nw THEN '+44 777' END AS phone3,
           CASE WHEN sm THEN 'c' || o_orderkey || '@x.org' END AS email1,
           CAST(NULL AS VARCHAR) AS email2,
           CASE WHEN nw THEN 'L' || c_nationkey END AS lcl_tx_id,
           CASE WHEN nw THEN 'N' || c_nationkey % 5 END AS nat_tx_id,
           CASE WHEN (CASE WHEN nw THEN 'NEW' ELSE ['ADDACCT', 'UPDACCT', 'UPDCUST', 'CLOSEACCT',
               'INACT'][o_orderkey % 5 + 1] END) IN ('CLOSEACCT', 'INACT') THEN 'Inactive'
               ELSE 'Active' END AS status
    FROM a)"""


_FLAT_SQL = f"WITH {ACTIONS_CTE}" + """
    SELECT actiontype AS "ActionType", strftime(update_ts, '%Y-%m-%dT%H:%M:%S') AS "ActionTS",
           CAST(customerid AS VARCHAR) AS "C_ID", taxid AS "C_TAX_ID", lower(gender) AS "C_GNDR",
           CAST(tier AS VARCHAR) AS "C_TIER", CAST(dob AS VARCHAR) AS "C_DOB",
           lastname AS "C_L_NAME", firstname AS "C_F_NAME", middleinitial AS "C_M_NAME",
           addressline1 AS "C_ADLINE1", addressline2 AS "C_ADLINE2", postalcode AS "C_ZIPCODE",
           city AS "C_CITY", stateprov AS "C_STATE_PROV", country AS "C_CTRY",
           email1 AS "C_PRIM_EMAIL", email2 AS "C_ALT_EMAIL",
           lcl_tx_id AS "C_LCL_TX_ID", nat_tx_id AS "C_NAT_TX_ID",
           '1' AS "C_CTRY_CODE", CASE WHEN o_orderkey % 2 = 0 THEN '716' END AS "C_AREA_CODE",
           CAST(o_orderkey AS VARCHAR) AS "C_LOCAL", '99' AS "C_EXT",
           CAST(NULL AS VARCHAR) AS "C_CTRY_CODE_1", '716' AS "C_AREA_CODE_1",
           CASE WHEN phone2 IS NOT NULL THEN o_orderkey || '-2' END AS "C_LOCAL_1",
           CAST(NULL AS VARCHAR) AS "C_EXT_1",
           '44' AS "C_CTRY_CODE_2", CAST(NULL AS VARCHAR) AS "C_AREA_CODE_2",
           CASE WHEN phone3 IS NOT NULL THEN '777' END AS "C_LOCAL_2",
           CAST(NULL AS VARCHAR) AS "C_EXT_2",
           CAST(accountid AS VARCHAR) AS "CA_ID", CAST(taxstatus AS VARCHAR) AS "CA_TAX_ST",
           CAST(brokerid AS VARCHAR) AS "CA_B_ID", accountdesc AS "CA_NAME"
    FROM act"""


@query("xml_action_flatten", _FLAT_SQL)
def q_xml_action_flatten(spark, sf):
    flat = action_log(spark, sf)
    return flat.select(*[labels.blank_to_null(F.col(n)).alias(n) for n in flat.columns])


@query(
    "xml_found_columns",
    _FLAT_SQL.replace(
        "FROM act",
        """, 'web' || o_orderkey % 3 AS "Channel", o_orderkey % 7 || '' AS "Level",
           'P' || customerid AS "Partner", customerid || 'q' AS "Level_1" FROM act""",
    ),
)
def q_xml_found_columns(spark, sf):
    """The same actions with an attribute and elements nobody declared."""
    nested = nested_actions(spark, sf)
    full = nested.select(*[without_nulls(F.col(f.name), f.dataType).alias(f.name) for f in nested.schema])
    order = F.col("Customer.ContactInfo.C_PHONE_1.C_LOCAL").cast("long")
    customer = F.col("Customer._C_ID")
    loyalty = F.struct(
        (order % 7).cast("string").alias("Level"),
        F.struct(F.concat(F.lit("P"), customer).alias("Partner"), F.concat(customer, F.lit("q")).alias("Level")).alias("More"),
    )
    more = full.withColumns(
        {
            "_Channel": F.concat(F.lit("web"), order % 3),
            "Customer": F.col("Customer").withField("Loyalty", loyalty),
        }
    )
    flat, _ = read_any_actions(spark, action_files(more), "Action")
    return flat.select(*[labels.blank_to_null(F.col(n)).alias(n) for n in flat.columns])


@query(
    "customer_stage",
    f"WITH {ACTIONS_CTE}"
    + """
    SELECT * EXCLUDE (o_orderkey)
           REPLACE (CAST(dob AS VARCHAR) AS dob,
                    strftime(update_ts, '%Y-%m-%d %H:%M:%S') AS update_ts)
    FROM act""",
)
def q_customer_stage(spark, sf):
    staged = stage_customers(action_log(spark, sf))
    return staged.withColumns({"dob": text("dob"), "update_ts": stamp("update_ts")})


@query(
    "phone_format",
    """
    SELECT c_custkey, CASE WHEN nullif(loc, '') IS NOT NULL THEN concat(
               CASE WHEN nullif(cc, '') IS NOT NULL THEN '+' || cc || ' ' ELSE '' END,
               CASE WHEN nullif(ar, '') IS NOT NULL THEN '(' || ar || ') ' ELSE '' END,
               loc, coalesce(ext, '')) END AS phone
    FROM (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN '1' ELSE '' END AS cc,
                 CASE WHEN c_custkey % 3 = 0 THEN CAST(c_nationkey AS VARCHAR) END AS ar,
                 CASE WHEN c_acctbal < 0 THEN '' ELSE substr(c_name, 10) END AS loc,
                 CASE WHEN c_custkey % 5 = 0 THEN 'x1' END AS ext FROM customer)""",
)
def q_phone_format(spark, sf):
    key = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        "c_custkey",
        labels.phone(
            F.when(key % 2 == 0, "1").otherwise(""),
            F.when(key % 3 == 0, F.col("c_nationkey").cast("string")),
            F.when(F.col("c_acctbal") < 0, "").otherwise(F.substring("c_name", 10, 100)),
            F.when(key % 5 == 0, "x1"),
        ).alias("phone"),
    )


@query(
    "batch_date_load",
    """
    SELECT CAST(max(o_orderdate)::DATE AS VARCHAR) AS batchdate, c_nationkey AS batchid
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey""",
)
def q_batch_date_load(spark, sf):
    """The last order date of each nation, in a folder per nation."""
    return batch_dates(spark, sf).select(text("batchdate"), "batchid")


def batch_dates(spark, sf) -> DataFrame:
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    rows = (
        orders.groupBy("o_custkey")
        .agg(F.max("o_orderdate").alias("last"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("c_nationkey").alias("Batch"))
        .agg(F.to_date(F.max("last")).alias("batchdate"))
    )
    folder = fresh_folder(spark, "batches")
    rows.write.partitionBy("Batch").csv(folder)
    return read_batch_dates(spark, folder)


# Columns of the change extract that get a value of their own.
_EXTRACT_OWN = ["cdc_flag", "cdc_dsn", "customerid", "lastname", "tier", "dob", "city"]
_EXTRACT_NAMES = [c.split()[0] for c in CUSTOMER_EXTRACT.split(",")]
_EXTRACT_REST = [n for n in _EXTRACT_NAMES if n not in _EXTRACT_OWN]


@query(
    "cdc_extract_read",
    f"""
    SELECT CASE WHEN c_acctbal < 0 THEN 'U' ELSE 'I' END AS cdc_flag, c_custkey + 1 AS cdc_dsn,
           c_custkey AS customerid, c_name AS lastname,
           CAST(c_nationkey % 3 + 1 AS TINYINT) AS tier, '1980-05-06' AS dob,
           CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS city,
           {", ".join(f"'{n} ' || c_custkey AS {n}" for n in _EXTRACT_REST)}
    FROM customer""",
)
def q_cdc_extract_read(spark, sf):
    """Customers as the change extract of a second batch."""
    known = {
        "cdc_flag": F.when(F.col("c_acctbal") < 0, "U").otherwise("I"),
        "cdc_dsn": F.col("c_custkey") + 1,
        "customerid": F.col("c_custkey"),
        "lastname": F.col("c_name"),
        "tier": F.col("c_nationkey") % 3 + 1,
        "dob": F.lit("1980-05-06"),
        "city": F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")),
        **{n: F.concat(F.lit(f"{n} "), "c_custkey") for n in _EXTRACT_REST},
    }
    rows = table(spark, sf, "customer").select(*[known[n].alias(n) for n in _EXTRACT_NAMES])
    read = read_delimited(spark, write_delimited(rows, "Batch2-Customer.txt"), CUSTOMER_EXTRACT)
    return read.select(*[text(n) if n == "dob" else F.col(n) for n in _EXTRACT_NAMES])
