"""Schemas of the warehouse, staging and source tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Column names and types of each table.
WAREHOUSE = {
    "BatchDate": "batchdate date not null, batchid int",
    "DimAccount": """
        sk_accountid bigint not null, accountid bigint, sk_brokerid bigint, sk_customerid bigint,
        accountdesc string, taxstatus tinyint, status string, iscurrent boolean, batchid int,
        effectivedate date, enddate date""",
    "DimBroker": """
        sk_brokerid bigint not null, brokerid bigint, managerid bigint, firstname string,
        lastname string, middleinitial string, branch string, office string, phone string,
        iscurrent boolean, batchid int, effectivedate date, enddate date""",
    "DimCompany": """
        sk_companyid bigint not null, companyid bigint, status string, name string, industry string,
        sprating string, islowgrade boolean, ceo string, addressline1 string,
        addressline2 string, postalcode string, city string, stateprov string, country string,
        description string, foundingdate date, iscurrent boolean, batchid int,
        effectivedate date, enddate date""",
    "DimCustomer": """
        sk_customerid bigint not null, customerid bigint, taxid string, status string, lastname string,
        firstname string, middleinitial string, gender string, tier tinyint, dob date,
        addressline1 string, addressline2 string, postalcode string, city string,
        stateprov string, country string, phone1 string, phone2 string, phone3 string,
        email1 string, email2 string, nationaltaxratedesc string, nationaltaxrate float,
        localtaxratedesc string, localtaxrate float, agencyid string, creditrating int,
        networth int, marketingnameplate string, iscurrent boolean, batchid int,
        effectivedate date, enddate date""",
    "DimDate": """
        sk_dateid bigint not null, datevalue date, datedesc string, calendaryearid int,
        calendaryeardesc string, calendarqtrid int, calendarqtrdesc string,
        calendarmonthid int, calendarmonthdesc string, calendarweekid int,
        calendarweekdesc string, dayofweeknum int, dayofweekdesc string, fiscalyearid int,
        fiscalyeardesc string, fiscalqtrid int, fiscalqtrdesc string, holidayflag boolean""",
    "DimSecurity": """
        sk_securityid bigint not null, symbol string, issue string, status string, name string,
        exchangeid string, sk_companyid bigint, sharesoutstanding bigint, firsttrade date,
        firsttradeonexchange date, dividend double, iscurrent boolean, batchid int,
        effectivedate date, enddate date""",
    "DimTime": """
        sk_timeid bigint not null, timevalue string, hourid int, hourdesc string, minuteid int,
        minutedesc string, secondid int, seconddesc string, markethoursflag boolean,
        officehoursflag boolean""",
    "DimTrade": """
        tradeid int not null, sk_brokerid bigint, sk_createdateid bigint, sk_createtimeid bigint,
        sk_closedateid bigint, sk_closetimeid bigint, status string, type string,
        cashflag boolean, sk_securityid bigint, sk_companyid bigint, quantity int,
        bidprice double, sk_customerid bigint, sk_accountid bigint, executedby string,
        tradeprice double, fee double, commission double, tax double, batchid int""",
    "FactCashBalances": """
        sk_customerid bigint not null, sk_accountid bigint not null, sk_dateid bigint not null, cash double,
        batchid int""",
    "FactHoldings": """
        tradeid int, currenttradeid int not null, sk_customerid bigint, sk_accountid bigint,
        sk_securityid bigint, sk_companyid bigint, sk_dateid bigint, sk_timeid bigint,
        currentprice double, currentholding int, batchid int""",
    "FactMarketHistory": """
        sk_securityid bigint not null, sk_companyid bigint, sk_dateid bigint not null, peratio double,
        yield double, fiftytwoweekhigh double, sk_fiftytwoweekhighdate bigint,
        fiftytwoweeklow double, sk_fiftytwoweeklowdate bigint, closeprice double,
        dayhigh double, daylow double, volume int, batchid int""",
    "FactWatches": """
        sk_customerid bigint not null, sk_securityid bigint not null, sk_dateid_dateplaced bigint,
        sk_dateid_dateremoved bigint, batchid int""",
    "Financial": """
        sk_companyid bigint not null, fi_year int not null, fi_qtr int not null, fi_qtr_start_date date,
        fi_revenue double, fi_net_earn double, fi_basic_eps double, fi_dilut_eps double,
        fi_margin double, fi_inventory double, fi_assets double, fi_liability double,
        fi_out_basic bigint, fi_out_dilut bigint""",
    "Prospect": """
        agencyid string not null, sk_recorddateid bigint, sk_updatedateid bigint, batchid int,
        iscustomer boolean, lastname string, firstname string, middleinitial string,
        gender string, addressline1 string, addressline2 string, postalcode string,
        city string, state string, country string, phone string, income string,
        numbercars int, numberchildren int, maritalstatus string, age int, creditrating int,
        ownorrentflag string, employer string, numbercreditcards int, networth int,
        marketingnameplate string""",
    "StatusType": "st_id string, st_name string not null",
    "TaxRate": "tx_id string not null, tx_name string, tx_rate float",
    "TradeType": "tt_id string not null, tt_name string, tt_is_sell int, tt_is_mrkt int",
    "industry": "in_id string, in_name string not null, in_sc_id string",
}

# Columns of the header-less source files.
PROSPECT_FILE = """
    agencyid string, lastname string, firstname string, middleinitial string, gender string,
    addressline1 string, addressline2 string, postalcode string, city string, state string,
    country string, phone string, income int, numbercars int, numberchildren int,
    maritalstatus string, age int, creditrating int, ownorrentflag string, employer string,
    numbercreditcards int, networth int"""
HR_FILE = """
    employeeid bigint, managerid bigint, employeefirstname string, employeelastname string,
    employeemi string, employeejobcode string, employeebranch string, employeeoffice string,
    employeephone string"""
TRADE_FILE = """
    tradeid bigint, t_dts timestamp_ntz, status string, t_tt_id string, cashflag tinyint,
    t_s_symb string, quantity int, bidprice double, t_ca_id bigint, executedby string,
    tradeprice double, fee double, commission double, tax double"""
TRADE_HISTORY_FILE = "tradeid bigint, th_dts timestamp_ntz, status string"
CASH_FILE = "accountid bigint, ct_dts timestamp_ntz, ct_amt double, ct_name string"
HOLDING_FILE = "hh_h_t_id int, hh_t_id int, hh_before_qty int, hh_after_qty int"
WATCH_FILE = "w_c_id bigint, w_s_symb string, w_dts timestamp_ntz, w_action string"
CUSTOMER_EXTRACT = """
    cdc_flag string, cdc_dsn bigint, customerid bigint, taxid string, status string,
    lastname string, firstname string, middleinitial string, gender string, tier tinyint,
    dob date, addressline1 string, addressline2 string, postalcode string, city string,
    stateprov string, country string,
    c_ctry_n1 string, c_area_n1 string, c_local_n1 string, c_ext_n1 string,
    c_ctry_n2 string, c_area_n2 string, c_local_n2 string, c_ext_n2 string,
    c_ctry_n3 string, c_area_n3 string, c_local_n3 string, c_ext_n3 string,
    email1 string, email2 string, lcl_tx_id string, nat_tx_id string"""

STAGING = {
    "FinWire": "rectype string, recdate date, value string",
    "ProspectIncremental": PROSPECT_FILE.replace("income int", "income string")
    + ", marketingnameplate string, recordbatchid int, batchid int",
}


def struct(ddl: str, comments: dict[str, str] | None = None) -> T.StructType:
    """A schema from its DDL, with column comments as field metadata."""
    parsed = T.StructType.fromDDL(ddl)
    notes = comments or {}
    return T.StructType(
        [
            T.StructField(
                f.name,
                f.dataType,
                f.nullable,
                {"comment": notes[f.name]} if f.name in notes else {},
            )
            for f in parsed
        ]
    )


def comments_by_table(comments: DataFrame) -> dict[str, dict[str, str]]:
    """Comment rows (one per warehouse column) as a nested dictionary."""
    out: dict[str, dict[str, str]] = {}
    for r in comments.collect():
        out.setdefault(r["table_full_name"], {})[r["column"]] = r["comment"]
    return out
