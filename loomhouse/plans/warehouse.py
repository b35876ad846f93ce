"""Builders of the warehouse tables: DataFrames in, one target table out.

Each result is positional; ``loomhouse.operators.sinks.conform`` casts it to
the schema in ``loomhouse.schemas.WAREHOUSE`` before it is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomhouse.functions import fixed_width as fw
from loomhouse.functions import labels
from loomhouse.operators.aggregates import daily_total, running_total, watch_periods
from loomhouse.operators.intervals import overlap_join, point_lookup
from loomhouse.operators.joins import either_key_lookup, expand_names, match_people, role_lookup
from loomhouse.operators.keys import (
    assign_dense_ids,
    composite_hash_key,
    composite_key,
    date_key,
    next_dense_start,
)
from loomhouse.operators.sinks import conform
from loomhouse.operators.skew import salted_join
from loomhouse.operators.versions import OPEN_END, scd2_build
from loomhouse.schemas import STAGING, WAREHOUSE, struct
from loomhouse.session import materialize


def conform_to(df: DataFrame, table: str, enforce: bool = True) -> DataFrame:
    """Positional conform to a warehouse table; source names need not be unique."""
    positional = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return conform(positional, struct(WAREHOUSE[table]), enforce=enforce)


def stage_customers(flat: DataFrame) -> DataFrame:
    """Typed customer actions from the flattened action log."""
    text = labels.blank_to_null

    def number(c: str, kind: str):
        return F.col(c).try_cast(kind)

    def phone(suffix: str):
        names = ("C_CTRY_CODE", "C_AREA_CODE", "C_LOCAL", "C_EXT")
        return labels.phone(*[F.col(n + suffix) for n in names])

    return flat.select(
        number("C_ID", "bigint").alias("customerid"),
        number("CA_ID", "bigint").alias("accountid"),
        number("CA_B_ID", "bigint").alias("brokerid"),
        text(F.col("C_TAX_ID")).alias("taxid"),
        text(F.col("CA_NAME")).alias("accountdesc"),
        number("CA_TAX_ST", "tinyint").alias("taxstatus"),
        labels.action_status(F.col("ActionType")).alias("status"),
        text(F.col("C_L_NAME")).alias("lastname"),
        text(F.col("C_F_NAME")).alias("firstname"),
        text(F.col("C_M_NAME")).alias("middleinitial"),
        text(F.upper("C_GNDR")).alias("gender"),
        number("C_TIER", "tinyint").alias("tier"),
        number("C_DOB", "date").alias("dob"),
        text(F.col("C_ADLINE1")).alias("addressline1"),
        text(F.col("C_ADLINE2")).alias("addressline2"),
        text(F.col("C_ZIPCODE")).alias("postalcode"),
        text(F.col("C_CITY")).alias("city"),
        text(F.col("C_STATE_PROV")).alias("stateprov"),
        text(F.col("C_CTRY")).alias("country"),
        phone("").alias("phone1"),
        phone("_1").alias("phone2"),
        phone("_2").alias("phone3"),
        text(F.col("C_PRIM_EMAIL")).alias("email1"),
        text(F.col("C_ALT_EMAIL")).alias("email2"),
        text(F.col("C_LCL_TX_ID")).alias("lcl_tx_id"),
        text(F.col("C_NAT_TX_ID")).alias("nat_tx_id"),
        number("ActionTS", "timestamp_ntz").alias("update_ts"),
        F.col("ActionType").alias("actiontype"),
    )


def stage_prospects(prospects: DataFrame, batch: int) -> DataFrame:
    """Prospect file rows with marketing tags and batch numbers."""
    names = (
        "networth", "income", "numberchildren", "numbercreditcards", "age", "creditrating",
        "numbercars",
    )
    tagged = prospects.withColumn(
        "marketingnameplate", labels.marketing_nameplate(*[F.col(n) for n in names])
    ).withColumns({"recordbatchid": F.lit(batch), "batchid": F.lit(batch)})
    return conform(tagged, struct(STAGING["ProspectIncremental"]), by_name=True)


def build_broker(hr: DataFrame, dates: DataFrame, batch: int = 1) -> DataFrame:
    """Employees with the broker job code (a fixed value), valid from the first date."""
    first_day = dates.agg(F.min("datevalue")).scalar()
    out = hr.where(F.col("employeejobcode") == "314").select(
        F.col("employeeid").alias("sk_brokerid"),
        F.col("employeeid").alias("brokerid"),
        "managerid",
        "employeefirstname",
        "employeelastname",
        "employeemi",
        "employeebranch",
        "employeeoffice",
        "employeephone",
        F.lit(True),
        F.lit(batch),
        first_day,
        F.lit(OPEN_END).cast("date"),
    )
    return conform_to(out, "DimBroker")


def build_company(
    wire: DataFrame, industry: DataFrame, batch: int = 1, founding_as_loaded: bool = False
) -> DataFrame:
    """Company versions from ``CMP`` records.

    Records of unknown industries are dropped before versions are formed. The
    founding date is read as yyyyMMdd; ``founding_as_loaded`` gives the null
    the warehouse load produces.
    """
    decoded = fw.decode(wire.where("rectype = 'CMP'"), "value", fw.COMPANY, ["recdate"])
    named = role_lookup(
        decoded, industry.withColumnRenamed("in_id", "industryid"), "industryid",
        {"industryid": ""}, ["in_name"],
    )
    founded = F.lit(None).cast("date") if founding_as_loaded else F.col("foundingdate")
    rows = named.select(
        F.col("cik").cast("bigint").alias("companyid"),
        "recdate",
        labels.map_code(F.col("status"), labels.STATUS_LABELS).alias("status"),
        F.col("companyname").alias("name"),
        F.col("in_name").alias("industry"),
        labels.valid_rating(F.col("sprating")).alias("sprating"),
        labels.is_low_grade(F.col("sprating")).alias("islowgrade"),
        F.col("ceoname").alias("ceo"),
        F.col("addrline1").alias("addressline1"),
        F.col("addrline2").alias("addressline2"),
        "postalcode",
        "city",
        F.col("stateprovince").alias("stateprov"),
        "country",
        "description",
        founded.alias("foundingdate"),
    )
    attrs = [c for c in rows.columns if c not in ("companyid", "recdate")]
    versions = scd2_build(rows, ["companyid"], "recdate", attrs, attrs)
    out = versions.select(
        composite_key("effectivedate", "companyid"),
        "companyid",
        *attrs,
        "iscurrent",
        F.lit(batch),
        "effectivedate",
        "enddate",
    )
    return conform_to(out, "DimCompany")


def build_customer(
    actions: DataFrame,
    tax_rates: DataFrame,
    prospects: DataFrame,
    existing: DataFrame | None = None,
    batch: int = 1,
    fill: str = "first",
) -> DataFrame:
    """Customer versions with tax rates and matching prospects.

    Nulls are filled from the key's first version (``fill="first"``, as the
    warehouse loads it) or forward. Customers with an unknown tax id drop out.
    Numbering continues behind ``existing``.
    """
    changes = actions.where(F.col("actiontype").isin("NEW", "INACT", "UPDCUST"))
    names = [
        "taxid", "status", "lastname", "firstname", "middleinitial", "gender", "tier", "dob",
        "addressline1", "addressline2", "postalcode", "city", "stateprov", "country",
        "phone1", "phone2", "phone3", "email1", "email2", "lcl_tx_id", "nat_tx_id",
    ]
    versions = scd2_build(
        changes, ["customerid"], "update_ts", ["actiontype", *names], names,
        fill=fill, filled=[n for n in names if n != "status"],
    )
    taxed = role_lookup(
        versions, tax_rates, "tx_id",
        {"nat_tx_id": "national_", "lcl_tx_id": "local_"}, ["tx_name", "tx_rate"],
    )
    found = match_people(
        materialize(taxed, "customer-versions"), prospects, ["lastname", "firstname", "addressline1", "postalcode"],
        ["addressline2"], True, ["agencyid", "creditrating", "networth", "marketingnameplate"],
    )
    start = 2 if existing is None else next_dense_start(existing, "sk_customerid")
    numbered = assign_dense_ids(
        found, ["customerid", "effectivedate", "agencyid", "marketingnameplate"], "sk", start
    )
    out = numbered.select(
        "sk", "customerid", "taxid", "status", "lastname", "firstname", "middleinitial",
        labels.gender_or_unknown(F.col("gender")), "tier", "dob", "addressline1",
        "addressline2", "postalcode", "city", "stateprov", "country", "phone1", "phone2",
        "phone3", "email1", "email2", "national_tx_name", "national_tx_rate",
        "local_tx_name", "local_tx_rate", "agencyid", "creditrating", "networth",
        "marketingnameplate", "iscurrent", F.lit(batch), "effectivedate", "enddate",
    )
    return conform_to(out, "DimCustomer")


def build_security(wire: DataFrame, companies: DataFrame, batch: int = 1) -> DataFrame:
    """Security versions, cut where the issuing company changes."""
    records = wire.where("rectype = 'SEC'").withColumn("key", labels.company_key(F.col("value")))
    decoded = fw.decode(records, "value", fw.SECURITY, ["recdate", "key"])
    rows = decoded.withColumn(
        "status", labels.map_code(F.col("status"), labels.STATUS_LABELS)
    ).withColumn("key", F.coalesce(F.col("key").try_cast("bigint").cast("string"), "key"))
    attrs = [c for c in rows.columns if c not in ("symbol", "recdate")]
    versions = materialize(
        scd2_build(rows, ["symbol"], "recdate", attrs, attrs).drop("iscurrent"),
        "security-versions",
    )
    issuers = expand_names(
        companies.select("sk_companyid", "companyid", "name", "effectivedate", "enddate"),
        "companyid", "name", "key",
    )
    cut = overlap_join(versions, issuers, ["key"])
    numbered = assign_dense_ids(
        cut, ["symbol", "effectivedate", "sk_companyid"], "sk_securityid"
    )
    out = numbered.select(
        "sk_securityid", "symbol", "issue", "status", "name", "exchangeid", "sk_companyid",
        "sharesoutstanding", "firsttrade", "firsttradeonexchange", "dividend",
        F.col("enddate") == F.lit(OPEN_END).cast("date"), F.lit(batch), "effectivedate",
        "enddate",
    )
    return conform_to(out, "DimSecurity")


def build_account(
    actions: DataFrame,
    customers: DataFrame,
    brokers: DataFrame,
    batch: int = 1,
    fill: str | None = None,
) -> DataFrame:
    """Account versions, cut where the owning customer changes.

    The warehouse load leaves nulls of an account as they are; ``fill="forward"``
    carries the last known value.
    """
    changes = actions.where(~F.col("actiontype").isin("UPDCUST", "INACT"))
    attrs = ["customerid", "accountdesc", "taxstatus", "brokerid", "status"]
    versions = scd2_build(
        changes, ["accountid"], "update_ts", ["actiontype", *attrs], attrs,
        fill=fill, filled=[a for a in attrs if a != "customerid"],
    ).drop("iscurrent")
    owners = customers.select("customerid", "sk_customerid", "effectivedate", "enddate")
    cut = overlap_join(
        materialize(versions, "account-versions"), owners, ["customerid"], how="left"
    )
    managed = salted_join(
        cut, brokers.select("brokerid", "sk_brokerid"), ["brokerid"], profile=changes
    )
    out = managed.select(
        composite_key("effectivedate", "accountid"), "accountid", "sk_brokerid",
        "sk_customerid", "accountdesc", "taxstatus", "status",
        F.col("enddate") == F.lit(OPEN_END).cast("date"), F.lit(batch), "effectivedate",
        "enddate",
    )
    return conform_to(out, "DimAccount")


def build_trade(
    trades: DataFrame,
    history: DataFrame,
    status_types: DataFrame,
    securities: DataFrame,
    accounts: DataFrame,
    batch: int = 1,
    paired: bool = False,
    hashed_keys: bool = False,
) -> DataFrame:
    """Trades with the security and account versions valid when created.

    As loaded, only history rows that open a trade find a version, so closing
    keys stay null; ``paired`` first collects opening and closing time per
    trade. Date keys too long for a number are null, or hashes with
    ``hashed_keys``.
    """
    status, kind, at = F.col("_status"), F.col("t_tt_id"), F.col("th_dts")
    past = history.select("tradeid", "th_dts", F.col("status").alias("_status"))
    named = role_lookup(
        trades, status_types, "st_id", {"status": ""}, ["st_name"]
    )
    events = salted_join(past, named, ["tradeid"]).select(
        *named.columns,
        labels.created_at(status, kind, at).alias("created"),
        labels.closed_at(status, kind, at).alias("closed"),
    )
    if paired:
        events = events.groupBy(*named.columns).agg(
            F.min("created").alias("created"), F.max("closed").alias("closed")
        )
    opened = materialize(
        events.where(F.col("created").isNotNull()).withColumn("day", F.to_date("created")),
        "trade-events",
    )
    with_security = point_lookup(
        opened,
        securities.select(
            F.col("symbol").alias("t_s_symb"), "sk_securityid", "sk_companyid",
            "effectivedate", "enddate",
        ),
        ["t_s_symb"],
        "day",
    )
    placed = point_lookup(
        with_security,
        accounts.select(
            F.col("accountid").alias("t_ca_id"), "sk_brokerid", "sk_customerid",
            "sk_accountid", "effectivedate", "enddate",
        ),
        ["t_ca_id"],
        "day",
        profile=opened,
    )
    make_key = composite_hash_key if hashed_keys else composite_key
    created = make_key("created", "t_ca_id", "sk_brokerid")
    closed = make_key("closed", "t_ca_id", "sk_brokerid")
    if hashed_keys:
        closed = F.when(F.col("closed").isNotNull(), closed)
    out = placed.select(
        "tradeid", "sk_brokerid", created, created, closed, closed, "st_name",
        labels.map_code(kind, labels.TRADE_TYPE_LABELS), "cashflag", "sk_securityid",
        "sk_companyid", "quantity", "bidprice", "sk_customerid", "sk_accountid",
        "executedby", "tradeprice", "fee", "commission", "tax", F.lit(batch),
    )
    return conform_to(out, "DimTrade")


def build_cash_balances(
    cash: DataFrame, accounts: DataFrame, batch: int = 1, enforce: bool = True
) -> DataFrame:
    """Running cash balance per account and day with a transaction.

    An account version without customer breaks the table's NOT NULL and raises
    an error; ``enforce=False`` keeps such rows.
    """
    # written once: the join reads it for the day ranges, the counts and the rows
    daily = materialize(daily_total(cash, ["accountid"], "ct_dts", "ct_amt", "total"), "daily-cash")
    owned = point_lookup(
        daily,
        accounts.select("accountid", "sk_customerid", "sk_accountid", "effectivedate", "enddate"),
        ["accountid"],
        "datevalue",
    )
    out = owned.select(
        "sk_customerid", "sk_accountid", date_key("datevalue"),
        running_total(["accountid"], "datevalue", "total"), F.lit(batch),
    )
    return conform_to(out, "FactCashBalances", enforce)


def build_holdings(holdings: DataFrame, trades: DataFrame, batch: int = 1) -> DataFrame:
    side = trades.select(
        F.col("tradeid").alias("hh_t_id"), "sk_customerid", "sk_accountid", "sk_securityid",
        "sk_companyid", "sk_closedateid", "sk_closetimeid", "tradeprice",
    )
    out = salted_join(holdings, side, ["hh_t_id"]).select(
        "hh_h_t_id", "hh_t_id", "sk_customerid", "sk_accountid", "sk_securityid",
        "sk_companyid", "sk_closedateid", "sk_closetimeid", "tradeprice", "hh_after_qty",
        F.lit(batch),
    )
    return conform_to(out, "FactHoldings")


def build_watches(
    watches: DataFrame,
    securities: DataFrame,
    customers: DataFrame,
    batch: int = 1,
    paired: bool = False,
) -> DataFrame:
    """Watch placements and removals with the versions valid when placed."""
    periods = materialize(
        watch_periods(watches, ["w_c_id", "w_s_symb"], "w_dts", "w_action", "CNCL", paired),
        "watches",
    )
    span = ["effectivedate", "enddate"]
    seen = point_lookup(
        periods,
        securities.select(F.col("symbol").alias("w_s_symb"), "sk_securityid", *span),
        ["w_s_symb"],
        "dateplaced",
    )
    owned = point_lookup(
        seen,
        customers.select(F.col("customerid").alias("w_c_id"), "sk_customerid", *span),
        ["w_c_id"],
        "dateplaced",
        profile=periods,
    )
    out = owned.select(
        "sk_customerid", "sk_securityid", date_key("dateplaced"), date_key("dateremoved"),
        F.lit(batch),
    )
    return conform_to(out, "FactWatches")


def build_financial(wire: DataFrame, companies: DataFrame) -> DataFrame:
    """Quarterly figures with the company version found by number or by name."""
    record = F.col("value")
    records = wire.where(F.col("rectype").isin("FIN_COMPANYID", "FIN_NAME")).select(
        "recdate", "value", labels.company_id_text(record).alias("id_text"),
        labels.company_name(record).alias("conm"),
    )
    decoded = fw.decode(records, "value", fw.FINANCIAL, ["recdate", "id_text", "conm"])
    found = either_key_lookup(
        decoded,
        companies.select("sk_companyid", "companyid", "name", "effectivedate", "enddate"),
        "id_text", "conm", "companyid", "name", "recdate",
    )
    return conform_to(
        found.select("sk_companyid", *[f.name for f in fw.FINANCIAL]), "Financial"
    )


def build_prospect(prospects: DataFrame, batch_dates: DataFrame, customers: DataFrame) -> DataFrame:
    """Prospects with record and update dates and whether they are customers."""
    people = ["lastname", "firstname", "addressline1", "postalcode"]
    current = customers.where("iscurrent").select(
        *people, "addressline2", F.lit(True).alias("iscustomer")
    )
    dated = role_lookup(
        prospects, batch_dates.withColumnRenamed("batchid", "_batch"), "_batch",
        {"recordbatchid": "record_", "batchid": "update_"}, ["batchdate"],
    )
    matched = match_people(dated, current, people, ["addressline2"], False, ["iscustomer"])
    rest = struct(WAREHOUSE["Prospect"]).names[5:]
    out = matched.select(
        "agencyid", date_key("record_batchdate"), date_key("update_batchdate"), "batchid",
        F.coalesce("iscustomer", F.lit(False)), *rest,
    )
    return conform_to(out, "Prospect")
