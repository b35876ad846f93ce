"""Versions, interval joins, balances and watches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomhouse.bindings.registry import query, stored, table, text
from loomhouse.operators.aggregates import (
    daily_total,
    row_audit,
    running_total,
    watch_periods,
)
from loomhouse.operators.history import History, apply_changes, current_versions
from loomhouse.operators.intervals import overlap_join, point_lookup
from loomhouse.operators.joins import either_key_lookup, expand_names
from loomhouse.operators.versions import scd2_build
from loomhouse.session import fresh_folder, materialize


def span() -> list:
    return [text("effectivedate"), text("enddate")]


# Versions of one event type per user, as used on both sides of interval joins.
_VERSIONS = """
    SELECT user_id, event_id, value, ts::DATE AS eff,
           coalesce(lead(ts::DATE) OVER (PARTITION BY user_id ORDER BY ts, event_id),
                    DATE '9999-12-31') AS fin
    FROM events WHERE event_type = '{kind}'"""


def _sql_versions(name: str, kind: str) -> str:
    return f"{name} AS (SELECT * FROM ({_VERSIONS.format(kind=kind)}) WHERE eff < fin)"


def versions_of(spark, sf, kind: str) -> DataFrame:
    """The versions of one event type, stored like a dimension."""

    def build():
        changes = table(spark, sf, "events").where(F.col("event_type") == kind)
        return scd2_build(
            changes, ["user_id"], "ts", ["event_id"], ["event_id", "value"]
        ).drop("iscurrent")

    return stored(spark, sf, f"versions-{kind}", build)


def _filled(spark, sf, fill: str | None) -> DataFrame:
    """Versions of all events; clicks and errors carry no value."""
    changes = table(spark, sf, "events").withColumn(
        "v", F.when(~F.col("event_type").isin("click", "error"), F.col("value"))
    )
    return scd2_build(
        changes, ["user_id"], "ts", ["event_id"], ["event_type", "v"], fill=fill, filled=["v"]
    ).select("user_id", "event_type", "v", *span(), "iscurrent")


def _filled_sql(value: str) -> str:
    return f"""
    WITH e AS (SELECT *, CASE WHEN event_type NOT IN ('click', 'error') THEN value END AS v0
               FROM events),
    h AS (SELECT user_id, event_type, {value} AS v, ts::DATE AS eff,
                 coalesce(lead(ts::DATE) OVER w, DATE '9999-12-31') AS fin,
                 lead(ts) OVER w IS NULL AS iscurrent
          FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    SELECT user_id, event_type, v, CAST(eff AS VARCHAR) AS effectivedate,
           CAST(fin AS VARCHAR) AS enddate, iscurrent
    FROM h WHERE eff < fin"""


@query(
    "scd2_build",
    """
    WITH h AS (SELECT user_id, event_type, value, ts::DATE AS eff,
                      coalesce(lead(ts::DATE) OVER w, DATE '9999-12-31') AS fin,
                      lead(ts) OVER w IS NULL AS iscurrent
               FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    SELECT user_id, event_type, value, CAST(eff AS VARCHAR) AS effectivedate,
           CAST(fin AS VARCHAR) AS enddate, iscurrent
    FROM h WHERE eff < fin""",
)
def q_scd2_build(spark, sf):
    return scd2_build(
        table(spark, sf, "events"), ["user_id"], "ts", ["event_id"], ["event_type", "value"]
    ).select("user_id", "event_type", "value", *span(), "iscurrent")


@query("account_versions", _filled_sql("coalesce(v0, last_value(v0) OVER w)"))
def q_account_versions(spark, sf):
    return _filled(spark, sf, None)


@query("attr_backfill_first", _filled_sql("coalesce(v0, first_value(v0) OVER w)"))
def q_backfill_first(spark, sf):
    return _filled(spark, sf, "first")


@query("attr_fill_forward", _filled_sql("coalesce(v0, last_value(v0 IGNORE NULLS) OVER w)"))
def q_fill_forward(spark, sf):
    return _filled(spark, sf, "forward")


@query("scd2_apply_batch", _filled_sql("coalesce(v0, last_value(v0 IGNORE NULLS) OVER w)"))
def q_apply_batch(spark, sf):
    """A first load up to the middle of the events, then a batch with the rest.

    Errors of the first half arrive with the second batch, so it holds late changes.
    """
    changes = table(spark, sf, "events").withColumn(
        "v", F.when(~F.col("event_type").isin("click", "error"), F.col("value"))
    )
    day = F.unix_date(F.to_date("ts"))
    middle = changes.agg(((F.min(day) + F.max(day)) / 2).alias("m")).scalar()
    first = (day < middle) & (F.col("event_type") != "error")
    how = History(["user_id"], "ts", ["event_id"], ["event_type", "v"], "forward", ["v"])
    folder = fresh_folder(spark, "versioned")
    apply_changes(spark, folder, how, "1", changes.where(first), buckets=16)
    done = apply_changes(spark, folder, how, "2", changes.where(~first))
    return current_versions(done, how).select("user_id", "event_type", "v", *span(), "iscurrent")


@query(
    "scd2_point_lookup",
    f"""
    WITH {_sql_versions("d", "purchase")}
    SELECT e.event_id, e.user_id, d.event_id AS purchase_id, d.value AS purchase_value,
           CAST(d.eff AS VARCHAR) AS effectivedate, CAST(d.fin AS VARCHAR) AS enddate
    FROM events e JOIN d ON e.user_id = d.user_id
         AND e.ts::DATE >= d.eff AND e.ts::DATE < d.fin
    WHERE e.event_type <> 'purchase'""",
)
def q_point_lookup(spark, sf):
    facts = table(spark, sf, "events").where("event_type <> 'purchase'")
    dim = versions_of(spark, sf, "purchase").withColumnsRenamed(
        {"event_id": "purchase_id", "value": "purchase_value"}
    )
    found = point_lookup(
        facts.select("event_id", "user_id", F.to_date("ts").alias("day")),
        dim,
        ["user_id"],
        "day",
        keep_interval=True,
    )
    return found.select("event_id", "user_id", "purchase_id", "purchase_value", *span())


@query(
    "account_customer_overlap",
    f"""
    WITH {_sql_versions("a", "click")}, {_sql_versions("c", "signup")}
    SELECT a.user_id, a.event_id AS account_id, c.event_id AS customer_id,
           CAST(CASE WHEN a.eff < c.eff THEN c.eff ELSE a.eff END AS VARCHAR) AS effectivedate,
           CAST(CASE WHEN a.fin > c.fin THEN c.fin ELSE a.fin END AS VARCHAR) AS enddate
    FROM a FULL OUTER JOIN c ON a.user_id = c.user_id AND c.fin > a.eff AND c.eff < a.fin
    WHERE a.eff < a.fin""",
)
def q_account_customer_overlap(spark, sf):
    accounts = versions_of(spark, sf, "click").drop("value")
    customers = versions_of(spark, sf, "signup").drop("value")
    cut = overlap_join(
        accounts.withColumnRenamed("event_id", "account_id"),
        customers.withColumnRenamed("event_id", "customer_id"),
        ["user_id"],
        how="left",
        slice_days=31,
    )
    return cut.select("user_id", "account_id", "customer_id", *span())


@query(
    "security_company_overlap",
    f"""
    WITH {_sql_versions("v", "view")}, {_sql_versions("p", "purchase")},
    s AS (SELECT event_id AS security_id, eff, fin,
                 CASE WHEN user_id % 2 = 0 THEN CAST(user_id AS VARCHAR)
                      ELSE 'user ' || user_id END AS k FROM v),
    c AS (SELECT event_id AS company_id, eff, fin, 'user ' || user_id AS k FROM p
          UNION ALL
          SELECT event_id, eff, fin, CAST(user_id AS VARCHAR) FROM p),
    j AS (SELECT s.k, security_id, company_id,
                 CASE WHEN s.eff < c.eff THEN c.eff ELSE s.eff END AS eff,
                 CASE WHEN s.fin > c.fin THEN c.fin ELSE s.fin END AS fin
          FROM s JOIN c ON s.k = c.k AND s.eff < c.fin AND s.fin > c.eff)
    SELECT k, security_id, company_id, CAST(eff AS VARCHAR) AS effectivedate,
           CAST(fin AS VARCHAR) AS enddate
    FROM j WHERE eff < fin""",
)
def q_security_company_overlap(spark, sf):
    by_name = F.concat(F.lit("user "), F.col("user_id"))
    securities = versions_of(spark, sf, "view").select(
        F.col("event_id").alias("security_id"),
        F.when(F.col("user_id") % 2 == 0, F.col("user_id").cast("string"))
        .otherwise(by_name)
        .alias("k"),
        "effectivedate",
        "enddate",
    )
    companies = versions_of(spark, sf, "purchase").select(
        F.col("event_id").alias("company_id"),
        "user_id",
        by_name.alias("name"),
        "effectivedate",
        "enddate",
    )
    cut = overlap_join(
        securities, expand_names(companies, "user_id", "name", "k"), ["k"], slice_days=31
    )
    return cut.select("k", "security_id", "company_id", *span())


@query(
    "financial_either_key",
    """
    WITH f AS (SELECT o_orderkey, o_orderdate::DATE AS d,
                      CASE WHEN o_custkey % 2 = 0 THEN CAST(o_custkey AS VARCHAR) END AS idt,
                      CASE WHEN o_custkey % 2 <> 0 THEN c_name END AS nm
               FROM orders JOIN customer ON o_custkey = c_custkey),
    d AS (SELECT c_custkey, c_name, DATE '1995-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS eff,
                 DATE '1999-01-01' + CAST(c_nationkey * 30 AS INTEGER) AS fin FROM customer)
    SELECT f.o_orderkey, d.c_custkey AS company_id
    FROM f JOIN d ON f.d >= d.eff AND f.d < d.fin
         AND ((f.idt IS NOT NULL AND f.idt = CAST(d.c_custkey AS VARCHAR))
              OR (f.nm IS NOT NULL AND f.nm = d.c_name))""",
)
def q_financial_either_key(spark, sf):
    customer = table(spark, sf, "customer")
    orders = table(spark, sf, "orders")
    even = F.col("o_custkey") % 2 == 0
    facts = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey",
        F.to_date("o_orderdate").alias("day"),
        F.when(even, F.col("o_custkey").cast("string")).alias("id_text"),
        F.when(~even, F.col("c_name")).alias("nm"),
    )
    dim = customer.select(
        "c_custkey",
        "c_name",
        F.date_add(F.lit("1995-01-01").cast("date"), (F.col("c_custkey") % 1000).cast("int")).alias(
            "effectivedate"
        ),
        F.date_add(F.lit("1999-01-01").cast("date"), F.col("c_nationkey") * 30).alias("enddate"),
    )
    return either_key_lookup(
        facts, dim, "id_text", "nm", "c_custkey", "c_name", "day"
    ).select("o_orderkey", F.col("c_custkey").alias("company_id"))


@query(
    "daily_cash_total",
    """
    SELECT user_id, CAST(ts::DATE AS VARCHAR) AS datevalue, round(sum(value), 2) AS total
    FROM events GROUP BY ALL""",
)
def q_daily_cash_total(spark, sf):
    daily = daily_total(table(spark, sf, "events"), ["user_id"], "ts", "value", "total")
    return daily.select("user_id", text("datevalue"), F.round("total", 2).alias("total"))


@query(
    "cash_running_balance",
    f"""
    WITH {_sql_versions("d", "purchase")},
    t AS (SELECT user_id, ts::DATE AS datevalue, sum(value) AS total FROM events GROUP BY ALL)
    SELECT t.user_id, d.event_id AS account_version,
           CAST(strftime(t.datevalue, '%Y%m%d') AS BIGINT) AS sk_dateid,
           round(sum(total) OVER (PARTITION BY t.user_id ORDER BY t.datevalue), 2) AS cash
    FROM t JOIN d ON t.user_id = d.user_id AND t.datevalue >= d.eff AND t.datevalue < d.fin""",
)
def q_cash_running_balance(spark, sf):
    """Daily totals, the account version of the day, and the running balance."""
    cash = table(spark, sf, "events")
    daily = materialize(daily_total(cash, ["user_id"], "ts", "value", "total"), "daily-cash")
    owned = point_lookup(
        daily,
        versions_of(spark, sf, "purchase").drop("value"),
        ["user_id"],
        "datevalue",
    )
    return owned.select(
        "user_id",
        F.col("event_id").alias("account_version"),
        F.date_format("datevalue", "yyyyMMdd").cast("long").alias("sk_dateid"),
        F.round(running_total(["user_id"], "datevalue", "total"), 2).alias("cash"),
    )


_WATCH = """
    SELECT user_id, CAST({placed} AS VARCHAR) AS dateplaced,
           CAST({removed} AS VARCHAR) AS dateremoved
    FROM events GROUP BY {by}"""


@query(
    "watch_events",
    _WATCH.format(
        placed="min(ts)::DATE",
        removed="(CASE WHEN event_type = 'error' THEN ts END)::DATE",
        by="user_id, (CASE WHEN event_type = 'error' THEN ts END)::DATE",
    ),
)
def q_watch_events(spark, sf):
    events = table(spark, sf, "events")
    periods = watch_periods(events, ["user_id"], "ts", "event_type", "error")
    return periods.select("user_id", text("dateplaced"), text("dateremoved"))


@query(
    "watch_periods_paired",
    _WATCH.format(
        placed="(min(ts) FILTER (WHERE event_type <> 'error'))::DATE",
        removed="(max(ts) FILTER (WHERE event_type = 'error'))::DATE",
        by="user_id",
    ),
)
def q_watch_periods_paired(spark, sf):
    events = table(spark, sf, "events")
    periods = watch_periods(events, ["user_id"], "ts", "event_type", "error", paired=True)
    return periods.select("user_id", text("dateplaced"), text("dateremoved"))


TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


@query(
    "table_row_audit",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in TABLES
    ),
)
def q_table_row_audit(spark, sf):
    return row_audit({t: table(spark, sf, t) for t in TABLES})
