"""Keys, codes, classifications, matching and sinks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomhouse.bindings.registry import query, sql_case, sql_list, stamp, table, text
from loomhouse.bindings.staging import NAMEPLATE_SQL
from loomhouse.functions import labels
from loomhouse.operators.joins import match_people, role_lookup
from loomhouse.operators.keys import (
    assign_dense_ids,
    composite_hash_key,
    composite_key,
    date_key,
    next_dense_start,
)
from loomhouse.operators.audited import Checks, write_audited
from loomhouse.operators.bucketed import BucketedTable, upsert_bucketed
from loomhouse.operators.sinks import conform, save, upsert
from loomhouse.schemas import struct
from loomhouse.session import fresh_folder
from loomhouse.sources.files import batch_number


@query(
    "company_key_normalize",
    """
    SELECT s_suppkey,
           CASE WHEN s_acctbal >= 0 THEN CAST(s_suppkey + 1 AS VARCHAR) END AS id_text,
           CASE WHEN s_acctbal < 0 THEN s_name END AS name,
           CASE WHEN s_acctbal >= 0 THEN CAST(s_suppkey + 1 AS VARCHAR) ELSE s_name END AS k
    FROM supplier""",
)
def q_company_key(spark, sf):
    """Records that end in a zero-padded number or in a padded name."""
    tail = F.when(
        F.col("s_acctbal") >= 0,
        F.lpad(F.lpad((F.col("s_suppkey") + 1).cast("string"), 10, "0"), 60, " "),
    ).otherwise(F.rpad(F.concat("s_name", F.lit(" ")), 60, " "))
    rows = table(spark, sf, "supplier").withColumn("value", F.concat(F.lit("FIN 1995Q1 "), tail))
    record = F.col("value")
    return rows.select(
        "s_suppkey",
        labels.company_id_text(record).alias("id_text"),
        labels.company_name(record).alias("name"),
        labels.company_key(record).alias("k"),
    )


@query(
    "role_playing_lookup",
    """
    SELECT c.n_name AS customer_nation, s.n_name AS supplier_nation, count(*) AS n_lines,
           round(sum(l_extendedprice * (1 - l_discount)), 0) AS revenue
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
         JOIN customer ON o_custkey = c_custkey
         JOIN supplier ON l_suppkey = s_suppkey
         JOIN nation c ON c_nationkey = c.n_nationkey
         JOIN nation s ON s_nationkey = s.n_nationkey
    GROUP BY ALL""",
)
def q_role_playing_lookup(spark, sf):
    """One lookup in two roles, after the lines are summed per pair of codes."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_suppkey",
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("amount"),
    )
    per_pair = lines.groupBy("l_orderkey", "l_suppkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount")
    )
    owned = (
        per_pair.join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("c_nationkey", "s_nationkey")
        .agg(F.sum("n").alias("n_lines"), F.sum("amount").alias("amount"))
    )
    named = role_lookup(
        owned,
        table(spark, sf, "nation"),
        "n_nationkey",
        {"c_nationkey": "customer_", "s_nationkey": "supplier_"},
        ["n_name"],
    )
    return named.select(
        F.col("customer_n_name").alias("customer_nation"),
        F.col("supplier_n_name").alias("supplier_nation"),
        "n_lines",
        F.round("amount", 0).alias("revenue"),
    )


_PEOPLE = """
    WITH c AS (SELECT c_custkey, 'p' || substr(c_name, 10) AS lastname, 'Jo' AS firstname,
                      CASE WHEN c_acctbal < 3000 THEN '' WHEN c_acctbal > 6000 THEN 'Flat b'
                      END AS addressline2 FROM customer),
    s AS (SELECT s_suppkey, 'P' || substr(s_name, 10) AS lastname, 'JO' AS firstname,
                 CASE WHEN s_acctbal < 3000 THEN NULL WHEN s_acctbal > 6000 THEN 'FLAT B'
                      ELSE '' END AS addressline2 FROM supplier)
    SELECT c_custkey, s_suppkey, s_suppkey IS NOT NULL AS iscustomer
    FROM c LEFT JOIN s ON upper(c.lastname) = upper(s.lastname)
         AND upper(c.firstname) = upper(s.firstname)
         AND upper({blank}(c.addressline2, '')) = upper({blank}(s.addressline2, ''))"""


def _people(spark, sf, strict: bool):
    c_bal, s_bal = F.col("c_acctbal"), F.col("s_acctbal")
    left = table(spark, sf, "customer").select(
        "c_custkey",
        F.concat(F.lit("p"), F.substring("c_name", 10, 100)).alias("lastname"),
        F.lit("Jo").alias("firstname"),
        F.when(c_bal < 3000, "").when(c_bal > 6000, "Flat b").alias("addressline2"),
    )
    right = table(spark, sf, "supplier").select(
        "s_suppkey",
        F.concat(F.lit("P"), F.substring("s_name", 10, 100)).alias("lastname"),
        F.lit("JO").alias("firstname"),
        F.when(s_bal < 3000, F.lit(None)).when(s_bal > 6000, "FLAT B").otherwise("").alias(
            "addressline2"
        ),
    )
    matched = match_people(
        left, right, ["lastname", "firstname"], ["addressline2"], strict, ["s_suppkey"]
    )
    return matched.select(
        "c_custkey", "s_suppkey", F.col("s_suppkey").isNotNull().alias("iscustomer")
    )


@query("prospect_match", _PEOPLE.format(blank="coalesce"))
def q_prospect_match(spark, sf):
    return _people(spark, sf, False)


@query("prospect_match_strict", _PEOPLE.format(blank="nullif"))
def q_prospect_match_strict(spark, sf):
    return _people(spark, sf, True)


_UPSERT_SQL = """
    WITH old AS (SELECT c_custkey, c_name, c_acctbal, c_mktsegment, 1 AS recordbatchid,
                        1 AS batchid FROM customer WHERE c_mktsegment <> 'BUILDING'),
    new AS (SELECT c_custkey, lower(c_name) AS c_name, c_acctbal + 50 AS c_acctbal,
                   c_mktsegment, 2 AS recordbatchid, 2 AS batchid
            FROM customer WHERE c_acctbal > 0)
    SELECT coalesce(n.c_custkey, o.c_custkey) AS c_custkey,
           CASE WHEN n.c_custkey IS NOT NULL THEN n.c_name ELSE o.c_name END AS c_name,
           round(CASE WHEN n.c_custkey IS NOT NULL THEN n.c_acctbal ELSE o.c_acctbal END, 2)
               AS c_acctbal,
           coalesce(n.c_mktsegment, o.c_mktsegment) AS c_mktsegment,
           coalesce(n.recordbatchid, o.recordbatchid) AS recordbatchid,
           coalesce(o.batchid, n.batchid) AS batchid
    FROM old o FULL JOIN new n ON o.c_custkey = n.c_custkey"""


def _deliveries(spark, sf) -> tuple[DataFrame, DataFrame]:
    """A first batch of customers, and a second with two deliveries per key."""
    customer = table(spark, sf, "customer").drop("c_nationkey")
    first = customer.where("c_mktsegment <> 'BUILDING'").withColumns(
        {"recordbatchid": F.lit(1), "batchid": F.lit(1)}
    )
    second = (
        customer.where("c_acctbal > 0")
        .withColumns({"recordbatchid": F.lit(2), "batchid": F.lit(2)})
        .withColumn("delivery", F.explode(F.array(F.lit(1), F.lit(2))))
        .withColumn("c_acctbal", F.col("c_acctbal") + 25 * F.col("delivery"))
        .withColumn("c_name", F.lower("c_name"))
    )
    return first, second


@query("prospect_upsert", _UPSERT_SQL)
def q_prospect_upsert(spark, sf):
    """A second batch with two deliveries per key over a first batch."""
    first, second = _deliveries(spark, sf)
    merged = upsert(first, second, ["c_custkey"], ["batchid"], ["delivery"])
    return merged.withColumn("c_acctbal", F.round("c_acctbal", 2))


@query("upsert_bucketed", _UPSERT_SQL)
def q_upsert_bucketed(spark, sf):
    """The same batches applied to a stored table; the second one is sent twice."""
    first, second = _deliveries(spark, sf)
    stored_in = fresh_folder(spark, "prospects")
    empty = BucketedTable.create(spark, stored_in, first.schema, ["c_custkey"], 16)
    loaded = upsert_bucketed(
        empty, "1", first.withColumn("delivery", F.lit(1)), ["batchid"], ["delivery"]
    )
    for _ in range(2):
        loaded = upsert_bucketed(loaded, "2", second, ["batchid"], ["delivery"])
    return loaded.rows().withColumn("c_acctbal", F.round("c_acctbal", 2))


@query(
    "marketing_nameplate",
    f"""
    WITH p AS (SELECT c_custkey, c_acctbal * 150 AS networth, c_nationkey * 10000 AS income,
                      c_custkey % 6 AS numberchildren, c_custkey % 9 AS numbercreditcards,
                      CASE WHEN c_mktsegment = 'BUILDING' THEN NULL
                           ELSE 18 + c_custkey % 60 END AS age,
                      500 + c_custkey % 350 AS creditrating, c_custkey % 5 AS numbercars
               FROM customer)
    SELECT c_custkey, {NAMEPLATE_SQL} AS marketingnameplate FROM p""",
)
def q_marketing_nameplate(spark, sf):
    key = F.col("c_custkey")
    plate = labels.marketing_nameplate(
        networth=F.col("c_acctbal") * 150,
        income=F.col("c_nationkey") * 10000,
        children=key % 6,
        cards=key % 9,
        age=F.when(F.col("c_mktsegment") != "BUILDING", 18 + key % 60),
        rating=500 + key % 350,
        cars=key % 5,
    )
    return table(spark, sf, "customer").select("c_custkey", plate.alias("marketingnameplate"))


_GRADES = labels.HIGH_GRADES + labels.LOW_GRADES


@query(
    "rating_classify",
    f"""
    WITH r AS (SELECT p_partkey,
                      coalesce([{sql_list(_GRADES)}][p_size], 'size ' || p_size) AS rating
               FROM part)
    SELECT p_partkey, CASE WHEN rating IN ({sql_list(_GRADES)}) THEN rating END AS sprating,
           CASE WHEN rating IN ({sql_list(labels.HIGH_GRADES)}) THEN FALSE
                WHEN rating IN ({sql_list(labels.LOW_GRADES)}) THEN TRUE END AS islowgrade
    FROM r""",
)
def q_rating_classify(spark, sf):
    grades = F.array(*[F.lit(g) for g in _GRADES])
    rating = F.coalesce(
        F.get(grades, F.col("p_size") - 1), F.concat(F.lit("size "), F.col("p_size"))
    )
    return (
        table(spark, sf, "part")
        .withColumn("rating", rating)
        .select(
            "p_partkey",
            labels.valid_rating(F.col("rating")).alias("sprating"),
            labels.is_low_grade(F.col("rating")).alias("islowgrade"),
        )
    )


_ORDER_CODES = {"F": "CMPT", "O": "ACTV", "P": "PNDG"}
_ORDER_TYPES = {"1-URGENT": "TMB", "2-HIGH": "TMS", "3-MEDIUM": "TSL", "5-LOW": "TLB"}


@query(
    "code_mapping",
    f"""
    WITH o AS (SELECT o_orderkey, {sql_case("o_orderstatus", _ORDER_CODES)} AS s,
                      {sql_case("o_orderpriority", _ORDER_TYPES)} AS t FROM orders)
    SELECT o_orderkey, {sql_case("s", labels.STATUS_LABELS)} AS status,
           {sql_case("t", labels.TRADE_TYPE_LABELS)} AS type FROM o""",
)
def q_code_mapping(spark, sf):
    status = labels.map_code(F.col("o_orderstatus"), _ORDER_CODES)
    kind = labels.map_code(F.col("o_orderpriority"), _ORDER_TYPES)
    return table(spark, sf, "orders").select(
        "o_orderkey",
        labels.map_code(status, labels.STATUS_LABELS).alias("status"),
        labels.map_code(kind, labels.TRADE_TYPE_LABELS).alias("type"),
    )


_EVENT_STATUS = {
    "purchase": "SBMT", "view": "PNDG", "click": "CMPT", "error": "CNCL", "signup": "ACTV",
}


def opens_sql(status: str, kind: str) -> str:
    """Whether a history row opens a trade: pending, or a submitted market order."""
    return f"({status} = 'PNDG' OR {status} || coalesce({kind}, '') IN ('SBMTTMB', 'SBMTTMS'))"


_OPENS = opens_sql("s", "t")


@query(
    "trade_event_split",
    f"""
    WITH e AS (SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS moment,
                      {sql_case("event_type", _EVENT_STATUS)} AS s,
                      CASE WHEN value < 50 THEN 'TMB' WHEN value < 100 THEN 'TMS'
                           ELSE 'TLB' END AS t FROM events)
    SELECT event_id,
           CASE WHEN {_OPENS} THEN moment WHEN s IN ('CMPT', 'CNCL') THEN NULL END AS created,
           CASE WHEN {_OPENS} THEN NULL WHEN s IN ('CMPT', 'CNCL') THEN moment END AS closed
    FROM e""",
)
def q_trade_event_split(spark, sf):
    status = labels.map_code(F.col("event_type"), _EVENT_STATUS)
    kind = F.when(F.col("value") < 50, "TMB").when(F.col("value") < 100, "TMS").otherwise("TLB")
    at = stamp("ts")
    return table(spark, sf, "events").select(
        "event_id",
        labels.created_at(status, kind, at).alias("created"),
        labels.closed_at(status, kind, at).alias("closed"),
    )


@query(
    "date_key",
    "SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS sk_dateid FROM orders",
)
def q_date_key(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", date_key("o_orderdate").alias("sk_dateid"))


@query(
    "date_composite_key",
    """
    SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') || o_custkey AS BIGINT) AS k2,
           TRY_CAST(strftime(o_orderdate, '%Y%m%d') || o_custkey || o_orderkey || '0000'
                    AS BIGINT) AS k4 FROM orders""",
)
def q_date_composite_key(spark, sf):
    """The longer key overflows for some orders and is null there."""
    return table(spark, sf, "orders").select(
        "o_orderkey",
        composite_key("o_orderdate", "o_custkey").alias("k2"),
        composite_key(
            "o_orderdate", "o_custkey", "o_orderkey", F.lit("0000"), overflow="null"
        ).alias("k4"),
    )


@query(
    "date_hash_key",
    "SELECT count(*) AS n_rows, count(DISTINCT (o_orderdate, o_custkey, o_orderkey)) AS n_keys"
    " FROM orders",
)
def q_date_hash_key(spark, sf):
    """Hash keys of the parts that do not fit a number: as many keys as parts."""
    key = composite_hash_key("o_orderdate", "o_custkey", "o_orderkey")
    return (
        table(spark, sf, "orders")
        .groupBy(key.alias("k"))
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_keys"))
    )


@query(
    "batch_id_from_path",
    """
    SELECT o_orderkey, CAST(regexp_replace('Batch' || o_custkey || '_' || o_orderpriority,
                            '[^0-9]', '', 'g') AS INTEGER) AS batchid FROM orders""",
)
def q_batch_id_from_path(spark, sf):
    folder = F.concat_ws("_", F.concat(F.lit("Batch"), "o_custkey"), "o_orderpriority")
    return table(spark, sf, "orders").select("o_orderkey", batch_number(folder).alias("batchid"))


@query(
    "conform_to_schema",
    """
    SELECT CAST(o_orderkey AS INTEGER) AS tradeid, CAST(o_custkey AS VARCHAR) AS account,
           CAST(CASE WHEN o_orderstatus = 'F' THEN 'Y' ELSE 'N' END AS BOOLEAN) AS iscurrent,
           CAST(substr(o_orderpriority, 1, 1) AS TINYINT) AS rank,
           CAST(CAST(strftime(o_orderdate, '%Y-%m-%d') AS DATE) AS VARCHAR) AS effectivedate,
           CAST(o_totalprice > 100000 AS BOOLEAN) AS cashflag FROM orders""",
)
def q_conform(spark, sf):
    target = struct(
        "tradeid int, account string, iscurrent boolean, rank tinyint, effectivedate date, "
        "cashflag boolean",
        {"tradeid": "Trade identifier"},
    )
    rows = table(spark, sf, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.when(F.col("o_orderstatus") == "F", "Y").otherwise("N").alias("flag"),
        F.substring("o_orderpriority", 1, 1).alias("digit"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        (F.col("o_totalprice") > 100000).cast("tinyint").alias("cash"),
    )
    typed = conform(rows, target)
    return typed.select(
        "tradeid", "account", "iscurrent", "rank", text("effectivedate"), "cashflag"
    )


@query(
    "dense_surrogate_key",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
           row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey,
               l_extendedprice, l_quantity, l_discount, l_tax, l_shipdate) AS sk
    FROM lineitem""",
)
def q_dense_surrogate_key(spark, sf):
    lines = table(spark, sf, "lineitem")
    order = [
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
        "l_discount", "l_tax", "l_shipdate",
    ]
    numbered = assign_dense_ids(lines.select(*order), order, "sk")
    return numbered.select(*order[:5], "sk")


@query(
    "dense_key_append",
    """
    WITH old AS (SELECT max(p_partkey) AS m FROM part)
    SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) + (SELECT m FROM old) + 1 AS sk
    FROM supplier""",
)
def q_dense_key_append(spark, sf):
    """Suppliers numbered behind the highest part key, as an append does."""
    start = next_dense_start(table(spark, sf, "part"), "p_partkey")
    suppliers = table(spark, sf, "supplier").select("s_suppkey")
    return assign_dense_ids(suppliers, ["s_suppkey"], "sk", start)


@query(
    "table_append",
    """
    SELECT o_orderkey AS tradeid, CAST(o_custkey AS VARCHAR) AS account, o_totalprice AS price,
           CASE WHEN o_orderstatus = 'P' THEN 2 ELSE 1 END AS batchid
    FROM orders""",
)
def q_table_append(spark, sf):
    """A table replaced by a first batch of orders, then a second one appended."""
    orders = table(spark, sf, "orders")
    target = struct("tradeid bigint not null, account string, price double, batchid int")
    folder = fresh_folder(spark, "appended")

    def batch(rows, number: int):
        return conform(
            rows.select("o_orderkey", "o_custkey", "o_totalprice", F.lit(number)), target
        )

    save(batch(orders, 0), folder, "overwrite")
    save(batch(orders.where("o_orderstatus <> 'P'"), 1), folder, "overwrite")
    save(batch(orders.where("o_orderstatus = 'P'"), 2), folder)
    return spark.read.schema(target).parquet(folder)


_AUDITED = {
    "orders": (("o_orderkey",), "o_totalprice", 1),
    "customer": (("c_custkey",), "c_acctbal", 1),
    "lineitem": (("l_orderkey", "l_linenumber"), "l_extendedprice", 1_000),
}


@query(
    "load_audit",
    " UNION ALL ".join(
        f"""
    SELECT '{name}' AS table_name, (SELECT count(*) FROM {name})::BIGINT AS "rows",
           (SELECT count(*) FROM {name} WHERE {value} IS NULL)::BIGINT AS nulls,
           (SELECT count(*) FROM {name} WHERE NOT coalesce({value} > 0, false))::BIGINT AS not_positive,
           (SELECT max(n) FROM (SELECT count(*) AS n FROM {name} GROUP BY {", ".join(keys)}))::BIGINT AS most_copies,
           true AS near, (SELECT count(*) FROM {name})::BIGINT AS published"""
        for name, (keys, value, _) in _AUDITED.items()
    ),
)
def q_load_audit(spark, sf):
    """Tables audited while they are written; what was published is counted."""
    folder = fresh_folder(spark, "audited")
    found = []
    for name, (keys, value, copies) in _AUDITED.items():
        checks = Checks(not_null=keys, unique=keys, copies=copies, least_rows=1)
        rows = table(spark, sf, name).withColumn("positive", F.col(value) > 0)
        seen = write_audited(rows.withColumn("positive", F.nullif("positive", F.lit(False))), folder, name, checks)
        near = seen["distinct"] * seen["most_copies"] >= 0.8 * seen["rows"]
        published = spark.read.parquet(f"{folder}/{name}").agg(F.count(F.lit(1)).alias("published"))
        found.append(
            published.select(
                F.lit(name).alias("table_name"), F.lit(seen["rows"]).cast("long").alias("rows"),
                F.lit(seen[f"null_{value}"]).cast("long").alias("nulls"),
                F.lit(seen["null_positive"]).cast("long").alias("not_positive"),
                F.lit(seen["most_copies"]).cast("long").alias("most_copies"),
                F.lit(near).alias("near"), "published",
            )
        )
    return reduce(DataFrame.unionByName, found)
