"""Code mappings, classifications and formatted labels."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Status codes.
STATUS_LABELS = {
    "ACTV": "Active",
    "CMPT": "Completed",
    "CNCL": "Canceled",
    "PNDG": "Pending",
    "SBMT": "Submitted",
    "INAC": "Inactive",
}
# Trade type codes.
TRADE_TYPE_LABELS = {
    "TMB": "Market Buy",
    "TMS": "Market Sell",
    "TSL": "Stop Loss",
    "TLS": "Limit Sell",
    "TLB": "Limit Buy",
}
# Credit ratings, best first.
HIGH_GRADES = ["AAA", "AA+", "AA", "AA-", "A+", "A", "A-", "BBB+", "BBB", "BBB-"]
LOW_GRADES = [
    "BB+", "BB", "BB-", "B+", "B", "B-", "CCC+", "CCC", "CCC-", "CC", "C", "D",
]
# Marketing tags, each with the thresholds of which any (all) must hold.
NAMEPLATE_RULES = {
    "HighValue": ("OR", [("networth", ">", 1000000), ("income", ">", 200000)]),
    "Expenses": ("OR", [("numberchildren", ">", 3), ("numbercreditcards", ">", 5)]),
    "Boomer": ("OR", [("age", ">", 45)]),
    "MoneyAlert": (
        "OR",
        [("income", "<", 50000), ("creditrating", "<", 600), ("networth", "<", 100000)],
    ),
    "Spender": ("OR", [("numbercars", ">", 3), ("numbercreditcards", ">", 7)]),
    "Inherited": ("AND", [("age", "<", 25), ("networth", ">", 1000000)]),
}
_SIGNS = {">": operator.gt, "<": operator.lt, "OR": operator.or_, "AND": operator.and_}
# Customer actions by resulting status.
ACTIVE_ACTIONS = ["NEW", "ADDACCT", "UPDACCT", "UPDCUST"]
INACTIVE_ACTIONS = ["CLOSEACCT", "INACT"]


def map_code(code: Column, labels: dict[str, str]) -> Column:
    """Label of a code; null for unknown codes."""
    out = F
    for key, label in labels.items():
        out = out.when(code == key, F.lit(label))
    return out


def valid_rating(rating: Column) -> Column:
    """The rating itself when it is on the scale, else null."""
    return F.when(rating.isin(HIGH_GRADES + LOW_GRADES), rating)


def is_low_grade(rating: Column) -> Column:
    """False for investment grade, true below it, null off the scale."""
    return F.when(rating.isin(HIGH_GRADES), F.lit(False)).when(
        rating.isin(LOW_GRADES), F.lit(True)
    )


def action_status(action: Column) -> Column:
    return F.when(action.isin(ACTIVE_ACTIONS), F.lit("Active")).when(
        action.isin(INACTIVE_ACTIONS), F.lit("Inactive")
    )


def gender_or_unknown(gender: Column) -> Column:
    return F.when(gender.isin("M", "F"), gender).otherwise(F.lit("U"))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def _present(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def phone(country: Column, area: Column, local: Column, ext: Column) -> Column:
    """``+CC (AREA) LOCALEXT`` with optional parts; null without local part."""
    return F.when(
        _present(local),
        F.concat(
            F.when(_present(country), F.concat(F.lit("+"), country, F.lit(" "))).otherwise(""),
            F.when(_present(area), F.concat(F.lit("("), area, F.lit(") "))).otherwise(""),
            local,
            F.coalesce(ext, F.lit("")),
        ),
    )


def tag_list(rules: dict[str, Column]) -> Column:
    """Names of the rules that hold, joined with ``+``; null when none does."""
    tags = [F.when(rule, F.lit(tag)) for tag, rule in rules.items()]
    return F.nullif(F.concat_ws("+", *tags), F.lit(""))


def marketing_nameplate(
    networth: Column,
    income: Column,
    children: Column,
    cards: Column,
    age: Column,
    rating: Column,
    cars: Column,
) -> Column:
    """Marketing tags of a prospect, by ``NAMEPLATE_RULES``."""
    values = {
        "networth": networth, "income": income, "numberchildren": children,
        "numbercreditcards": cards, "age": age, "creditrating": rating, "numbercars": cars,
    }
    return tag_list(
        {
            tag: reduce(_SIGNS[how], [_SIGNS[sign](values[f], limit) for f, sign, limit in tests])
            for tag, (how, tests) in NAMEPLATE_RULES.items()
        }
    )


def _tail_is_number(record: Column) -> Column:
    return F.substring(record, -10, 10).rlike("^[0-9]+$")


def company_id_text(record: Column) -> Column:
    """Company number at the end of a record without leading zeros, else null."""
    return F.when(
        _tail_is_number(record), F.regexp_replace(F.substring(record, -10, 10), "^0+", "")
    )


def company_name(record: Column) -> Column:
    """Company name in the last 60 characters when no number is there."""
    return F.when(~_tail_is_number(record), F.trim(F.substring(record, -60, 60)))


def company_key(record: Column) -> Column:
    """Number (without leading zeros) or name, as one text key."""
    return F.coalesce(company_id_text(record), company_name(record))


def created_at(status: Column, trade_type: Column, at: Column) -> Column:
    """Time of a history row that opens a trade."""
    return F.when(_opens(status, trade_type), at)


def closed_at(status: Column, trade_type: Column, at: Column) -> Column:
    """Time of a history row that completes or cancels a trade."""
    closes = status.isin("CMPT", "CNCL")
    return F.when(closes & ~F.coalesce(_opens(status, trade_type), F.lit(False)), at)


def _opens(status: Column, trade_type: Column) -> Column:
    return ((status == "SBMT") & trade_type.isin("TMB", "TMS")) | (status == "PNDG")
