"""Binding of the TPC-H-style test tables to the opportunity data model.

Opportunity = order. The order's first line item (smallest
``(l_linenumber, l_suppkey, l_partkey)``; line numbers repeat, so the whole
triple is the tie-break) names the sales agent (its supplier) and the product
(its part's brand). Customers are accounts; a supplier's nation and region are
the agent's manager and regional office.

Scale notes: the first-line aggregate is a partial (map-side) aggregation on
``l_orderkey``. Suppliers and parts are joined to its narrow rows, customers to
the orders' fields, and the order key's join comes last: the opportunities are
dealt by their key then, so dropping repeated ones needs no further shuffle.
Supplier, part and customer
are dimensions that grow with the data: they are joined without a broadcast
hint and AQE broadcasts them only when their runtime size is under
``spark.sql.autoBroadcastJoinThreshold``. Nation and region are fixed-size
(25 and 5 rows) and are broadcast explicitly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Fixed values of the opportunity model.
STAGES = ("Won", "Lost", "Engaging", "Prospecting")
CLOSED_STAGES = ("Won", "Lost")
WON_PRIORITIES = ("1", "2", "3")   # leading digit of o_orderpriority for a won order
CLOSE_OFFSET_MULT, CLOSE_OFFSET_MOD = 31, 200     # close = order date + 1 + (key*31) % 200
CREATE_OFFSET_MULT, CREATE_OFFSET_MOD = 7919, 20  # creation = engage - (10 + (key*7919) % 20)
EMPLOYEES_MOD = 991                               # employees = 10 + custkey % 991

OPPORTUNITY_COLUMNS = ("opportunity_id", "sales_agent", "product", "account",
                       "deal_stage", "engage_date", "close_date", "close_value")


def first_lines(lineitem: DataFrame) -> DataFrame:
    """One row per order: supplier and part of its first line item.

    ``min(struct(linenumber, suppkey, partkey))`` equals
    ``min_by(suppkey, struct(...))`` and ``min_by(partkey, struct(...))`` in one
    aggregate buffer.
    """
    first = F.min(F.struct("l_linenumber", "l_suppkey", "l_partkey")).alias("first")
    return (lineitem.groupBy("l_orderkey").agg(first)
            .select("l_orderkey",
                    F.col("first.l_suppkey").alias("first_suppkey"),
                    F.col("first.l_partkey").alias("first_partkey")))


def stage_of(status: Column, priority: Column) -> Column:
    won = (status == "F") & F.substring(priority, 1, 1).isin(*WON_PRIORITIES)
    return (F.when(won, "Won").when(status == "F", "Lost")
            .when(status == "P", "Engaging").otherwise("Prospecting"))


def order_fields(orders: DataFrame) -> DataFrame:
    """The opportunity fields that an order has by itself."""
    stage = stage_of(F.col("o_orderstatus"), F.col("o_orderpriority"))
    day = F.to_date("o_orderdate")
    offset = 1 + (F.col("o_orderkey") * CLOSE_OFFSET_MULT) % CLOSE_OFFSET_MOD
    return orders.select(F.col("o_orderkey").cast("string").alias("opportunity_id"), stage.alias("deal_stage"),
                         F.when(F.col("o_orderstatus") != "O", day).alias("engage_date"),
                         F.when(F.col("o_orderstatus") == "F", F.date_add(day, offset.cast("int"))).alias("close_date"),
                         F.when(stage == "Won", F.col("o_totalprice")).when(stage == "Lost", F.lit(0.0)).alias("close_value"))


def ledger(t: dict[str, DataFrame]) -> DataFrame:
    """A table in the opportunity layout that breaks its rules: one row a line
    item, with ship months as close dates (often before the order), account
    balances as values (some negative), returned goods as a stage that doesn't
    exist, missing agents and close dates, and repeated rows. Orders of even
    months keep the rules, so that checks pass in some periods."""
    o = t["orders"].select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    lines = t["lineitem"].select("l_orderkey", "l_suppkey", "l_partkey", "l_quantity", "l_discount", "l_returnflag", "l_shipdate")
    cust = t["customer"].select("c_custkey", "c_name", "c_acctbal")
    day = F.to_date("o_orderdate")
    odd = F.month(day) % 2 == 1
    stage = stage_of(F.col("o_orderstatus"), F.col("o_orderpriority"))
    closed = F.col("o_orderstatus") == "F"
    return (lines.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(cust, F.col("o_custkey") == F.col("c_custkey"), "left")
            .select(F.col("l_orderkey").cast("string").alias("opportunity_id"),
                    F.when(~odd | (F.col("l_quantity") < 44), F.concat(F.lit("Agent-"), (F.col("l_suppkey") % 3).cast("string"))).alias("sales_agent"),
                    F.concat(F.lit("Part-"), (F.col("l_partkey") % 2).cast("string")).alias("product"),
                    F.col("c_name").alias("account"),
                    F.when(odd & (F.month(day) % 3 == 0) & (F.col("l_returnflag") == "R"), F.lit("Returned")).otherwise(stage).alias("deal_stage"),
                    day.alias("engage_date"),
                    F.when(closed & ~odd, F.date_add(day, 5))
                     .when(closed & (F.col("l_discount") < 0.09), F.trunc(F.to_date("l_shipdate"), "month")).alias("close_date"),
                    F.when(closed, F.when(odd, F.col("c_acctbal")).otherwise(F.abs("c_acctbal"))).alias("close_value"),
                    F.date_sub(day, 15).alias("creation_date"),
                    F.date_format(F.date_sub(day, 15), "yyyy-MM").alias("creation_year_month"),
                    F.last_day(day).alias("snapshot_date"), F.date_format(day, "yyyy-MM").alias("snapshot_period")))


def opportunities(t: dict[str, DataFrame]) -> DataFrame:
    """The raw opportunity table (the first eight model columns) plus the
    numeric ``opportunity_key`` used for reproducible pseudo-random offsets."""
    o = t["orders"].select("o_orderkey", "o_custkey", "o_orderstatus",
                           "o_totalprice", "o_orderdate", "o_orderpriority")
    lines = first_lines(t["lineitem"].select("l_orderkey", "l_linenumber",
                                             "l_suppkey", "l_partkey"))
    sup = t["supplier"].select("s_suppkey", F.col("s_name").alias("sales_agent"))
    brand = t["part"].select("p_partkey", F.col("p_brand").alias("product"))
    cust = t["customer"].select("c_custkey", F.col("c_name").alias("account"))

    stage = stage_of(F.col("o_orderstatus"), F.col("o_orderpriority"))
    odate = F.to_date("o_orderdate")
    closed = F.col("o_orderstatus") == "F"
    close_offset = 1 + (F.col("o_orderkey") * CLOSE_OFFSET_MULT) % CLOSE_OFFSET_MOD
    named = (lines.join(sup, F.col("first_suppkey") == sup.s_suppkey, "left")
             .join(brand, F.col("first_partkey") == brand.p_partkey, "left").select("l_orderkey", "sales_agent", "product"))
    return (o.join(cust, F.col("o_custkey") == cust.c_custkey, "left")
            .join(named, F.col("o_orderkey") == F.col("l_orderkey"), "left")
            .select(F.col("o_orderkey").cast("string").alias("opportunity_id"),
                    "sales_agent", "product", "account",
                    stage.alias("deal_stage"),
                    F.when(F.col("o_orderstatus") != "O", odate).alias("engage_date"),
                    F.when(closed, F.date_add(odate, close_offset.cast("int"))).alias("close_date"),
                    F.when(stage == "Won", F.col("o_totalprice"))
                     .when(stage == "Lost", F.lit(0.0)).alias("close_value"),
                    F.col("o_orderkey").alias("opportunity_key")))


def max_engage_date(t: dict[str, DataFrame]) -> Column:
    """Latest engage date as a scalar subquery over two columns of ``orders``
    (evaluated once, inlined as a literal; no join)."""
    o = t["orders"]
    return (o.where(F.col("o_orderstatus") != "O")
            .select(F.max(F.to_date("o_orderdate"))).scalar())


def sales_teams(t: dict[str, DataFrame]) -> DataFrame:
    """sales_agent, manager (nation), regional_office (region)."""
    nation = F.broadcast(t["nation"].select("n_nationkey", "n_name", "n_regionkey"))
    region = F.broadcast(t["region"].select("r_regionkey", "r_name"))
    return (t["supplier"].select("s_name", "s_nationkey")
            .join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
            .select(F.col("s_name").alias("sales_agent"),
                    F.col("n_name").alias("manager"),
                    F.col("r_name").alias("regional_office")))


def accounts(t: dict[str, DataFrame]) -> DataFrame:
    """account, sector, revenue, employees."""
    c = t["customer"]
    return c.select(F.col("c_name").alias("account"),
                    F.col("c_mktsegment").alias("sector"),
                    F.col("c_acctbal").alias("revenue"),
                    (10 + F.col("c_custkey") % EMPLOYEES_MOD).cast("long").alias("employees"))


def products(t: dict[str, DataFrame]) -> DataFrame:
    """product (brand), number of parts, average list price."""
    return (t["part"].groupBy(F.col("p_brand").alias("product"))
            .agg(F.count("*").alias("parts"),
                 F.bround(F.avg("p_retailprice").cast("decimal(38,10)"), 2).cast("double").alias("sales_price")))
