"""Geographic multipliers: share of a place in its state."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattloom.functions.text import col
from wattloom.operators import mapping, shares
from wattloom.operators.shares import Target, targets
from wattloom.registry.core import LINES_SQL, ORDERS_SQL, PLACES_SQL, Tables, query, rounded

# Segment -> technology group, in upgrade "O" and "F" (a characteristics map).
GROUPS = (
    ("1-URGENT", "O", "ann_1"),
    ("2-HIGH", "O", "ann_1"),
    ("3-MEDIUM", "O", "ann_2"),
    ("4-NOT SPECIFIED", "O", "ann_3"),
    ("5-LOW", "O", "ann_4"),
    ("1-URGENT", "F", "ann_5"),
    ("2-HIGH", "F", "ann_5"),
    ("2-HIGH", "F", "ann_6"),
    ("3-MEDIUM", "F", "ann_6"),
)
GROUPS_SQL = "groups(o_orderpriority, o_orderstatus, group_ann) AS (VALUES " + ", ".join(
    f"('{p}', '{s}', '{g}')" for p, s, g in GROUPS
) + ")"


def group_map(t: Tables):
    return t.literal(
        list(GROUPS), "o_orderpriority string, o_orderstatus string, group_ann string"
    )


@query(
    "annual_share_literal",
    f"""
WITH {ORDERS_SQL},
detail AS (
  SELECT county, state, 'ann_1' AS group_ann, SUM(o_totalprice) AS v
  FROM placed_orders WHERE o_orderstatus = 'O' GROUP BY county, state)
SELECT county, state, group_ann, 'Other' AS end_use, 'Electric' AS fuel,
  ROUND(v / NULLIF(SUM(v) OVER (PARTITION BY state, group_ann), 0), 10)
    AS multiplier_annual
FROM detail
""",
)
def annual_share_literal(t: Tables):
    """One literal group, base upgrade only."""
    base = t.orders().filter(col("o_orderstatus") == "O")
    out = shares.share_of_group(
        base.withColumn("group_ann", F.lit("ann_1")),
        ["county", "state"],
        ["state", "group_ann"],
        {"v": col("o_totalprice")},
        targets("v", "Other", ["Electric"]),
        share_name="multiplier_annual",
    )
    return rounded(out, {"multiplier_annual": 10})


@query(
    "annual_share_mapped",
    f"""
WITH {ORDERS_SQL}, {GROUPS_SQL},
detail AS (
  SELECT county, state, group_ann, SUM(o_totalprice) AS v
  FROM placed_orders JOIN groups USING (o_orderpriority, o_orderstatus)
  WHERE o_orderstatus IN (SELECT DISTINCT o_orderstatus FROM groups)
    AND group_ann NOT IN ('ann_4')
  GROUP BY county, state, group_ann)
SELECT county, state, group_ann, 'Cooking' AS end_use, 'Electric' AS fuel,
  ROUND(v / NULLIF(SUM(v) OVER (PARTITION BY state, group_ann), 0), 10)
    AS multiplier_annual
FROM detail
""",
)
def annual_share_mapped(t: Tables):
    """Groups by characteristic and upgrade; one row may belong to two groups."""
    grouped = mapping.attach_groups(
        t.orders(),
        group_map(t),
        ["o_orderpriority"],
        "group_ann",
        upgrade="o_orderstatus",
        exclude=["ann_4"],
    )
    out = shares.share_of_group(
        grouped,
        ["county", "state"],
        ["state", "group_ann"],
        {"v": col("o_totalprice")},
        targets("v", "Cooking", ["Electric"]),
        share_name="multiplier_annual",
    )
    return rounded(out, {"multiplier_annual": 10})


@query(
    "annual_share_guarded",
    f"""
WITH {PLACES_SQL},
detail AS (
  SELECT county, state, c_mktsegment AS group_ann, SUM(c_acctbal - 4500) AS v
  FROM places GROUP BY county, state, c_mktsegment),
totalled AS (
  SELECT *, SUM(v) OVER (PARTITION BY state, group_ann) AS total FROM detail)
SELECT county, state, group_ann, 'Heating (Equip.)' AS end_use, 'Electric' AS fuel,
  ROUND(v / total, 6) AS multiplier_annual
FROM totalled WHERE total > 0
""",
)
def annual_share_guarded(t: Tables):
    """Groups whose total is not positive yield no multiplier."""
    out = shares.share_of_group(
        t.places().select(
            col("c_custkey").alias("county"),
            "state",
            col("c_mktsegment").alias("group_ann"),
            (col("c_acctbal") - 4500).alias("v"),
        ),
        ["county", "state"],
        ["state", "group_ann"],
        {"v": col("v")},
        targets("v", "Heating (Equip.)", ["Electric"], guard=True),
        share_name="multiplier_annual",
    )
    return rounded(out, {"multiplier_annual": 6})


@query(
    "annual_share_fanout",
    f"""
WITH {LINES_SQL},
detail AS (
  SELECT county, state, l_returnflag AS group_ann,
    SUM(CASE WHEN l_linestatus = 'F' THEN l_quantity + l_tax END) AS el,
    SUM(CASE WHEN l_linestatus = 'O' THEN l_quantity END) AS ng
  FROM lines GROUP BY county, state, l_returnflag),
totalled AS (
  SELECT *, SUM(el) OVER w AS el_total, SUM(ng) OVER w AS ng_total
  FROM detail WINDOW w AS (PARTITION BY state, group_ann)),
branches AS (
  SELECT *, 'Other' AS end_use, 'Electric' AS fuel, el / NULLIF(el_total, 0) AS m FROM totalled
  UNION ALL
  SELECT *, 'Computers and Electronics', 'Electric', el / NULLIF(el_total, 0) FROM totalled
  UNION ALL
  SELECT *, 'Other', 'Natural Gas', ng / NULLIF(ng_total, 0) FROM totalled WHERE ng_total > 0
  UNION ALL
  SELECT *, 'Other', 'Propane', ng / NULLIF(ng_total, 0) FROM totalled WHERE ng_total > 0)
SELECT county, state, group_ann, end_use, fuel, ROUND(m, 10) AS multiplier_annual
FROM branches
""",
)
def annual_share_fanout(t: Tables):
    """Several measures and fuels from one aggregation."""
    fuel = col("l_linestatus")
    out = shares.share_of_group(
        t.lines().withColumn("group_ann", col("l_returnflag")),
        ["county", "state"],
        ["state", "group_ann"],
        {
            "el": F.when(fuel == "F", col("l_quantity") + col("l_tax")),
            "ng": F.when(fuel == "O", col("l_quantity")),
        },
        (
            Target("el", "Other", "Electric"),
            Target("el", "Computers and Electronics", "Electric"),
            Target("ng", "Other", "Natural Gas", True),
            Target("ng", "Other", "Propane", True),
        ),
        share_name="multiplier_annual",
    )
    return rounded(out, {"multiplier_annual": 10})


@query(
    "weighted_count_share",
    f"""
WITH {LINES_SQL},
detail AS (
  SELECT county, state,
    SUM(CASE WHEN l_linenumber <= 3 AND l_returnflag = 'A'
        THEN CAST(l_linenumber AS DOUBLE) * l_quantity ELSE 0 END) AS gas,
    SUM(CASE WHEN l_linenumber > 3 AND l_returnflag IN ('N', 'R')
        THEN CAST(l_linenumber AS DOUBLE) * l_quantity ELSE 0 END) AS elec
  FROM lines GROUP BY county, state)
SELECT county, state, 'Cooking' AS end_use, 'Natural Gas' AS fuel,
  ROUND(gas / NULLIF(SUM(gas) OVER (PARTITION BY state), 0), 10) AS multiplier_annual
FROM detail
UNION ALL
SELECT county, state, 'Cooking', 'Electric',
  ROUND(elec / NULLIF(SUM(elec) OVER (PARTITION BY state), 0), 10)
FROM detail
""",
)
def weighted_count_share(t: Tables):
    """Counts x weight chosen by condition, one column per fuel."""
    number, flag = col("l_linenumber"), col("l_returnflag")
    count = number.cast("double") * col("l_quantity")
    out = shares.share_of_group(
        t.lines(),
        ["county", "state"],
        ["state"],
        {
            "gas": F.when((number <= 3) & (flag == "A"), count).otherwise(0.0),
            "elec": F.when((number > 3) & flag.isin("N", "R"), count).otherwise(0.0),
        },
        targets("gas", "Cooking", ["Natural Gas"]) + targets("elec", "Cooking", ["Electric"]),
        share_name="multiplier_annual",
    )
    return rounded(out, {"multiplier_annual": 10})


@query(
    "gap_share",
    f"""
WITH {ORDERS_SQL},
regional AS (
  SELECT county, state FROM places WHERE c_mktsegment != 'BUILDING'),
sums AS (
  SELECT o_custkey AS county, SUM(o_totalprice) AS gap FROM orders GROUP BY o_custkey),
shared AS (
  SELECT s.county, r.state,
    gap / NULLIF(SUM(gap) OVER (PARTITION BY r.state), 0) AS m
  FROM sums s LEFT JOIN regional r ON s.county = r.county)
SELECT county, 'com_gap_ann_1' AS group_ann, ROUND(m, 10) AS multiplier_annual,
  'com' AS sector, state, end_use, 'Electric' AS fuel
FROM shared CROSS JOIN (VALUES ('Gap'), ('Other'), ('Lighting')) AS e(end_use)
""",
)
def gap_share(t: Tables):
    """Unmodelled consumption: same share for all end uses, NULL state is a group."""
    from wattloom.plans.specs import gap_annual

    known = t.places().filter(col("c_mktsegment") != "BUILDING").select(
        col("c_custkey").alias("county"), "state"
    )
    gap = t("orders").select(col("o_custkey").alias("county"), "o_totalprice")
    out = gap_annual(
        gap, known, "o_totalprice", ["Gap", "Other", "Lighting"], county="county", state="state"
    )
    return rounded(out, {"multiplier_annual": 10})


@query(
    "shares_three_levels",
    f"""
WITH {LINES_SQL},
totals AS (
  SELECT c_mktsegment, l_returnflag, CAST(YEAR(l_shipdate) AS INTEGER) AS year,
    o_orderstatus, SUM(l_extendedprice) AS total
  FROM lines WHERE l_linestatus = 'F'
  GROUP BY ALL)
SELECT c_mktsegment, l_returnflag, year, o_orderstatus, ROUND(total, 2) AS total,
  ROUND(total / SUM(total) OVER (PARTITION BY l_returnflag, year, o_orderstatus), 10)
    AS share_of_eu,
  ROUND(total / SUM(total) OVER (PARTITION BY year, o_orderstatus), 10) AS share_of_sector,
  ROUND(total / SUM(total) OVER (PARTITION BY year), 10) AS share_of_total
FROM totals
""",
)
def shares_three_levels(t: Tables):
    """Measure shares of end use, sector and scenario from one aggregation."""
    lines = t.lines().filter(col("l_linestatus") == "F")
    out = shares.nested_shares(
        lines.withColumn("year", F.year("l_shipdate")),
        ["c_mktsegment", "l_returnflag", "year", "o_orderstatus"],
        col("l_extendedprice"),
        {
            "share_of_eu": ["l_returnflag", "year", "o_orderstatus"],
            "share_of_sector": ["year", "o_orderstatus"],
            "share_of_total": ["year"],
        },
    )
    return rounded(
        out, {"total": 2, "share_of_eu": 10, "share_of_sector": 10, "share_of_total": 10}
    )
