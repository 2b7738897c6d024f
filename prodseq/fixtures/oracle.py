"""The registered queries as SQL over the same test tables."""

from __future__ import annotations

import re

from prodseq.fixtures.views import SINGLE_DATE
from prodseq.operators.inventory import COLOURS
from prodseq.operators.ranking import TIE_BREAK, TIE_BREAK_REST
from prodseq.plans import layouts
from prodseq.plans.params import DEFAULTS, LOCATION_TYPES, WHOLE_NUMBERS

_YEARLY = "make_date(CAST(year(l_shipdate) AS INTEGER), 1, 1)"
_SINGLE = f"DATE '{SINGLE_DATE}'"

_TIES = ", ".join(
    [f"{c} {'ASC' if up else 'DESC'} NULLS LAST" for c, up in TIE_BREAK]
    + [f"{c} ASC NULLS LAST" for c in TIE_BREAK_REST]
)

_SKU = (
    "'P' || lpad(CAST(p_partkey AS VARCHAR), 7, '0')"
    " || lpad(CAST(p_size AS VARCHAR), 2, '0') || 'XX'"
)

_VIEWS = {
    "base": f"""
SELECT {{day}} AS report_date, {_SKU} AS sku,
  CASE WHEN p_partkey % 5 = 4 AND c_mktsegment <> 'FURNITURE' THEN '1400_FG10'
    ELSE CASE c_mktsegment WHEN 'AUTOMOBILE' THEN '1300_OE10' WHEN 'MACHINERY' THEN '1300_ST10'
    WHEN 'HOUSEHOLD' THEN '1300_FG10' WHEN 'BUILDING' THEN '1400_FG10' END END AS loc, p_partkey, p_brand, c_mktsegment, l_suppkey, l_linenumber,
  l_quantity, l_extendedprice, l_returnflag, l_linestatus
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey""",
    "bor": """
SELECT report_date, sku, 'Tyre 15" wide, ' || sku AS description, loc, count(*) * 25.0::DOUBLE AS norm,
  sum(l_quantity) AS virtual_norm,
  2 * sum(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0 END)
    - sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS stock
FROM base WHERE c_mktsegment <> 'FURNITURE' GROUP BY report_date, sku, loc""",
    "bmr": """
SELECT report_date, sku, CASE WHEN p_partkey % 11 = 0 OR p_partkey % 5 = 4 THEN '1400' ELSE '1300' END AS plant,
  sum(CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE 0 END) AS requirement,
  100 * sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END)
    / nullif(sum(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0 END), 0) AS penetration
FROM base WHERE c_mktsegment = 'FURNITURE' GROUP BY ALL""",
    "places": """
SELECT DISTINCT report_date, sku, loc, p_partkey, p_brand
FROM base WHERE loc IS NOT NULL""",
    "bpr": """
SELECT DISTINCT report_date, sku, 'L' || CAST(l_suppkey % 12 AS VARCHAR) AS loc,
  ['JIT','Depot','depot','Depot Mobility','Feeder','PWH','Other'][l_suppkey % 7 + 1] AS location_type,
  ['Black','Red','Yellow','Green'][l_linenumber % 4 + 1] AS colour, 'F' AS top_sku
FROM base
UNION ALL
SELECT report_date, sku, loc, 'PWH', ['Black','Red','Yellow','Green'][p_partkey % 4 + 1],
  CASE WHEN p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') THEN 'T' ELSE 'F' END
FROM places WHERE p_partkey % 7 <> 0
UNION ALL
SELECT report_date, sku, loc, 'PWH', 'Black', 'T' FROM places WHERE p_partkey % 50 = 1""",
    "dispatch": """
SELECT CASE WHEN p_partkey % 13 <> 0 THEN 1300 + l_suppkey % 2 WHEN l_suppkey % 2 = 0 THEN 1300.7 ELSE 99999999999 END AS plant,
  sku, format('{{:,.2f}}', l_extendedprice) AS amount,
  CASE l_linenumber WHEN 7 THEN '0' WHEN 6 THEN '1,' || lpad(CAST(CAST(l_quantity AS BIGINT) AS VARCHAR), 3, '0')
    ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS quantity
FROM base""",
    "curing": f"""
SELECT {_SKU} AS sku, CASE WHEN p_partkey % 10 <> 0 THEN 10.0 + p_partkey % 20 END AS cure_time FROM part
UNION ALL
SELECT {_SKU}, CASE WHEN p_partkey % 10 <> 0 THEN 13.0 + p_partkey % 20 END FROM part WHERE p_partkey % 4 = 0""",
    "mould": """
SELECT report_date, sku, 'WC' || CAST(l_suppkey AS VARCHAR) AS machine, l_quantity AS mould_life,
  CASE WHEN p_partkey % 101 = 0 THEN 0.0 ELSE 50.0 END AS target_life
FROM base WHERE p_partkey % 3 <> 0""",
    "manual": f"""
SELECT {_SINGLE} AS report_date, {_SKU} AS sku, 'Manual ' || p_name AS description,
  ['OE','ST','EXP','RE'][p_partkey % 4 + 1] AS market, CAST(p_size * 10 AS DOUBLE) AS quantity,
  CASE WHEN p_partkey % 111 = 3 THEN 9999999999 WHEN p_partkey % 2 = 0 THEN 1 ELSE 0 END AS highest_priority, p_partkey AS entry_no
FROM part WHERE p_partkey % 37 = 3""",
    "flagged": """
SELECT report_date, sku, colour,
  CASE WHEN location_type = 'depot' THEN 'Depot' ELSE location_type END AS location_type
FROM bpr WHERE colour IN ('Black', 'Red')""",
    "inv": """
SELECT report_date, sku, sum(
    CASE location_type WHEN 'JIT' THEN 5.0 WHEN 'Depot' THEN 4.0 WHEN 'Depot Mobility' THEN 3.0
      WHEN 'Feeder' THEN 2.0 WHEN 'PWH' THEN 1.0 ELSE 0.0 END
    * CASE colour WHEN 'Black' THEN 1.0 ELSE 0.5 END)::DOUBLE AS inventory
FROM flagged GROUP BY report_date, sku""",
    "signals": """
SELECT *, CASE WHEN adjusted_target - stock < 0 THEN 0 ELSE adjusted_target - stock END AS requirement,
  CASE WHEN virtual_norm = 0 THEN 0 ELSE (virtual_norm - stock) / virtual_norm * 100 END AS penetration
FROM (SELECT *, CASE WHEN market = 'RE' THEN virtual_norm * 0.5::DOUBLE ELSE virtual_norm END AS adjusted_target
  FROM (SELECT *, CASE split_part(loc, '_', 2) WHEN 'FG10' THEN 'RE' WHEN 'OE10' THEN 'OE'
      WHEN 'ST10' THEN 'ST' ELSE split_part(loc, '_', 2) END AS market
    FROM bor WHERE loc LIKE '1300%'))""",
    "marked": """
SELECT s.*, b.top_sku FROM signals s LEFT JOIN bpr b
ON s.report_date = b.report_date AND s.sku = b.sku AND s.loc = b.loc""",
    "export": """
SELECT report_date, sku, 'EXP' AS market, CAST(NULL AS DOUBLE) AS adjusted_target, requirement,
  penetration, 'T' AS top_sku FROM bmr WHERE plant = '1300'""",
    "demand": """
SELECT *, coalesce(TRY_CAST(substr(sku, 9, 2) AS INTEGER), 0) AS size,
  CASE market WHEN 'OE' THEN 4.0 WHEN 'ST' THEN 3.0 WHEN 'EXP' THEN 2.0 WHEN 'RE' THEN 1.0 END::DOUBLE AS market_weight,
  CASE WHEN top_sku = 'T' THEN 1 ELSE 0 END AS top_flag
FROM (SELECT * FROM export UNION ALL BY NAME SELECT * FROM marked)
WHERE requirement IS DISTINCT FROM 0""",
    "normed": """
SELECT d.*, d.penetration / nullif(m.p, 0) AS norm_penetration, d.requirement / nullif(m.r, 0) AS norm_requirement
FROM demand d JOIN (SELECT report_date, max(penetration) AS p, max(requirement) AS r
  FROM demand GROUP BY report_date) m USING (report_date)""",
    "dscore": """
SELECT *, market_weight * 0.25::DOUBLE + norm_penetration * 0.35::DOUBLE + norm_requirement * 0.3::DOUBLE
  + top_flag * 0.1::DOUBLE AS raw_score FROM normed""",
    "asp": """
SELECT sku, round(avg(TRY_CAST(replace(amount, ',', '') AS DOUBLE)
  / nullif(TRY_CAST(quantity AS DOUBLE), 0)), 6) AS asp
FROM dispatch WHERE plant = 1300 GROUP BY sku""",
    "cure": "SELECT sku, max(cure_time)::DOUBLE AS cure_time FROM curing GROUP BY sku",
    "priced": """
SELECT *, asp * daily_cure AS rev_pot FROM (
  SELECT *, CAST(ceil(1440.0::DOUBLE / cure_time * 0.9::DOUBLE) AS BIGINT) AS daily_cure FROM (
    SELECT d.*, coalesce(i.inventory, 0) AS inventory, coalesce(a.asp, 3000.0::DOUBLE) AS asp,
      coalesce(c.cure_time, 15.0::DOUBLE) + 2.5::DOUBLE AS cure_time, coalesce(d.raw_score, 0) AS demand_score
    FROM dscore d LEFT JOIN inv i USING (report_date, sku) LEFT JOIN asp a USING (sku)
    LEFT JOIN cure c USING (sku)))""",
    "relative": """
SELECT p.*, coalesce(p.inventory / nullif(m.i, 0), 0) AS norm_inventory,
  coalesce(p.rev_pot / nullif(m.v, 0), 0) AS price_priority
FROM priced p JOIN (SELECT report_date, max(inventory) AS i, max(rev_pot) AS v FROM priced
  GROUP BY report_date) m USING (report_date)""",
    "scored": """
SELECT *, demand_score * 0.4::DOUBLE + norm_inventory * 0.3::DOUBLE + price_priority * 0.3::DOUBLE AS consolidated
FROM relative""",
    "stage1": """
SELECT report_date, sku, description, size, market, coalesce(norm, 0) AS norm,
  coalesce(virtual_norm, 0) AS virtual_norm, coalesce(adjusted_target, 0) AS adjusted_target,
  coalesce(stock, 0) AS stock, coalesce(requirement, 0) AS requirement,
  coalesce(penetration, 0) AS penetration, coalesce(norm_penetration, 0) AS norm_penetration,
  coalesce(norm_requirement, 0) AS norm_requirement, top_sku, top_flag,
  coalesce(market_weight, 0) AS market_weight, inventory, norm_inventory, asp, cure_time,
  daily_cure, rev_pot, price_priority, demand_score, consolidated,
  rank() OVER (PARTITION BY report_date ORDER BY round(consolidated, 9) DESC) AS demand_rank
FROM scored""",
    "moulds": """
SELECT report_date, sku, count(DISTINCT machine) AS machine_count,
  round(avg(mould_life / nullif(target_life, 0)), 6) AS mould_health
FROM mould GROUP BY report_date, sku""",
    "ghosts": """
SELECT m.report_date, m.sku, coalesce(TRY_CAST(substr(m.sku, 9, 2) AS INTEGER), 0) AS size,
  'RE' AS market, 0.0::DOUBLE AS requirement, 0.0::DOUBLE AS penetration, 20.0::DOUBLE AS cure_time,
  m.machine_count, m.mould_health, f.lowest * 0.5::DOUBLE AS consolidated, true AS is_ghost
FROM moulds m JOIN (SELECT report_date, min(consolidated) AS lowest FROM stage1 GROUP BY report_date) f
  ON m.report_date = f.report_date
WHERE NOT EXISTS (SELECT 1 FROM stage1 s WHERE s.report_date = m.report_date AND s.sku = m.sku)""",
    "joined": """
SELECT s.*, coalesce(m.machine_count, 0) AS machine_count,
  coalesce(m.mould_health, 0) AS mould_health, false AS is_ghost
FROM stage1 s LEFT JOIN moulds m ON s.report_date = m.report_date AND s.sku = m.sku""",
    "proxied": """
SELECT *, rank() OVER (PARTITION BY report_date ORDER BY round(proxy, 9) DESC) AS proxy_rank FROM (
  SELECT *, consolidated * greatest(0.0::DOUBLE, 1.0::DOUBLE - machine_count * 0.05::DOUBLE) AS proxy
  FROM (SELECT * FROM joined UNION ALL BY NAME SELECT * FROM ghosts))""",
    "stage2": """
SELECT * REPLACE (coalesce(norm, 0) AS norm, coalesce(virtual_norm, 0) AS virtual_norm,
  coalesce(adjusted_target, 0) AS adjusted_target, coalesce(stock, 0) AS stock,
  coalesce(norm_penetration, 0) AS norm_penetration, coalesce(norm_requirement, 0) AS norm_requirement,
  coalesce(inventory, 0) AS inventory, coalesce(norm_inventory, 0) AS norm_inventory,
  coalesce(demand_score, 0) AS demand_score, coalesce(asp, 0) AS asp,
  coalesce(daily_cure, 0) AS daily_cure, coalesce(rev_pot, 0) AS rev_pot,
  coalesce(price_priority, 0) AS price_priority, coalesce(market_weight, 0) AS market_weight,
  coalesce(top_flag, 0) AS top_flag),
  coalesce(demand_rank <= 50 AND machine_count = 0, false) AS critical_gap,
  coalesce(demand_rank > 200 AND machine_count > 2, false) AS excess_production,
  coalesce(mould_health > 0.9, false) AS mould_alert
FROM proxied""",
    "mranked": """
SELECT *, 10.0::DOUBLE + highest_priority * 1.0::DOUBLE AS manual_score,
  row_number() OVER (PARTITION BY report_date
    ORDER BY 10.0 + highest_priority DESC, quantity DESC, entry_no) AS manual_rank
FROM manual WHERE length(trim(sku)) > 0""",
    "superseded": """
SELECT * FROM stage2 s WHERE EXISTS (
  SELECT 1 FROM manual m WHERE m.report_date = s.report_date AND m.sku = s.sku)""",
    "remaining": """
SELECT * FROM stage2 s WHERE NOT EXISTS (
  SELECT 1 FROM manual m WHERE m.report_date = s.report_date AND m.sku = s.sku)""",
    "prior": """
SELECT report_date, sku, requirement AS prior_requirement, machine_count, mould_health
FROM superseded QUALIFY row_number() OVER (PARTITION BY report_date, sku
  ORDER BY demand_rank NULLS LAST, market, requirement DESC) = 1""",
    "mrows": """
SELECT m.report_date, m.sku, m.description, coalesce(TRY_CAST(substr(m.sku, 9, 2) AS INTEGER), 0) AS size,
  m.market, m.highest_priority, m.manual_score, m.manual_rank,
  coalesce(p.prior_requirement, 0) AS prior_requirement, m.quantity AS manual_requirement,
  m.quantity AS requirement, false AS is_ghost, coalesce(p.machine_count, 0) AS machine_count,
  coalesce(p.mould_health, 0) AS mould_health, coalesce(p.machine_count, 0) = 0 AS critical_gap,
  false AS excess_production, coalesce(p.mould_health, 0) > 0.9 AS mould_alert,
  'Manual' AS source, m.manual_rank AS proxy_rank, m.manual_score AS consolidated
FROM mranked m LEFT JOIN prior p ON m.report_date = p.report_date AND m.sku = p.sku""",
    "arows": f"""
SELECT r.* REPLACE (row_number() OVER (PARTITION BY report_date ORDER BY proxy_rank, {_TIES})
    + coalesce(n, 0) AS proxy_rank),
  'Automated' AS source, requirement AS prior_requirement, 0.0::DOUBLE AS manual_requirement
FROM remaining r LEFT JOIN (SELECT report_date, count(*) AS n FROM manual GROUP BY report_date)
  USING (report_date)""",
    "hybrid": """
SELECT * REPLACE (coalesce(description, '') AS description, coalesce(top_sku, '') AS top_sku,
  coalesce(highest_priority, 0) AS highest_priority, coalesce(manual_score, 0) AS manual_score,
  coalesce(manual_rank, 0) AS manual_rank, coalesce(norm, 0) AS norm,
  coalesce(virtual_norm, 0) AS virtual_norm, coalesce(adjusted_target, 0) AS adjusted_target,
  coalesce(stock, 0) AS stock, coalesce(penetration, 0) AS penetration,
  coalesce(norm_penetration, 0) AS norm_penetration, coalesce(norm_requirement, 0) AS norm_requirement,
  coalesce(inventory, 0) AS inventory, coalesce(norm_inventory, 0) AS norm_inventory,
  coalesce(demand_score, 0) AS demand_score, coalesce(proxy, 0) AS proxy,
  coalesce(asp, 0) AS asp, coalesce(daily_cure, 0) AS daily_cure, coalesce(rev_pot, 0) AS rev_pot,
  coalesce(price_priority, 0) AS price_priority, coalesce(market_weight, 0) AS market_weight,
  coalesce(top_flag, 0) AS top_flag)
FROM (SELECT * FROM mrows UNION ALL BY NAME SELECT * FROM arows)""",
    "strategic": """
SELECT *, CASE WHEN source = 'Manual' THEN manual_score ELSE consolidated END AS full_score FROM hybrid""",
    "penalised": """
SELECT *, penetration > 100 AND source <> 'Manual' AS is_overstock,
  CASE WHEN penetration > 100 AND source <> 'Manual' THEN full_score * 0.0 ELSE full_score END AS strategic
FROM strategic""",
    "final": """
SELECT *, row_number() OVER (PARTITION BY report_date ORDER BY is_overstock,
  CASE WHEN is_overstock THEN NULL ELSE round(strategic, 9) END DESC NULLS LAST,
  CASE WHEN is_overstock THEN penetration END ASC NULLS LAST, proxy_rank) AS final_rank
FROM penalised""",
    "plain_final": f"""
SELECT *, 'Automated' AS source, row_number() OVER (PARTITION BY report_date
  ORDER BY demand_rank NULLS LAST, {_TIES}) AS final_rank FROM stage2""",
}

# Columns that are not rounded doubles.
_TEXT = {"machine", 
    "sku", "description", "market", "top_sku", "source", "loc", "plant", "location_type", "colour",
}
_WHOLE = {
    "size", "top_flag", "daily_cure", "demand_rank", "machine_count", "proxy_rank",
    "highest_priority", "manual_rank", "final_rank", "n",
}
_FLAG = {"critical_gap", "excess_production", "mould_alert", "is_ghost", "is_overstock"}


def _select(columns: list[str] | dict[str, str], source: str, tail: str = "") -> str:
    named = columns if isinstance(columns, dict) else {c: c for c in columns}
    parts = []
    for inner, shown in named.items():
        if inner == "priority":
            continue
        if inner == "report_date":
            value = "CAST(report_date AS VARCHAR)"
        elif inner in _TEXT or inner in _FLAG:
            value = inner
        elif inner in _WHOLE:
            value = f"CAST({inner} AS BIGINT)"
        else:
            value = f"CAST(round({inner}, 6) AS DOUBLE)"
        parts.append(f'{value} AS "{shown}"')
    return f"SELECT {', '.join(parts)} FROM {source} {tail}".strip()


def _with_views(query: str, yearly: bool = False) -> str:
    """Put the views a query uses, directly or through others, before it."""
    needed: set[str] = set()

    def visit(sql: str) -> None:
        for name in set(re.findall(r"[a-z][a-z_0-9]*", sql)) & _VIEWS.keys() - needed:
            if re.search(rf"(?:FROM|JOIN)\s+{name}\b", sql):
                needed.add(name)
                visit(_VIEWS[name])

    visit(query)
    views = [
        f"{n} AS ({sql.strip().format(day=_YEARLY if yearly else _SINGLE)})"
        if n in ("base", "dispatch")
        else f"{n} AS ({sql.strip()})"
        for n, sql in _VIEWS.items()
        if n in needed
    ]
    return "WITH " + ",\n".join(views) + "\n" + query if views else query


# Other values of the parameters, each different from all defaults, and where the default stands.
OTHER_PARAMETERS = {
    "MARKET_WEIGHTS_OE": (7, "WHEN 'OE' THEN 4.0"),
    "MARKET_WEIGHTS_ST": (5, "WHEN 'ST' THEN 3.0"),
    "MARKET_WEIGHTS_EXP": (6, "WHEN 'EXP' THEN 2.0"),
    "MARKET_WEIGHTS_RE": (8, "WHEN 'RE' THEN 1.0"),
    "LOCATION_WEIGHTS_JIT": (9, "WHEN 'JIT' THEN 5.0"),
    "LOCATION_WEIGHTS_Depot": (11, "WHEN 'Depot' THEN 4.0"),
    "LOCATION_WEIGHTS_Depot_Mobility": (12, "WHEN 'Depot Mobility' THEN 3.0"),
    "LOCATION_WEIGHTS_Feeder": (13, "WHEN 'Feeder' THEN 2.0"),
    "LOCATION_WEIGHTS_PWH": (14, "WHEN 'PWH' THEN 1.0"),
    "SCORING_market_weightage": (0.21, "market_weight * 0.25"),
    "SCORING_penetration_weightage": (0.22, "norm_penetration * 0.35"),
    "SCORING_requirement_weightage": (0.23, "norm_requirement * 0.3"),
    "SCORING_top_sku_weightage": (0.24, "top_flag * 0.1"),
    "INVENTORY_BLACK_FACTOR": (1.7, "WHEN 'Black' THEN 1.0"),
    "INVENTORY_RED_FACTOR": (0.6, "ELSE 0.5 END"),
    "CONSOLIDATED_demand_priority": (0.45, "demand_score * 0.4"),
    "CONSOLIDATED_inventory_priority": (0.36, "norm_inventory * 0.3"),
    "CONSOLIDATED_price_priority": (0.19, "price_priority * 0.3"),
    "EFFICIENCY_FACTOR": (0.8, "cure_time * 0.9"),
    "DEFAULT_ASP": (2750, "coalesce(a.asp, 3000.0"),
    "DEFAULT_CURE_TIME": (17, "coalesce(c.cure_time, 15.0"),
}


def _with_other_parameters(sql: str) -> str:
    for value, place in OTHER_PARAMETERS.values():
        if place not in sql:
            raise ValueError(f"the SQL does not hold {place}")
        head, _, tail = place.rpartition(" ") if not place.endswith("END") else ("ELSE", "", "")
        changed = f"ELSE {float(value)} END" if place.endswith("END") else f"{head} {float(value)}"
        sql = sql.replace(place, changed)
    return sql


def _top(n: int) -> str:
    return f"QUALIFY row_number() OVER (PARTITION BY report_date ORDER BY demand_rank NULLS LAST, {_TIES}) <= {n}"


def _report(layout: dict[str, str], source: str) -> str:
    return _select({"report_date": "report_date"} | layout, source)


def _pivot_sql() -> str:
    cells = ", ".join(
        f"count(*) FILTER (colour = '{c}' AND location_type = '{t}') AS \"{c} Count_{t}\""
        for c in COLOURS
        for t in LOCATION_TYPES
    )
    return (
        f"SELECT CAST(report_date AS VARCHAR) AS report_date, sku, {cells}"
        " FROM flagged GROUP BY report_date, sku"
    )


def _params_sql() -> str:
    rows = ", ".join(
        f"('{sheet}', '{name}', {float(value)}::DOUBLE, {name in WHOLE_NUMBERS})"
        for sheet, values in DEFAULTS.items()
        for name, value in values.items()
    )
    return f"""
WITH defaults(sheet, parameter, default_value, whole) AS (VALUES {rows}),
answers(parameter, user_input) AS (
  SELECT 'MARKET_WEIGHTS_' || CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'OE' WHEN 'MACHINERY' THEN 'ST'
      WHEN 'FURNITURE' THEN 'EXP' WHEN 'HOUSEHOLD' THEN 'RE' END,
    ' ' || CAST(count(*) AS VARCHAR) || '.5 '
  FROM customer WHERE c_mktsegment <> 'BUILDING' GROUP BY c_mktsegment
  UNION ALL SELECT 'DEFAULT_ASP', CAST(CAST(floor(max(l_extendedprice)) AS BIGINT) AS VARCHAR) || '.75' FROM lineitem
  UNION ALL SELECT 'EFFICIENCY_FACTOR', '0.' || CAST(80 + count(*) % 19 AS VARCHAR) FROM lineitem
  UNION ALL SELECT 'DEFAULT_CURE_TIME', CASE WHEN count(*) > 0 THEN '  ' END FROM part)
SELECT sheet, parameter, default_value, user_input,
  CASE WHEN whole THEN trunc(v) ELSE v END AS value, true AS is_valid
FROM (SELECT *, coalesce(TRY_CAST(nullif(trim(user_input), '') AS DOUBLE), default_value) AS v
  FROM defaults LEFT JOIN answers USING (parameter))"""


def _summary(columns: list[str], source: str) -> str:
    return (
        f"SELECT CAST(report_date AS VARCHAR) AS report_date, {', '.join(columns)}"
        f" FROM {source} GROUP BY report_date"
    )


def _count(name: str, condition: str) -> str:
    return f"count(*) FILTER ({condition}) AS {name}"


DEMAND = [
    "report_date", "sku", "market", "norm", "virtual_norm", "adjusted_target", "stock",
    "requirement", "penetration", "top_sku",
]
SIGNALS = ["report_date", "sku", "loc", "market", "adjusted_target", "requirement", "penetration"]
REVENUE = ["report_date", "sku", "market", "asp", "cure_time", "daily_cure", "rev_pot"]
GHOSTS = [
    "report_date", "sku", "size", "market", "requirement", "penetration", "cure_time",
    "machine_count", "mould_health", "consolidated", "is_ghost",
]
MANUAL_ROWS = [
    "report_date", "sku", "description", "size", "market", "highest_priority", "manual_score",
    "manual_rank", "prior_requirement", "manual_requirement", "requirement", "machine_count",
    "mould_health", "critical_gap", "excess_production", "mould_alert", "is_ghost", "source",
    "proxy_rank", "consolidated",
]
UNION = [
    "report_date", "sku", "market", "source", "prior_requirement", "manual_requirement",
    "requirement", "highest_priority", "manual_rank", "proxy_rank", "top_sku", "description",
    "norm", "penetration",
]

FLAG_COUNTS = [
    _count("critical_gaps", "critical_gap"),
    _count("excess_production", "excess_production"),
    _count("mould_alerts", "mould_alert"),
]


# Every file starts where the one before it ended, and rows ascend within.
_IN_ORDER = """
SELECT CAST(report_date AS VARCHAR) AS report_date, count(*) AS rows, 0::BIGINT AS files_out_of_order,
  0::BIGINT AS rows_out_of_order FROM {} GROUP BY report_date"""

# Both parts of the manual list hold all columns, the second one from right to left.
_MANUAL_SQL = """
WITH columns(column_name, nth) AS (VALUES ('SKU Code', 1::BIGINT), ('SKU Description', 2), ('Market', 3), ('Quantity', 4), ('Highest Priority', 5))
SELECT part, column_name, column_name <> 'SKU Description' AS is_required, place AS first, place AS last
FROM (SELECT 'early' AS part, column_name, nth AS place FROM columns UNION ALL SELECT 'late', column_name, 6 - nth FROM columns)
WHERE EXISTS (SELECT 1 FROM part)"""


def oracle_sql() -> dict[str, str]:
    single = {
        "inventory_counts": _select(
            ["report_date", "sku", "location_type", "colour", "n"],
            "(SELECT report_date, sku, location_type, colour, count(*) AS n FROM flagged GROUP BY ALL)",
        ),
        "inventory_pivot": _pivot_sql(),
        "inventory_score": _select(["report_date", "sku", "inventory"], "inv"),
        "demand_signals": _select(SIGNALS, "signals"),
        "demand_topsku_join": _select([*SIGNALS, "top_sku"], "marked"),
        "export_demand": _select(
            ["report_date", "sku", "market", "adjusted_target", "requirement", "penetration", "top_sku"],
            "export",
        ),
        "demand_combined": _select(DEMAND, "demand"),
        "rim_size": _select(["report_date", "sku", "size"], "demand"),
        "demand_norm": _select(
            ["report_date", "sku", "market", "norm_penetration", "norm_requirement"], "normed"
        ),
        "demand_score": _select(
            {c: c for c in ["report_date", "sku", "market", "market_weight", "top_flag"]}
            | {"raw_score": "demand_score"},
            "dscore",
        ),
        "priority_struct": "SELECT CAST(report_date AS VARCHAR) AS report_date, sku,"
        " -market_weight AS by_market, round(-penetration, 6) AS by_penetration,"
        " round(-requirement, 6) AS by_requirement, CAST(-top_flag AS BIGINT) AS by_top FROM demand",
        "inventory_norm": _select(
            ["report_date", "sku", "market", "inventory", "norm_inventory"], "relative"
        ),
        "asp_by_sku": _select(["sku", "asp"], "asp"),
        "cure_time_by_sku": _select(["sku", "cure_time"], "cure"),
        "revenue_potential": _select(REVENUE, "priced"),
        "price_priority": _select(
            ["report_date", "sku", "market", "rev_pot", "price_priority"], "relative"
        ),
        "consolidated_rank": _select(
            ["report_date", "sku", "market", "consolidated", "demand_rank"], "stage1"
        ),
        "stage1_report": _report(layouts.STAGE1, "stage1"),
        "mould_summary": _select(["report_date", "sku", "machine_count", "mould_health"], "moulds"),
        "ghost_skus": _select(GHOSTS, "ghosts"),
        "deployment_join": _select(
            ["report_date", "sku", "market", "requirement", "machine_count", "mould_health", "is_ghost"],
            "joined",
        ),
        "proxy_rank": _select(
            ["report_date", "sku", "market", "machine_count", "consolidated", "proxy", "proxy_rank"],
            "proxied",
        ),
        "gap_flags": _select(
            ["report_date", "sku", "market", "demand_rank", "machine_count", "mould_health",
             "critical_gap", "excess_production", "mould_alert"],
            "stage2",
        ),
        "deployment_report": _report(layouts.STAGE2, "stage2"),
        "stage2_summary": _summary(
            [
                *FLAG_COUNTS,
                _count("ghost_skus", "is_ghost"),
                _count("in_production", "machine_count > 0"),
                _count("not_in_production", "machine_count = 0"),
                "count(*) AS rows_analyzed",
            ],
            "stage2",
        ),
        "proxy_range": _summary(
            ["round(min(proxy), 6) AS lowest", "round(max(proxy), 6) AS highest"], "stage2"
        ),
        "top_k_priority": _select(
            ["report_date", "sku", "market", "machine_count", "consolidated", "proxy", "proxy_rank"],
            "stage2",
            _top(5),
        ),
        "top_critical_gaps": _select(
            ["report_date", "sku", "market", "demand_rank", "machine_count"],
            "stage2",
            f"WHERE critical_gap {_top(5)}",
        ),
        "manual_clean": "SELECT CAST(report_date AS VARCHAR) AS report_date, sku, description, market,"
        " quantity, CAST(highest_priority AS BIGINT) AS highest_priority, entry_no FROM manual",
        "manual_rank": _select(
            ["report_date", "sku", "market", "manual_score", "manual_rank"], "mranked"
        ),
        "manual_prior_requirement": _select(["report_date", "sku", "prior_requirement"], "prior"),
        "manual_rows": _select(MANUAL_ROWS, "mrows"),
        "superseded_rows": _select(
            ["report_date", "sku", "market", "requirement", "demand_rank"], "superseded"
        ),
        "superseded_removed": _select(
            ["report_date", "sku", "market", "requirement", "proxy_rank"], "remaining"
        ),
        "automated_rerank": _select(
            ["report_date", "sku", "market", "requirement", "proxy_rank"], "arows"
        ),
        "hybrid_union": _select(UNION, "hybrid"),
        "strategic_score": _select(
            {c: c for c in ["report_date", "sku", "market", "source"]} | {"full_score": "strategic"},
            "strategic",
        ),
        "overstock_penalty": _select(
            ["report_date", "sku", "market", "source", "penetration", "strategic", "is_overstock"],
            "penalised",
        ),
        "final_rank": _select(["report_date", "sku", "market", "source", "final_rank"], "final"),
        "hybrid_report": _report(layouts.STAGE3, "final"),
        "hybrid_report_no_manual": _report(layouts.STAGE3_NO_MANUAL, "plain_final"),
        "stage3_summary": _summary(
            [
                _count("manual_entries", "source = 'Manual'"),
                _count("highest_priority", "source = 'Manual' AND highest_priority = 1"),
                _count("in_production", "source = 'Automated' AND machine_count > 0"),
                _count("not_in_production", "source = 'Automated' AND machine_count = 0"),
                *FLAG_COUNTS,
                _count("overstock", "is_overstock"),
                _count("automated_above_manual_floor", "source = 'Automated' AND full_score >= 10"),
                "count(*) AS rows_in_sequence",
            ],
            "final",
        ),
    }
    yearly = {
        "src_dated_reports": _select(
            ["report_date", "sku", "description", "loc", "norm", "virtual_norm", "stock"], "bor"
        ),
        "src_promote_header": _select(
            ["report_date", "plant", "sku", "requirement", "penetration"], "bmr", "WHERE plant = '1300'"
        ),
        "src_mould_csv": _select(
            {"report_date": "report_date", "sku": "sku", "machine": "machine", "mould_life": "mould_life", "target_life": "target_life"}, "mould"
        ),
        "top_k_per_date": _select(
            ["report_date", "sku", "market", "machine_count", "demand_rank"], "stage2", _top(5)
        ),
        "gate_complete_dates": "SELECT DISTINCT CAST(report_date AS VARCHAR) AS report_date FROM bor"
        " WHERE year(report_date) % 3 <> 0 AND report_date IN (SELECT report_date FROM bmr)"
        " AND report_date IN (SELECT report_date FROM bpr)",
        "date_range_dates": "SELECT CAST(CAST(d AS DATE) AS VARCHAR) AS report_date,"
        " CAST(d AS DATE) IN (SELECT report_date FROM bor WHERE year(report_date) % 3 <> 0"
        " AND report_date IN (SELECT report_date FROM bmr)"
        " AND report_date IN (SELECT report_date FROM bpr)) AS complete"
        " FROM (SELECT unnest(generate_series(min(report_date), max(report_date), INTERVAL 1 DAY)) AS d FROM bor)",
        "stage1_date_range": _report(layouts.STAGE1, "stage1")
        + " WHERE year(report_date) % 3 <> 0",
    }
    for name, like in {"rank_range_stage1": "consolidated_rank", "rank_range_proxy": "proxy_rank", "rank_range_final": "final_rank", "src_manual_csv": "manual_clean", "sink_read_back": "hybrid_report"}.items():
        single[name] = single[like]
    single["src_manual_csv"] = (
        "SELECT sku, description, market, quantity, CAST(highest_priority AS BIGINT) AS highest_priority, place"
        " FROM manual JOIN (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) AS place FROM part) ON entry_no = p_partkey"
    )
    single["sink_stage2"] = (
        "SELECT CAST(report_date AS VARCHAR) AS report_date, sku, market,"
        f" row_number() OVER (PARTITION BY report_date ORDER BY proxy_rank NULLS LAST, {_TIES}) AS place FROM stage2"
    )
    single["sink_stage2_order"] = _IN_ORDER.format("stage2")
    yearly["sink_stage1"] = (
        "SELECT CAST(report_date AS VARCHAR) AS report_date, sku, market,"
        " row_number() OVER (PARTITION BY report_date ORDER BY demand_rank NULLS LAST,"
        " sku ASC NULLS LAST, market ASC NULLS LAST, requirement DESC NULLS LAST) AS place FROM stage1"
    )
    yearly["sink_stage1_order"] = _IN_ORDER.format("stage1")
    single["unusable_rows"] = """
SELECT 'BOR' AS report, count(*) AS rows FROM bor WHERE sku IS NULL OR loc IS NULL
UNION ALL SELECT 'BMR', count(*) FROM bmr WHERE plant = '1300' AND sku IS NULL
UNION ALL SELECT 'BPR', count(*) FROM bpr WHERE sku IS NULL
UNION ALL SELECT 'DISPATCH', count(*) FROM dispatch WHERE sku IS NULL
UNION ALL SELECT 'CURING', count(*) FROM curing WHERE sku IS NULL
UNION ALL SELECT 'MOULD', count(*) FROM base WHERE p_partkey % 3 = 0
UNION ALL SELECT 'MANUAL', count(*) FROM part WHERE p_partkey % 37 <> 3"""
    single["sink_read_back"] = (
        "SELECT CAST(report_date AS VARCHAR) AS report_date, sku, market,"
        f" row_number() OVER (PARTITION BY report_date ORDER BY final_rank NULLS LAST, {_TIES}) AS place FROM final"
    )
    parameters = {n: _with_other_parameters(_with_views(single[like])) for n, like in {"stage1_with_parameters": "stage1_report", "deployment_with_parameters": "deployment_report"}.items()}
    return (
        parameters | {n: _with_views(q) for n, q in single.items()}
        | {n: _with_views(q, yearly=True) for n, q in yearly.items()}
        | {"params_resolve": _params_sql(), "src_manual_columns": _MANUAL_SQL}
    )
