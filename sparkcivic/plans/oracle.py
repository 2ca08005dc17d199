"""DuckDB twins of the fixture bindings, for the SQL oracle of every query.

The driver tables are pre-registered as DuckDB views; these CTEs derive the
same analysis inputs as ``plans.fixtures`` does in Spark.
"""

from __future__ import annotations

from .fixtures import CODE_STEPS, JUNK_CODE_LINES, OPEN_STATUSES, WEAPON_WORDS


def pad(expr: str, width: int) -> str:
    """zfill for non-negative keys: pad to ``width``, never truncate."""
    s = f"CAST({expr} AS VARCHAR)"
    return f"(CASE WHEN length({s}) >= {width} THEN {s} ELSE lpad({s}, {width}, '0') END)"


def spark_round(expr: str, digits: int) -> str:
    """Spark rounds a double HALF_UP on its shortest decimal form; DuckDB
    rounds the binary value. Going through the text form reproduces Spark."""
    return (f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)")


def sql_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


TS_FORMAT = "%m/%d/%Y %I:%M:%S %p"
OPEN = sql_list(OPEN_STATUSES)

CTES = {
    "incidents_all": f"""incidents_all AS (
    SELECT o_orderkey AS dr_no, c_nationkey AS area, o_orderstatus AS status,
           o_orderpriority AS crime,
           CASE WHEN o_orderkey % 17 = 0 THEN NULL
                ELSE CAST(floor(o_totalprice / 5000) AS INTEGER) - 1 END AS age,
           CASE WHEN o_orderkey % 101 = 0 THEN 'garbage'
                ELSE strftime(o_orderdate, '{TS_FORMAT}') END AS date_occ,
           CASE WHEN o_orderkey % 7 = 0 THEN 0.0e0 WHEN o_orderkey % 11 = 0 THEN NULL
                ELSE 33.7e0 + ((o_orderkey * 7919) % 5000) / 10000.0e0 END AS lat,
           CASE WHEN o_orderkey % 7 = 0 THEN 0.0e0 WHEN o_orderkey % 13 = 0 THEN NULL
                ELSE -118.7e0 + ((o_orderkey * 3571) % 6000) / 10000.0e0 END AS lon,
           o_orderdate
    FROM orders JOIN customer ON o_custkey = c_custkey)""",
    "incidents": """incidents AS (
    SELECT dr_no, area, status, crime, age, date_occ, lat, lon FROM incidents_all)""",
    "incidents_codes": f"""incidents_codes AS (
    SELECT i.*,
           CASE WHEN dr_no % 19 <> 0 THEN concat_ws(' ', {', '.join(
               f"CASE WHEN dr_no % {len(CODE_STEPS)} + 1 > {i} THEN {pad(f'(dr_no * {m}) % (SELECT max(p_partkey) FROM part) + 1', 6)} END"
               for i, m in enumerate(CODE_STEPS))}) END AS mocodes
    FROM incidents i)""",
    "sites": """sites AS (
    SELECT s_suppkey AS sid, s_name AS division,
           CAST(33.7e0 + ((s_suppkey * 6151) % 5000) / 10000.0e0 AS FLOAT) AS site_lat,
           CAST(-118.7e0 + ((s_suppkey * 104729) % 6000) / 10000.0e0 AS FLOAT) AS site_lon
    FROM supplier)""",
    "census": f"""census AS (
    SELECT {pad('c_custkey', 5)} AS zip,
           CAST(CAST(c_custkey % 200 AS DOUBLE) / 10.0e0 AS FLOAT) AS hh
    FROM customer)""",
    "income": f"""income AS (
    SELECT CASE WHEN c_custkey % 3 <> 0 THEN {pad('c_custkey', 5)} ELSE '-' || {pad('(c_custkey + 1)', 4)} END AS zip,
           CASE WHEN c_custkey % 29 = 0 THEN '-'
                ELSE '$' || format('{{:,}}', CAST(floor(c_acctbal * 10) AS BIGINT)) END AS inc
    FROM customer)""",
    "dictionary": """dictionary AS (
    SELECT CAST(p_partkey AS INTEGER) AS code, p_name AS description FROM part)""",
    "code_lines": f"""code_lines AS (
    SELECT {pad('p_partkey', 6)} || ' ' || p_name AS value FROM part
    UNION ALL SELECT * FROM (VALUES {', '.join("('" + v + "')" for v in JUNK_CODE_LINES)}) t(value))""",
    "weapon_points": f"""weapon_points AS (
    SELECT DISTINCT dr_no, lat, lon
    FROM (SELECT dr_no, lat, lon, unnest(string_split(mocodes, ' ')) AS code_str
          FROM incidents_codes
          WHERE mocodes IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL
            AND NOT (lat = 0.0 AND lon = 0.0)) e
    WHERE TRY_CAST(code_str AS INTEGER) IN (
        SELECT code FROM dictionary
        WHERE {' OR '.join(f"contains(lower(description), '{w}')" for w in WEAPON_WORDS)}))""",
}

DEPENDS = {
    "incidents": ["incidents_all"],
    "incidents_codes": ["incidents"],
    "weapon_points": ["incidents_codes", "dictionary"],
}


def with_ctes(names: list[str], body: str) -> str:
    """Prefix ``body`` with the named CTEs (and what they depend on)."""
    order: list[str] = []

    def add(n: str):
        for d in DEPENDS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    return "WITH " + ",\n".join(CTES[n] for n in order) + "\n" + body


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    raw = (f"(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + "
           f"cos(radians({lat1})) * cos(radians({lat2})) * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2))")
    a = f"(CASE WHEN {raw} > 1.0e0 THEN 1.0e0 WHEN {raw} < 0.0e0 THEN 0.0e0 ELSE {raw} END)"
    return f"(6371.0e0 * (2.0e0 * atan2(sqrt({a}), sqrt(1.0e0 - {a}))))"

