"""Raw tables with planted faults, derived from the given tables.

The given tables are almost clean, so each view below spoils them by rule, always over all
rows. The text is SQL that Spark and the checking engine both understand; it only prepares
input; `day` says in which of the daily runs a row arrives. What the library computes from it, and what the check computes, share nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

USERS = """
SELECT
  concat('  U', cast(CASE WHEN c_custkey % 97 = 0 AND c_custkey > 0 THEN c_custkey - 1
                          ELSE c_custkey END AS string), ' ') AS user_id,
  CASE WHEN c_custkey % 41 = 0 THEN ''
       WHEN c_custkey % 53 = 0 THEN 'not-an-email'
       WHEN c_custkey % 29 = 0 AND c_custkey > 0
         THEN concat('  User', cast(c_custkey - 1 AS string), '@Example.COM ')
       ELSE concat('user', cast(c_custkey AS string), '@example.com') END AS email,
  concat('org-', cast(c_nationkey % 7 AS string)) AS org_id,
  CASE c_custkey % 6 WHEN 0 THEN 'Teacher ' WHEN 1 THEN 'student' WHEN 2 THEN ' ADMIN'
       WHEN 3 THEN 'district_admin' WHEN 4 THEN 'other'
       ELSE CASE WHEN c_custkey % 5 = 0 THEN 'principal' ELSE 'student' END END AS role,
  CASE c_nationkey % 8 WHEN 0 THEN ' ny ' WHEN 1 THEN 'Ca' WHEN 2 THEN 'Texas'
       WHEN 3 THEN ' CAX ' WHEN 4 THEN 'zz9' WHEN 5 THEN 'New York' WHEN 6 THEN 'AL'
       ELSE '' END AS state,
  CASE WHEN c_custkey % 10 = 0 THEN ''
       ELSE concat('D', cast(c_nationkey AS string)) END AS district_id,
  concat('2024-01-', lpad(cast(1 + c_custkey % 20 AS string), 2, '0')) AS day
FROM customer
"""

DISTRICTS = """
SELECT
  CASE WHEN n_nationkey = 7 THEN 'D7-old'
       ELSE concat(' D', cast(n_nationkey AS string)) END AS district_id,
  CASE n_nationkey % 20 WHEN 0 THEN 'NYC' WHEN 1 THEN ' nyc '
       WHEN 2 THEN '  Northside Unified' WHEN 3 THEN 'Northside Unified '
       ELSE concat('District ', cast(n_nationkey % 20 AS string)) END AS district_name,
  CASE n_nationkey % 6 WHEN 0 THEN 'alabama' WHEN 1 THEN 'tx' WHEN 2 THEN ' texas'
       WHEN 3 THEN 'N.Y.' WHEN 4 THEN 'California' ELSE 'ak' END AS state,
  concat('2024-01-', lpad(cast(1 + n_nationkey % 3 AS string), 2, '0')) AS day
FROM nation
"""

RESOURCES = """
SELECT
  CASE WHEN p_partkey % 211 = 0 THEN ''
       WHEN p_partkey % 83 = 0 THEN concat('R', cast(p_partkey - 1 AS string))
       ELSE concat('R', cast(p_partkey AS string)) END AS resource_id,
  CASE p_size % 7 WHEN 0 THEN 'Lesson' WHEN 1 THEN ' assessment' WHEN 2 THEN 'ACTIVITY '
       WHEN 3 THEN 'module' WHEN 4 THEN 'pathway' WHEN 5 THEN 'lesson'
       ELSE CASE WHEN p_partkey % 4 = 0 THEN 'video' ELSE 'module' END END AS type,
  concat(' ', p_type, ' ') AS subject,
  CASE p_size % 9 WHEN 0 THEN 'K-2' WHEN 1 THEN ' Grades Pre K to 2' WHEN 2 THEN 'Third to Fifth'
       WHEN 3 THEN 'grades 3-5 ' WHEN 4 THEN 'Middle School' WHEN 5 THEN '6-8'
       WHEN 6 THEN 'HIGH SCHOOL' WHEN 7 THEN '9-12' ELSE 'college' END AS grade_band,
  p_size - CASE WHEN p_partkey % 17 = 0 THEN 100 ELSE 0 END AS view_count,
  concat('2024-01-', lpad(cast(1 + p_partkey % 20 AS string), 2, '0')) AS day
FROM part
"""

# Every fifth event or so completes something, so that there is a completion rate. The times
# are spelled in four ways; some are not times at all.
EVENTS = """
SELECT
  concat('E', cast(CASE WHEN event_id % 307 = 0 AND event_id > 0 THEN event_id - 1
                        ELSE event_id END AS string)) AS event_id,
  CASE WHEN event_id % 61 = 0 THEN concat('U', cast(user_id + 100000000 AS string))
       ELSE concat('U', cast(user_id AS string)) END AS user_id,
  CASE WHEN event_id % 89 = 0 THEN ' '
       WHEN event_id % 71 = 0 THEN concat('X', cast(event_id AS string))
       ELSE concat('R', cast(user_id + 1 AS string)) END AS resource_id,
  CASE WHEN event_id % 113 = 0 THEN ''
       WHEN event_type = 'purchase' THEN ' Complete'
       ELSE upper(event_type) END AS event_type,
  CASE WHEN event_id % 101 = 0 THEN 'garbage'
       WHEN event_id % 4 = 0 THEN substring(cast(ts AS string), 1, 19)
       WHEN event_id % 4 = 1 THEN concat(substring(cast(ts AS string), 6, 2), '/',
              substring(cast(ts AS string), 9, 2), '/', substring(cast(ts AS string), 1, 4),
              ' ', substring(cast(ts AS string), 12, 8))
       WHEN event_id % 4 = 2 THEN concat(substring(cast(ts AS string), 1, 10), 'T',
              substring(cast(ts AS string), 12, 8), '+00:00')
       ELSE concat('January ', cast(cast(substring(cast(ts AS string), 9, 2) AS int) AS string),
              ' 2024 ', substring(cast(ts AS string), 12, 5)) END AS event_ts,
  substring(cast(ts AS string), 1, 10) AS day
FROM events
"""

NEWSLETTER = """
SELECT
  concat('user', cast(o_custkey AS string), '@example.com') AS email,
  substring(cast(o_orderdate AS string), 1, 10) AS subscribed_at,
  CASE WHEN o_orderkey % 7 = 0 THEN ''
       WHEN o_orderkey % 3 = 0 THEN concat(substring(cast(o_orderdate AS string), 1, 10), ' 10:30 PM')
       ELSE concat(substring(cast(o_orderdate AS string), 1, 10), ' 10:00') END AS opened_at,
  CASE WHEN o_orderkey % 5 = 0 THEN ''
       WHEN o_orderkey % 11 = 0 THEN concat(substring(cast(o_orderdate AS string), 1, 10), ' 08:00')
       ELSE concat(substring(cast(o_orderdate AS string), 1, 10), 'T23:45:00Z') END AS clicked_at,
  concat('2024-01-', lpad(cast(1 + o_orderkey % 20 AS string), 2, '0')) AS day
FROM orders
"""

RAW = {
    "users": USERS,
    "districts": DISTRICTS,
    "resources": RESOURCES,
    "events": EVENTS,
    "newsletter": NEWSLETTER,
}
BASE = {
    "users": "customer", "districts": "nation", "resources": "part", "events": "events",
    "newsletter": "orders",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A spoiled raw table. The source is bound by argument, not by a shared view name."""
    base = BASE[name]
    text = RAW[name].replace(f"FROM {base}", "FROM {source}")
    return spark.sql(text, source=table(spark, sf_dir, base))
