"""DuckDB twins of the stand-in builders, as SQL CTE fragments.

Used only to build the oracle SQL strings the driver runs against the same
Parquet tables; the Spark side never executes these.
"""

from __future__ import annotations

EVENTS_WITH_NULLS = """events_n AS (
  SELECT event_id, ts,
         CASE WHEN user_id <> 0 THEN user_id END AS user_id,
         nullif(event_type, 'error') AS event_type,
         CASE WHEN value >= 5 THEN value END AS value,
         CASE WHEN NOT contains(props, '"k": 1') THEN props END AS props
  FROM events)"""

ORDERS_WITH_NULLS = """orders_n AS (
  SELECT o_orderkey,
         CASE WHEN o_custkey >= 100 THEN o_custkey END AS o_custkey,
         nullif(o_orderstatus, 'P') AS o_orderstatus,
         CASE WHEN o_totalprice >= 5000 THEN o_totalprice END AS o_totalprice,
         o_orderdate,
         nullif(o_orderpriority, '5-LOW') AS o_orderpriority
  FROM orders)"""

LISTS = """lists AS (
  SELECT l.l_orderkey AS o_orderkey,
         string_agg(DISTINCT n.n_name, ', ' ORDER BY n.n_name) AS country
  FROM lineitem l
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  GROUP BY l.l_orderkey)"""

VALID = """valid_countries AS (
  SELECT n_name AS country FROM nation WHERE n_regionkey <> 4)"""

LANG_MAP = """lang_map AS (
  SELECT n.n_name AS country,
         CASE WHEN r.r_name = 'ASIA'
              THEN ['lang_' || lower(r.r_name), 'lang_' || lower(n.n_name)]
              ELSE ['lang_' || lower(r.r_name)] END AS Languages
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
  WHERE NOT (r.r_name = 'EUROPE' AND n.n_nationkey > 15)
  UNION ALL
  SELECT n_name, ['lang_extra'] FROM nation WHERE n_name = 'NATION_1')"""

TITLES = LISTS + """,
titles AS (
  SELECT 's' || CAST(o.o_orderkey AS VARCHAR) AS show_id,
         CASE WHEN o.o_orderstatus = 'O' THEN 'TV Show' ELSE 'Movie' END AS type,
         'Order ' || CAST(o.o_orderkey AS VARCHAR) AS title,
         CASE WHEN o.o_orderpriority <> '5-LOW' THEN 'Clerk ' || o.o_orderpriority END AS director,
         CASE WHEN o.o_custkey >= 100 THEN 'Customer ' || CAST(o.o_custkey AS VARCHAR) END AS "cast",
         CASE WHEN o.o_orderpriority = '3-MEDIUM' THEN ', ' || lists.country ELSE lists.country END AS country,
         CASE WHEN o.o_orderpriority = '1-URGENT' AND o.o_orderstatus = 'P' THEN 'Unknown'
              ELSE strftime(o.o_orderdate, '%B %-d, %Y') END AS date_added,
         CASE WHEN o.o_orderpriority = '2-HIGH' AND o.o_orderstatus = 'P' THEN 'TV-PG'
              ELSE CAST(year(o.o_orderdate) AS VARCHAR) END AS release_year,
         o.o_orderpriority AS rating,
         CASE WHEN o.o_orderstatus = 'O'
              THEN CAST(CAST(floor(o.o_totalprice / 100000) AS BIGINT) + 1 AS VARCHAR)
                   || CASE WHEN floor(o.o_totalprice / 100000) = 0 THEN ' Season' ELSE ' Seasons' END
              ELSE CAST(CAST(floor(o.o_totalprice / 4000) AS BIGINT) AS VARCHAR) || ' min' END AS duration,
         CASE o.o_orderstatus WHEN 'F' THEN 'Dramas' WHEN 'O' THEN 'Docuseries' ELSE 'Comedies' END
           || ', ' || CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'International' ELSE 'Independent' END
           AS listed_in,
         CASE WHEN o.o_totalprice >= 5000 THEN 'Order of customer ' || CAST(o.o_custkey AS VARCHAR) END AS description
  FROM orders o LEFT JOIN lists ON lists.o_orderkey = o.o_orderkey)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
