"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Tables are the driver's pre-registered views. Shared stand-ins are written
once as CTE text and spliced in; every computed column has the same alias as
the Spark query.
"""

from __future__ import annotations

AREA = "'S' || lpad(CAST({k} AS VARCHAR), 8, '0')"

PANEL = f"""panel AS (
  SELECT {AREA.format(k='c.c_nationkey')} AS area_code,
         CAST(date_trunc('month', o.o_orderdate) AS DATE) AS date,
         CAST(count(*) AS BIGINT) AS count,
         round(sum(o.o_totalprice), 2) AS value
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  GROUP BY 1, 2)"""

SUPPLY_PANEL = f"""supply AS (
  SELECT {AREA.format(k='s.s_nationkey')} AS area_code,
         CAST(date_trunc('month', l.l_shipdate) AS DATE) AS date,
         round(sum(l.l_quantity), 2) AS qty,
         round(sum(l.l_extendedprice), 2) AS gross
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
  GROUP BY 1, 2)"""

NAMES = f"""names AS (SELECT {AREA.format(k='n_nationkey')} AS area_code, n_name AS area_name FROM nation)"""

ANCHORS = """bounds AS (SELECT area_code, min(date) AS d0, max(date) AS d1 FROM panel GROUP BY 1)"""


def norm(x: str) -> str:
    """The name key (H1) in DuckDB SQL: same steps; accents via ``strip_accents``."""
    s = f"lower(coalesce(CAST({x} AS VARCHAR), ''))"
    s = f"replace({s}, ' and ', '')"
    s = f"translate({s}, '&/,.-''()’', '')"
    s = f"regexp_replace({s}, '[\\s\\x0b\\x1c-\\x1f\\x85\\pZ]+', '', 'g')"
    s = f"replace({s}, 'agus', '')"
    s = f"regexp_replace({s}, 'ward$', '')"
    return f"regexp_replace(strip_accents({s}), '[^\\x00-\\x7F]', '', 'g')"


def gapped_fill(src: str, key: str, order: str, val: str, extra: str = "") -> str:
    """Positional linear fill (F3) of ``val`` over ``src`` as SQL select text."""
    w = f"PARTITION BY {key} ORDER BY {order}"
    return f"""
  SELECT *,
    last_value({val} IGNORE NULLS) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS y0,
    last_value(CASE WHEN {val} IS NOT NULL THEN pos END IGNORE NULLS)
      OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS i0,
    first_value({val} IGNORE NULLS) OVER ({w} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS y1,
    first_value(CASE WHEN {val} IS NOT NULL THEN pos END IGNORE NULLS)
      OVER ({w} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS i1
  FROM {src}"""


FILL = "CASE WHEN y1 IS NULL OR i1 = i0 THEN y0 ELSE y0 + (y1 - y0) / (i1 - i0) * (pos - i0) END"

SQL: dict[str, str] = {}

SQL["monthly_area_counts"] = f"""
WITH r AS (
  SELECT n.n_name AS ward_name, c.c_mktsegment AS council_name,
         year(o.o_orderdate) AS year, month(o.o_orderdate) AS month
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  WHERE (c.c_mktsegment IS NULL OR c.c_mktsegment NOT IN ('AUTOMOBILE'))
    AND (n.n_name IS NULL OR n.n_name NOT IN ('NATION_3'))),
s AS (SELECT {norm('ward_name')} AS ward_name, year, month, CAST(count(*) AS BIGINT) AS count FROM r GROUP BY 1, 2, 3),
l AS (SELECT {norm('n_name')} AS ward_name, {AREA.format(k='n_nationkey')} AS ward_code FROM nation)
SELECT s.count, l.ward_code, make_date(CAST(s.year AS INTEGER), CAST(s.month AS INTEGER), 1) AS date
FROM s LEFT JOIN l ON s.ward_name = l.ward_name"""

SQL["group_sum"] = """
SELECT l_returnflag, l_linestatus, round(coalesce(sum(l_quantity), 0), 2) AS l_quantity,
       round(coalesce(sum(l_extendedprice), 0), 2) AS l_extendedprice
FROM lineitem WHERE l_returnflag IS NOT NULL AND l_linestatus IS NOT NULL GROUP BY 1, 2"""

SQL["group_sum_wide"] = """
SELECT c.c_mktsegment AS council_name, n.n_name AS ward_name, CAST(year(o.o_orderdate) AS INTEGER) AS year,
       CAST(month(o.o_orderdate) AS INTEGER) AS month, o.o_orderstatus AS crime_group, o.o_orderpriority AS group_description,
       CAST(count(*) AS BIGINT) AS count
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE c.c_mktsegment IS NOT NULL AND n.n_name IS NOT NULL AND o.o_orderstatus IS NOT NULL
  AND o.o_orderpriority IS NOT NULL
GROUP BY 1, 2, 3, 4, 5, 6"""

SQL["lookup_left_join"] = """
SELECT c.c_custkey, c.c_name AS c_name_x, c.c_nationkey, n.n_name AS c_name_y, n.n_regionkey
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey + 1"""

SQL["exclude_values"] = """
SELECT c_custkey, c_mktsegment FROM customer
WHERE c_mktsegment IS NULL OR c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING')"""

SQL["contains_all"] = """
SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, '(?i)R') AND regexp_matches(p_name, '(?i)i.g')"""

SQL["prefix_filter"] = "SELECT c_custkey, c_name FROM customer WHERE starts_with(c_name, 'Customer#00000001')"

SQL["split_rows"] = """
SELECT o_orderkey, o_orderstatus, CASE WHEN coalesce(o_orderstatus = 'F', false) THEN 'eq' ELSE 'ne' END AS half
FROM orders"""

SQL["rename_columns"] = "SELECT n_nationkey AS ward_code, n_name AS ward_name, n_regionkey FROM nation"

SQL["subset_columns"] = "SELECT o_orderkey, o_custkey, o_totalprice FROM orders"

SQL["drop_columns_by_pattern"] = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_returnflag,
       l_linestatus FROM lineitem"""

SQL["select_by_suffix"] = f"""
SELECT {AREA.format(k='n_nationkey')} AS ward_code, n_name AS name, n_regionkey AS region FROM nation"""

SQL["set_date"] = "SELECT n_nationkey, n_name, DATE '2011-01-01' AS date FROM nation"

SQL["stack_frames"] = """
SELECT c_custkey AS id, c_name AS name, CAST(NULL AS DOUBLE) AS acctbal FROM customer
UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier"""

SQL["combine_year_month"] = """
SELECT o_orderkey, make_date(CAST(year(o_orderdate) AS INTEGER), CAST(month(o_orderdate) AS INTEGER), 1) AS date
FROM orders"""

SQL["month_diff"] = """
WITH d AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT o_orderkey, CAST((year(d) - 1995) * 12 + (month(d) - 1) AS BIGINT) AS months,
       CAST(CASE WHEN d >= DATE '1995-01-31' AND day(d) < 31 AND d <> last_day(d)
                 THEN (year(d) - 1995) * 12 + (month(d) - 1) - 1
                 ELSE (year(d) - 1995) * 12 + (month(d) - 1) END AS BIGINT) AS whole_months
FROM d"""

SQL["normalise_column_names"] = "SELECT n_nationkey AS nation_key, n_name AS nation_name, n_regionkey AS regionkey FROM nation"

SQL["find_column"] = "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem"

SQL["require_columns"] = "SELECT c_custkey, c_acctbal FROM customer"

SQL["ratio_column"] = """
SELECT l_orderkey, l_linenumber, round(l_discount / nullif(l_tax, 0), 6) AS discount_per_tax FROM lineitem"""

SQL["fractions"] = """
SELECT l_orderkey, l_linenumber, round(l_discount / nullif(l_tax, 0), 6) AS l_discount,
       round(l_quantity / nullif(l_discount / nullif(l_tax, 0), 0), 6) AS l_quantity FROM lineitem"""

SQL["row_sum"] = """
SELECT l_orderkey, l_linenumber,
       round(coalesce(l_quantity, 0) + coalesce(l_discount, 0) + coalesce(l_tax, 0), 6) AS total FROM lineitem"""

SQL["apply_weight"] = """
SELECT l_orderkey, l_linenumber, round(l_quantity * l_discount, 6) AS l_quantity,
       round(l_extendedprice * l_discount, 6) AS l_extendedprice, l_discount FROM lineitem"""

SQL["density"] = f"""
WITH {PANEL},
area AS (SELECT {AREA.format(k='n_nationkey')} AS area_code, (n_regionkey + 1) * 1.5e6 * 1e-6 AS area FROM nation)
SELECT p.area_code, p.date, round(p.count / nullif(a.area, 0), 6) AS population_density
FROM panel p LEFT JOIN area a ON p.area_code = a.area_code"""

SQL["log_features"] = f"""
WITH {PANEL}
SELECT area_code, date, round(ln(1 + count), 6) AS count_log1p,
       round(CASE WHEN value > 0 THEN ln(value) END, 6) AS value_ln FROM panel"""

SQL["to_number"] = """
SELECT event_id, TRY_CAST(regexp_extract(props, '(-?\\d+(\\.\\d+)?)', 1) AS DOUBLE) AS k FROM events"""

SQL["to_number_strict"] = """
SELECT c_custkey, CAST(c_acctbal AS DOUBLE) AS acctbal, CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal END AS known FROM customer"""

SQL["value_edits"] = """
SELECT n_nationkey, CASE n_name WHEN 'NATION_1' THEN 'nation one' WHEN 'NATION_2' THEN 'nation two'
                     WHEN 'NATION_24' THEN 'nation twenty-four' ELSE n_name END AS n_name FROM nation"""

SQL["disambiguate"] = f"""
WITH {NAMES}
SELECT area_code, CASE area_code WHEN 'S00000003' THEN 'nationthree_north'
                  WHEN 'S00000013' THEN 'nationthirteen_south' ELSE area_name END AS area_name FROM names"""

SQL["apply_column_function"] = "SELECT p_partkey, upper(trim(p_name)) AS p_name FROM part"

SQL["to_month_date"] = """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date,
       make_date(CAST(year(o_orderdate) AS INTEGER), 1, 1) AS year_start FROM orders"""

SQL["normalise_name"] = f"SELECT doc_id, {norm('text')} AS name_key FROM documents"

SQL["normalise_name_parts"] = f"""
SELECT p_partkey, {norm("concat_ws(' and ', p_name, p_type)")} AS name_key FROM part"""

SQL["pivot_wide"] = """
WITH long AS (
  SELECT l_suppkey, l_returnflag, round(coalesce(sum(l_quantity), 0), 2) AS q FROM lineitem
  WHERE l_suppkey IS NOT NULL AND l_returnflag IS NOT NULL GROUP BY 1, 2)
SELECT l_suppkey, max(CASE WHEN l_returnflag = 'A' THEN q END) AS "A",
       max(CASE WHEN l_returnflag = 'N' THEN q END) AS "N", max(CASE WHEN l_returnflag = 'R' THEN q END) AS "R"
FROM long GROUP BY 1"""

SQL["expand_months"] = f"""
WITH {PANEL}, {ANCHORS},
a AS (SELECT p.area_code, p.date, p.count FROM panel p JOIN bounds b ON p.area_code = b.area_code
      AND (p.date = b.d0 OR p.date = b.d1)),
g AS (SELECT area_code, CAST(unnest(generate_series(d0, d1, INTERVAL 1 MONTH)) AS DATE) AS date FROM bounds)
SELECT g.area_code, g.date, a.count FROM g LEFT JOIN a ON g.area_code = a.area_code AND g.date = a.date"""

SQL["densify_linear"] = f"""
WITH {PANEL}, {ANCHORS},
v AS (SELECT b.area_code, b.d0, b.d1, p0.value AS v0, p1.value AS v1 FROM bounds b
      JOIN panel p0 ON p0.area_code = b.area_code AND p0.date = b.d0
      JOIN panel p1 ON p1.area_code = b.area_code AND p1.date = b.d1),
g AS (SELECT *, CAST(unnest(generate_series(d0, d1, INTERVAL 1 MONTH)) AS DATE) AS date FROM v),
i AS (SELECT *, datediff('month', d0, date) AS i, datediff('month', d0, d1) AS n FROM g)
SELECT area_code, date, round(CASE WHEN date = d1 THEN v1 WHEN i = 0 THEN v0
                                   ELSE coalesce(v0 + ((v1 - v0) * i) / n, v0) END, 6) AS value FROM i"""

SQL["extend_flat"] = f"""
WITH {PANEL},
l AS (SELECT area_code, max(date) AS d, arg_max(count, date) AS c, arg_max(value, date) AS v FROM panel GROUP BY 1)
SELECT area_code, date, count, value FROM panel
UNION ALL
SELECT area_code, CAST(unnest(generate_series(d + INTERVAL 1 MONTH, DATE '2002-01-01', INTERVAL 1 MONTH)) AS DATE),
       c, v FROM l WHERE d < DATE '2002-01-01'"""

SQL["interpolate_linear"] = f"""
WITH {PANEL},
g AS (SELECT area_code, date, count, CASE WHEN month(date) NOT IN (3, 4, 7) THEN value END AS v,
             row_number() OVER (PARTITION BY area_code ORDER BY date) AS pos FROM panel),
f AS ({gapped_fill('g', 'area_code', 'date', 'v')})
SELECT area_code, date, count, round({FILL}, 6) AS value FROM f"""

SQL["resample_monthly"] = f"""
WITH m AS (
  SELECT {AREA.format(k='c.c_nationkey')} AS area_code, CAST(date_trunc('month', o.o_orderdate) AS DATE) AS date,
         avg(round(o.o_totalprice * 100)) AS v
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2),
b AS (SELECT area_code, min(date) AS d0, max(date) AS d1 FROM m GROUP BY 1),
g AS (SELECT area_code, CAST(unnest(generate_series(d0, d1, INTERVAL 1 MONTH)) AS DATE) AS date FROM b),
s AS (SELECT g.area_code, g.date, m.v, row_number() OVER (PARTITION BY g.area_code ORDER BY g.date) AS pos
      FROM g LEFT JOIN m ON g.area_code = m.area_code AND g.date = m.date),
f AS ({gapped_fill('s', 'area_code', 'date', 'v')})
SELECT area_code, date, round({FILL}, 6) AS value FROM f"""

SQL["sheets_to_monthly"] = f"""
WITH y AS (
  SELECT {AREA.format(k='c.c_nationkey')} AS area_code, make_date(CAST(year(o.o_orderdate) AS INTEGER), 1, 1) AS date,
         CAST(count(*) AS DOUBLE) AS v
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2),
b AS (SELECT area_code, min(date) AS d0, max(date) AS d1 FROM y GROUP BY 1),
g AS (SELECT area_code, CAST(unnest(generate_series(d0, d1, INTERVAL 1 MONTH)) AS DATE) AS date FROM b),
s AS (SELECT g.area_code, g.date, y.v, row_number() OVER (PARTITION BY g.area_code ORDER BY g.date) AS pos
      FROM g LEFT JOIN y ON g.area_code = y.area_code AND g.date = y.date),
f AS ({gapped_fill('s', 'area_code', 'date', 'v')})
SELECT area_code, date, round({FILL}, 4) AS total FROM f"""

_W = "PARTITION BY area_code ORDER BY date"

SQL["lag_features"] = f"""
WITH {PANEL},
l AS (SELECT area_code, date, count, lag(count, 1) OVER ({_W}) AS crime_last_month,
             lag(count, 2) OVER ({_W}) AS crime_last_two_months, lag(count, 3) OVER ({_W}) AS crime_last_three_months
      FROM panel)
SELECT * FROM l WHERE crime_last_three_months IS NOT NULL"""

SQL["rolling_mean"] = f"""
WITH {PANEL}
SELECT area_code, date, count,
  round(CASE WHEN count(count) OVER ({_W} ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) = 3
        THEN avg(count) OVER ({_W} ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) END, 6) AS crime_3month_avg
FROM panel"""

SQL["latest_row"] = f"""
WITH {PANEL}
SELECT area_code, date, count, value FROM panel
QUALIFY row_number() OVER (PARTITION BY area_code ORDER BY date DESC) = 1"""

SQL["first_k_areas"] = f"""
WITH {PANEL}
SELECT * FROM panel WHERE area_code IN (SELECT DISTINCT area_code FROM panel ORDER BY 1 LIMIT 4)"""

SQL["ordered_split"] = f"""
WITH {PANEL},
n AS (SELECT count(*) AS n FROM panel),
r AS (SELECT *, row_number() OVER (ORDER BY area_code, date) - 1 AS pos FROM panel)
SELECT area_code, date, count, value, CASE WHEN pos >= n - ceil(0.1 * n) THEN 'test' ELSE 'train' END AS split
FROM r, n"""

SQL["date_split"] = f"""
WITH {PANEL},
n AS (SELECT ceil(0.1 * count(*)) AS need FROM panel),
pd AS (SELECT date, count(*) AS c FROM panel GROUP BY 1),
cum AS (SELECT date, coalesce(sum(c) OVER (ORDER BY date DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
        AS before FROM pd),
cut AS (SELECT min(date) AS cutoff FROM cum, n WHERE before < need)
SELECT area_code, date, count, value, CASE WHEN date >= cutoff THEN 'test' ELSE 'train' END AS split
FROM panel, cut"""

SQL["check_nulls"] = """
WITH j AS (SELECT c.c_custkey, n.n_name, n.n_regionkey FROM customer c
           LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey + 1),
s AS (SELECT 'c_custkey' AS "column", CAST(count(*) FILTER (WHERE c_custkey IS NULL) AS BIGINT) AS null_count FROM j
      UNION ALL SELECT 'n_name', CAST(count(*) FILTER (WHERE n_name IS NULL) AS BIGINT) FROM j
      UNION ALL SELECT 'n_regionkey', CAST(count(*) FILTER (WHERE n_regionkey IS NULL) AS BIGINT) FROM j)
SELECT * FROM s WHERE null_count > 0"""

SQL["check_month_series"] = f"""
WITH {PANEL},
m AS (SELECT area_code, date AS found, row_number() OVER ({_W}) AS position,
             min(date) OVER (PARTITION BY area_code) AS s FROM panel),
e AS (SELECT area_code, found, position, CAST(s + to_months(CAST(position - 1 AS INTEGER)) AS DATE) AS expected
      FROM m)
SELECT area_code, arg_min(expected, position) AS expected, arg_min(found, position) AS found,
       CAST(min(position) AS BIGINT) AS position
FROM e WHERE found <> expected GROUP BY 1"""

SQL["check_schema"] = f"""
WITH {PANEL},
n AS (SELECT count(*) FILTER (WHERE month(date) = 2) AS n FROM panel)
SELECT 'count' AS "column", 'type bigint != double' AS problem
UNION ALL SELECT 'population', 'missing'
UNION ALL SELECT 'value', 'nulls: ' || CAST(n AS VARCHAR) FROM n WHERE n > 0"""

# --- sources, sinks, links, views, panel joins -----------------------------------------------

SQL["trimmed_csv"] = "SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer"

SQL["read_csv"] = "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier"

SQL["pick_sheet"] = "SELECT o_orderkey, o_totalprice FROM orders WHERE year(o_orderdate) = 1997"

SQL["multi_file_read"] = """
SELECT CAST(year(o_orderdate) AS VARCHAR) AS source_key, o_orderkey, o_totalprice FROM orders"""

SQL["promote_header"] = """
SELECT CAST(n_nationkey AS BIGINT) AS "Nation Key", n_name AS "Nation Name", CAST(n_regionkey AS BIGINT) AS "Region Key"
FROM nation"""

SQL["replace_table"] = f"WITH {PANEL} SELECT * FROM panel"

SQL["gated_replace"] = f"WITH {SUPPLY_PANEL} SELECT * FROM supply"

SQL["extract_lookup"] = f"SELECT 'P' || CAST(s_suppkey AS VARCHAR) AS area_code, {norm('s_name')} AS s_name FROM supplier"

LINKS = """
a AS (SELECT page_id, url, regexp_extract_all(html, '(?is)<a\\b[^>]*>.*?</a>') AS arr FROM pages),
l AS (SELECT page_id, url, unnest(range(0, len(arr))) AS link_pos, unnest(arr) AS anchor FROM a),
t AS (SELECT *, regexp_extract(anchor, '(?is)^<a\\b([^>]*)>', 1) AS tag,
             regexp_extract(anchor, '(?is)^<a\\b[^>]*>(.*)</a>$', 1) AS inner_html FROM l),
links AS (
  SELECT page_id, url, CAST(link_pos AS BIGINT) AS link_pos,
         CASE WHEN regexp_matches(tag, '(?is)(?:^|\\s)href\\s*=')
              THEN replace(regexp_extract(tag, '(?is)(?:^|\\s)href\\s*=\\s*["'']([^"'']*)["'']', 1), '&amp;', '&')
         END AS href,
         replace(regexp_replace(inner_html, '<[^>]*>', '', 'g'), '&amp;', '&') AS text
  FROM t)"""

SQL["links_by_title"] = f"""
WITH {LINKS}
SELECT page_id, link_pos, text AS title, 'https://example.org' || href AS url FROM links
WHERE text IS NOT NULL AND text <> '' AND contains(text, 'the') AND href IS NOT NULL"""

SQL["nth_link_by_regex"] = f"""
WITH {LINKS},
m AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY link_pos) - 1 AS k FROM links
      WHERE regexp_matches(href, '^/[a-z]')),
b AS (SELECT *, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1) AS scheme,
             regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) AS origin,
             regexp_extract(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '^(.*/)', 1) AS dir
      FROM m WHERE k = 1)
SELECT page_id, link_pos, href,
       CASE WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN href
            WHEN starts_with(href, '//') THEN scheme || ':' || href
            WHEN starts_with(href, '/') THEN origin || href
            ELSE origin || CASE WHEN dir = '' THEN '/' ELSE dir END || href END AS url
FROM b"""

SQL["first_link_by_type"] = f"""
WITH {LINKS}
SELECT page_id, arg_min(href, link_pos) AS href, min(link_pos) AS link_pos FROM links
WHERE href IS NOT NULL AND (contains(lower(href), 'th') OR contains(lower(href), 'qu')) GROUP BY 1"""

CRIME = f"""crime AS (SELECT count, CASE WHEN area_code <> 'S00000005' THEN area_code END AS ward_code, date
                    FROM panel)"""

SQL["history_crime"] = f"""
WITH {PANEL}, {CRIME}
SELECT count, ward_code, date FROM crime WHERE ward_code IS NOT NULL AND date IS NOT NULL"""

SQL["history_crime_month"] = SQL["history_crime"] + " AND date = DATE '1997-05-01'"
SQL["history_crime_area"] = SQL["history_crime_month"] + " AND ward_code = 'S00000003'"
SQL["history_optional_area"] = f"WITH {PANEL}, {CRIME} SELECT * FROM crime WHERE ward_code = 'S00000003'"
SQL["area_series_one"] = f"""
WITH {PANEL}, {CRIME}
SELECT *, row_number() OVER (ORDER BY date) AS position FROM crime WHERE ward_code = 'S00000003'"""

SQL["vertex_table"] = """
SELECT 'P' || CAST(s_suppkey AS VARCHAR) AS area_code, 0 AS part, 0 AS ring, CAST(i AS INTEGER) AS seq,
       CAST(s_suppkey % 10 AS DOUBLE) + CASE WHEN i IN (1, 2) THEN 1 ELSE 0 END AS x,
       CAST(floor(s_suppkey / 10) AS DOUBLE) + CASE WHEN i IN (2, 3) THEN 1 ELSE 0 END AS y
FROM supplier, range(4) t(i)"""

SQL["history_optional"] = f"WITH {PANEL}, {CRIME} SELECT * FROM crime"

SQL["area_names"] = f"SELECT {AREA.format(k='n_nationkey')} AS ward_code, n_name AS ward_name FROM nation"

SQL["area_series"] = SQL["history_crime"]

SQL["map_slice"] = f"""
WITH {PANEL}, {NAMES}
SELECT p.area_code, p.date, p.count, p.value, n.area_name,
       round(CASE WHEN p.count > 0 THEN ln(p.count) END, 6) AS log_count
FROM panel p JOIN names n ON p.area_code = n.area_code WHERE p.date = DATE '1998-01-01'"""

SQL["param_sql"] = f"""
WITH {PANEL} SELECT area_code, date, count FROM panel WHERE date >= DATE '1999-01-01' AND count > 5"""

SQL["join_panel"] = f"""
WITH {PANEL}, {SUPPLY_PANEL}, {NAMES}
SELECT p.area_code, p.date, p.count, p.value, s.qty, s.gross, n.area_name
FROM panel p JOIN supply s ON p.area_code = s.area_code AND p.date = s.date
JOIN names n ON p.area_code = n.area_code"""

TREND = f"""{ANCHORS},
tv AS (SELECT b.area_code, b.d0, b.d1, p0.value AS v0, p1.value AS v1 FROM bounds b
       JOIN panel p0 ON p0.area_code = b.area_code AND p0.date = b.d0
       JOIN panel p1 ON p1.area_code = b.area_code AND p1.date = b.d1),
tg AS (SELECT *, CAST(unnest(generate_series(d0, d1, INTERVAL 1 MONTH)) AS DATE) AS date FROM tv),
ti AS (SELECT *, datediff('month', d0, date) AS i, datediff('month', d0, d1) AS n FROM tg),
trend AS (SELECT area_code, date, round(CASE WHEN date = d1 THEN v1 WHEN i = 0 THEN v0
                                        ELSE coalesce(v0 + ((v1 - v0) * i) / n, v0) END, 6) AS value_trend FROM ti)"""

SQL["area_history"] = f"""
WITH {PANEL}, {SUPPLY_PANEL}, {NAMES}, {TREND}
SELECT p.area_code, p.date, p.count, p.value, s.qty, s.gross, t.value_trend, n.area_name
FROM panel p JOIN supply s ON p.area_code = s.area_code AND p.date = s.date
JOIN trend t ON p.area_code = t.area_code AND p.date = t.date
JOIN names n ON p.area_code = n.area_code"""

# --- spatial ----------------------------------------------------------------------------------

SQUARES = f"""
sa AS (SELECT 'P' || CAST(s_suppkey AS VARCHAR) AS source_code, s_acctbal,
              CAST(s_suppkey % 10 AS DOUBLE) AS x0, CAST(floor(s_suppkey / 10) AS DOUBLE) AS y0, 1.0 AS w
       FROM supplier),
sh AS (SELECT (floor(max(s_suppkey) / 10) + 1.5) / 5 AS h FROM supplier),
sb AS (SELECT {AREA.format(k='n_nationkey')} AS target_code, CAST(n_nationkey % 5 AS DOUBLE) * 2.04 AS x0,
              CAST(n_nationkey % 5 + 1 AS DOUBLE) * 2.04 AS x1, floor(n_nationkey / 5) * h AS y0,
              (floor(n_nationkey / 5) + 1) * h AS y1 FROM nation, sh),
ov AS (SELECT sa.source_code, sb.target_code, sa.s_acctbal, sa.w * sa.w AS src_area,
              greatest(0, least(sa.x0 + sa.w, sb.x1) - greatest(sa.x0, sb.x0))
              * greatest(0, least(sa.y0 + sa.w, sb.y1) - greatest(sa.y0, sb.y0)) AS a,
              least(sa.w * sa.w, (sb.x1 - sb.x0) * (sb.y1 - sb.y0)) AS small
       FROM sa, sb),
pairs AS (SELECT * FROM ov WHERE a > 1e-9 * small)"""

SQL["polygon_area"] = """
SELECT 'Q' || CAST(p_partkey AS VARCHAR) AS area_code,
       round(0.65 * (1 + p_size / 50.0) * (1 + (p_retailprice % 100) / 100.0), 6) AS area FROM part"""

SQL["overlap_area"] = f"WITH {SQUARES} SELECT source_code, target_code, round(a, 6) AS overlap_area FROM pairs"

SQL["overlap_weight"] = f"WITH {SQUARES} SELECT source_code, target_code, round(a / src_area, 6) AS weight FROM pairs"

SQL["crosswalk_reweight"] = f"""
WITH {SQUARES}
SELECT target_code, round(sum(s_acctbal * (a / src_area)), 4) AS acctbal, round(sum(a / src_area), 6) AS suppliers
FROM pairs GROUP BY 1"""

# Both layers are rectangles, so an overlap has the four corners of what they share.
SQL["clip_overlaps"] = f"""
WITH {SQUARES},
shared AS (SELECT p.source_code, p.target_code, p.a, greatest(sa.x0, sb.x0) AS x0, least(sa.x0 + sa.w, sb.x1) AS x1,
                  greatest(sa.y0, sb.y0) AS y0, least(sa.y0 + sa.w, sb.y1) AS y1
           FROM pairs p JOIN sa ON sa.source_code = p.source_code JOIN sb ON sb.target_code = p.target_code)
SELECT source_code, target_code, round(CASE WHEN i IN (0, 3) THEN x0 ELSE x1 END, 6) AS x,
       round(CASE WHEN i < 2 THEN y0 ELSE y1 END, 6) AS y, CAST(1 AS BIGINT) AS rings, round(a, 6) AS area
FROM shared, range(4) AS t(i)"""

SQL["prepare_boundaries"] = f"""
SELECT {AREA.format(k='n_nationkey')} AS ward_code_2022, {norm('n_name')} AS ward_name_2022, CAST(6.25 AS DOUBLE) AS area_2022
FROM nation"""

CORNERS = """
       CASE WHEN i IN (1, 2) THEN 1 ELSE 0 END AS dx, CASE WHEN i IN (2, 3) THEN 1 ELSE 0 END AS dy"""

SQL["boundary_features"] = f"""
WITH c AS (SELECT s_suppkey AS k, i, {CORNERS} FROM supplier, range(5) AS t(i))
SELECT 'P' || CAST(k AS VARCHAR) AS area_code, 'Feature' AS feature_type, 'MultiPolygon' AS geometry_type,
       CAST(i AS BIGINT) AS position, CAST(k % 10 + dx AS DOUBLE) AS x, CAST(floor(k / 10) + dy AS DOUBLE) AS y FROM c"""

SQL["project_vertices"] = f"""
WITH c AS (SELECT s_suppkey AS k, i, {CORNERS} FROM supplier, range(4) AS t(i))
SELECT 'P' || CAST(k AS VARCHAR) AS area_code, CAST(i AS INTEGER) AS seq, CAST((k % 10 + dx) * 10 + 250000 AS DOUBLE) AS x,
       CAST((floor(k / 10) + dy) * 10 + 650000 AS DOUBLE) AS y, true AS in_scotland FROM c"""

SQL["boundary_job"] = f"""
WITH c AS (SELECT n_nationkey AS k, i, {CORNERS} FROM nation, range(4) AS t(i))
SELECT {AREA.format(k='k')} AS ward_code, CAST(i AS BIGINT) AS seq, CAST((k % 4 + dx) * 25000 + 250000 AS DOUBLE) AS x,
       CAST((floor(k / 4) + dy) * 25000 + 650000 AS DOUBLE) AS y FROM c"""

JAGGED = """
cells AS (SELECT 'Q' || CAST(p_partkey AS VARCHAR) AS area_code, p_partkey % 50 AS c, p_partkey // 50 AS r FROM part),
sides AS (SELECT * FROM (VALUES (0, 0, 0, 0, 0), (8, 1, 1, 0, 0), (16, 0, 0, 1, 1), (24, 1, 0, 0, 1))
          AS v(first, across, dc, dr, back)),
steps AS (SELECT area_code, first + k AS seq, across, c + dc AS i, r + dr AS j, CASE WHEN back = 1 THEN 8 - k ELSE k END AS s
          FROM cells, sides, range(8) AS t(k)),
bent AS (SELECT *, (i * 7 + j * 13 + across) % 3 - 1 AS bulge,
                CASE WHEN s IN (0, 8) THEN 0.0 ELSE ((i * 7 + j * 13 + across) % 3 - 1) * 0.2::DOUBLE
                     * (1 - abs(2 * (s / 8.0::DOUBLE) - 1)) + ((i * 31 + j * 17 + s * 11) % 5 - 2) * 0.001::DOUBLE END AS d
         FROM steps),
jagged AS (SELECT area_code, seq, across, i, j, s, bulge,
                  CASE WHEN across = 0 THEN i + s / 8.0::DOUBLE ELSE i + d END AS x,
                  CASE WHEN across = 0 THEN j + d ELSE j + s / 8.0::DOUBLE END AS y FROM bent)"""

# Of a border stay its ends and, if it bulges, the middle: all else is within the tolerance of the lines between those.
SQL["simplify_topology"] = f"""
WITH {JAGGED}
SELECT area_code, CAST(seq AS BIGINT) AS seq, round(x, 6) AS x, round(y, 6) AS y FROM jagged
WHERE s IN (0, 8) OR s = 4 AND bulge <> 0"""

SQL["topology_faults"] = f"""
WITH {JAGGED},
borders AS (SELECT across, i, j, any_value(bulge) AS bulge, count(DISTINCT area_code) AS owners FROM jagged
            GROUP BY across, i, j)
SELECT CAST(sum(CASE WHEN bulge = 0 THEN 1 ELSE 2 END) AS BIGINT) AS segments,
       CAST(sum(CASE WHEN owners = 1 THEN 0 WHEN bulge = 0 THEN 1 ELSE 2 END) AS BIGINT) AS shared,
       CAST(0 AS BIGINT) AS faults FROM borders"""

# --- features and models ----------------------------------------------------------------------

HIST = """hist AS (SELECT p.area_code, p.date, p.count, p.value, s.qty, s.gross
                 FROM panel p JOIN supply s ON p.area_code = s.area_code AND p.date = s.date)"""

DENSITY = f"""darea AS (SELECT {AREA.format(k='n_nationkey')} AS area_code, (n_regionkey + 1) * 1.5 AS area FROM nation),
dens AS (SELECT p.area_code, p.date, p.count / nullif(a.area, 0) AS population_density
         FROM panel p LEFT JOIN darea a ON p.area_code = a.area_code)"""


def trend_sql(src: str, cols: list[str], extra_null: str = "count") -> str:
    aggs = ", ".join(f"regr_slope({c}, x) AS s_{c}, regr_intercept({c}, x) AS i_{c}, avg({c}) AS m_{c}"
                     for c in cols)
    preds = ", ".join(f"coalesce(i_{c}, m_{c}) + coalesce(s_{c}, 0) * n AS {c}" for c in cols)
    return f"""
  tx AS (SELECT *, CAST(row_number() OVER (PARTITION BY area_code ORDER BY date) - 1 AS DOUBLE) AS x FROM {src}),
  tg AS (SELECT area_code, CAST(count(*) AS DOUBLE) AS n, max(date) AS last, {aggs} FROM tx GROUP BY 1),
  fc AS (SELECT area_code, CAST(last + INTERVAL 1 MONTH AS DATE) AS date, CAST(NULL AS BIGINT) AS {extra_null},
                {preds} FROM tg)"""


FEATS = f"""
    lag(count, 1) OVER ({_W}) AS crime_last_month, lag(count, 2) OVER ({_W}) AS crime_last_two_months,
    lag(count, 3) OVER ({_W}) AS crime_last_three_months,
    round(CASE WHEN count(count) OVER ({_W} ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) = 3
          THEN avg(count) OVER ({_W} ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) END, 6) AS crime_3month_avg"""

SQL["trend_forecast"] = f"""
WITH {PANEL}, {SUPPLY_PANEL}, {HIST}, {trend_sql('hist', ['value', 'qty', 'gross'])}
SELECT area_code, date, count, round(value, 4) AS value, round(qty, 4) AS qty, round(gross, 4) AS gross FROM fc"""

SQL["prediction_features"] = f"""
WITH {PANEL}, {SUPPLY_PANEL}, {DENSITY},
h2 AS (SELECT h.area_code, h.date, h.count, h.value, s.qty, s.gross, d.population_density
       FROM panel h JOIN supply s ON h.area_code = s.area_code AND h.date = s.date
       JOIN dens d ON h.area_code = d.area_code AND h.date = d.date),
{trend_sql('h2', ['value', 'qty', 'gross', 'population_density'])},
u AS (SELECT area_code, date, count, value, qty, gross, population_density FROM h2
      UNION ALL SELECT area_code, date, count, value, qty, gross, population_density FROM fc),
l AS (SELECT area_code, date, count, round(value, 4) AS value, round(qty, 4) AS qty, round(gross, 4) AS gross,
             {FEATS}, round(ln(1 + population_density), 6) AS pop_density_log FROM u)
SELECT * FROM l WHERE crime_last_three_months IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY area_code ORDER BY date DESC) = 1"""

SQL["training_features"] = f"""
WITH {PANEL}, {SUPPLY_PANEL}, {NAMES}, {TREND}, {DENSITY},
j AS (SELECT p.area_code, p.date, p.count, p.value, s.qty, s.gross, t.value_trend, d.population_density, n.area_name
      FROM panel p JOIN supply s ON p.area_code = s.area_code AND p.date = s.date
      JOIN trend t ON p.area_code = t.area_code AND p.date = t.date
      JOIN dens d ON p.area_code = d.area_code AND p.date = d.date
      JOIN names n ON p.area_code = n.area_code),
l AS (SELECT area_code, date, count, value, qty, gross, value_trend, area_name, {FEATS},
             round(ln(1 + population_density), 6) AS pop_density_log FROM j)
SELECT * FROM l WHERE crime_last_three_months IS NOT NULL"""

SQL["forecast_months"] = f"""
WITH RECURSIVE {PANEL},
x AS (SELECT area_code, date, CAST(count AS DOUBLE) AS y, avg(count) OVER ({_W} ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS m,
             lag(count, 3) OVER ({_W}) AS third, row_number() OVER (PARTITION BY area_code ORDER BY date DESC) AS back FROM panel),
line AS (SELECT regr_slope(y, m) AS s, regr_intercept(y, m) AS i FROM x WHERE third IS NOT NULL),
ends AS (SELECT area_code, max(date) AS last, max(CASE WHEN back = 1 THEN y END) AS a, max(CASE WHEN back = 2 THEN y END) AS b,
                max(CASE WHEN back = 3 THEN y END) AS c FROM x GROUP BY area_code),
ahead AS (SELECT area_code, last, 0 AS step, a, b, c FROM ends WHERE c IS NOT NULL
          UNION ALL SELECT area_code, last, step + 1, i + s * (a + b + c) / 3, a, b FROM ahead, line WHERE step < 6)
SELECT area_code, CAST(last + to_months(step) AS DATE) AS date, CAST(step AS INTEGER) AS step, round(a, 4) AS crime_prediction
FROM ahead WHERE step > 0"""

JOINED = f"""
j AS (SELECT p.area_code, p.date, p.count FROM panel p JOIN supply s ON p.area_code = s.area_code AND p.date = s.date
      JOIN trend t ON p.area_code = t.area_code AND p.date = t.date
      JOIN dens d ON p.area_code = d.area_code AND p.date = d.date)"""

SQL["training_job"] = f"""
WITH {PANEL}, {SUPPLY_PANEL}, {NAMES}, {TREND}, {DENSITY}, {JOINED},
l AS (SELECT area_code, date, count, lag(count, 3) OVER ({_W}) AS third FROM j),
o AS (SELECT *, row_number() OVER (ORDER BY area_code, date) AS k, count(*) OVER () AS n FROM l WHERE third IS NOT NULL)
SELECT area_code AS ward_code, date, CAST(count AS DOUBLE) AS actual_crime, true AS plausible FROM o WHERE k > n - ceil(0.1 * n)"""

SQL["scoring_job"] = f"""
WITH {PANEL}, {SUPPLY_PANEL}, {NAMES}, {TREND}, {DENSITY}, {JOINED}
SELECT area_code AS ward_code, CAST(max(date) + INTERVAL 1 MONTH AS DATE) AS date, true AS plausible,
       area_code = {AREA.format(k='7')} AS answered FROM j GROUP BY area_code HAVING count(*) >= 3"""

LAGRES = f"""lr AS (SELECT area_code, date, CAST(lag(count, 1) OVER ({_W}) AS DOUBLE) AS predicted_crime,
                    CAST(count AS DOUBLE) AS actual_crime FROM panel),
res AS (SELECT * FROM lr WHERE predicted_crime IS NOT NULL)"""

SQL["regression_metrics"] = f"""
WITH {PANEL}, {LAGRES}
SELECT CAST(count(*) AS BIGINT) AS n, round(avg(pow(actual_crime - predicted_crime, 2)), 6) AS mse,
       round(sqrt(avg(pow(actual_crime - predicted_crime, 2))), 6) AS rmse FROM res"""

SQL["metrics_by_area"] = f"""
WITH {PANEL}, {LAGRES}
SELECT area_code, CAST(count(*) AS BIGINT) AS n, round(avg(pow(actual_crime - predicted_crime, 2)), 6) AS mse
FROM res GROUP BY 1"""

SQL["linear_fit"] = f"""
WITH {PANEL},
l AS (SELECT count, lag(count, 1) OVER ({_W}) AS prev FROM panel),
r AS (SELECT regr_intercept(count, prev) AS b0, regr_slope(count, prev) AS b1 FROM l WHERE prev IS NOT NULL)
SELECT 'intercept' AS term, round(b0, 6) AS coefficient FROM r
UNION ALL SELECT 'crime_last_month', round(b1, 6) FROM r"""

SQL["check_columns"] = f"""
WITH mac AS ({SQL["monthly_area_counts"]})
SELECT 'count' AS "column", true AS present, CAST(count(*) FILTER (WHERE count IS NULL) AS BIGINT) AS null_count
FROM mac
UNION ALL SELECT 'ward_code', true, CAST(count(*) FILTER (WHERE ward_code IS NULL) AS BIGINT) FROM mac
UNION ALL SELECT 'date', true, CAST(count(*) FILTER (WHERE date IS NULL) AS BIGINT) FROM mac
UNION ALL SELECT 'population', false, CAST(NULL AS BIGINT)"""

# --- whole jobs on derived inputs -------------------------------------------------------------

SQL["crime_job"] = f"""
WITH r AS (
  SELECT CASE WHEN n.n_name = 'NATION_7' THEN 'Nation 7 Ward' ELSE n.n_name END AS ward_name,
         c.c_mktsegment AS council_name, year(o.o_orderdate) AS year, month(o.o_orderdate) AS month
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  WHERE (c.c_mktsegment IS NULL OR c.c_mktsegment NOT IN ('AUTOMOBILE'))
    AND (n.n_name IS NULL OR n.n_name NOT IN ('NATION_3'))),
s AS (SELECT {norm('ward_name')} AS ward_name, council_name, year, month, CAST(count(*) AS BIGINT) AS count
      FROM r WHERE council_name IS NOT NULL GROUP BY 1, 2, 3, 4),
l AS (SELECT {norm('n_name')} AS ward_name, {AREA.format(k='n_nationkey')} AS ward_code FROM nation)
SELECT s.count, l.ward_code, make_date(CAST(s.year AS INTEGER), CAST(s.month AS INTEGER), 1) AS date
FROM s LEFT JOIN l ON s.ward_name = l.ward_name"""

SQL["ward_area"] = f"""
SELECT {AREA.format(k='n_nationkey')} AS ward_code, round((n_regionkey + 1) * 1.5e6 * 1e-6, 6) AS area FROM nation"""

SQL["population_density_job"] = f"""
WITH y AS (
  SELECT c.c_nationkey AS k, year(o.o_orderdate) AS yr, CAST(count(*) AS DOUBLE) AS n
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2),
a AS (SELECT n_nationkey AS k, (n_regionkey + 1) * 1.5e6 * 1e-6 AS area FROM nation),
v AS (SELECT {AREA.format(k='a.k')} AS ward_code,
             y0.n / a.area AS v0, y1.n / a.area AS v1
      FROM a JOIN y y0 ON y0.k = a.k AND y0.yr = 1996 JOIN y y1 ON y1.k = a.k AND y1.yr = 2000),
g AS (SELECT *, CAST(unnest(generate_series(DATE '1996-01-01', DATE '2001-01-01', INTERVAL 1 MONTH)) AS DATE) AS date
      FROM v),
i AS (SELECT *, datediff('month', DATE '1996-01-01', date) AS i FROM g)
SELECT ward_code, date, round(CASE WHEN i = 0 THEN v0 WHEN i >= 48 THEN v1
                                   ELSE coalesce(v0 + ((v1 - v0) * i) / 48, v0) END, 6) AS population_density
FROM i"""

SQL["education_job"] = f"""
WITH {SQUARES},
c11 AS (SELECT 'P' || CAST(l_suppkey AS VARCHAR) AS source_code,
               count(*) FILTER (WHERE l_returnflag = 'A') AS l1, count(*) FILTER (WHERE l_returnflag = 'N') AS l2,
               count(*) FILTER (WHERE l_returnflag = 'R') AS l3, count(*) FILTER (WHERE l_linestatus = 'F') AS l4,
               count(*) FILTER (WHERE l_linestatus = 'O') AS nq, count(*) AS tot
        FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier) GROUP BY 1),
s11 AS (SELECT source_code, CAST(l3 + l4 AS DOUBLE) / tot AS w, CAST(l1 + l2 + nq AS DOUBLE) / tot AS wo FROM c11),
e11 AS (SELECT p.target_code AS ward_code, sum(s.w * (p.a / p.src_area)) AS w, sum(s.wo * (p.a / p.src_area)) AS wo
        FROM s11 s JOIN pairs p ON s.source_code = p.source_code GROUP BY 1),
c22 AS (SELECT {AREA.format(k='c_nationkey')} AS ward_code, count(*) AS tot,
               count(*) FILTER (WHERE c_mktsegment = 'AUTOMOBILE') AS nq,
               count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS l1,
               count(*) FILTER (WHERE c_mktsegment = 'FURNITURE') AS l2,
               count(*) FILTER (WHERE c_mktsegment = 'HOUSEHOLD') AS l3,
               count(*) FILTER (WHERE c_mktsegment = 'MACHINERY') AS l35,
               count(*) FILTER (WHERE c_acctbal > 5000) AS l4
        FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation) GROUP BY 1),
e22 AS (SELECT ward_code, CAST(l3 + l35 + l4 AS DOUBLE) / tot AS w, CAST(l1 + l2 + nq AS DOUBLE) / tot AS wo FROM c22),
both_years AS (SELECT e22.ward_code, e11.w AS w0, e11.wo AS wo0, e22.w AS w1, e22.wo AS wo1
               FROM e22 JOIN e11 ON e22.ward_code = e11.ward_code),
g AS (SELECT *, CAST(unnest(generate_series(DATE '2011-01-01', DATE '2022-01-01', INTERVAL 1 MONTH)) AS DATE) AS date
      FROM both_years),
i AS (SELECT *, datediff('month', DATE '2011-01-01', date) AS i FROM g)
SELECT ward_code, round(CASE WHEN i = 0 THEN w0 WHEN i = 132 THEN w1 ELSE w0 + ((w1 - w0) * i) / 132 END, 6)
         AS pop_with_qual,
       round(CASE WHEN i = 0 THEN wo0 WHEN i = 132 THEN wo1 ELSE wo0 + ((wo1 - wo0) * i) / 132 END, 6)
         AS pop_without_qual,
       date
FROM i
UNION ALL
SELECT ward_code, round(w, 6), round(wo, 6), DATE '2022-01-01' FROM e22
WHERE ward_code NOT IN (SELECT ward_code FROM e11)"""

SQL["employment_job"] = f"""
WITH {SQUARES},
c11 AS (SELECT 'P' || CAST(l_suppkey AS VARCHAR) AS source_code, CAST(count(*) AS DOUBLE) AS tot,
               CAST(count(*) FILTER (WHERE l_linestatus = 'F') AS DOUBLE) AS emp,
               CAST(count(*) FILTER (WHERE l_returnflag = 'R') AS DOUBLE) AS unemp,
               CAST(count(*) FILTER (WHERE l_discount < 0.02) AS DOUBLE) AS care,
               CAST(count(*) FILTER (WHERE l_tax > 0.07) AS DOUBLE) AS sick
        FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier) GROUP BY 1),
s11 AS (SELECT source_code, unemp / nullif(emp, 0) AS un, sick / nullif(tot, 0) AS si, care / nullif(tot, 0) AS ca
        FROM c11),
e11 AS (SELECT p.target_code AS ward_code, coalesce(sum(s.un * (p.a / p.src_area)), 0) AS un,
               coalesce(sum(s.si * (p.a / p.src_area)), 0) AS si, coalesce(sum(s.ca * (p.a / p.src_area)), 0) AS ca
        FROM s11 s JOIN pairs p ON s.source_code = p.source_code GROUP BY 1),
c22 AS (SELECT {AREA.format(k='c_nationkey')} AS ward_code, CAST(count(*) AS DOUBLE) AS tot,
               CAST(count(*) FILTER (WHERE c_mktsegment IN ('BUILDING', 'FURNITURE')) AS DOUBLE) AS act,
               CAST(count(*) FILTER (WHERE c_acctbal < 0) + count(*) FILTER (WHERE c_acctbal > 9000) AS DOUBLE) AS un,
               CAST(count(*) FILTER (WHERE c_mktsegment = 'HOUSEHOLD') AS DOUBLE) AS care,
               CAST(count(*) FILTER (WHERE c_mktsegment = 'MACHINERY') AS DOUBLE) AS sick
        FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation) GROUP BY 1),
e22 AS (SELECT ward_code, un / nullif(act, 0) AS un, sick / nullif(tot, 0) AS si, care / nullif(tot, 0) AS ca
        FROM c22),
b AS (SELECT e22.ward_code, e11.un AS u0, e11.si AS s0, e11.ca AS c0, e22.un AS u1, e22.si AS s1, e22.ca AS c1
      FROM e22 JOIN e11 ON e22.ward_code = e11.ward_code),
g AS (SELECT *, CAST(unnest(generate_series(DATE '2011-01-01', DATE '2022-01-01', INTERVAL 1 MONTH)) AS DATE) AS date
      FROM b),
i AS (SELECT *, datediff('month', DATE '2011-01-01', date) AS i FROM g)
SELECT ward_code, date,
  round(CASE WHEN i = 0 THEN u0 WHEN i = 132 THEN u1 ELSE coalesce(u0 + ((u1 - u0) * i) / 132, u0) END, 6)
    AS unemployed_adults,
  round(CASE WHEN i = 0 THEN s0 WHEN i = 132 THEN s1 ELSE coalesce(s0 + ((s1 - s0) * i) / 132, s0) END, 6)
    AS long_term_sick_or_disabled,
  round(CASE WHEN i = 0 THEN c0 WHEN i = 132 THEN c1 ELSE coalesce(c0 + ((c1 - c0) * i) / 132, c0) END, 6)
    AS caring_for_family
FROM i
UNION ALL
SELECT ward_code, DATE '2022-01-01', round(un, 6), round(si, 6), round(ca, 6) FROM e22
WHERE ward_code NOT IN (SELECT ward_code FROM e11)"""

SQL["name_lookup_job"] = f"SELECT {AREA.format(k='n_nationkey')} AS ward_code, n_name AS ward_name FROM nation"

SQL["checked_publish"] = f"WITH {PANEL}, {TREND} SELECT area_code, date, value_trend FROM trend"

SQL["join_bucketed"] = SQL["area_history"]
