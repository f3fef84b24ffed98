"""The same results in plain SQL, over the order-line tables, to check the queries against."""

from __future__ import annotations

# Order lines with their derived columns; rnk() etc. below build on it.
LINES = """
lines0 AS (
  SELECT r.r_name AS area, home.n_name AS sub_area,
         CASE WHEN l_partkey % 211 <> 0 THEN n.n_name END AS origin_country,
         CASE WHEN l_partkey % 211 <> 0 AND n.n_regionkey IN (0, 1) THEN 'BD' ELSE 'CN' END AS region,
         'PORT_' || n.n_nationkey AS origin_port, s_name AS supplier,
         CASE WHEN l_partkey % 199 <> 0 THEN p_brand END AS factory,
         CAST(l_orderkey AS VARCHAR) AS destination_po, CAST(l_partkey AS VARCHAR) AS kimball, l_partkey,
         l_returnflag AS colour_code, p_name AS description, CAST(p_size AS VARCHAR) AS size,
         CAST(l_quantity AS INTEGER) AS po_qty, CAST(l_shipdate AS DATE) AS handover_date,
         CASE WHEN p_size <= 25 THEN p_type END AS carton_matrix_code, p_size AS units_per_carton,
         CASE WHEN p_size % 17 <> 0 THEN 200 + 10 * p_size END AS carton_length_mm,
         CAST(150 + 10 * (l_partkey % 30) AS INTEGER) AS carton_width_mm,
         100 + 25 * l_linenumber AS carton_height_mm, p_brand AS packaging_supplier,
         CAST(l_shipdate AS DATE) + CAST(l_partkey % 10 - 8 AS INTEGER) AS updated_date, o_orderpriority AS updated_by,
         CASE WHEN l_returnflag <> 'R' THEN CAST(l_shipdate AS DATE) + CAST(l_partkey % 10 - 8 AS INTEGER) END
           AS approved_date,
         CASE WHEN l_returnflag <> 'R' THEN o_orderpriority END AS approved_by,
         CASE WHEN l_returnflag <> 'R' THEN 'Approved' WHEN l_linestatus = 'F' THEN 'Approval Rejected'
              WHEN l_linenumber % 2 = 0 THEN 'Pending' ELSE 'Escalated' END AS packaging_status
  FROM lineitem
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN supplier ON l_suppkey = s_suppkey
  LEFT JOIN part ON l_partkey = p_partkey
  LEFT JOIN nation home ON s_nationkey = home.n_nationkey
  LEFT JOIN nation n ON CASE WHEN l_linenumber < 6 THEN s_nationkey ELSE (s_nationkey + 1) % 25 END = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey),
lines AS (
  SELECT *, CAST(date_trunc('month', handover_date) AS DATE) AS month,
         strftime(handover_date, '%Y_%m') || CASE WHEN day(handover_date) <= 15 THEN '_1-15' ELSE '_16-31' END
           AS source_file,
         CASE WHEN carton_matrix_code IS NOT NULL THEN 'Standard' ELSE 'Custom' END AS carton_type,
         CAST(printf('%.4f', carton_length_mm / 1000 * (carton_width_mm / 1000) * (carton_height_mm / 1000)) AS DOUBLE) AS cbm,
         CAST(printf('%.2f', units_per_carton / NULLIF(CAST(printf('%.4f', 
           carton_length_mm / 1000 * (carton_width_mm / 1000) * (carton_height_mm / 1000)) AS DOUBLE), 0)) AS DOUBLE) AS density,
         CASE WHEN packaging_status = 'Approved' AND updated_date <= handover_date THEN 'Compliant'
              ELSE 'Non-compliant' END AS compliance_status
  FROM lines0),
m AS (SELECT * FROM lines WHERE handover_date >= DATE '2001-10-01' AND handover_date < DATE '2001-11-01'),
year AS (SELECT * FROM lines WHERE handover_date >= DATE '2000-11-01' AND handover_date < DATE '2001-11-01'),
tab AS (SELECT * FROM lines WHERE month IN (DATE '2001-10-01', DATE '2001-09-01', DATE '2000-10-01')),
chart AS (
  SELECT CAST(unnest(generate_series(DATE '2000-11-01', DATE '2001-10-01', INTERVAL 1 MONTH)) AS DATE) AS month),
grid AS (SELECT month FROM chart WHERE month >= (SELECT min(month) FROM lines))
"""
CONTACTS = """
contacts AS (
  SELECT lower(s_name) AS supplier_name, 's' || s_suppkey || '@example.com' AS email FROM supplier
  WHERE s_suppkey % 3 <> 0
  UNION ALL
  SELECT lower(s_name), 'ops' || s_suppkey || '@example.com' FROM supplier
  WHERE s_suppkey % 3 <> 0 AND s_suppkey % 2 = 0
  UNION ALL SELECT 'zz retired', 'zz@example.com'),
emails AS (SELECT supplier_name, string_agg(email, ', ' ORDER BY email) AS emails FROM contacts GROUP BY 1)
"""
OK = "count(*) FILTER (compliance_status = 'Compliant')"
RATE = f"{OK} / count(*) * 100"
STATUS = """count(*) FILTER (packaging_status = 'Pending') AS pending,
  count(*) FILTER (packaging_status = 'Approved') AS approved,
  count(*) FILTER (packaging_status = 'Approval Rejected') AS rejected,
  count(*) FILTER (packaging_status = 'Escalated') AS escalated"""
COUNTRIES = "string_agg(DISTINCT origin_country, ', ' ORDER BY origin_country)"
DETAILS = f"count(DISTINCT destination_po) AS dest_po_count, count(*) AS reflected_lines, {STATUS}"
DETAIL_SUMS = ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in (
    "dest_po_count", "reflected_lines", "pending", "approved", "rejected", "escalated"))


def band(rate: str) -> str:
    return f"CASE WHEN {rate} >= 70 THEN 'high' WHEN {rate} >= 40 THEN 'mid' ELSE 'low' END"


def region_of(rows: str, key: str = "supplier") -> str:
    """Region of each supplier: BD unless some known country is not a BD one."""
    return (f"SELECT {key}, CASE WHEN count(*) FILTER (origin_country IS NOT NULL AND region = 'CN') = 0 "
            f"THEN 'BD' ELSE 'CN' END AS region FROM {rows} GROUP BY {key}")


def working(days_off: str, month: str = "month") -> str:
    """Days of the month on other ISO weekdays than the two given."""
    return (f"len(list_filter(generate_series({month}, last_day({month}), INTERVAL 1 DAY), "
            f"lambda d: isodow(d) NOT IN ({days_off})))")


def pct_change(now: str, before: str) -> str:
    return f"CAST(round_even(({now} - {before}) / NULLIF({before}, 0) * 100, 0) AS BIGINT)"


def _sql(body: str, *, contacts: bool = False, **more: str) -> str:
    parts = [LINES] + ([CONTACTS] if contacts else []) + [f"{name} AS ({text})" for name, text in more.items()]
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n" + body


def _ranked(rows: str, *within: str) -> str:
    keys = ", ".join((*within, "supplier"))
    part = f"PARTITION BY {', '.join(within)}" if within else ""
    same = ", ".join((*within, "rate"))
    return (f"SELECT *, dense_rank() OVER ({part} ORDER BY rate DESC) AS rank, "
            f"count(supplier) OVER ({part}) AS total, count(*) OVER (PARTITION BY {same}) > 1 AS shared "
            f"FROM (SELECT {keys}, {RATE} AS rate FROM {rows} GROUP BY {keys})")


_MONTH_RATES = f"SELECT supplier, month, {RATE} AS rate FROM lines GROUP BY ALL"
_FOLLOW = f"""
SELECT row_number() OVER (ORDER BY avg3, r0, supplier) AS sl, supplier, origin_countries, factory_count,
       dest_po_count, qty, reflected_lines, CAST(printf('%.1f', r0) AS DOUBLE) AS rate, CAST(printf('%.1f', r1) AS DOUBLE) AS prev_1,
       CAST(printf('%.1f', r2) AS DOUBLE) AS prev_2, CAST(printf('%.1f', avg3) AS DOUBLE) AS avg_3month
FROM (SELECT c.*, p1.rate AS r1, p2.rate AS r2,
             (r0 + coalesce(p1.rate, 0) + coalesce(p2.rate, 0))
             / (1 + (p1.rate IS NOT NULL)::INT + (p2.rate IS NOT NULL)::INT) AS avg3
      FROM (SELECT supplier, {COUNTRIES} AS origin_countries, count(DISTINCT factory) AS factory_count,
                   count(DISTINCT destination_po) AS dest_po_count, CAST(sum(po_qty) AS BIGINT) AS qty,
                   count(*) AS reflected_lines, {RATE} AS r0 FROM m GROUP BY supplier) c
      LEFT JOIN rates p1 ON p1.supplier = c.supplier AND p1.month = DATE '2001-09-01'
      LEFT JOIN rates p2 ON p2.supplier = c.supplier AND p2.month = DATE '2001-08-01')
WHERE r0 < 40 AND avg3 < 40"""
_FACTORIES = f"""SELECT supplier, factory, {COUNTRIES} AS origin_countries, CAST(printf('%.1f', {RATE}) AS DOUBLE) AS rate
FROM m GROUP BY supplier, factory"""
_COUNTRY_MONTHS = f"""SELECT origin_country AS country, month, CAST(printf('%.2f', {RATE}) AS DOUBLE) AS rate
FROM lines GROUP BY origin_country, month"""
_DETAILS = f"SELECT supplier, factory, {DETAILS} FROM m GROUP BY supplier, factory"
_KPI_TABLE = """SELECT month, origin_country AS country, count(DISTINCT supplier) AS suppliers,
  count(DISTINCT factory) AS factories, count(*) AS reflected_lines FROM tab GROUP BY month, origin_country"""
_TREND = """SELECT month, count(DISTINCT supplier) AS suppliers, count(DISTINCT factory) AS factories,
  count(DISTINCT supplier) FILTER (region = 'BD') AS bd_suppliers,
  count(DISTINCT factory) FILTER (region = 'BD') AS bd_factories,
  count(DISTINCT supplier) FILTER (region = 'CN') AS cn_suppliers,
  count(DISTINCT factory) FILTER (region = 'CN') AS cn_factories,
  count(y.l_partkey) AS lines, count(*) FILTER (region = 'BD') AS bd, count(*) FILTER (region = 'CN') AS cn
FROM grid LEFT JOIN {rows} y USING (month) GROUP BY month"""
_MONTH_CELLS = """count(*) FILTER (month = DATE '2001-10-01') AS m0,
  count(*) FILTER (month = DATE '2001-09-01') AS m1, count(*) FILTER (month = DATE '2000-10-01') AS m12"""


def _dashboard(line_filter: str = "TRUE", region: str = "") -> dict[str, str]:
    """CTEs of the supplier dashboard: filtered counts per supplier for the month and the two before."""
    def month(back, first, last):
        return f"""SELECT supplier, string_agg(DISTINCT origin_country, ', ' ORDER BY origin_country) AS countries,
            count(DISTINCT factory) AS factories, count(*) AS lines, {OK} AS ok, {RATE} AS rate, {STATUS}
            FROM lines WHERE handover_date >= DATE '{first}' AND handover_date < DATE '{last}' AND {line_filter}
            GROUP BY supplier"""

    keep = f"SELECT c.*, r.region FROM c0 c JOIN regions r USING (supplier) WHERE {region or 'TRUE'}"
    earlier = "SELECT * FROM {} WHERE " + ("supplier IN (SELECT supplier FROM cur)" if region else "TRUE")
    return {"c0": month(0, "2001-10-01", "2001-11-01"), "c1": month(1, "2001-09-01", "2001-10-01"),
            "c2": month(2, "2001-08-01", "2001-09-01"), "regions": region_of("m"), "ranks": _ranked("m"),
            "cur": keep, "p1": earlier.format("c1"), "p2": earlier.format("c2"),
            "shown": """SELECT cur.*, p1.rate AS r1,
              (cur.rate + coalesce(p1.rate, 0) + coalesce(p2.rate, 0))
              / (1 + (p1.rate IS NOT NULL)::INT + (p2.rate IS NOT NULL)::INT) AS avg3, ranks.rank
              FROM cur LEFT JOIN p1 USING (supplier) LEFT JOIN p2 USING (supplier) LEFT JOIN ranks USING (supplier)"""}


_SUPPLIER_TABLE = f"""SELECT supplier, region, coalesce(countries, '') AS countries, factories, lines,
  CAST(printf('%.1f', rate) AS DOUBLE) AS compliance, {band('rate')} AS band, CAST(printf('%.1f', avg3) AS DOUBLE) AS avg_3m,
  CAST(printf('%.1f', rate - r1) AS DOUBLE) AS change, rank FROM shown"""
_CARDS = f"""SELECT CAST(printf('%.1f', now_rate) AS DOUBLE) AS compliance, CAST(printf('%.1f', now_rate - old_rate) AS DOUBLE) AS compliance_change,
  top_count, CASE WHEN had > 0 THEN top_count - top_old END AS top_change, follow_up_count, pending, approved, rejected,
  escalated, total, "all", high, mid, low
FROM (SELECT sum(ok) / sum(lines) * 100 AS now_rate, count(*) FILTER (rate >= 95) AS top_count,
        count(*) FILTER (rate < 40 AND avg3 < 40) AS follow_up_count, CAST(sum(pending) AS BIGINT) AS pending,
        CAST(sum(approved) AS BIGINT) AS approved, CAST(sum(rejected) AS BIGINT) AS rejected,
        CAST(sum(escalated) AS BIGINT) AS escalated, CAST(sum(lines) AS BIGINT) AS total, count(*) AS "all",
        count(*) FILTER (rate >= 70) AS high, count(*) FILTER (rate >= 40 AND rate < 70) AS mid,
        count(*) FILTER (rate < 40) AS low FROM shown) a,
     (SELECT sum(ok) / sum(lines) * 100 AS old_rate, count(*) FILTER (rate >= 95) AS top_old, count(*) AS had
      FROM p1) b"""
_SERIES_KEYS = """spine AS (
  SELECT supplier, month FROM (SELECT supplier, min(month) AS first FROM lines WHERE month <= DATE '2001-10-01'
                               GROUP BY supplier) JOIN chart ON month >= first)"""
_SERIES = """WITH {lines}, {keys}
SELECT s.supplier, s.month, {values} FROM spine s LEFT JOIN year y
  ON y.supplier IS NOT DISTINCT FROM s.supplier AND y.month = s.month GROUP BY s.supplier, s.month"""


def _series(values: str) -> str:
    return _SERIES.format(lines=LINES.strip(), keys=_SERIES_KEYS, values=values)


_EXTRACT = ", ".join(f'{column} AS "{header}"' for column, header in (
    ("area", "Area"), ("sub_area", "Sub-Area"), ("origin_country", "Origin Country"), ("origin_port", "Origin Port"),
    ("supplier", "Supplier"), ("factory", "Factory"), ("destination_po", "Destination PO"), ("kimball", "Kimball"),
    ("colour_code", "Colour Code"), ("description", "Description"), ("size", "Size"), ("po_qty", "PO Qty"),
    ("handover_date", "Current Handover Date"), ("carton_matrix_code", "Carton Matrix Code"),
    ("units_per_carton", "Units Per Carton"), ("carton_length_mm", "Outer Carton Length (mm)"),
    ("carton_width_mm", "Outer Carton Width (mm)"), ("carton_height_mm", "Outer Carton Height (mm)"),
    ("packaging_supplier", "Packaging Supplier"), ("CAST(updated_date AS TIMESTAMP)", "Updated Date"),
    ("updated_by", "Updated By"), ("CAST(approved_date AS TIMESTAMP)", "Approved Date"),
    ("approved_by", "Approved By"), ("packaging_status", "Packaging Confirmation Status"),
    ("compliance_status", "Compliance Status")))
_ALIASED = """CASE WHEN CAST(right(supplier, 9) AS INTEGER) % 10 = 0 THEN supplier || ' (ID)' ELSE supplier END"""
_DIRECTORY = """SELECT coalesce(k.supplier, e.supplier_name) AS name, coalesce(emails, '') AS emails, region
FROM known k FULL JOIN emails e ON lower(trim(k.supplier)) = e.supplier_name"""
_SHOWN = """destination_po, kimball, supplier, factory, po_qty, handover_date, packaging_status, cbm, density,
  compliance_status, source_file"""
_TEXT_DAY = "strftime({}, '%d %b %Y')"
_SIDE = "coalesce(CAST({} AS VARCHAR), '0')"

# Section of a supplier's report -> (query whose rows it shows, its fields).
_SECTIONS = {
    "headline": ("supplier_headline", "lines, compliant, rate, band"),
    "kpis": ("supplier_kpis", "origin_countries, factory_count, total_lines, compliant_count, non_compliant_count"),
    "ranking": ("global_rank", "rank, total, shared"),
    "local_ranking": ("local_rank", "country, rank, total, shared"),
    "factories": ("supplier_factories", "factory, origin_countries, rate, band"),
    "factory_bands": ("factory_bands", "band, factories"),
    "line_details": ("line_details", "factory, dest_po_count, reflected_lines, pending, approved, rejected, escalated"),
    "line_totals": ("line_totals", "dest_po_count, reflected_lines, pending, approved, rejected, escalated"),
    "carton_usage": ("carton_usage", "factory, standard_carton_pct, total_carton_qty, corrugated_sqm"),
}


def _documents(q: dict[str, str]) -> str:
    """Each section's rows as JSON objects, with the folder of their supplier."""
    def item(fields, month="'2001-10-01'"):
        pairs = ", ".join(f"{f} := {f}" for f in fields.split(", "))
        return f"to_json(struct_pack(month := {month}, {pairs}))"

    parts = [f"SELECT supplier, '{name}' AS section, {item(fields)} AS item FROM ({q[source]})"
             for name, (source, fields) in _SECTIONS.items()]
    parts.append(f"""SELECT supplier, 'series', {item('compliance, approved, density', "strftime(month, '%Y-%m-%d')")}
      FROM ({q['supplier_series']}) JOIN ({q['density_series']}) USING (supplier, month)""")
    regions = f"""SELECT supplier, CASE WHEN count(origin_country) > 0 AND count(*) FILTER (
      origin_country IS NOT NULL AND region = 'CN') = 0 THEN 'BD' ELSE 'CN' END AS region FROM m GROUP BY supplier"""
    return _sql("SELECT region, supplier, section, CAST(item AS VARCHAR) AS item FROM items JOIN folders "
                "USING (supplier)", items="\n UNION ALL ".join(parts), folders=regions)


# Table of the month summary or the KPI report -> (query whose rows it shows, its fields).
SUMMARY_TABLES = {
    "sources": ("summary_sources", "total_suppliers, total_factories"),
    "country_compliance": ("country_compliance", "country, rate"),
    "country_average": ("country_average", "avg_rate, like_for_like_change"),
    "country_trend": ("country_trend", "country, month, rate"),
    "country_order": ("country_order", "position, country, first_month"),
    "line_details": ("country_line_details", "country, dest_po_count, reflected_lines, pending, approved, rejected, escalated"),
    "line_totals": ("country_line_totals", "dest_po_count, reflected_lines, pending, approved, rejected, escalated"),
    "top_suppliers": ("top_suppliers", "sl, supplier, origin_countries, factory_count, dest_po_count, reflected_lines, rate"),
    "follow_up": ("follow_up_emails", "supplier, avg_3month, emails"),
    "supplier_trend": ("supplier_trend", "supplier, month, rate"),
    "yearly_average": ("yearly_average", "supplier, mean_rate, heat_band"),
}
KPI_TABLES = {
    "monthly_tables": ("kpi_monthly", "month, country, suppliers, factories, reflected_lines"),
    "monthly_totals": ("kpi_monthly_totals", "month, suppliers, factories, reflected_lines"),
    "approver_performance": ("approver_performance", "approved_by, m0, m1, m12, share_of_max"),
    "lines_per_working_day": ("avg_lines_per_day", "region, lines, working_days, avg"),
    "supplier_factory_trend": ("supplier_factory_trend", "month, suppliers, factories, bd_suppliers, bd_factories, cn_suppliers, cn_factories"),
    "region_lines": ("region_lines", "month, bd, cn"),
    "headline": ("kpi_headline", "measure, now, before, change_pct, bd_share, cn_share"),
    "month_comparison": ("month_comparison", "country, region, lines_m0, lines_m1, lines_m12, share"),
}


def _bundle(q: dict[str, str], tables: dict[str, tuple[str, str]]) -> str:
    """All rows of several tables as JSON objects. Dates are written as text, as in the reports."""
    def item(fields):
        pairs = ", ".join(f"{f} := " + (f"CAST({f} AS VARCHAR)" if f in ("month", "first_month") else f) for f in fields.split(", "))
        return f"CAST(to_json(struct_pack({pairs})) AS VARCHAR)"

    return "\n UNION ALL ".join(f"SELECT '{name}' AS \"table\", {item(fields)} AS item FROM ({q[source]})"
                                for name, (source, fields) in tables.items())


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["derive_lines"] = _sql("""SELECT destination_po, kimball, handover_date, carton_type, cbm, density,
      compliance_status, source_file FROM lines""")
    q["clean_text"] = _sql("""SELECT supplier, count(*) AS lines, count(po_qty) AS counted,
      CAST(sum(po_qty) AS BIGINT) AS qty, count(handover_date) AS dated, min(handover_date) AS first_day,
      count(*) FILTER (packaging_status = 'Approved' AND updated_date <= handover_date) AS compliant
      FROM untidy GROUP BY supplier""", untidy="""SELECT CASE WHEN l_partkey % 13 <> 0 THEN supplier END AS supplier,
      CASE WHEN l_partkey % 11 = 0 THEN NULL WHEN l_partkey % 5 = 0 THEN round_even(po_qty + 0.5, 0)::INT
        ELSE po_qty END AS po_qty,
      CASE WHEN l_partkey % 17 <> 0 THEN handover_date END AS handover_date, updated_date, packaging_status
      FROM lines""")
    untidy = f"""SELECT destination_po, kimball, l_partkey, source_file, packaging_status, updated_date, colour_code,
      CASE WHEN l_partkey % 13 <> 0 THEN supplier END AS supplier,
      description || chr(10) || 'second "line", of ' || kimball AS description,
      CASE WHEN l_partkey % 11 <> 0 THEN po_qty END AS po_qty,
      CASE WHEN l_partkey % 17 <> 0 THEN handover_date END AS handover_date FROM lines"""
    q["load_untidy"] = _sql("""SELECT destination_po, kimball, colour_code, supplier, description, po_qty, handover_date,
      CASE WHEN packaging_status = 'Approved' AND updated_date <= handover_date THEN 'Compliant' ELSE 'Non-compliant' END
        AS compliance_status, source_file FROM untidy""", untidy=untidy)
    q["load_untidy_report"] = _sql("""SELECT source_file, 'Loaded' AS status, count(*) AS rows,
      count(*) FILTER (l_partkey % 11 = 0) + count(*) FILTER (l_partkey % 17 = 0) AS unreadable_cells
      FROM untidy GROUP BY 1
      UNION ALL SELECT source_file, 'Skipped', NULL, NULL FROM (SELECT min(source_file) AS source_file FROM lines)""", untidy=untidy)
    q["load_split_csv"] = _sql("""SELECT destination_po, kimball, colour_code, supplier,
      description || chr(10) || 'second "line", of ' || kimball AS description, po_qty, handover_date, compliance_status,
      strftime(handover_date, '%Y') AS source_file FROM lines""")
    q["supplier_alias"] = _sql(f"SELECT {_ALIASED} AS supplier, count(*) AS lines FROM lines GROUP BY 1")
    q["load_pending_files"] = _sql("""SELECT source_file FROM lines GROUP BY 1
      HAVING min(handover_date) >= DATE '2001-01-01'""")
    q["load_report"] = _sql("""SELECT source_file,
      CASE WHEN min(handover_date) < DATE '1998-01-01' THEN 'Skipped' ELSE 'Loaded' END AS status,
      CASE WHEN min(handover_date) >= DATE '1998-01-01' THEN count(*) END AS rows FROM lines GROUP BY 1
      UNION ALL SELECT 'not_an_export', 'Failed', NULL""")
    q["replace_by_file"] = _sql(f"""SELECT {_SHOWN} FROM lines
      WHERE source_file NOT IN ('2001_09_1-15', '2001_09_16-31') OR packaging_status = 'Approved'""")
    q["clear_lines"] = _sql("SELECT CAST(0 AS BIGINT) AS lines_left, count(*) AS contacts_left FROM contacts",
                            contacts=True)
    q["stream_ingest"] = _sql(f"SELECT {_SHOWN} FROM lines")
    kept = """SELECT * FROM lines WHERE source_file NOT IN ('2001_10_1-15', '1995_01_1-15') OR packaging_status = 'Approved'"""
    q["load_resumed"] = _sql(f"SELECT {_SHOWN}, month AS handover_month FROM kept", kept=kept)
    q["load_resumed_contents"] = _sql("""SELECT source_file, month, CAST(sum(lines) AS BIGINT) AS lines, count(*) AS suppliers, min(first_month) AS earliest,
      count(*) FILTER (first_month = month) AS new_suppliers
      FROM (SELECT source_file, month, supplier, count(*) AS lines FROM kept GROUP BY ALL)
      JOIN (SELECT supplier, min(month) AS first_month FROM kept GROUP BY 1) USING (supplier) GROUP BY ALL""", kept=kept)
    q["published_month"] = _sql(f"""SELECT supplier, count(*) AS lines, {OK} AS compliant,
      dense_rank() OVER (ORDER BY {RATE} DESC) AS rank FROM m GROUP BY supplier""")

    q["contacts_import"] = _sql("SELECT supplier_name, email FROM contacts", contacts=True)
    q["contacts_replace"] = _sql("""SELECT * FROM contacts WHERE supplier_name NOT IN
      (SELECT lower(s_name) FROM supplier WHERE s_nationkey < 5)
      UNION ALL SELECT lower(s_name), 'new@example.com' FROM supplier WHERE s_nationkey < 5 AND s_acctbal > 0""",
                                 contacts=True)
    q["supplier_directory"] = _sql(f"SELECT row_number() OVER (ORDER BY lower(name), name) AS position, * FROM ({_DIRECTORY})",
                                   contacts=True, known=region_of("lines"))
    q["contacts_export"] = _sql(f'SELECT name AS "Supplier Name", emails AS "Email" FROM ({_DIRECTORY})',
                                contacts=True, known=region_of("lines"))
    q["directory_filter"] = _sql("""SELECT supplier AS name, '2001-10' AS month, region FROM known
      WHERE region = 'CN'""", known=region_of("m"))
    q["directory_months"] = _sql("""SELECT CAST(row_number() OVER (ORDER BY month DESC) AS INTEGER) AS position, month
      FROM (SELECT DISTINCT strftime(month, '%Y-%m') AS month FROM lines)""")
    q["supplier_countries"] = _sql("""SELECT DISTINCT supplier, strftime(month, '%Y-%m') AS month,
      origin_country AS country FROM lines WHERE supplier IS NOT NULL""")

    q["month_extract"] = _sql(f"SELECT {_EXTRACT} FROM m")
    q["extract_by_supplier"] = _sql("""SELECT regions.region AS region, regexp_replace(supplier, '[<>:"/\\\\|?*]', '_', 'g')
      AS supplier_file, supplier, destination_po, kimball, CAST(po_qty AS VARCHAR) AS po_qty,
      CAST(handover_date AS VARCHAR) AS handover_date, compliance_status FROM named JOIN regions USING (supplier)""", named=f"SELECT * REPLACE ({_ALIASED} AS supplier) FROM m WHERE supplier IS NOT NULL",
                                    regions=region_of("named"))
    q["extract_selected"] = _sql("""SELECT supplier, regions.region AS region, supplier AS supplier_file, destination_po, kimball,
      po_qty, handover_date, compliance_status FROM m JOIN regions USING (supplier)
      WHERE supplier IN ('Supplier#000000001', 'Supplier#000000003')""", regions=region_of("m"))
    q["country_regions"] = _sql("""SELECT origin_country, count(*) AS lines, any_value(region) AS region
      FROM lines GROUP BY 1""")
    q["supplier_regions"] = _sql(region_of("m"))
    q["working_days"] = _sql(f"""SELECT month, CAST({working('5, 6')} AS INTEGER) AS bd_days,
      CAST({working('6, 7')} AS INTEGER) AS cn_days, CAST(day(last_day(month)) AS INTEGER) AS calendar_days
      FROM (SELECT DISTINCT month FROM lines)""")
    q["month_spine"] = _sql("""SELECT CAST(row_number() OVER (ORDER BY month) - 1 AS INTEGER) AS ordinal, month,
      strftime(month, '%b ''%y') AS label,
      month IN (DATE '2001-10-01', DATE '2001-09-01', DATE '2000-10-01') AS is_table_month FROM grid""")
    q["latest_month"] = _sql("""SELECT max(month) AS latest_month, min(handover_date) AS min_date,
      max(handover_date) AS max_date FROM lines""")

    q["compliance_rate"] = _sql(f"""SELECT supplier, month, count(*) AS lines, {OK} AS compliant,
      CAST(printf('%.2f', {RATE}) AS DOUBLE) AS rate FROM lines GROUP BY 1, 2""")
    q["supplier_range"] = _sql("""SELECT supplier, min(handover_date) AS min_date, max(handover_date) AS max_date
      FROM lines GROUP BY 1""")
    q["supplier_kpis"] = _sql(f"""SELECT supplier, {COUNTRIES} AS origin_countries,
      count(DISTINCT factory) AS factory_count, count(*) AS total_lines, {OK} AS compliant_count,
      count(*) FILTER (compliance_status = 'Non-compliant') AS non_compliant_count FROM m GROUP BY supplier""")
    q["supplier_factories"] = _sql(f"SELECT *, {band('rate')} AS band FROM ({_FACTORIES})")
    q["factory_bands"] = _sql(f"""SELECT supplier, {band('rate')} AS band, count(*) AS factories
      FROM ({_FACTORIES}) GROUP BY 1, 2""")
    q["line_details"] = _sql(_DETAILS)
    q["line_totals"] = _sql(f"SELECT supplier, {DETAIL_SUMS} FROM ({_DETAILS}) GROUP BY supplier")
    q["carton_usage"] = _sql("""SELECT supplier, factory,
      CAST(printf('%.1f', ok / n * 100) AS DOUBLE) AS standard_carton_pct,
      CAST(coalesce(qty, 0) AS BIGINT) AS total_carton_qty,
      (t // 100000 + (t % 100000 > 50000 OR t % 100000 = 50000 AND (t // 100000) % 2 = 1)::INT) / 10.0::DOUBLE
        AS corrugated_sqm FROM totals""", totals="""SELECT supplier, factory,
        count(*) FILTER (packaging_status = 'Approved') AS ok, count(*) AS n,
        sum(po_qty) FILTER (packaging_status = 'Approved') AS qty,
        coalesce(sum(CAST(po_qty AS BIGINT) * (carton_length_mm + 60) * (carton_width_mm + carton_height_mm + 40) * 2)
          FILTER (packaging_status = 'Approved'), 0) AS t FROM m GROUP BY supplier, factory""")
    q["supplier_headline"] = _sql(f"""SELECT *, {band('rate')} AS band FROM (SELECT supplier, count(*) AS lines,
      {OK} AS compliant, CAST(printf('%.2f', {RATE}) AS DOUBLE) AS rate FROM m GROUP BY supplier)""")
    q["supplier_series"] = _series("""
      CASE WHEN count(y.l_partkey) = 0 THEN 0.0::DOUBLE ELSE CAST(printf('%.1f', count(*) FILTER (
        compliance_status = 'Compliant') / count(*) * 100) AS DOUBLE) END AS compliance,
      CASE WHEN count(y.l_partkey) = 0 THEN 0.0::DOUBLE ELSE CAST(printf('%.1f', count(*) FILTER (
        packaging_status = 'Approved') / count(*) * 100) AS DOUBLE) END AS approved""")
    q["density_series"] = _series("""coalesce(CAST(printf('%.1f', 
      CAST(sum(CAST(density AS DECIMAL(10, 2))) FILTER (packaging_status = 'Approved') AS DOUBLE)
      / NULLIF(count(density) FILTER (packaging_status = 'Approved'), 0)) AS DOUBLE), 0.0::DOUBLE) AS density""")
    q["suppliers_for_month"] = _sql("SELECT DISTINCT supplier FROM m")
    q["global_rank"] = _sql(f"""SELECT supplier, CAST(printf('%.4f', rate) AS DOUBLE) AS rate, rank, total, shared
      FROM ({_ranked('m')})""")
    q["global_rank_all_months"] = _sql(f"SELECT month, supplier, rank, total, shared FROM ({_ranked('lines', 'month')})")
    q["local_rank"] = _sql(f"""SELECT supplier, origin_country AS country,
      CASE WHEN origin_country IS NULL THEN 0 ELSE rank END AS rank,
      CASE WHEN origin_country IS NULL THEN 0 ELSE total END AS total,
      origin_country IS NOT NULL AND shared AS shared FROM ({_ranked('m', 'origin_country')})""")
    q["mom_change"] = _sql("""SELECT supplier, month, CAST(printf('%.1f', c.rate) AS DOUBLE) AS rate,
      CAST(printf('%.1f', p.rate) AS DOUBLE) AS prev_rate, CAST(printf('%.1f', c.rate - p.rate) AS DOUBLE) AS change
      FROM rates c LEFT JOIN (SELECT supplier, CAST(month + INTERVAL 1 MONTH AS DATE) AS month, rate FROM rates) p
      USING (supplier, month)""", rates=_MONTH_RATES)
    q["rolling_3m"] = _sql("""SELECT supplier, c.month, CAST(printf('%.1f', 
      (c.rate + coalesce(p1.rate, 0) + coalesce(p2.rate, 0))
      / (1 + (p1.rate IS NOT NULL)::INT + (p2.rate IS NOT NULL)::INT)) AS DOUBLE) AS avg_3m
      FROM rates c LEFT JOIN rates p1 USING (supplier) LEFT JOIN rates p2 USING (supplier)
      """.replace("FROM rates c LEFT JOIN rates p1 USING (supplier) LEFT JOIN rates p2 USING (supplier)",
                  """FROM rates c
      LEFT JOIN (SELECT supplier, CAST(month + INTERVAL 1 MONTH AS DATE) AS month, rate FROM rates) p1
        USING (supplier, month)
      LEFT JOIN (SELECT supplier, CAST(month + INTERVAL 2 MONTH AS DATE) AS month, rate FROM rates) p2
        USING (supplier, month)"""), rates=_MONTH_RATES)
    q["month_rollup"] = _sql(f"""SELECT month, origin_country, count(*) AS lines, {OK} AS compliant, {STATUS},
      count(*) FILTER (packaging_status <> 'Pending') AS active, CAST(sum(po_qty) AS BIGINT) AS qty,
      CAST(sum(po_qty) FILTER (packaging_status = 'Approved') AS BIGINT) AS approved_qty,
      count(DISTINCT supplier) AS suppliers, count(DISTINCT approved_by) AS approvers
      FROM lines GROUP BY 1, 2""")

    q["summary_sources"] = _sql("""SELECT count(DISTINCT supplier) AS total_suppliers,
      count(DISTINCT factory) AS total_factories FROM m""")
    q["country_compliance"] = _sql(f"""SELECT origin_country AS country, CAST(printf('%.2f', {RATE}) AS DOUBLE) AS rate
      FROM m GROUP BY 1""")
    q["country_average"] = _sql("""SELECT CAST(printf('%.2f', sum(n) / (count(n) * 100)) AS DOUBLE) AS avg_rate,
      CAST(printf('%.2f', sum(n) FILTER (p IS NOT NULL) / (count(*) FILTER (n IS NOT NULL AND p IS NOT NULL) * 100)
        - sum(p) FILTER (n IS NOT NULL) / (count(*) FILTER (n IS NOT NULL AND p IS NOT NULL) * 100)) AS DOUBLE)
        AS like_for_like_change
      FROM (SELECT country, max(steps) FILTER (month = DATE '2001-10-01') AS n,
              max(steps) FILTER (month = DATE '2001-09-01') AS p
            FROM (SELECT country, month, CAST(round(rate * 100) AS BIGINT) AS steps FROM rates) GROUP BY country)""",
                                rates=_COUNTRY_MONTHS)
    q["country_line_details"] = _sql(f"SELECT origin_country AS country, {DETAILS} FROM m GROUP BY 1")
    q["country_line_totals"] = _sql(f"SELECT {DETAIL_SUMS} FROM (SELECT {DETAILS} FROM m GROUP BY origin_country)")
    q["top_suppliers"] = _sql(f"""SELECT row_number() OVER (ORDER BY raw DESC, reflected_lines DESC, supplier) AS sl,
      supplier, origin_countries, factory_count, dest_po_count, reflected_lines, CAST(printf('%.1f', raw) AS DOUBLE) AS rate
      FROM (SELECT supplier, {COUNTRIES} AS origin_countries, count(DISTINCT factory) AS factory_count,
        count(DISTINCT destination_po) AS dest_po_count, count(*) AS reflected_lines, {RATE} AS raw
        FROM m GROUP BY supplier HAVING {RATE} >= 95)""")
    q["follow_up"] = _sql(_FOLLOW, rates=_MONTH_RATES)
    q["follow_up_emails"] = _sql(f"""SELECT supplier, avg_3month, coalesce(emails, '') AS emails FROM ({_FOLLOW})
      LEFT JOIN emails ON lower(trim(supplier)) = supplier_name""", contacts=True, rates=_MONTH_RATES)
    q["country_trend"] = _sql("""SELECT k.country, grid.month, r.rate
      FROM (SELECT DISTINCT origin_country AS country FROM year) k CROSS JOIN grid
      LEFT JOIN rates r ON r.country IS NOT DISTINCT FROM k.country AND r.month = grid.month""",
                              rates=_COUNTRY_MONTHS)
    q["country_order"] = _sql("""SELECT row_number() OVER (ORDER BY first_month, country NULLS LAST) AS position,
      country, first_month FROM (SELECT origin_country AS country, min(month) AS first_month FROM year GROUP BY 1)""")
    trend = """SELECT k.supplier, grid.month, CAST(printf('%.1f', r.rate) AS DOUBLE) AS rate
      FROM (SELECT DISTINCT supplier FROM year) k CROSS JOIN grid
      LEFT JOIN rates r ON r.supplier = k.supplier AND r.month = grid.month"""
    q["supplier_trend"] = _sql(trend, rates=_MONTH_RATES)
    q["yearly_cells"] = _sql(f"""SELECT *, CASE WHEN rate < 40 THEN 'low' WHEN rate < 60 THEN 'mid' ELSE 'none' END
      AS heat_band FROM ({trend})""", rates=_MONTH_RATES)
    q["yearly_search"] = _sql("""SELECT * FROM (SELECT row_number() OVER (ORDER BY supplier) AS sl, supplier
      FROM (SELECT DISTINCT supplier FROM year)) WHERE supplier LIKE '%5%'""")
    q["yearly_average"] = _sql(f"""SELECT supplier, CAST(printf('%.1f', mean) AS DOUBLE) AS mean_rate,
      CASE WHEN mean < 40 THEN 'low' WHEN mean < 60 THEN 'mid' ELSE 'none' END AS heat_band
      FROM (SELECT supplier, sum(CAST(round(rate * 10) AS BIGINT)) / (count(rate) * 10) AS mean
        FROM ({trend}) GROUP BY supplier)""", rates=_MONTH_RATES)

    q["kpi_monthly"] = _sql(_KPI_TABLE)
    q["kpi_monthly_totals"] = _sql(f"""SELECT month, CAST(sum(suppliers) AS BIGINT) AS suppliers,
      CAST(sum(factories) AS BIGINT) AS factories, CAST(sum(reflected_lines) AS BIGINT) AS reflected_lines
      FROM ({_KPI_TABLE}) GROUP BY month""")
    q["approver_performance"] = _sql("""SELECT approved_by, CASE WHEN p0 > 0 THEN m0 END AS m0,
      CASE WHEN p1 > 0 THEN m1 END AS m1, CASE WHEN p12 > 0 THEN m12 END AS m12,
      CAST(printf('%.4f', m0 / max(greatest(m0, m1, m12)) OVER ()) AS DOUBLE) AS share_of_max
      FROM counts, (SELECT m0 AS p0, m1 AS p1, m12 AS p12 FROM present)""",
                                     counts=f"SELECT approved_by, {_MONTH_CELLS} FROM tab "
                                            "WHERE approved_by <> '' GROUP BY 1",
                                     present=f"SELECT {_MONTH_CELLS} FROM tab")
    q["avg_lines_per_day"] = _sql(f"""SELECT region, lines, CAST(working_days AS INTEGER) AS working_days,
      CAST(ceil(lines / working_days) AS BIGINT) AS avg
      FROM (SELECT 'BD' AS region, count(*) FILTER (region = 'BD') AS lines,
              {working('5, 6', "DATE '2001-10-01'")} AS working_days FROM active
            UNION ALL SELECT 'CN', count(*) FILTER (region = 'CN'), {working('6, 7', "DATE '2001-10-01'")} FROM active)
      """, active="SELECT * FROM m WHERE origin_country IS NOT NULL AND packaging_status <> 'Pending'")
    q["supplier_factory_trend"] = _sql(f"SELECT * EXCLUDE (lines, bd, cn) FROM ({_TREND.format(rows='year')})")
    q["region_lines"] = _sql(f"SELECT month, bd, cn FROM ({_TREND.format(rows='year')})")
    measures = "\n UNION ALL ".join(
        f"SELECT '{name}' AS measure, n.{name} AS now, b.{name} AS before, n.bd, n.cn FROM n LEFT JOIN b ON TRUE"
        for name in ("lines", "suppliers", "factories"))
    q["kpi_headline"] = _sql(f"""SELECT measure, now, before, {pct_change('now', 'before')} AS change_pct,
      CAST(round_even(bd / (bd + cn) * 100, 0) AS BIGINT) AS bd_share,
      100 - CAST(round_even(bd / (bd + cn) * 100, 0) AS BIGINT) AS cn_share FROM ({measures})""",
                             t=_TREND.format(rows="year"), n="SELECT * FROM t WHERE month = DATE '2001-10-01'",
                             b="SELECT * FROM t WHERE month = DATE '2001-09-01'")
    q["month_comparison"] = _sql(f"""SELECT country, region, NULLIF(m0, 0) AS lines_m0, NULLIF(m1, 0) AS lines_m1,
      NULLIF(m12, 0) AS lines_m12, CAST(round_even(m0 / sum(m0) OVER () * 100, 0) AS BIGINT) AS share
      FROM (SELECT origin_country AS country, any_value(region) AS region, {_MONTH_CELLS} FROM tab GROUP BY 1)""")

    q["dashboard_suppliers"] = _sql(_SUPPLIER_TABLE, **_dashboard("factory ILIKE '%brand#1%'"))
    q["dashboard_region_filter"] = _sql(_SUPPLIER_TABLE, **_dashboard(region="region = 'BD'"))
    q["dashboard_cards"] = _sql(_CARDS, **_dashboard())
    q["dashboard_cards_region"] = _sql(_CARDS, **_dashboard(region="region = 'CN'"))
    q["band_filter"] = _sql(f"""SELECT supplier, compliance, band, lines FROM ({_SUPPLIER_TABLE})
      WHERE band = 'low' ORDER BY compliance, supplier LIMIT 25""", **_dashboard())
    rates_by_region = ", ".join(
        f"CAST(printf('%.1f', count(*) FILTER (y.region IN ({keys}) AND compliance_status = 'Compliant') "
        f"/ NULLIF(count(*) FILTER (y.region IN ({keys})), 0) * 100) AS DOUBLE) AS \"{name}\""
        for name, keys in (("bd", "'BD'"), ("cn", "'CN'"), ("all", "'BD', 'CN'")))
    q["rate_trend"] = _sql(f"SELECT month, {rates_by_region} FROM grid LEFT JOIN year y USING (month) GROUP BY month")
    q["country_bars"] = _sql(f"""SELECT row_number() OVER (ORDER BY raw DESC, country) AS position, country,
      CAST(printf('%.1f', raw) AS DOUBLE) AS rate FROM (SELECT origin_country AS country, {RATE} AS raw FROM m
      WHERE origin_country IS NOT NULL AND region = 'BD' GROUP BY 1)""")
    q["kpi_dashboard"] = _sql(f"""SELECT n.lines, {pct_change('n.lines', 'b.lines')} AS lines_change_pct, n.suppliers,
      n.suppliers - b.suppliers AS suppliers_change, n.factories, n.factories - b.factories AS factories_change,
      bd_lines, CAST(bd_working_days AS INTEGER) AS bd_working_days,
      CAST(ceil(bd_lines / bd_working_days) AS BIGINT) AS bd_avg,
      cn_lines, CAST(cn_working_days AS INTEGER) AS cn_working_days,
      CAST(ceil(cn_lines / cn_working_days) AS BIGINT) AS cn_avg
      FROM n LEFT JOIN b ON TRUE, (SELECT
        count(*) FILTER (region = 'BD' AND packaging_status <> 'Pending') AS bd_lines,
        count(*) FILTER (region = 'CN' AND packaging_status <> 'Pending') AS cn_lines,
        {working('5, 6', "DATE '2001-10-01'")} AS bd_working_days,
        {working('6, 7', "DATE '2001-10-01'")} AS cn_working_days FROM m)""",
                              t=_TREND.format(rows="year"), n="SELECT * FROM t WHERE month = DATE '2001-10-01'",
                              b="SELECT * FROM t WHERE month = DATE '2001-09-01'")
    q["kpi_people"] = _sql(f"""SELECT month, lines, suppliers, factories, bd AS bd_lines, cn AS cn_lines, bd_suppliers,
      cn_suppliers, bd_factories, cn_factories FROM ({_TREND.format(rows='picked')})""",
                           picked="SELECT * FROM year WHERE approved_by = '2-HIGH'")
    q["kpi_countries"] = _sql("""SELECT origin_country AS country, NULLIF(count(*) FILTER (
        month = DATE '2001-10-01'), 0) AS lines_m0, NULLIF(count(*) FILTER (month = DATE '2001-09-01'), 0) AS lines_m1,
      NULLIF(count(*) FILTER (month = DATE '2000-10-01'), 0) AS lines_m12, 'CN' AS region,
      CAST(coalesce(round_even(count(*) FILTER (month = DATE '2001-10-01') / (SELECT count(*) FROM picked
        WHERE month = DATE '2001-10-01') * 100, 0), 0) AS BIGINT) AS share
      FROM picked WHERE origin_country <> '' GROUP BY 1""",
                              picked="""SELECT * FROM lines WHERE region = 'CN' AND factory ILIKE '%brand#2%'
      AND month BETWEEN DATE '2000-10-01' AND DATE '2001-10-01'""")
    q["approver_change"] = _sql(f"""SELECT approved_by, now, prev, {pct_change('now', 'prev')} AS change_pct
      FROM (SELECT approved_by, count(*) FILTER (month = DATE '2001-10-01') AS now,
        count(*) FILTER (month = DATE '2001-09-01') AS prev FROM lines
        WHERE month IN (DATE '2001-10-01', DATE '2001-09-01') AND approved_by <> '' GROUP BY 1)""")

    q["transaction_list"] = _sql(f"""SELECT supplier, factory, destination_po, kimball, description, po_qty,
      {_TEXT_DAY.format('handover_date')} AS handover_text, {_TEXT_DAY.format('updated_date')} AS updated_text,
      {_TEXT_DAY.format('approved_date')} AS approved_text, {_SIDE.format('carton_length_mm')} || '×' ||
      {_SIDE.format('carton_width_mm')} || '×' || {_SIDE.format('carton_height_mm')} AS carton_size,
      packaging_status, compliance_status FROM m""")
    order = ", ".join(f"{c} NULLS LAST" for c in (
        "handover_date", "updated_date", "area", "sub_area", "origin_country", "origin_port", "supplier", "factory",
        "destination_po", "kimball", "colour_code", "description", "size", "po_qty", "carton_matrix_code",
        "units_per_carton", "carton_length_mm", "carton_width_mm", "carton_height_mm", "packaging_supplier",
        "updated_by", "approved_date", "approved_by", "packaging_status", "carton_type", "cbm", "density",
        "compliance_status", "source_file"))
    q["transaction_page"] = _sql("""SELECT page, total, handover_date, destination_po, kimball, factory, description,
      po_qty FROM (SELECT *, (pos + 1) // 2 AS page, max((pos + 1) // 2) OVER () AS last FROM numbered)
      WHERE page = last""", numbered=f"""SELECT *, row_number() OVER (ORDER BY {order}) AS pos,
      count(*) OVER () AS total FROM m WHERE supplier = 'Supplier#000000001' AND (destination_po ILIKE '%#%'
      OR kimball ILIKE '%#%' OR factory ILIKE '%#%' OR description ILIKE '%#%')""")
    fields = ("destination_po", "kimball", "factory", "description")
    searches = ", ".join(
        "count(*) FILTER ({}) AS {}".format(" OR ".join(f"contains(lower({c}), '{text}')" for c in fields), name)
        for name, text in (("percent", "%"), ("underscore", "_"), ("brand", "brand#1"), ("digits", "99")))
    q["text_search"] = _sql(f"SELECT {searches}, count(*) AS blank FROM lines")
    q["search_names"] = _sql("""SELECT 'supplier' AS kind, supplier AS name, supplier FROM (
        SELECT DISTINCT supplier FROM m WHERE supplier ILIKE '%#%' ORDER BY supplier LIMIT 20)
      UNION ALL SELECT DISTINCT 'factory', factory, supplier FROM m WHERE supplier IS NOT NULL AND factory IN (
        SELECT DISTINCT factory FROM m WHERE factory ILIKE '%#%' ORDER BY factory LIMIT 20)""")
    q["filter_options"] = _sql("""SELECT *, CAST(row_number() OVER (PARTITION BY kind ORDER BY value) AS INTEGER) AS position
      FROM (SELECT DISTINCT 'country' AS kind, origin_country AS value FROM m WHERE origin_country <> ''
            UNION ALL SELECT DISTINCT 'approver', approved_by FROM m WHERE approved_by <> '')""")
    q["numbered_lines"] = _sql("""SELECT row_number() OVER (ORDER BY handover_date, supplier, destination_po, kimball)
      AS position, handover_date, supplier, destination_po, kimball FROM lines""")
    q["supplier_json"] = _documents(q)
    q["report_fan_out"] = f"""{q["supplier_json"]}
      UNION ALL SELECT region, supplier, 'transactions', concat_ws('|', factory, destination_po, kimball, description, po_qty,
        handover_text, updated_text, approved_text, carton_size, packaging_status, compliance_status)
      FROM ({q["transaction_list"]}) JOIN folders USING (supplier)"""
    q["report_failures"] = f"""SELECT supplier, CASE WHEN supplier LIKE '%013' THEN 'Incomplete' ELSE 'Written' END AS status,
      count(*) + CASE WHEN supplier LIKE '%013' THEN 0 ELSE 1 END AS items,
      CASE WHEN supplier LIKE '%013' THEN 'checked' END AS failed_sections FROM ({q["supplier_json"]}) GROUP BY supplier"""
    q["month_summary_tables"] = _bundle(q, SUMMARY_TABLES)
    q["kpi_report_tables"] = _bundle(q, KPI_TABLES)
    return q
