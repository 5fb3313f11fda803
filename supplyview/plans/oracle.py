"""The queries again in SQL, for a side-by-side check on the same tables.

Written from the rules, not from the DataFrame code: windows over whole sheets
and nested loops are fine here, since the check runs on small data.
"""

from __future__ import annotations

# --- inputs ------------------------------------------------------------------

DIM = """
dim AS (
  SELECT p_name AS product,
         CASE WHEN starts_with(p_name, 'red ') THEN 'N/A'
              WHEN starts_with(p_name, 'old ') THEN ''
              ELSE split_part(p_name, ' ', -1) END AS category,
         min(p_partkey) AS file_pos
  FROM part WHERE NOT starts_with(p_name, 'hot ') GROUP BY p_name)"""

LINES = """
lines AS (
  SELECT l_orderkey, p_name AS product, l_quantity AS quantity,
         CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'LANDED'
              WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'PULLOUT'
              WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'SAILING'
              WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 'UNSERVED IMPORTED'
              WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'UNSERVED LOCAL'
         END AS status
  FROM lineitem JOIN part ON l_partkey = p_partkey
  WHERE NOT (l_returnflag = 'R' AND l_linestatus = 'O'))"""

STOCK = """
stock AS (
  SELECT p_name AS product, CAST(p_size AS DOUBLE) AS quantity, 'INVENTORY' AS status FROM part)"""

_AMOUNT = """
         CAST(replace(format('{:,}', CAST(floor(sum(CAST(p_retailprice AS DECIMAL(18,2)))) AS BIGINT)),
              ',', '') AS DOUBLE) AS ingredient_amount,
         CAST(sum(p_size) AS DOUBLE) AS ingredient_stock,
         min(p_partkey) AS file_pos"""

USAGE = f"""
usage AS (SELECT p_name AS ingredient_name, {_AMOUNT} FROM part GROUP BY p_name)"""

LOOSE = f"""
loose AS (
  SELECT CASE WHEN starts_with(p_name, 'hot ') THEN split_part(p_name, ' ', -1)
              WHEN starts_with(p_name, 'cold ') THEN upper(p_name) || ' Premium'
              WHEN starts_with(p_name, 'new ')
                THEN 'alloy ' || substr(split_part(p_name, ' ', -1), 1, 2)
              ELSE p_name END AS ingredient_name, {_AMOUNT}
  FROM part GROUP BY 1)"""

# Product sums in the tables' own units, with the category of each product.
SUMS = f"""{DIM}, {LINES}, {STOCK}, {USAGE},
fact_lines AS (
  SELECT product, quantity, status FROM lines
  UNION ALL SELECT product, quantity, status FROM stock
  UNION ALL SELECT ingredient_name, ingredient_amount, 'GLOBAL USAGE' FROM usage),
fact AS (
  SELECT f.product, f.quantity, f.status,
         CASE WHEN d.product IS NOT NULL THEN d.category
              WHEN f.status = 'GLOBAL USAGE' THEN f.product ELSE '' END AS category
  FROM fact_lines f LEFT JOIN dim d ON f.product = d.product),
sums AS (
  SELECT CASE WHEN category = '' THEN 'Uncategorized' ELSE category END AS category, status,
         sum(quantity) / CASE WHEN status IN ('INVENTORY', 'GLOBAL USAGE', 'UNSERVED LOCAL')
                              THEN 1000 ELSE 1 END AS quantity
  FROM fact WHERE category <> 'N/A' GROUP BY 1, 2)"""

STATUSES = (
    "GLOBAL USAGE", "INVENTORY", "LANDED", "PULLOUT", "SAILING",
    "UNSERVED IMPORTED", "UNSERVED LOCAL",
)
COUNTED = [s for s in STATUSES if s != "GLOBAL USAGE"]


def _status_columns(rounded: bool = True) -> str:
    parts = []
    for s in STATUSES:
        total = f"coalesce(sum(quantity) FILTER (status = '{s}'), 0)"
        parts.append(f"round({total}, 6) AS \"{s}\"" if rounded else f"{total} AS \"{s}\"")
    return ", ".join(parts)


WIDE = f"""
labelled AS (
  SELECT category, status, quantity, false AS is_total FROM sums
  UNION ALL SELECT 'TOTAL', status, quantity, true FROM sums),
wide AS (
  SELECT is_total, category, {_status_columns(rounded=False)}
  FROM labelled GROUP BY is_total, category),
totalled AS (
  SELECT *, {' + '.join(f'"{s}"' for s in COUNTED)} AS total FROM wide)"""

PLAN = """
plan AS (
  SELECT category,
         coalesce(sum(quantity) FILTER (status <> 'GLOBAL USAGE'), 0) AS total,
         coalesce(sum(quantity) FILTER (status = 'INVENTORY'), 0) AS inventory,
         coalesce(sum(quantity) FILTER (status = 'GLOBAL USAGE'), 0) AS monthly_usage
  FROM sums GROUP BY category)"""

FUZZY = f"""{LOOSE},
ingredients AS (
  SELECT l.ingredient_name, l.ingredient_amount, l.file_pos, e.product AS exact,
         (SELECT arg_min(d.product, d.file_pos) FROM dim d
          WHERE contains(lower(d.product), lower(l.ingredient_name))
             OR contains(lower(l.ingredient_name), lower(d.product))) AS part_match
  FROM loose l LEFT JOIN dim e ON e.product = l.ingredient_name),
mapping AS (
  SELECT ingredient_name, ingredient_amount, file_pos,
         coalesce(exact, part_match, ingredient_name) AS mapped_product,
         exact IS NULL AND part_match IS NULL AS is_new
  FROM ingredients)"""

FUZZY_USAGE = """
mapped AS (
  SELECT mapped_product, arg_min(ingredient_amount, file_pos) / 12 AS monthly
  FROM mapping GROUP BY mapped_product),
products AS (
  SELECT DISTINCT CASE WHEN category = '' THEN 'Uncategorized' ELSE category END AS category, product
  FROM fact WHERE category <> 'N/A'),
category_usage AS (
  SELECT p.category, sum(coalesce(m.monthly, i.ingredient_amount / 12, 0)) AS monthly_usage
  FROM products p LEFT JOIN mapped m ON m.mapped_product = p.product
  LEFT JOIN mapping i ON i.ingredient_name = p.product
  GROUP BY p.category)"""


def _enhanced(usage: str) -> str:
    columns = [f'round("{s}", 6) AS "{s}"' for s in STATUSES]
    columns.append('round(total, 6) AS "TOTAL"')
    columns.append(f'round({usage}, 6) AS "Monthly Usage"')
    for m in range(1, 7):
        columns.append(f'round(total - {usage} * {m}, 6) AS "{m} Month Projection"')
    return "category, " + ", ".join(columns)


GRID = """
grid AS (
  SELECT 'wb' || CAST(event_id // 1024 AS VARCHAR) AS workbook,
         'S' || CAST((event_id // 256) % 4 AS VARCHAR) AS sheet,
         event_id % 256 AS row_idx, event_id,
         CASE
           WHEN event_id % 17 = 0 THEN [NULL, NULL, NULL, NULL, NULL]
           WHEN event_id % 37 <= 1 THEN ['repeat', '1', 'same', NULL, NULL]
           WHEN event_id % 23 = 0 THEN ['ITEM DESCRIPTION', 'QTY IN KGS', 'SUPPLIER', 'REMARKS', NULL]
           WHEN event_id % 41 = 0 THEN [kind, 'LANDED TABLE', supplier, props, NULL]
           WHEN event_id % 43 = 0 THEN [kind, value_text, 'PULL-OUT TABLE', props, NULL]
           WHEN event_id % 47 = 0 THEN ['FOR PULL-OUT', value_text, supplier, props, NULL]
           WHEN event_id % 53 = 0 THEN ['LANDED', value_text, supplier, props, NULL]
           WHEN event_id % 59 = 0 THEN [
             CASE user_id % 4 WHEN 0 THEN 'RAW MATERIALS' WHEN 1 THEN 'raw materials'
                              WHEN 2 THEN 'RAW MATERIAL' ELSE 'Raw Material Name' END,
             CASE user_id % 3 WHEN 0 THEN 'STILL TO BE DELIVERED (in kilos)'
                              WHEN 1 THEN 'Still to deliver (KG)' ELSE 'QTY' END,
             'SUPPLIER', 'REMARKS', NULL]
           WHEN event_id % 61 = 0 THEN ['BILL OF LADING NO', value_text, supplier, props, NULL]
           WHEN event_id % 67 = 0 THEN ['Contract No', value_text, supplier, props, NULL]
           ELSE [kind, value_text, supplier, props, NULL] END AS cells
  FROM (SELECT *,
          CASE WHEN event_id % 3 <> 1 THEN event_type END AS kind,
          CASE WHEN event_id % 29 = 0 THEN '-' ELSE CAST(value AS VARCHAR) END AS value_text,
          CASE WHEN event_id % 5 <> 0 THEN 'SUP ' || CAST(user_id % 20 AS VARCHAR) END AS supplier
        FROM events))"""

SHEET = "workbook, sheet"
JOINED = "array_to_string(list_transform(cells, lambda c: coalesce(c, '~')), '|')"


def joined(cells: str) -> str:
    return JOINED.replace("cells", cells)


def count_cells(test: str, cells: str = "cells") -> str:
    """Number of cells passing ``test`` on the stripped text ``s``."""
    body = test.replace("{s}", "trim(c)")
    return f"len(list_filter({cells}, lambda c: c IS NOT NULL AND {body}))"


def digits(text: str, ignoring: str) -> str:
    return f"regexp_full_match(translate({text}, '{ignoring}', ''), '[0-9]+')"


STRICT = (
    "{s} <> '' AND length({s}) < 50 AND NOT " + digits("{s}", ".-")
    + " AND NOT " + digits("{s}", ".,")
    + " AND NOT regexp_matches(substr({s}, 1, 3), '[0-9]')"
)
LENIENT = "{s} <> '' AND NOT " + digits("{s}", ".-,")
LABEL = "{s} <> '' AND NOT " + digits("{s}", ".-")


def best_row(source: str, rule: str, by: str = SHEET, start: str = "0") -> str:
    """CTE body: the best-scoring of the first ten rows."""
    return f"""
  SELECT {by}, row_idx AS header_row, cells AS header_cells, score FROM (
    SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY score DESC, row_idx) AS rn
    FROM (SELECT *, {count_cells(rule)} AS score FROM {source}
          WHERE row_idx - {start} BETWEEN 0 AND 9))
  WHERE rn = 1 AND score >= 2"""


def first_row(source: str, test: str, by: str = SHEET) -> str:
    """CTE body: the first row passing ``test``."""
    return f"""
  SELECT {by}, min(row_idx) AS header_row, arg_min(cells, row_idx) AS header_cells
  FROM {source} WHERE row_idx >= 0 AND {test} GROUP BY {by}"""


def holds(label: str) -> str:
    return f"list_contains(list_transform(cells, lambda c: trim(c)), '{label}')"


def mentions(text: str) -> str:
    return f"len(list_filter(cells, lambda c: contains(upper(c), '{text}'))) > 0"


BLANK = "len(list_filter(cells, lambda c: c IS NOT NULL)) = 0"

NAMES = """list_transform(header_cells, lambda c, i:
    CASE WHEN c IS NULL OR trim(c) = '' THEN 'Column_' || CAST(i - 1 AS VARCHAR) ELSE trim(c) END)"""


def markers(source: str) -> str:
    """CTEs for the marker split of a grid."""
    titled = "(contains(upper(c), 'HEADER') OR contains(upper(c), 'TABLE') OR i = 1)"
    return f"""
marked AS (
  SELECT * FROM (
    SELECT {SHEET}, row_idx, list_filter(list_transform(cells, lambda c, i:
      CASE WHEN contains(upper(c), 'LANDED') AND {titled} THEN 'LANDED'
           WHEN contains(upper(c), 'PULL') AND {titled} THEN 'PULLOUT' END),
      lambda k: k IS NOT NULL)[1] AS kind
    FROM {source} WHERE row_idx >= 0) WHERE kind IS NOT NULL),
firsts AS (
  SELECT {SHEET}, min(row_idx) FILTER (kind = 'LANDED') AS l, min(row_idx) FILTER (kind = 'PULLOUT') AS p
  FROM marked GROUP BY {SHEET}),
starts AS (
  SELECT m.workbook, m.sheet,
         coalesce(max(row_idx) FILTER (kind = 'LANDED') + 1, 0) AS landed,
         max(row_idx) FILTER (kind = 'PULLOUT') + 1 AS pullout
  FROM marked m JOIN firsts f USING ({SHEET})
  WHERE l IS NULL OR p IS NULL OR row_idx <= greatest(l, p)
  GROUP BY m.workbook, m.sheet),
split AS (
  SELECT g.*, CASE WHEN row_idx < pullout - 1 THEN 'LANDED' ELSE 'PULLOUT' END AS "table",
         CASE WHEN row_idx < pullout - 1 THEN landed ELSE pullout END AS start_row
  FROM {source} g JOIN starts s USING ({SHEET})
  WHERE pullout > landed
    AND ((row_idx >= landed AND row_idx < pullout - 1) OR row_idx >= pullout))"""


FIRST_COL = f"""
valid AS (
  SELECT {SHEET}, row_idx, upper(trim(coalesce(cells[1], ''))) AS title,
         lead(len(list_filter(cells, lambda c: c IS NOT NULL)) >= 2 AND {count_cells(LABEL)} >= 2)
           OVER (PARTITION BY {SHEET} ORDER BY row_idx) AS next_valid
  FROM grid),
first_col AS (
  SELECT {SHEET}, min(row_idx) FILTER (contains(title, 'LANDED')) + 1 AS landed,
         min(row_idx) FILTER (contains(title, 'FOR PULL-OUT')) + 1 AS pullout
  FROM valid WHERE next_valid AND (contains(title, 'LANDED') OR contains(title, 'FOR PULL-OUT'))
  GROUP BY {SHEET}),
lasts AS (SELECT {SHEET}, max(row_idx) AS last_row FROM grid GROUP BY {SHEET}),
first_col_ranges AS (
  SELECT {SHEET}, landed AS l0, CASE WHEN landed < pullout THEN pullout - 2 ELSE last_row END AS l1,
         pullout AS p0, CASE WHEN pullout <= landed THEN landed - 2 ELSE last_row END AS p1
  FROM first_col JOIN lasts USING ({SHEET}))"""


def cut(ranges: str, source: str = "grid") -> str:
    return f"""
  SELECT g.*, CASE WHEN row_idx BETWEEN l0 AND l1 THEN 'LANDED' ELSE 'PULLOUT' END AS "table",
         CASE WHEN row_idx BETWEEN l0 AND l1 THEN l0 ELSE p0 END AS start_row
  FROM {source} g JOIN {ranges} r USING ({SHEET})
  WHERE row_idx BETWEEN l0 AND l1 OR row_idx BETWEEN p0 AND p1"""


TABLE_ROWS = f'SELECT {SHEET}, "table", start_row, row_idx, {JOINED} AS cells'

# Trailing nulls do not matter: the grid's rows all have the same width.
SEPARATORS = f"""
flagged AS (
  SELECT {SHEET}, row_idx,
         {BLANK} OR coalesce({JOINED} = lead({JOINED}) OVER w, false) AS sep
  FROM grid WINDOW w AS (PARTITION BY {SHEET} ORDER BY row_idx))"""

BOUNDARIES = f"""{SEPARATORS},
numbered AS (
  SELECT *, sum(CASE WHEN sep THEN 1 ELSE 0 END) OVER (PARTITION BY {SHEET} ORDER BY row_idx) AS n
  FROM flagged),
boundaries AS (
  SELECT {SHEET}, min(row_idx) AS start_row, max(row_idx) AS end_row
  FROM numbered WHERE NOT sep GROUP BY {SHEET}, n
  UNION ALL
  SELECT {SHEET}, 0, max(row_idx) FROM flagged GROUP BY {SHEET} HAVING bool_and(sep))"""

PATTERNS = f"""
patterned AS (
  SELECT {SHEET}, row_idx,
         array_to_string(list_transform(cells, lambda c: CASE WHEN c IS NULL THEN '-' ELSE 'x' END), '') AS pattern
  FROM grid),
changes AS (
  SELECT *, coalesce(pattern <> lag(pattern) OVER (PARTITION BY {SHEET} ORDER BY row_idx), false) AS change
  FROM patterned),
runs AS (
  SELECT *, sum(CASE WHEN change THEN 1 ELSE 0 END) OVER (PARTITION BY {SHEET} ORDER BY row_idx) AS n,
         bool_or(change) OVER (PARTITION BY {SHEET}) AS changes
  FROM changes),
patterns AS (
  SELECT {SHEET}, min(row_idx) AS start_row, max(row_idx) AS end_row
  FROM runs WHERE changes AND contains(pattern, 'x') GROUP BY {SHEET}, n)"""

MIDPOINT = f"""
values_ AS (
  SELECT {SHEET}, unnest(cells) AS v, unnest(range(len(cells))) AS col FROM grid),
columns_ AS (
  SELECT {SHEET}, col, bool_or(v IS NOT NULL AND TRY_CAST(trim(v) AS DOUBLE) IS NULL) AS has_text
  FROM values_ GROUP BY {SHEET}, col),
mixed AS (
  SELECT {SHEET} FROM columns_ GROUP BY {SHEET} HAVING bool_or(has_text) AND NOT bool_and(has_text)),
midpoint AS (
  SELECT {SHEET}, 0 AS l0, (max(row_idx) + 1) // 2 - 1 AS l1,
         (max(row_idx) + 1) // 2 AS p0, max(row_idx) AS p1
  FROM grid JOIN mixed USING ({SHEET}) GROUP BY {SHEET})"""


def first_two(ranges: str, name: str, keep_single: bool) -> str:
    having = "" if keep_single else "HAVING count(*) >= 2"
    return f"""
{name} AS (
  SELECT {SHEET}, min(start_row) FILTER (n = 1) AS l0, min(end_row) FILTER (n = 1) AS l1,
         min(start_row) FILTER (n = 2) AS p0, min(end_row) FILTER (n = 2) AS p1
  FROM (SELECT *, row_number() OVER (PARTITION BY {SHEET} ORDER BY start_row) AS n FROM {ranges})
  GROUP BY {SHEET} {having})"""


ADVANCED = f"""{FIRST_COL}, {BOUNDARIES}, {PATTERNS}, {MIDPOINT},
{first_two('boundaries', 'two_boundaries', False)}, {first_two('patterns', 'two_patterns', True)},
ranked AS (
  SELECT 0 AS rule, {SHEET}, l0, l1, p0, p1 FROM first_col_ranges
  UNION ALL SELECT 1, {SHEET}, l0, l1, p0, p1 FROM two_boundaries
  UNION ALL SELECT 2, {SHEET}, l0, l1, p0, p1 FROM two_patterns
  UNION ALL SELECT 3, {SHEET}, l0, l1, p0, p1 FROM midpoint),
chosen AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {SHEET} ORDER BY rule) AS n FROM ranked)
  WHERE n = 1)"""

LOCAL_HEADERS = f"""
local_headers AS (
  SELECT {SHEET}, row_idx, header_cells, {NAMES} AS header FROM (
    SELECT {SHEET}, row_idx, cells AS header_cells FROM grid
    WHERE contains(lower(cells[1]), 'raw') AND contains(lower(cells[1]), 'material')))"""


def renamed_headers(known_product: str = "", known_quantity: str = "") -> str:
    """CTE: positions of the two labels by exact text, alias, then fuzzy rule."""

    def position(expected: str, known: str, fuzzy: str) -> str:
        low = "list_transform(header, lambda h: lower(h))"
        steps = [f"list_position({low}, '{expected.lower()}')"]
        if known:
            steps.append(f"list_position({low}, '{known}')")
        steps.append(f"list_position(list_transform({low}, lambda h: {fuzzy}), true)")
        return "coalesce(" + ", ".join(f"nullif({s}, 0)" for s in steps) + ")"

    product = position(
        "RAW MATERIALS", known_product, "contains(h, 'raw') AND contains(h, 'material')"
    )
    quantity = position(
        "STILL TO BE DELIVERED (in kilos)", known_quantity,
        "contains(h, 'still') AND contains(h, 'deliver') AND (contains(h, 'kilo') OR contains(h, 'kg'))",
    )
    return f"""{LOCAL_HEADERS},
placed AS (SELECT *, {product} AS product_at, {quantity} AS quantity_at FROM local_headers),
renamed AS (
  SELECT *, list_transform(header, lambda h, i:
    CASE WHEN i = product_at THEN 'RAW MATERIALS'
         WHEN i = quantity_at THEN 'STILL TO BE DELIVERED (in kilos)' ELSE h END) AS new_header
  FROM placed)"""


def _is_new(at: str, expected: str, known: str = "") -> str:
    found = f"lower(header[{at}])"
    test = f"{at} IS NOT NULL AND {found} <> '{expected.lower()}'"
    return f"{test} AND {found} <> '{known}'" if known else test


ORDER_ROWS = """
order_rows AS (
  SELECT o_orderkey, 'material ' || CAST(o_custkey % 500 AS VARCHAR) AS product,
         CAST(o_totalprice AS VARCHAR) AS price, o_orderpriority,
         o_orderkey // 128 AS sheet_no, o_orderkey % 128 AS pos
  FROM orders)"""

DELIVERIES = f"""{ORDER_ROWS},
kinds AS (
  SELECT *, 'deliveries' || CAST(sheet_no // 6 AS VARCHAR) AS workbook,
         ['LANDED.PULL OUT', 'SAILING', 'UNSERVED IMPORTED', 'UNSERVED LOCAL', 'SUMMARY', 'NOTES'][sheet_no % 6 + 1] AS sheet
  FROM order_rows),
heads AS (
  SELECT *,
    CASE WHEN sheet = 'UNSERVED LOCAL' THEN 'RAW MATERIALS' ELSE 'PRODUCT' END AS product_name,
    CASE sheet WHEN 'LANDED.PULL OUT' THEN 'QTY (MT) /BL' WHEN 'SAILING' THEN 'QTY (MT) /BL'
               WHEN 'UNSERVED IMPORTED' THEN 'TOTAL'
               WHEN 'UNSERVED LOCAL' THEN 'STILL TO BE DELIVERED (in kilos)' ELSE 'AMOUNT' END AS quantity_name,
    sheet = 'LANDED.PULL OUT' AS stacked
  FROM kinds),
delivery_grid AS (
  SELECT workbook, sheet, pos + CASE WHEN stacked AND pos >= 64 THEN 4 ELSE 2 END AS row_idx,
         [CASE WHEN sheet <> 'UNSERVED LOCAL' OR o_orderkey % 4 = 0 THEN product END,
          CASE WHEN o_orderkey % 11 = 0 THEN 'n.a.' ELSE price END,
          CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority END, NULL] AS cells
  FROM heads
  UNION ALL
  SELECT workbook, sheet, 0, [CASE WHEN stacked THEN 'LANDED TABLE' ELSE 'REPORT 1' END, NULL, NULL, NULL]
  FROM heads WHERE pos = 0
  UNION ALL
  SELECT workbook, sheet, 1, [product_name, quantity_name, 'SUPPLIER', NULL] FROM heads WHERE pos = 0
  UNION ALL
  SELECT workbook, sheet, 66, ['PULL-OUT TABLE', NULL, NULL, NULL] FROM heads WHERE pos = 64 AND stacked
  UNION ALL
  SELECT workbook, sheet, 67, [product_name, quantity_name, 'SUPPLIER', NULL] FROM heads WHERE pos = 64 AND stacked),
stacked_rows AS (SELECT * FROM delivery_grid WHERE sheet = 'LANDED.PULL OUT'),
{markers('stacked_rows')},
routed AS (
  SELECT workbook, sheet, row_idx, cells, sheet AS "table", 0 AS start_row FROM delivery_grid
  WHERE sheet NOT IN ('LANDED.PULL OUT', 'SUMMARY')
  UNION ALL SELECT workbook, sheet, row_idx, cells, "table", start_row FROM split),
best AS ({best_row('routed', STRICT, SHEET + ', "table"', 'start_row')}),
located AS (
  SELECT t.workbook, t.sheet, t."table", b.header_row, m.p IS NOT NULL AS mapped, m.p, m.q,
         CAST(nullif(list_position({NAMES}, m.p), 0) - 1 AS BIGINT) AS product_pos,
         CAST(nullif(list_position({NAMES}, m.q), 0) - 1 AS BIGINT) AS quantity_pos
  FROM (SELECT DISTINCT workbook, sheet, "table" FROM routed) t
  LEFT JOIN best b USING (workbook, sheet, "table")
  LEFT JOIN (VALUES ('LANDED', 'PRODUCT', 'QTY (MT) /BL'), ('PULLOUT', 'PRODUCT', 'QTY (MT) /BL'),
                    ('SAILING', 'PRODUCT', 'QTY (MT) /BL'), ('UNSERVED IMPORTED', 'PRODUCT', 'TOTAL'),
                    ('UNSERVED LOCAL', 'RAW MATERIALS', 'STILL TO BE DELIVERED (in kilos)')
            ) m(tbl, p, q) ON m.tbl = t."table"),
reasoned AS (
  SELECT *, CASE WHEN NOT mapped THEN 'no column mapping'
                 WHEN product_pos IS NULL OR quantity_pos IS NULL THEN
                   'missing columns: ' || concat_ws(', ', CASE WHEN product_pos IS NULL THEN p END,
                                                   CASE WHEN quantity_pos IS NULL THEN q END)
            END AS reason
  FROM located),
delivered AS (
  SELECT r.workbook, r.sheet, r."table", r.row_idx,
         -- Summary rows of unserved local have no supplier and lose their product.
         CASE WHEN r."table" = 'UNSERVED LOCAL' AND coalesce(cells[3], '') = '' THEN ''
              ELSE cells[product_pos + 1] END AS product,
         cells[quantity_pos + 1] AS quantity_text
  FROM routed r JOIN reasoned x USING (workbook, sheet, "table")
  WHERE x.reason IS NULL AND r.row_idx > x.header_row AND NOT {BLANK})"""

INVENTORY_GRID = f"""
inventory_grid AS (
  SELECT workbook, sheet, unnest(
      CASE WHEN pos = 0 THEN [{{'row_idx': 0, 'cells': ['STOCK LIST', NULL, NULL, NULL]}},
                              {{'row_idx': 1, 'cells': [NULL, NULL, NULL, NULL]}},
                              {{'row_idx': 2, 'cells': ['ITEM DESCRIPTION',
                                 CASE WHEN sheet_no % 5 <> 4 THEN 'QTY IN KGS' ELSE 'KGS' END, 'QTY OPEN', 'BRAND']}}]
           ELSE [] END
      || [{{'row_idx': pos + 3, 'cells':
            CASE WHEN p_partkey % 23 = 0 THEN [NULL, NULL, NULL, NULL]
                 ELSE [CASE p_partkey % 19 WHEN 0 THEN '  ' WHEN 1 THEN NULL ELSE p_name END,
                       CAST(p_size AS VARCHAR), NULL, p_brand] END}}], recursive := true)
  FROM (SELECT *, p_partkey // 128 AS sheet_no, p_partkey % 128 AS pos,
               'inventory' || CAST(p_partkey // 1024 AS VARCHAR) AS workbook,
               'S' || CAST((p_partkey // 128) % 8 AS VARCHAR) AS sheet FROM part))"""

# Every fifth group of four rows below the header is a merged product cell.
MERGED_GRID = INVENTORY_GRID.replace("inventory_grid AS", "unmerged_grid AS") + """,
inventory_grid AS (
  SELECT workbook, sheet, row_idx, g, is_merged,
         CASE WHEN is_merged THEN [CASE WHEN row_idx = 3 + 4 * g THEN 'pack widget ' || CAST(g AS VARCHAR) END]
                                  || cells[2:] ELSE cells END AS cells
  FROM (SELECT *, (row_idx - 3) // 4 AS g, row_idx >= 3 AND ((row_idx - 3) // 4) % 5 = 2 AS is_merged
        FROM unmerged_grid))"""

STOCK_ROWS = f"""
stock_header AS ({first_row('inventory_grid', holds('ITEM DESCRIPTION') + ' AND ' + holds('QTY IN KGS') + ' AND row_idx < 25')}),
stock_rows AS (
  SELECT workbook, sheet, row_idx - header_row - 1 AS row_idx, row_idx AS sheet_row, cells, {NAMES} AS header
  FROM inventory_grid JOIN stock_header USING ({SHEET}) WHERE row_idx > header_row)"""

INVENTORY = f"{INVENTORY_GRID},{STOCK_ROWS}"


SPLIT = f"""{ORDER_ROWS},
kinds AS (
  SELECT *, sheet_no % 6 AS turn, (sheet_no // 6) % 3 AS variant,
         CASE WHEN sheet_no % 6 = 4 THEN 'local' ELSE 'imports' END || CAST(sheet_no // 6 AS VARCHAR) AS workbook,
         ['Sailling', 'Landed', 'For Pull out Return', 'UNSERVED', 'Sheet1', 'Other'][sheet_no % 6 + 1] AS sheet
  FROM order_rows),
split_grid AS (
  SELECT workbook, sheet, turn, pos + 2 AS row_idx,
         CASE WHEN o_orderkey % 13 = 0 THEN [NULL, NULL, NULL, NULL]
              ELSE [CASE WHEN turn <> 4 OR o_orderkey % 4 = 0 THEN product END,
                    CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority END, price, NULL] END AS cells
  FROM kinds
  UNION ALL SELECT workbook, sheet, turn, CASE WHEN turn = 3 THEN 0 ELSE -1 END, ['note', NULL, NULL, NULL]
  FROM kinds WHERE pos = 0
  UNION ALL SELECT workbook, sheet, turn, CASE WHEN turn = 3 THEN 1 ELSE 0 END, ['title', NULL, NULL, NULL]
  FROM kinds WHERE pos = 0
  UNION ALL SELECT workbook, sheet, turn, CASE WHEN turn = 3 THEN -1 ELSE 1 END,
    CASE WHEN turn = 4 THEN CASE variant
           WHEN 0 THEN ['RAW MATERIALS', 'SUPPLIER', 'STILL TO BE DELIVERED (in kilos)', NULL]
           WHEN 1 THEN ['Raw Material', 'SUPPLIER', 'Still to deliver (KG)', NULL]
           ELSE ['raw materials', 'SUPPLIER', 'REMAINING', NULL] END
         ELSE ['PRODUCT', CASE WHEN turn = 0 THEN 'Contract No' ELSE 'Bill of Lading' END,
               CASE WHEN turn = 3 THEN 'TOTAL' ELSE 'QTY (MT) /BL' END, NULL] END
  FROM kinds WHERE pos = 0),
-- By construction the header is the row naming the product; the local sheets of
-- variant 2 have no quantity column.
split_header AS (
  SELECT workbook, sheet, turn, min(row_idx) AS header_row, arg_min(cells, row_idx) AS header_cells
  FROM split_grid
  WHERE CASE turn WHEN 0 THEN row_idx >= 0 AND {mentions('CONTRACT')}
                  WHEN 1 THEN row_idx >= 0 AND {mentions('BILL OF LADING')}
                  WHEN 2 THEN row_idx >= 0 AND {mentions('BILL OF LADING')}
                  WHEN 3 THEN row_idx = -1
                  WHEN 4 THEN row_idx >= 0 AND row_idx < 200 AND {count_cells(LENIENT)} >= 2
                  ELSE false END
  GROUP BY workbook, sheet, turn),
split_body AS (
  SELECT g.workbook, g.sheet, g.turn, row_idx, header_row,
         ['SAILING', 'LANDED', 'PULLOUT', 'UNSERVED IMPORTED', 'UNSERVED LOCAL'][g.turn + 1] AS "table",
         cells[1] AS product, cells[2] AS supplier, cells[3] AS quantity_text, header_cells[3] AS quantity_name
  FROM split_grid g JOIN split_header h USING (workbook, sheet)
  WHERE row_idx > header_row AND NOT {BLANK}),
split_filled AS (
  SELECT * EXCLUDE (product),
         CASE WHEN turn <> 4 THEN product
              WHEN supplier IS NULL OR supplier = '' THEN ''
              ELSE last_value(product IGNORE NULLS) OVER (
                PARTITION BY workbook, sheet ORDER BY row_idx ROWS UNBOUNDED PRECEDING) END AS product
  FROM split_body WHERE quantity_name <> 'REMAINING')"""


def with_(*parts: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",".join(p.strip() for p in parts) + "\n"


ORACLE_SQL: dict[str, str] = {}

# --- the fact ----------------------------------------------------------------

_TONS = "CASE WHEN status IN ('INVENTORY', 'GLOBAL USAGE', 'UNSERVED LOCAL') THEN quantity / 1000 ELSE quantity END"

ORACLE_SQL["combined_fact"] = with_(SUMS) + (
    f"SELECT product, {_TONS} AS quantity, status, category FROM fact"
)
ORACLE_SQL["category_lookup"] = with_(DIM, LINES) + (
    "SELECT l_orderkey, l.product, coalesce(d.category, '') AS category"
    " FROM lines l LEFT JOIN dim d ON l.product = d.product"
)
ORACLE_SQL["mapped_projection"] = with_(DELIVERIES) + (
    'SELECT workbook, sheet, "table", header_row, product_pos, quantity_pos, reason FROM reasoned'
)
ORACLE_SQL["nonempty_product"] = """
SELECT event_id, CASE WHEN event_id % 7 = 3 THEN ' ' || event_type ELSE event_type END AS product
FROM events WHERE event_id % 7 >= 3"""
ORACLE_SQL["lenient_numeric"] = """
SELECT event_id, CASE event_id % 13
  WHEN 0 THEN value WHEN 2 THEN CAST(CAST(value AS VARCHAR) || 'e3' AS DOUBLE) WHEN 3 THEN -value
  WHEN 8 THEN value WHEN 10 THEN 0.5 WHEN 11 THEN 5.0 END AS parsed
FROM events"""
_UNITS = "SELECT status, round(sum(quantity) {}, 6) AS quantity FROM (SELECT quantity, status FROM lines UNION ALL SELECT quantity, status FROM stock) GROUP BY status"
ORACLE_SQL["unit_conversion"] = with_(LINES, STOCK) + _UNITS.format(
    "/ CASE WHEN status IN ('INVENTORY', 'UNSERVED LOCAL') THEN 1000 ELSE 1 END"
)
ORACLE_SQL["unit_conversion_legacy"] = with_(LINES, STOCK) + _UNITS.format(
    "* CASE WHEN status = 'UNSERVED LOCAL' THEN 1000 ELSE 1 END"
)
ORACLE_SQL["usage_clean"] = with_(USAGE) + (
    "SELECT ingredient_name, ingredient_amount, ingredient_stock FROM usage"
)
ORACLE_SQL["usage_fact"] = with_(DIM, USAGE) + """
SELECT ingredient_name AS product, ingredient_amount / 1000 AS quantity, 'GLOBAL USAGE' AS status,
       CASE WHEN d.product IS NULL THEN ingredient_name ELSE d.category END AS category
FROM usage LEFT JOIN dim d ON d.product = ingredient_name"""

# --- reports -----------------------------------------------------------------

ORACLE_SQL["pivot_status"] = with_(SUMS) + (
    f"SELECT category, {_status_columns()} FROM sums GROUP BY category"
)
ORACLE_SQL["pivot_totals"] = with_(SUMS, WIDE) + (
    "SELECT category, "
    + ", ".join(f'round("{s}", 6) AS "{s}"' for s in STATUSES)
    + ', round(total, 6) AS "TOTAL" FROM totalled'
)
# The same report after products were forgotten and others moved: everything anew.
CHANGED = """,
changed AS (
  SELECT product, CASE WHEN file_pos % 20 = 1 THEN 'Moved' ELSE category END AS category
  FROM dim WHERE file_pos % 20 <> 0)"""
ORACLE_SQL["pivot_after_changes"] = with_(
    SUMS.replace(DIM, DIM + CHANGED).replace("LEFT JOIN dim d", "LEFT JOIN changed d"), WIDE
) + (
    "SELECT category, "
    + ", ".join(f'round("{s}", 6) AS "{s}"' for s in STATUSES)
    + ', round(total, 6) AS "TOTAL" FROM totalled'
)
ORACLE_SQL["pivot_shape"] = with_(SUMS) + (
    "SELECT count(DISTINCT category) AS n_categories,"
    " count(DISTINCT status) FILTER (status <> 'GLOBAL USAGE') AS n_statuses FROM sums"
)
ORACLE_SQL["usage_by_category"] = with_(SUMS) + (
    "SELECT category, round(quantity, 6) AS monthly_usage FROM sums WHERE status = 'GLOBAL USAGE'"
)
ORACLE_SQL["usage_monthly"] = with_(USAGE) + """
SELECT ingredient_name, round(ingredient_amount / 1000, 6) AS monthly_kilos,
       round(ingredient_amount / 12 / 1000, 6) AS annual_kilos, round(ingredient_amount / 12, 6) AS annual
FROM usage"""
ORACLE_SQL["projection_long"] = with_(SUMS, PLAN) + """
SELECT category, month, round(total, 6) AS total, round(monthly_usage, 6) AS monthly_usage,
       round(total - monthly_usage * month, 6) AS projection
FROM plan, (SELECT unnest([1, 2, 3, 4, 5, 6]) AS month)"""
ORACLE_SQL["enhanced_pivot"] = with_(SUMS, WIDE) + (
    "SELECT " + _enhanced('"GLOBAL USAGE"') + " FROM totalled"
)
ORACLE_SQL["usage_by_category_fuzzy"] = with_(SUMS, FUZZY, FUZZY_USAGE) + (
    "SELECT category, round(monthly_usage, 6) AS monthly_usage FROM category_usage"
)
ORACLE_SQL["enhanced_pivot_fuzzy"] = with_(SUMS, WIDE, FUZZY, FUZZY_USAGE) + (
    "SELECT " + _enhanced("monthly_usage") + """ FROM (
  SELECT t.*, coalesce(u.monthly_usage, 0) AS monthly_usage FROM totalled t
  LEFT JOIN (SELECT false AS is_total, category, monthly_usage FROM category_usage
             UNION ALL SELECT true, 'TOTAL', sum(monthly_usage) FROM category_usage) u
  USING (is_total, category))"""
)
ORACLE_SQL["inventory_risk"] = with_(SUMS, PLAN) + """
SELECT category, round(inventory, 6) AS inventory, round(monthly_usage, 6) AS monthly_usage,
       CASE WHEN inventory <= 0 THEN 'critical'
            WHEN monthly_usage > 0 AND inventory < monthly_usage THEN 'red'
            WHEN monthly_usage > 0 AND inventory < 2 * monthly_usage THEN 'yellow'
            ELSE 'none' END AS risk
FROM plan"""
ORACLE_SQL["projection_risk"] = with_(SUMS, PLAN) + """
SELECT category, month,
       CASE WHEN monthly_usage > 0 AND total = 0 THEN 'no_stock'
            WHEN monthly_usage > 0 AND total - monthly_usage * month < 0 THEN 'stockout'
            ELSE 'none' END AS risk,
       total - monthly_usage * month < 0 AS is_negative
FROM plan, (SELECT unnest([1, 2, 3, 4, 5, 6]) AS month)"""


def _shown(value: str, decimals: int) -> str:
    value = f"round({value}, 6)"
    return f"CASE WHEN {value} = 0 THEN '-' ELSE format('{{:,.{decimals}f}}', {value}) END"


ORACLE_SQL["pivot_display"] = with_(SUMS, WIDE) + (
    "SELECT category, "
    + ", ".join(f'{_shown(chr(34) + s + chr(34), 0)} AS "{s}"' for s in COUNTED)
    + f', {_shown("total", 0)} AS "TOTAL"'
    + "".join(
        f', {_shown(chr(34) + "GLOBAL USAGE" + chr(34), 2)} AS "{name}"'
        for name in ("GLOBAL USAGE", "Monthly Usage")
    )
    + "".join(
        ", " + _shown(f'(total - "GLOBAL USAGE" * {m})', 2) + f' AS "{m} Month Projection"'
        for m in range(1, 7)
    )
    + " FROM totalled"
)

# --- the category dimension --------------------------------------------------

RAW_DIM = """
clean AS (
  SELECT p_name AS product, min(p_partkey) AS file_pos,
         arg_max(CASE p_size % 5 WHEN 0 THEN '' WHEN 1 THEN 'N/A' ELSE p_type END, p_partkey) AS category
  FROM part GROUP BY p_name)"""
ORACLE_SQL["category_dim"] = with_(RAW_DIM) + "SELECT product, category, file_pos FROM clean"
ORACLE_SQL["category_dim_sorted"] = with_(RAW_DIM) + (
    "SELECT category IN ('', 'N/A') AS is_uncategorized, product, category FROM clean ORDER BY 1, 2"
)
_PRODUCTS = "SELECT product FROM lines UNION SELECT product FROM stock"
ORACLE_SQL["new_products"] = with_(DIM, LINES, STOCK) + (
    f"SELECT product FROM ({_PRODUCTS}) WHERE product NOT IN (SELECT product FROM dim)"
)
ORACLE_SQL["blank_category_products"] = with_(DIM, LINES, STOCK) + (
    f"SELECT product FROM ({_PRODUCTS}) WHERE product IN (SELECT product FROM dim WHERE category = '')"
)
ORACLE_SQL["ingredient_map_exact"] = with_(DIM, USAGE) + """
SELECT ingredient_name, ingredient_name AS mapped_product,
       ingredient_name NOT IN (SELECT product FROM dim) AS is_new FROM usage"""
ORACLE_SQL["ingredient_map_fuzzy"] = with_(DIM, FUZZY) + (
    "SELECT ingredient_name, mapped_product, is_new FROM mapping"
)
ORACLE_SQL["new_ingredients"] = with_(DIM, FUZZY) + """
SELECT product, category FROM dim
UNION ALL SELECT ingredient_name, 'N/A' FROM mapping
WHERE is_new AND ingredient_name NOT IN (SELECT product FROM dim)"""

# --- quality -----------------------------------------------------------------

ORACLE_SQL["status_counts"] = with_(SUMS) + (
    "SELECT status, count(*) AS n_rows FROM fact GROUP BY status ORDER BY 2 DESC, 1"
)
ORACLE_SQL["status_counts_fixed"] = with_(SUMS) + """
SELECT s.status, count(f.status) AS n_rows
FROM (VALUES ('SAILING'), ('LANDED'), ('PULLOUT'), ('UNSERVED IMPORTED'), ('UNSERVED LOCAL')) s(status)
LEFT JOIN fact f ON upper(f.status) = s.status GROUP BY s.status"""
ORACLE_SQL["category_counts"] = with_(SUMS) + """
SELECT CASE WHEN trim(category) = '' THEN 'No category' ELSE category END AS category, count(*) AS n_rows
FROM fact GROUP BY 1"""
ORACLE_SQL["na_products"] = with_(SUMS) + (
    "SELECT product, count(*) AS n_rows FROM fact WHERE category = 'N/A' GROUP BY product"
)
ORACLE_SQL["exclusion_counts"] = with_(SUMS) + """
SELECT count(*) AS n_total, count(*) FILTER (category = 'N/A') AS n_excluded,
       count(*) FILTER (category <> 'N/A') AS n_kept FROM fact"""
ORACLE_SQL["uncategorized_counts"] = with_(RAW_DIM) + """
SELECT count(*) FILTER (category = '') AS n_blank,
       count(*) FILTER (category IN ('', 'N/A')) AS n_blank_or_na FROM clean"""


def _profile(table: str, source: str, columns: dict[str, tuple[str, str]]) -> str:
    parts = [
        f"SELECT '{table}' AS \"table\", count(*) AS n_rows, CAST({len(columns)} AS BIGINT) AS n_columns,"
        f" '{name}' AS \"column\", '{dtype}' AS dtype, count(*) FILTER ({value} IS NULL) AS null_count"
        f" FROM {source}"
        for name, (dtype, value) in columns.items()
    ]
    return " UNION ALL ".join(parts)


ORACLE_SQL["table_profile"] = with_(USAGE, GRID) + " UNION ALL ".join([
    _profile("dimension", "part", {
        "product": ("string", "p_name"),
        "category": ("string", "nullif(p_size % 5, 0)"),
        "file_pos": ("bigint", "p_partkey"),
    }),
    _profile("usage", "usage", {
        "ingredient_name": ("string", "ingredient_name"),
        "ingredient_amount": ("double", "ingredient_amount"),
        "ingredient_stock": ("double", "ingredient_stock"),
    }),
    _profile("sheet", "grid", {
        "kind": ("string", "cells[1]"),
        "value": ("string", "cells[2]"),
        "supplier": ("string", "cells[3]"),
        "props": ("string", "cells[4]"),
        "note": ("string", "cells[5]"),
    }),
])
ORACLE_SQL["grid_profile"] = with_(
    DELIVERIES,
    f"""body AS (
      SELECT r.workbook, r.sheet, r."table", r.row_idx, {NAMES} AS names,
             CASE WHEN r."table" = 'UNSERVED LOCAL' AND coalesce(cells[3], '') = '' THEN [''] || cells[2:] ELSE cells END AS cells
      FROM routed r JOIN best b USING (workbook, sheet, "table")
      WHERE r.row_idx > b.header_row AND NOT {BLANK})""",
    """named AS (
      SELECT * FROM (
        SELECT workbook, sheet, "table", unnest(names) AS "column", unnest(cells) AS v FROM body)
      WHERE v IS NOT NULL)""",
    """counts AS (
      SELECT workbook, sheet, "table", "column", count(*) AS n,
             bool_and(TRY_CAST(trim(v) AS DOUBLE) IS NOT NULL) AS numbers
      FROM named GROUP BY ALL)""",
    'sizes AS (SELECT workbook, sheet, "table", count(*) AS n_rows FROM body GROUP BY ALL)',
) + """
SELECT workbook, sheet, "table", n_rows,
       count(*) OVER (PARTITION BY workbook, sheet, "table") AS n_columns, "column",
       CASE WHEN numbers THEN 'double' ELSE 'string' END AS dtype, n_rows - n AS null_count
FROM counts JOIN sizes USING (workbook, sheet, "table")"""
# On every row of a merged range stands the product of its first row.
MERGED_ROWS = STOCK_ROWS + """,
filled AS (
  SELECT s.*, g.is_merged, g.g,
         CASE WHEN g.is_merged THEN 'pack widget ' || CAST(g.g AS VARCHAR) ELSE s.cells[1] END AS product
  FROM stock_rows s JOIN inventory_grid g
    ON g.workbook = s.workbook AND g.sheet = s.sheet AND g.row_idx = s.sheet_row)"""
ORACLE_SQL["product_search"] = with_(MERGED_GRID, MERGED_ROWS) + """
SELECT workbook, sheet, row_idx, trim(product) AS product, cells[2] AS supplier,
       CAST(NULL AS VARCHAR) AS quantity,
       CAST(CASE WHEN is_merged THEN 3 + 4 * g END AS BIGINT) AS merged_from_row,
       CAST(CASE WHEN is_merged THEN 6 + 4 * g END AS BIGINT) AS merged_to_row
FROM filled WHERE contains(upper(product), 'WIDGET')"""
ORACLE_SQL["search_counts"] = with_(MERGED_GRID, MERGED_ROWS) + """
SELECT workbook, sheet, count(*) AS n_hits, count(*) FILTER (is_merged) AS n_merged
FROM filled WHERE contains(upper(product), 'WIDGET') GROUP BY workbook, sheet"""
ORACLE_SQL["merged_fill"] = with_(MERGED_GRID) + """
SELECT workbook, sheet, row_idx,
       CASE WHEN is_merged THEN 'pack widget ' || CAST(g AS VARCHAR) ELSE cells[1] END AS product,
       CAST(is_merged AS BIGINT) AS n_merged
FROM inventory_grid"""
ORACLE_SQL["first_inventory_sheet"] = with_(MERGED_GRID, MERGED_ROWS) + f"""
SELECT workbook, sheet, 'INVENTORY' AS "table", sheet_row AS row_idx, product, cells[2] AS quantity_text
FROM filled WHERE sheet = 'S0' AND NOT {BLANK}"""
ORACLE_SQL["preview"] = """
SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders ORDER BY o_orderpriority, o_orderkey LIMIT 10"""
ORACLE_SQL["required_columns"] = with_(INVENTORY, f"best AS ({best_row('inventory_grid', STRICT)})") + f"""
SELECT workbook, sheet, 'INVENTORY' AS "table",
       'missing columns: ' || array_to_string(list_filter(['ITEM DESCRIPTION', 'QTY IN KGS'],
          lambda l: NOT list_contains(coalesce({NAMES}, []), l)), ', ') AS reason
FROM (SELECT DISTINCT workbook, sheet FROM inventory_grid) LEFT JOIN best USING ({SHEET})
WHERE NOT coalesce(list_has_all({NAMES}, ['ITEM DESCRIPTION', 'QTY IN KGS']), false)"""

# --- sheets ------------------------------------------------------------------

_HEADER = f"SELECT {SHEET}, header_row, {joined('header_cells')} AS header"
ORACLE_SQL["header_strict"] = with_(GRID, f"best AS ({best_row('grid', STRICT)})") + (
    f"{_HEADER}, score FROM best"
)
ORACLE_SQL["header_lenient"] = with_(
    GRID,
    f"best AS ({best_row('grid', LENIENT)})",
    f"sizes AS (SELECT {SHEET}, count(*) AS n FROM grid GROUP BY {SHEET})",
) + f"{_HEADER}, score FROM best JOIN sizes USING ({SHEET}) WHERE n >= 2"
_REQUIRED = first_row(
    "grid", f"row_idx < 25 AND {holds('ITEM DESCRIPTION')} AND {holds('QTY IN KGS')}"
)
ORACLE_SQL["header_required"] = with_(GRID, f"best AS ({_REQUIRED})") + f"{_HEADER} FROM best"
ORACLE_SQL["header_anchor"] = with_(
    GRID,
    f"a AS ({first_row('grid', mentions('CONTRACT'))})",
    f"b AS ({first_row('grid', mentions('BILL OF LADING'))})",
) + f"{_HEADER}, 'CONTRACT' AS anchor FROM a UNION ALL {_HEADER}, 'BILL OF LADING' FROM b"
ORACLE_SQL["header_priority"] = with_(
    GRID,
    f"""steps AS (SELECT *, CASE
      WHEN len(list_filter(cells, lambda c: upper(trim(c)) = 'RAW MATERIALS')) > 0 THEN 1
      WHEN row_idx < 150 AND {holds('RAW MATERIALS')} AND {holds('STILL TO BE DELIVERED (in kilos)')} THEN 2
      WHEN row_idx < 200 AND {count_cells(LENIENT)} >= 2 THEN 3 END AS step FROM grid)""",
    f"""best AS (SELECT {SHEET}, row_idx AS header_row, cells AS header_cells, CAST(step AS BIGINT) AS step FROM (
      SELECT *, row_number() OVER (PARTITION BY {SHEET} ORDER BY step, row_idx) AS n FROM steps
      WHERE step IS NOT NULL) WHERE n = 1)""",
) + f"{_HEADER}, step FROM best"
ORACLE_SQL["promote_header"] = with_(
    GRID,
    f"best AS ({_REQUIRED})",
    f"""body AS (SELECT {SHEET}, row_idx - header_row - 1 AS row_idx, cells, {NAMES} AS names
      FROM grid JOIN best USING ({SHEET}) WHERE row_idx > header_row)""",
) + f"""
SELECT {SHEET}, row_idx, "column", value FROM (
  SELECT {SHEET}, row_idx, unnest(names) AS "column", unnest(cells) AS value FROM body)
WHERE value IS NOT NULL"""
ORACLE_SQL["split_markers"] = with_(GRID, markers("grid")) + f"{TABLE_ROWS} FROM split"
ORACLE_SQL["split_first_col"] = with_(GRID, FIRST_COL) + (
    f"{TABLE_ROWS} FROM ({cut('first_col_ranges')})"
)
ORACLE_SQL["split_blank_row"] = with_(
    GRID,
    f"blanks AS (SELECT {SHEET}, min(row_idx) FILTER ({BLANK}) AS b, max(row_idx) AS last_row FROM grid GROUP BY {SHEET})",
    f"ranges AS (SELECT {SHEET}, 0 AS l0, coalesce(b - 1, last_row) AS l1, b + 1 AS p0, last_row AS p1 FROM blanks)",
) + f"{TABLE_ROWS} FROM ({cut('ranges')})"
ORACLE_SQL["table_boundaries"] = with_(GRID, BOUNDARIES) + (
    f"SELECT {SHEET}, start_row, end_row FROM boundaries"
)
# The older rule, separator by separator.
ORACLE_SQL["table_boundaries_legacy"] = with_(
    GRID,
    SEPARATORS,
    f"""seps AS (SELECT {SHEET}, row_idx, row_number() OVER (PARTITION BY {SHEET} ORDER BY row_idx) AS n
      FROM flagged WHERE sep)""",
    f"lasts AS (SELECT {SHEET}, max(row_idx) AS last_row FROM grid GROUP BY {SHEET})",
    f"""steps AS (
      SELECT {SHEET}, CAST(0 AS BIGINT) AS n, CAST(0 AS BIGINT) AS opened,
             CAST(NULL AS BIGINT) AS start_row, CAST(NULL AS BIGINT) AS end_row FROM lasts
      UNION ALL
      SELECT s.workbook, s.sheet, s.n, CASE WHEN s.row_idx > opened THEN s.row_idx + 1 ELSE opened END,
             CASE WHEN s.row_idx > opened THEN opened END, CASE WHEN s.row_idx > opened THEN s.row_idx - 1 END
      FROM steps t JOIN seps s ON s.workbook = t.workbook AND s.sheet = t.sheet AND s.n = t.n + 1)""",
    f"""closed AS (SELECT {SHEET}, start_row, end_row FROM steps WHERE start_row IS NOT NULL
      UNION ALL
      SELECT {SHEET}, max(opened), max(last_row) FROM steps JOIN lasts USING ({SHEET})
      GROUP BY {SHEET} HAVING max(opened) <= max(last_row))""",
    recursive=True,
) + f"""
SELECT {SHEET}, start_row, end_row FROM closed
UNION ALL SELECT {SHEET}, 0, last_row FROM lasts ANTI JOIN closed USING ({SHEET})"""
ORACLE_SQL["null_pattern_segments"] = with_(GRID, PATTERNS) + (
    f"SELECT {SHEET}, start_row, end_row FROM patterns"
)
_PER_TABLE = (
    f'SELECT {SHEET}, "table", CAST(start_row AS BIGINT) AS start_row, count(*) AS n_rows,'
    " max(row_idx) AS end_row FROM ({}) GROUP BY ALL"
)
ORACLE_SQL["midpoint_split"] = with_(GRID, MIDPOINT) + _PER_TABLE.format(
    f'SELECT {SHEET}, "table", start_row, row_idx FROM ({cut("midpoint")})'
)
ORACLE_SQL["advanced_split"] = with_(GRID, ADVANCED) + _PER_TABLE.format(
    f'SELECT {SHEET}, "table", start_row, row_idx FROM ({cut("chosen")})'
)


def _filled(column: str) -> str:
    return (
        f"last_value({column} IGNORE NULLS) OVER (PARTITION BY {SHEET} ORDER BY row_idx"
        " ROWS UNBOUNDED PRECEDING)"
    )


_COLUMNS = f"""named AS (SELECT {SHEET}, row_idx, cells[1] AS kind, cells[2] AS value, cells[3] AS supplier, cells[4] AS props, cells[5] AS note FROM grid)"""
ORACLE_SQL["ffill_summary"] = with_(GRID, _COLUMNS) + f"""
SELECT {SHEET}, row_idx, CASE WHEN supplier IS NULL OR supplier = '' THEN '' ELSE {_filled('kind')} END AS kind,
       value, supplier, props, note FROM named"""
ORACLE_SQL["ffill_all"] = with_(GRID, _COLUMNS) + f"""
SELECT {SHEET}, row_idx, {_filled('kind')} AS kind, {_filled('value')} AS value, {_filled('supplier')} AS supplier,
       {_filled('props')} AS props, {_filled('note')} AS note
FROM named"""
ORACLE_SQL["fuzzy_header"] = with_(GRID, renamed_headers()) + (
    f"SELECT {SHEET}, row_idx, array_to_string(new_header, '|') AS header FROM renamed"
)
ORACLE_SQL["fuzzy_header_alias"] = with_(GRID, renamed_headers("raw material", "qty")) + f"""
SELECT {SHEET}, row_idx, array_to_string(new_header, '|') AS header,
       CAST(({_is_new('product_at', 'RAW MATERIALS', 'raw material')}) AS BIGINT)
       + CAST(({_is_new('quantity_at', 'STILL TO BE DELIVERED (in kilos)', 'qty')}) AS BIGINT) AS n_captured
FROM renamed"""
ORACLE_SQL["alias_upsert"] = with_(GRID, renamed_headers()) + f"""
SELECT 'UNSERVED_LOCAL' AS "table", expected, alias FROM (
  SELECT 'RAW MATERIALS' AS expected, header[product_at] AS alias FROM renamed
  WHERE {_is_new('product_at', 'RAW MATERIALS')}
  UNION
  SELECT 'STILL TO BE DELIVERED (in kilos)', header[quantity_at] FROM renamed
  WHERE {_is_new('quantity_at', 'STILL TO BE DELIVERED (in kilos)')}
  UNION
  SELECT 'STILL TO BE DELIVERED (in kilos)', header_cells[2] FROM renamed WHERE header_cells[2] = 'QTY')"""
ORACLE_SQL["drop_blank_rows"] = with_(GRID) + f"""
SELECT {SHEET}, 'null' AS rule, row_idx FROM grid WHERE NOT {BLANK}
UNION ALL
SELECT {SHEET}, 'white space', row_idx FROM grid
WHERE row_idx % 19 <> 0 AND {count_cells("{s} <> ''")} > 0"""
ORACLE_SQL["drop_blank_columns"] = with_(GRID) + f"""
SELECT {SHEET}, col_idx, count(*) AS n_values FROM (
  SELECT {SHEET}, unnest(cells) AS v, unnest(range(len(cells))) AS col_idx FROM grid)
WHERE v IS NOT NULL GROUP BY {SHEET}, col_idx"""
ORACLE_SQL["fill_nulls"] = with_(GRID, _COLUMNS) + f"""
SELECT {SHEET}, row_idx, coalesce(kind, '') AS kind, coalesce(supplier, '') AS supplier,
       coalesce(props, '') AS props, coalesce(note, '') AS note,
       coalesce(TRY_CAST(trim(value) AS DOUBLE), 0) AS value FROM named"""
ORACLE_SQL["whole_number_format"] = """
SELECT l_orderkey, CAST(l_quantity AS BIGINT) AS l_quantity,
       regexp_replace(CAST(l_extendedprice AS VARCHAR), '\\.0$', '') AS l_extendedprice
FROM lineitem"""
ORACLE_SQL["inventory_columns"] = with_(INVENTORY) + f"""
SELECT {SHEET}, row_idx, "column", value FROM (
  SELECT {SHEET}, row_idx, unnest(header) AS "column", unnest(cells) AS value FROM stock_rows)
WHERE value IS NOT NULL AND (contains("column", 'DESCRIPTION') OR contains("column", 'QTY'))"""
ORACLE_SQL["sheet_routing"] = with_(ORDER_ROWS) + """
SELECT workbook, sheet,
  CASE WHEN sheet = 'LANDED.PULL OUT' THEN 'STACKED' WHEN sheet = 'Sheet1' THEN 'SHEET' ELSE upper(sheet) END AS combined,
  CASE WHEN starts_with(workbook, 'local') THEN 'UNSERVED LOCAL'
       ELSE CASE sheet WHEN 'Sailling' THEN 'SAILING' WHEN 'Landed' THEN 'LANDED'
            WHEN 'For Pull out Return' THEN 'PULLOUT' WHEN 'UNSERVED' THEN 'UNSERVED IMPORTED' END END AS split,
  CASE sheet WHEN 'LANDED.PULL OUT' THEN 'STACKED' WHEN 'SAILING' THEN 'SAILING'
       WHEN 'UNSERVED IMPORTED' THEN 'UNSERVED IMPORTED' WHEN 'UNSERVED LOCAL' THEN 'UNSERVED LOCAL'
       WHEN 'SUMMARY' THEN 'SUMMARY' ELSE 'OTHER' END AS named
FROM (
  SELECT DISTINCT 'deliveries' || CAST(sheet_no // 6 AS VARCHAR) AS workbook,
    ['LANDED.PULL OUT', 'SAILING', 'UNSERVED IMPORTED', 'UNSERVED LOCAL', 'SUMMARY', 'NOTES'][sheet_no % 6 + 1] AS sheet
  FROM order_rows
  UNION ALL
  SELECT DISTINCT CASE WHEN sheet_no % 6 = 4 THEN 'local' ELSE 'imports' END || CAST(sheet_no // 6 AS VARCHAR),
    ['Sailling', 'Landed', 'For Pull out Return', 'UNSERVED', 'Sheet1', 'Other'][sheet_no % 6 + 1]
  FROM order_rows)"""
ORACLE_SQL["delivery_table"] = with_(DELIVERIES) + (
    'SELECT workbook, sheet, "table", row_idx, product, quantity_text FROM delivered'
)
ORACLE_SQL["delivery_fact"] = with_(DELIVERIES) + """
SELECT workbook, sheet, row_idx, product,
       TRY_CAST(quantity_text AS DOUBLE) / CASE WHEN "table" = 'UNSERVED LOCAL' THEN 1000 ELSE 1 END AS quantity,
       "table" AS status
FROM delivered WHERE trim(coalesce(product, '')) <> ''"""
ORACLE_SQL["inventory_table"] = with_(INVENTORY) + f"""
SELECT workbook, sheet, 'INVENTORY' AS "table", sheet_row AS row_idx, cells[1] AS product, cells[2] AS quantity_text
FROM stock_rows WHERE NOT {BLANK}"""
ORACLE_SQL["split_tables"] = with_(SPLIT) + """
SELECT workbook, sheet, "table", row_idx, product, quantity_text
FROM split_filled WHERE trim(coalesce(product, '')) <> ''"""
ORACLE_SQL["split_rejects"] = with_(SPLIT) + """
SELECT DISTINCT workbook, sheet, 'UNSERVED LOCAL' AS "table",
       'missing columns: STILL TO BE DELIVERED (in kilos)' AS reason
FROM split_body WHERE quantity_name = 'REMAINING'"""

# --- sources -----------------------------------------------------------------

ORACLE_SQL["sheet_grid"] = with_(GRID) + f"SELECT {SHEET}, row_idx, {JOINED} AS cells FROM grid"
ORACLE_SQL["sheet_listing"] = with_(GRID) + f"SELECT DISTINCT {SHEET} FROM grid"
ORACLE_SQL["date_from_path"] = """
SELECT o_orderkey,
       CASE o_orderkey % 10 WHEN 0 THEN '' WHEN 1 THEN '20231345' ELSE strftime(o_orderdate, '%Y%m%d') END AS date_text,
       o_orderkey % 10 <> 0 AS is_date_text,
       CASE WHEN o_orderkey % 10 <= 1 THEN '2024-01-01' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS ingest_date
FROM orders"""
ORACLE_SQL["partition_status"] = """
SELECT folder, CASE WHEN u AND h AND m THEN 'Ready' ELSE 'Missing files' END AS status,
       concat_ws(', ', CASE WHEN NOT u THEN '1-URGENT' END, CASE WHEN NOT h THEN '2-HIGH' END,
                 CASE WHEN NOT m THEN '3-MEDIUM' END) AS missing
FROM (SELECT strftime(o_orderdate, '%Y%m%d') AS folder, bool_or(o_orderpriority = '1-URGENT') AS u,
             bool_or(o_orderpriority = '2-HIGH') AS h, bool_or(o_orderpriority = '3-MEDIUM') AS m
      FROM orders GROUP BY 1)
ORDER BY folder"""
ORACLE_SQL["date_spine"] = """
WITH days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderpriority = '1-URGENT'),
spine AS (SELECT CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE) AS d FROM days)
SELECT strftime(d, '%Y-%m-%d') AS ingest_date FROM spine WHERE d NOT IN (SELECT d FROM days)"""

# --- nothing is lost ---------------------------------------------------------

# Blank rows, and stacked sheets whose second table has no marker.
_AUDITED = DELIVERIES.replace("delivery_grid AS (", "plain_grid AS (", 1).replace(
    "stacked_rows AS (",
    """delivery_grid AS (
  SELECT workbook, sheet, row_idx,
         list_transform(cells, lambda c: CASE
           WHEN row_idx > 1 AND row_idx % 29 = 0 THEN NULL
           WHEN CAST(replace(workbook, 'deliveries', '') AS BIGINT) % 3 = 1 AND c = 'PULL-OUT TABLE' THEN 'CONTINUED'
           ELSE c END) AS cells
  FROM plain_grid),
stacked_rows AS (""",
    1,
)
ORACLE_SQL["sheet_audit"] = with_(_AUDITED) + f"""
SELECT workbook, sheet, count(*) AS n_read,
       count(*) FILTER (NOT blank AND in_table AND reason IS NULL AND row_idx > header_row) AS n_table,
       count(*) FILTER (NOT blank AND sheet <> 'SUMMARY'
         AND ((in_table AND reason IS NULL AND row_idx <= header_row) OR (NOT in_table AND is_split))) AS n_header,
       count(*) FILTER (blank) AS n_blank,
       count(*) FILTER (NOT blank AND sheet <> 'SUMMARY'
         AND ((in_table AND reason IS NOT NULL) OR (NOT in_table AND NOT is_split))) AS n_rejected,
       count(*) FILTER (NOT blank AND sheet = 'SUMMARY') AS n_aside
FROM (
  SELECT d.workbook, d.sheet, d.row_idx, {BLANK.replace('cells', 'd.cells')} AS blank, r."table" IS NOT NULL AS in_table,
         x.header_row, x.reason, p.workbook IS NOT NULL AS is_split
  FROM delivery_grid d
  LEFT JOIN routed r ON r.workbook = d.workbook AND r.sheet = d.sheet AND r.row_idx = d.row_idx
  LEFT JOIN reasoned x ON x.workbook = r.workbook AND x.sheet = r.sheet AND x."table" = r."table"
  LEFT JOIN (SELECT DISTINCT workbook, sheet FROM split) p ON p.workbook = d.workbook AND p.sheet = d.sheet)
GROUP BY workbook, sheet"""
ORACLE_SQL["unsplit_sheets"] = with_(_AUDITED) + """
SELECT DISTINCT workbook, sheet, 'STACKED' AS "table", 'no rule splits the sheet' AS reason
FROM stacked_rows WHERE (workbook, sheet) NOT IN (SELECT workbook, sheet FROM split)"""
ORACLE_SQL["tables_beyond_two"] = with_(GRID, ADVANCED) + f"""
SELECT {SHEET}, start_row, end_row FROM (
  SELECT c.rule, r.*, row_number() OVER (PARTITION BY r.rule, r.workbook, r.sheet ORDER BY start_row) AS place
  FROM (SELECT 1 AS rule, {SHEET}, start_row, end_row FROM boundaries
        UNION ALL SELECT 2, {SHEET}, start_row, end_row FROM patterns) r
  JOIN chosen c ON c.workbook = r.workbook AND c.sheet = r.sheet AND c.rule = r.rule)
WHERE place > 2"""


def _line(cells: str) -> str:
    return f"array_to_string(list_transform({cells}, lambda c: coalesce(c, '')), ',')"


ORACLE_SQL["finished_tables"] = with_(
    DELIVERIES,
    f"""body AS (
      SELECT r.workbook, r.sheet, r."table", r.row_idx, {_line(NAMES)} AS head,
             {_line('''CASE WHEN r."table" = 'UNSERVED LOCAL' AND coalesce(cells[3], '') = '' THEN [''] || cells[2:] ELSE cells END''')} AS line
      FROM routed r JOIN best b USING (workbook, sheet, "table")
      WHERE r.row_idx > b.header_row AND NOT {BLANK})""",
    MERGED_GRID,
    MERGED_ROWS,
    f"""stock AS (
      SELECT workbook, sheet, 'INVENTORY' AS "table", sheet_row AS row_idx, 'ITEM DESCRIPTION,QTY IN KGS,QTY OPEN' AS head,
             {_line('[product, cells[2], cells[3]]')} AS line
      FROM filled WHERE NOT {BLANK}),
    finished AS (SELECT * FROM body UNION ALL SELECT * FROM stock WHERE trim(replace(line, ',', '')) <> '')""",
) + """
SELECT workbook, sheet, "table", row_idx, line FROM finished
UNION ALL SELECT DISTINCT workbook, sheet, "table", -2, head FROM finished"""
