"""Table cells to line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from docledger import functions as fn
from docledger.operators import cell_tables, positions
from workload import sql, views
from workload.registry import query

c = F.col
META = fn.META_WORDS
SUMMARY = fn.SUMMARY_WORDS


def _numbered(cells):
    return cell_tables.table_rows(cells, cell_tables.several_buckets(cells))


def _rows(spark, sf):
    return _numbered(views.table_cells(spark, sf))


ROWS = """
SELECT doc_id, table_no, row_number() OVER (PARTITION BY doc_id, table_no ORDER BY row_no) - 1 AS pos, cells,
       lead(cells) OVER (PARTITION BY doc_id, table_no ORDER BY row_no) AS next_cells
FROM fx_table_cells WHERE len(list_filter(cells, lambda x: x IS NOT NULL)) > 0"""


@query("SELECT doc_id, table_no, pos, array_to_string(cells, '|') AS cells, array_to_string(next_cells, '|') AS next_cells FROM rows", rows=ROWS)
def table_rows(spark, sf):
    joined = lambda name: F.array_join(name, "|").alias(name)
    return _rows(spark, sf).select("doc_id", "table_no", "pos", joined("cells"), joined("next_cells"))


@query("""SELECT document_id AS doc_id, 0 AS table_no, 0 AS header_pos, false AS two_rows,
                 'Item|Description|Qty|Unit Price|Total' AS header FROM fx_line_items GROUP BY document_id""")
def detect_header_row(spark, sf):
    found = cell_tables.detect_header_row(_rows(spark, sf)).drop("last_bucket")
    return found.withColumn("header", F.array_join("header", "|"))


# A header over two rows: the names of the number columns stand in the second one.
TWO_ROWS = """
SELECT doc_id, pos, array_to_string(cells, '|') AS cells FROM rows WHERE pos > 0"""


def _two_row_cells(spark, sf):
    cells = views.table_cells(spark, sf)
    head = c("row_no") == 0
    first = F.array(F.lit("Item"), F.lit("Details "), F.lit(""), F.lit(""), F.lit(" "))
    second = F.array(F.lit(""), F.lit(""), F.lit(" Quantity"), F.lit("Unit  Price"), F.lit("Total"))
    doubled = F.when(
        head,
        F.array(
            F.struct(F.lit(0).alias("row_no"), first.alias("cells")),
            F.struct(F.lit(1).alias("row_no"), second.alias("cells")),
        ),
    ).otherwise(F.array(F.struct((c("row_no") + 1).alias("row_no"), c("cells").alias("cells"))))
    return cells.select("doc_id", "table_no", F.inline(doubled))


@query("""
SELECT doc_id, 0 AS table_no, row_no + 1 AS pos, 'Item|Details|Quantity|Unit Price|Total' AS header,
       array_to_string(cells, '|') AS cells FROM fx_table_cells WHERE row_no > 0""")
def apply_header(spark, sf):
    rows = _numbered(_two_row_cells(spark, sf))
    joined = lambda name: F.array_join(name, "|").alias(name)
    return cell_tables.apply_header(rows).select("doc_id", "table_no", "pos", joined("header"), joined("cells"))


@query("""
SELECT doc_id, row_no + 1 AS pos, 0 AS item_at, 1 AS description_at, 2 AS quantity_at, 3 AS unit_price_at, 4 AS line_total_at
FROM fx_table_cells WHERE row_no > 0""")
def map_columns(spark, sf):
    rows = _numbered(_two_row_cells(spark, sf))
    mapped = cell_tables.map_columns(cell_tables.apply_header(rows))
    return mapped.select("doc_id", "pos", *[f"{name}_at" for name in cell_tables.HEADER_WORDS])


TYPED = """
SELECT document_id AS doc_id, 0 AS table_no, line_no AS pos, item, description, CAST(quantity AS DOUBLE) AS quantity,
       CAST(unit_price AS DOUBLE) AS unit_price,
       coalesce(CAST(line_total AS DOUBLE), CAST(unit_price AS DOUBLE) * CAST(quantity AS DOUBLE)) AS line_total
FROM fx_line_items"""


@query(TYPED)
def header_table_to_items(spark, sf):
    return cell_tables.header_table_to_items(_rows(spark, sf)).drop("_bucket")


def _any(x: str, words) -> str:
    return sql.any_word(x, words)


def _spans(t: str, pattern: str) -> str:
    """Tokens with their start and end offsets, as a list of structs."""
    toks = f"regexp_extract_all({t}, '{pattern}')"
    segs = f"string_split_regex({t}, '{pattern}')"
    length = lambda xs, n: f"coalesce(list_sum(list_transform({xs}[1:{n}], lambda x: length(x))), 0)"
    return (
        f"list_transform(range(1, len({toks}) + 1), lambda k: struct_pack(tok := {toks}[k], "
        f"s := {length(segs, 'k')} + {length(toks, 'k - 1')}, e := {length(segs, 'k')} + {length(toks, 'k')}))"
    )


MONEY = r"\$?\d{1,3}(?:,\d{3})*(?:\.\d{2})"
NUMBER = r"\b\d+(?:\.\d+)?\b"
TEXTS = f"SELECT *, {sql.strip('array_to_string(cells, chr(32))')} AS t, {sql.strip('array_to_string(next_cells, chr(32))')} AS below FROM rows"
SPANS = f"SELECT *, {_spans('t', MONEY)} AS money, {_spans('t', NUMBER)} AS allnums FROM texts"
NUMS = """
SELECT *, list_filter(allnums, lambda n: len(list_filter(money, lambda m: n.s >= m.s AND n.e <= m.e)) = 0) AS nums FROM spans"""
SAME_LINE = f"""
SELECT *, {sql.money_invoice('money[1].tok')} AS unit_price,
       CASE WHEN len(money) >= 2 THEN {sql.money_invoice('money[len(money)].tok')} END AS line_total,
       CASE WHEN len(money) > 0 THEN CAST(coalesce(
            CASE WHEN len(money) >= 2 THEN list_filter(nums, lambda n: n.s >= money[1].e AND n.e <= money[len(money)].s)[1].tok END,
            list_filter(nums, lambda n: n.s >= money[1].e)[1].tok, nums[1].tok) AS DOUBLE) END AS quantity
FROM nums_found"""
SAME = {"rows": ROWS, "texts": TEXTS, "spans": SPANS, "nums_found": NUMS, "same_line": SAME_LINE}


@query("SELECT doc_id, table_no, pos, unit_price, quantity, line_total FROM same_line", **SAME)
def same_line_numbers(spark, sf):
    rows = _rows(spark, sf).withColumn("text", F.trim(cell_tables.row_text(c("cells"))))
    return cell_tables.same_line_numbers(rows, "text").select(
        "doc_id", "table_no", "pos", "unit_price", "quantity", "line_total"
    )


JUDGED = f"""
SELECT *, {_any('t', META)} OR (contains(lower(t), 'item') AND contains(lower(t), 'description'))
          OR {_any('trim(cells[1])', META)} OR {_any('trim(cells[2])', META)}
          OR {_any('trim(cells[1])', SUMMARY)} OR {_any('trim(cells[2])', SUMMARY)} AS skipped,
       CASE WHEN next_cells IS NOT NULL AND NOT {_any('below', META)} THEN regexp_extract_all(below, '{MONEY}')[1] END AS below_money,
       CASE WHEN next_cells IS NOT NULL AND NOT {_any('below', META)}
            THEN list_filter(regexp_extract_all(below, '{NUMBER}'), lambda n: NOT regexp_matches(n, '{MONEY}'))[1] END AS below_num
FROM same_line"""
TAKES = """
SELECT *, NOT skipped AND (quantity IS NULL OR line_total IS NULL) AND (below_money IS NOT NULL OR below_num IS NOT NULL) AS takes
FROM judged"""
# Islands of rows that take their successor; every second row inside and just behind one is used up.
ISLANDS = """
SELECT *, sum(CASE WHEN takes AND NOT before THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, table_no ORDER BY pos) AS island
FROM (SELECT *, coalesce(lag(takes) OVER (PARTITION BY doc_id, table_no ORDER BY pos), false) AS before FROM takes)"""
USED = """
SELECT *, coalesce(lag(takes) OVER w AND lag(offset_in) OVER w % 2 = 0, false) AS used
FROM (SELECT *, CASE WHEN takes THEN row_number() OVER (PARTITION BY doc_id, table_no, island, takes ORDER BY pos) - 1 END AS offset_in FROM islands)
WINDOW w AS (PARTITION BY doc_id, table_no ORDER BY pos)"""
PAIRS = f"""
SELECT doc_id, table_no, pos, item, description, quantity, unit_price, coalesce(line_total, unit_price * quantity) AS line_total
FROM (SELECT doc_id, table_no, pos, trim(cells[1]) AS item, trim(cells[2]) AS description,
             coalesce(quantity, CASE WHEN takes THEN CAST(below_num AS DOUBLE) END) AS quantity, unit_price,
             coalesce(line_total, CASE WHEN takes THEN {sql.money_invoice('below_money')} END) AS line_total
      FROM used WHERE NOT skipped AND NOT used)
WHERE NOT ((item = '' AND description = '') AND quantity IS NULL AND unit_price IS NULL AND line_total IS NULL)"""
PAIRING = {**SAME, "judged": JUDGED, "takes": TAKES, "islands": ISLANDS, "used": USED}


@query(PAIRS, **PAIRING)
def line_pairs_to_items(spark, sf):
    return cell_tables.line_pairs_to_items(_rows(spark, sf)).drop("_bucket")


@query("""
SELECT order_key, line_no, coalesce(lag(takes) OVER w AND lag(offset_in) OVER w % 2 = 0, false) AS consumed
FROM (SELECT *, CASE WHEN takes THEN row_number() OVER (PARTITION BY order_key, island, takes ORDER BY line_no) - 1 END AS offset_in
      FROM marked) WINDOW w AS (PARTITION BY order_key ORDER BY line_no)""",
       marked="""
SELECT *, sum(CASE WHEN takes AND NOT before THEN 1 ELSE 0 END) OVER (PARTITION BY order_key ORDER BY line_no) AS island
FROM (SELECT *, coalesce(lag(takes) OVER (PARTITION BY order_key ORDER BY line_no), false) AS before
      FROM (SELECT order_key, line_no, supp_key % 3 > 0 AS takes FROM fx_line_items))""")
def consume_next(spark, sf):
    """Every item of a supplier not divisible by three takes its successor along."""
    items = views.line_items(spark, sf, numbered=True).select("order_key", "line_no", "supp_key")
    rows = positions.number_rows(items, ["order_key"], ["line_no"], positions.bucket_of(c("line_no")))
    return positions.consumed(rows, ["order_key"], "pos", c("supp_key") % 3 > 0).select("order_key", "line_no", "consumed")


# Every table whose item has a quantity, price or total under its header needs no second parse.
CANDIDATES = f"""SELECT *, 'header' AS path FROM ({TYPED})
UNION ALL SELECT *, 'pairs' FROM ({PAIRS}) AS p WHERE NOT EXISTS (SELECT 1 FROM fx_line_items f WHERE f.document_id = p.doc_id)"""


@query("SELECT doc_id, pos, path, item, quantity, unit_price, line_total FROM candidates", **PAIRING, candidates=CANDIDATES)
def union_header_and_pair_candidates(spark, sf):
    return cell_tables.union_candidates(_rows(spark, sf)).drop("_bucket", "table_no", "description")


@query("""
SELECT doc_id, table_no, path, CAST(sum(CAST(quantity IS NOT NULL AS INT) + CAST(unit_price IS NOT NULL AS INT)
       + CAST(line_total IS NOT NULL AS INT)) AS BIGINT) AS numeric_cells, count(*) AS rows
FROM candidates GROUP BY doc_id, table_no, path""", **PAIRING, candidates=CANDIDATES)
def score_numeric(spark, sf):
    return cell_tables.score_numeric(cell_tables.union_candidates(_rows(spark, sf)))


@query("""
SELECT doc_id, 0 AS table_no, 'header' AS path, CAST(sum(CAST(quantity IS NOT NULL AS INT) + CAST(unit_price IS NOT NULL AS INT)
       + CAST(line_total IS NOT NULL AS INT)) AS BIGINT) AS numeric_cells, count(*) AS rows
FROM typed GROUP BY doc_id""", typed=TYPED)
def best_candidate(spark, sf):
    return cell_tables.best_candidate(cell_tables.score_numeric(cell_tables.union_candidates(_rows(spark, sf))))


def _split_tables(spark, sf):
    """Tables cut in two: the first half without a header, the second with one."""
    cells = views.table_cells(spark, sf)
    table_no = F.when((c("row_no") > 0) & (c("row_no") <= 2), 0).otherwise(1)
    return cells.withColumn("table_no", table_no)


@query("""
SELECT doc_id, table_no, pos, item, description, quantity, unit_price, line_total FROM typed""", typed=TYPED)
def choose_items(spark, sf):
    return cell_tables.choose_items(views.table_cells(spark, sf))


@query()
def choose_items_split_tables(spark, sf):
    """Two tables compete in every document; compared with a sequential reading in the tests."""
    return cell_tables.choose_items(_split_tables(spark, sf))
