"""Expressions over whole tables of written amounts, labels, names, dates and lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from docledger import functions as fn
from docledger.operators.lines import explode_lines
from docledger.sources.files import content_hash
from workload import sql, views
from workload.registry import query

c = F.col


def _over(view, oracle_view: str, key: str, name: str, expression, oracle: str, column: str = "value"):
    """One query: the key and the value of an expression for every row of a view."""
    query(f"SELECT {key}, {oracle} AS {column} FROM {oracle_view}", name=name)(
        lambda spark, sf: view(spark, sf).select(key, expression().alias(column))
    )


def money(name, expression, oracle):
    _over(views.money_texts, "fx_money_text", "order_key", name, expression, oracle)


def label(name, expression, oracle):
    _over(views.label_texts, "fx_label_text", "order_key", name, expression, oracle)


def text(name, expression, oracle):
    _over(lambda s, d: views.table(s, d, "documents"), "documents", "doc_id", name, expression, oracle)


def item(name, expression, oracle):
    """Over line items, whose key repeats; rows are compared as a bag."""
    _over(views.line_items, "fx_line_items", "document_id", name, expression, oracle)


def line(name, expression, oracle):
    query(f"SELECT doc_id, line_no, {oracle} AS value FROM fx_doc_lines", name=name)(
        lambda spark, sf: explode_lines(views.table(spark, sf, "documents").select("doc_id", "text")).select(
            "doc_id", "line_no", expression().alias("value")
        )
    )


# Numbers and money
money("money_invoice", lambda: fn.money_invoice(c("text")), sql.money_invoice("text"))
money("money_ocr", lambda: fn.money_ocr(c("text")), sql.money_ocr("text"))
money("money_silver", lambda: fn.money_silver(c("text")), sql.money_silver("text"))
money("to_number_or_null", lambda: fn.to_number_or_null(c("text")), sql.number("text"))
money("int_lenient", lambda: fn.int_lenient(c("text")), f"CAST(trunc({sql.number('text')}) AS BIGINT)")
money("quantity_or_zero", lambda: fn.quantity_or_zero(c("text")), f"coalesce({sql.money_silver('text')}, 0)")
money(
    "clamp_negative_to_zero",
    lambda: fn.clamp_negative_to_zero(fn.money_invoice(c("text"))),
    f"greatest(coalesce({sql.money_invoice('text')}, 0), 0)",
)
money(
    "round2",
    lambda: fn.round2(fn.money_invoice(c("text")) * 0.075),
    f"CAST(round(CAST(({sql.money_invoice('text')}) * 0.075::DOUBLE AS DECIMAL(28,8)), 2) AS DOUBLE)",
)
money(
    "fmt_money",
    lambda: fn.fmt_money(fn.round2(fn.money_invoice(c("text")))),
    f"coalesce(printf('%,.2f', CAST(round(CAST(({sql.money_invoice('text')}) AS DECIMAL(28,8)), 2) AS DOUBLE)), '')",
)
money(
    "fix_split_decimal",
    lambda: fn.fix_split_decimal(F.regexp_replace("text", r"\.", " .")),
    r"regexp_replace(replace(text, '.', ' .'), '(\d)\s+([.,]\d{2})', '\1\2', 'g')",
)
label("tax_percent", lambda: fn.tax_percent(c("tax_raw")), sql.tax_percent("tax_raw"))
_over(
    views.documents,
    "fx_documents",
    "document_id",
    "fmt_pct",
    lambda: fn.fmt_pct(c("tax_meta_pct")),
    "coalesce(printf('%.2f%%', CAST(tax_meta_pct AS DOUBLE)), '')",
)

# Strings and keys
label("sanitize_id", lambda: fn.sanitize_id(c("number_raw")), r"regexp_replace(upper(number_raw), '[^A-Z0-9\-]+', '', 'g')")
label("first_token_with_digit", lambda: fn.first_token_with_digit(c("number_raw")), sql.token_with_digit("number_raw"))
label("clean_party_name", lambda: fn.clean_party_name(c("supplier")), sql.clean_party("supplier"))
label("vendor_slug8", lambda: fn.vendor_slug8(c("supplier")), sql.slug("supplier"))
HASHED = "concat_ws('|', nullif(path, ''), client, nullif(tax_raw, ''))"
label("hash12", lambda: fn.hash12(c("path"), c("client"), c("tax_raw")), f"upper(left(sha1({HASHED}), 12))")
PARTY = f"coalesce(nullif({sql.clean_party('coalesce(supplier, client)')}, ''), client)"
label(
    "invoice_document_id",
    lambda: fn.invoice_document_id(c("number_raw"), c("supplier"), c("client"), c("date_raw"), c("path")),
    f"""regexp_replace(concat_ws('-', {sql.slug(PARTY)}, CASE WHEN {sql.token_with_digit('number_raw')} IS NOT NULL
        THEN concat_ws('-', {sql.token_with_digit('number_raw')}, {sql.ymd('date_raw')})
        ELSE upper(left(sha1(concat_ws('|', {sql.stem("coalesce(path, 'unknown')")}, {sql.slug(PARTY)}, {sql.ymd('date_raw')})), 12)) END),
        '[^A-Z0-9\\-]+', '', 'g')""",
)
label(
    "receipt_document_id",
    lambda: fn.receipt_document_id(c("client"), fn.path_stem(c("path")), fn.parse_receipt_datetime(c("time_raw"))),
    f"concat_ws('-', {sql.slug('client')}, coalesce(nullif({sql.stem('path')}, ''), 'NA'), "
    f"coalesce(strftime({sql.receipt_time('time_raw')}, '%Y%m%d'), 'NA'))",
)
label("supplier_from_number_line", lambda: fn.supplier_from_number_line(c("number_raw")), sql.number_tail("number_raw"))
label(
    "supplier_fallback",
    lambda: fn.supplier_fallback(c("supplier"), c("number_raw"), c("client")),
    f"coalesce(nullif({sql.clean_party('supplier')}, ''), {sql.number_tail('number_raw')}, {sql.clean_party('client')})",
)
label("normalize_merchant", lambda: fn.normalize_merchant(c("supplier")), sql.merchant("supplier"))
label("document_number_token", lambda: fn.document_number_token(c("number_raw")), sql.number_token("number_raw"))
label("default_currency", lambda: fn.default_currency(c("tax_raw")), "coalesce(nullif(tax_raw, ''), 'USD')")
label("normalize_path", lambda: fn.normalize_path(c("path")), "replace(path, chr(92), '/')")
label("path_stem", lambda: fn.path_stem(fn.normalize_path(c("path"))), f"nullif({sql.stem('replace(path, chr(92), chr(47))')}, '')")
label(
    "safe_stem",
    lambda: fn.safe_stem(fn.normalize_path(c("path"))),
    f"coalesce(nullif(regexp_replace(lower({sql.stem('replace(path, chr(92), chr(47))')}), '[^a-z0-9_\\-]+', '-', 'g'), ''), 'doc')",
)

WORD = r"(^|[^\p{L}\p{N}_])%s($|[^\p{L}\p{N}_])"
CURRENCY = " ".join(
    f"WHEN contains(lower(text), '{sign}') OR regexp_matches(lower(text), '{WORD % word}') THEN '{code}'"
    for code, sign, word in (("EUR", "€", "eur"), ("GBP", "£", "gbp"), ("BRL", "r$", "brl"), ("USD", "$", "usd"))
)
text("detect_currency", lambda: fn.detect_currency(c("text")), f"CASE {CURRENCY} ELSE 'UNKNOWN' END")
text("content_hash", lambda: content_hash(c("text")), "sha256(text)")
text("text_sample", lambda: fn.text_sample(c("text"), 3), "array_to_string(string_split(text, chr(10))[1:3], chr(10))")
_over(
    views.receipt_texts,
    "fx_receipt_text",
    "doc_id",
    "keyword_score",
    lambda: fn.keyword_score(c("text")),
    "CAST(len(list_filter(list_value("
    + ", ".join(f"'{w}'" for w in fn.RECEIPT_KEYWORDS)
    + "), lambda w: contains(lower(text), w))) AS INTEGER)",
)
line("name_like", lambda: fn.name_like(c("line")), sql.name_like("line"))
line("merchant_text_clean", lambda: fn.merchant_text_clean(c("line")), sql.strip(r"regexp_replace(line, '[^A-Za-z0-9 ''&\-/.]', '', 'g')"))
line("normalize_line", lambda: fn.normalize_line(c("line")), sql.collapse(sql.strip("line"), 2))
line("line_key", lambda: F.sha1(fn.line_key(c("line"))), f"sha1(lower({sql.collapse(sql.strip('line'))}))")

# Dates
_over(
    views.invoice_texts,
    "fx_invoice_text",
    "document_id",
    "find_label_date",
    lambda: fn.find_label_date(c("text"), "invoice date"),
    r"nullif(regexp_extract(text, '(?i)invoice\s*date[:\s]*([0-9]{1,2}[/\-][0-9]{1,2}[/\-][0-9]{2,4})', 1), '')",
)
label("dmy_to_yyyymmdd", lambda: fn.dmy_to_yyyymmdd(c("date_raw")), sql.ymd("date_raw"))
label(
    "parse_receipt_datetime",
    lambda: F.date_format(fn.parse_receipt_datetime(c("time_raw")), "yyyy-MM-dd HH:mm:ss"),
    f"strftime({sql.receipt_time('time_raw')}, '%Y-%m-%d %H:%M:%S')",
)
label(
    "iso_to_yyyymmdd",
    lambda: fn.iso_to_yyyymmdd(fn.parse_receipt_datetime(c("time_raw"))),
    f"coalesce(strftime({sql.receipt_time('time_raw')}, '%Y%m%d'), 'NA')",
)

# Row classes
line("is_meta_row", lambda: fn.is_meta_row(c("line")), sql.any_word("line", fn.META_WORDS))
line("is_summary_row", lambda: fn.is_summary_row(c("line")), sql.any_word("line", fn.SUMMARY_WORDS))
item("is_excluded_line", lambda: fn.is_excluded_line(F.concat(c("description"), F.lit("#"), c("item"))), (
    "regexp_matches(description || '#' || item, '(?i)(SUBTOTAL|TOTAL|TAX|DISCOUNT|GIVEN|CASH|DEBIT|CARD|CHANGE|#\\s*ITEMS\\s*SOLD|"
    "MANAGER|MGR|SURVEY|THANK|APPROVAL|ACCOUNT|TERMINAL|APPR|TC#|OP#|TE#|TR#|ST#)')"
))
line("is_valid_name", lambda: fn.is_valid_name(c("line")), "regexp_matches(line, '[A-Za-z]{3,}')")


@query(
    """SELECT doc_id, line_no, line FROM rows
    WHERE NOT (contains(lower(line), 'subtotal') OR contains(lower(line), 'tax') OR contains(lower(line), 'amount due')
               OR contains(lower(line), 'total:')) AND NOT (line = '' AND amount IS NULL)""",
    rows="""SELECT doc_id, CAST(unnest(range(len(ls))) AS INTEGER) AS line_no, unnest(ls) AS line,
                   CAST(NULL AS DOUBLE) AS amount
            FROM (SELECT doc_id, list_transform(string_split(text, chr(10)),
                         lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')) AS ls FROM fx_ocr_passes)""",
)
def drop_noise_rows(spark, sf):
    passes = views.ocr_passes(spark, sf).select("doc_id", "text")
    rows = explode_lines(passes, keep_blank=True).withColumn("amount", F.lit(None).cast("double"))
    return rows.where(~fn.is_noise_item(c("line"), F.lit(""), c("amount"))).drop("amount")


@query("""SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM fx_receipt_text)
          WHERE NOT regexp_matches(line, '(?i)SUBTOTAL|TOTAL|TAX')""")
def drop_total_named_items(spark, sf):
    return explode_lines(views.receipt_texts(spark, sf)).where(~fn.is_total_named(c("line"))).select("doc_id", "line")


@query("""SELECT document_id, diff_sum_vs_subtotal IS DISTINCT FROM 0 AS value FROM fx_documents""")
def is_distinct_from(spark, sf):
    return views.documents(spark, sf, names=False).select(
        "document_id", fn.is_distinct_from(c("diff_sum_vs_subtotal"), 0).alias("value")
    )


@query("""SELECT order_key, supplier FROM fx_label_text WHERE supplier IS NOT NULL AND trim(supplier) <> ''""")
def skip_missing_or_empty(spark, sf):
    from docledger.operators.reconcile import only_filled

    return only_filled(views.label_texts(spark, sf), "supplier").select("order_key", "supplier")


