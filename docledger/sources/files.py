"""Document scans and the bronze, silver and table files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docledger.functions.strings import path_stem, text_sample
from docledger.operators.tables import split_failures
from docledger.schemas import BRONZE_ITEMS, INVOICE_META, RECEIPT_META, SILVER_DOCUMENTS, SILVER_ITEMS, names

INVOICE_GLOB = "*.pdf"
RECEIPT_GLOB = "*.{jpg,jpeg}"

# File pairs looked for first, in this order.
SILVER_PAIRS = (
    ("invoice_items.csv", "invoice_documents.csv"),
    ("receipt_items.csv", "receipt_documents.csv"),
)


def scan_documents(spark: SparkSession, directory: str, glob: str = INVOICE_GLOB) -> DataFrame:
    """Document files with path, stem, size and content; contents are only read if a later step asks for them.

    An empty directory is an error, found with a one-row probe.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(directory)
    if files.select("path").isEmpty():
        raise ValueError(f"no {glob} files in {directory}")
    return files.withColumn("stem", path_stem(F.col("path")))


def content_hash(c: Column) -> Column:
    return F.sha2(c, 256)


def sorted_inputs(files: DataFrame) -> DataFrame:
    return files.orderBy("path")


def _folder(path: Column) -> Column:
    """Name of the folder a per-document file lies in."""
    return F.regexp_extract(path, r"([^/]+)/[^/]+$", 1)


@dataclass
class Bronze:
    """Per-document files that were read: whole documents, and damaged ones as ``(doc_stem, path, error)``."""

    items: DataFrame
    meta: DataFrame
    failed: DataFrame


DAMAGED = "_damaged"


def _item_lines(spark: SparkSession, root: str, doc_type: str) -> DataFrame:
    """All lines of the item files as text, headers included; a line with too few or too many fields is in ``DAMAGED``."""
    fields = names(BRONZE_ITEMS)
    schema = ", ".join(f"{name} string" for name in (*fields, DAMAGED))
    options = {"header": False, "multiLine": True, "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": DAMAGED}
    lines = spark.read.schema(schema).options(**options).csv(f"{root}/*/{doc_type}_line_items.csv")
    path = F.col("_metadata.file_path")
    header = F.lit(True)
    for name in fields:
        header = header & (F.coalesce(name, F.lit("")) == name)
    return lines.select(_folder(path).alias("doc_stem"), path.alias("path"), "*", header.alias("header"))


def _meta_files(spark: SparkSession, root: str, doc_type: str) -> DataFrame:
    """All metadata files; one that cannot be read as an object of the schema is in ``DAMAGED``."""
    schema = INVOICE_META if doc_type == "invoice" else RECEIPT_META
    df = spark.read.schema(f"{schema}, {DAMAGED} string").json(
        f"{root}/*/{doc_type}_meta.json", multiLine=True, mode="PERMISSIVE", columnNameOfCorruptRecord=DAMAGED
    )
    return df.select(_folder(F.col("_metadata.file_path")).alias("doc_stem"), F.col("_metadata.file_path").alias("path"), "*")


def _as_items(lines: DataFrame) -> DataFrame:
    number = lambda c: F.col(c).try_cast("double")
    numbers = [F.nanvl(number(c), F.lit(None).cast("double")).alias(c) for c in ("quantity", "unit_price", "line_total")]
    return lines.where(~F.col("header")).select("doc_stem", "item", "description", *numbers)


def read_bronze(spark: SparkSession, root: str, doc_type: str) -> Bronze:
    """All per-document files below ``root``, with the document's folder as ``doc_stem``.

    A document is damaged if its metadata is missing or no JSON object of the schema, or if its item file is missing, empty,
    has no header line with the fields' names, or has a line with another number of fields. One damaged document stops no other.
    """
    lines, meta = _item_lines(spark, root, doc_type), _meta_files(spark, root, doc_type)
    by_file = lines.groupBy("doc_stem").agg(
        F.min("path").alias("items_path"),
        F.count_if("header").alias("headers"),
        F.min(F.when(~F.col("header"), F.col(DAMAGED))).alias("torn"),
    )
    # Spark does not read the damaged part of a file alone, so another column has to be asked for beside it.
    damaged = F.coalesce(DAMAGED, F.when(F.col("source_path").isNull(), F.col(DAMAGED)))
    of_meta = meta.groupBy("doc_stem").agg(F.min("path").alias("path"), F.count(damaged).alias("damaged"))
    files = of_meta.join(by_file, "doc_stem", "full")
    error = (
        F.when(F.col("path").isNull(), F.lit("no metadata file"))
        .when(F.col("damaged") > 0, F.lit("broken JSON"))
        .when(F.col("items_path").isNull(), F.lit("no line items file"))
        .when(F.col("headers") == 0, F.lit("wrong header"))
        .when(F.col("torn").isNotNull(), F.concat(F.lit("torn line: "), F.substring("torn", 1, 80)))
    )
    whole, failed = split_failures(files, error)
    of_items = F.col("path").isNull() | ~F.col("error").isin("broken JSON", "no line items file")
    failed = failed.select("doc_stem", F.when(of_items, F.coalesce("items_path", "path")).otherwise(F.col("path")).alias("path"), "error")
    keys = whole.select("doc_stem")
    return Bronze(
        _as_items(lines.join(keys, "doc_stem", "left_semi")),
        meta.drop("path", DAMAGED).join(keys, "doc_stem", "left_semi"),
        failed,
    )


def read_bronze_items(spark: SparkSession, root: str, doc_type: str) -> DataFrame:
    """Items of all documents whose files are whole."""
    return read_bronze(spark, root, doc_type).items


def read_bronze_meta(spark: SparkSession, root: str, doc_type: str) -> DataFrame:
    """Metadata of all documents whose files are whole; keys a document lacks are null."""
    return read_bronze(spark, root, doc_type).meta


def with_text_sample(df: DataFrame, text: str = "text") -> DataFrame:
    return df.withColumn("ocr_text_sample", text_sample(F.col(text)))


def write_bronze(items: DataFrame, meta: DataFrame, root: str) -> None:
    """Bronze of a whole batch as two datasets, in a folder that has none yet."""
    items.write.parquet(f"{root}/items")
    meta.write.parquet(f"{root}/meta")


def write_silver(items: DataFrame, documents: DataFrame, root: str) -> None:
    """Silver of all documents, in a fresh folder; documents are partitioned by type, so that a report reads only its own."""
    documents.write.partitionBy("doc_type").parquet(f"{root}/documents")
    items.write.parquet(f"{root}/items")


def read_silver(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Documents and items that :func:`write_silver` wrote."""
    return tuple(spark.read.schema(schema).parquet(f"{root}/{name}") for name, schema in (("documents", SILVER_DOCUMENTS), ("items", SILVER_ITEMS)))


def concat_silver(*frames: DataFrame) -> DataFrame:
    """Bag union of silver frames by column name."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def union_doc_types(invoices: DataFrame, receipts: DataFrame) -> DataFrame:
    """Invoices and receipts in one documents table."""
    return concat_silver(invoices, receipts)


def read_silver_pair(spark: SparkSession, directory: str) -> tuple[DataFrame, DataFrame]:
    """Items and documents of a silver directory: the invoice pair, else the receipt pair, else any pair of names."""
    listing = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(directory).select("path")
    )
    # The probe is bounded: only the few names the rule can pick are looked at.
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    names = listing.select(name.alias("n"))
    known = {r.n for r in names.where(F.col("n").isin([x for pair in SILVER_PAIRS for x in pair])).collect()}
    pair = next((p for p in SILVER_PAIRS if set(p) <= known), None)
    if pair is None:
        first = names.agg(
            F.min(F.when(F.col("n").endswith("_items.csv"), F.col("n"))).alias("items"),
            F.min(F.when(F.col("n").endswith("_documents.csv"), F.col("n"))).alias("documents"),
        ).first()
        pair = (first.items, first.documents)
    if None in pair:
        found = [r.n for r in names.orderBy("n").limit(20).collect()]
        raise FileNotFoundError(f"no items and documents files in {directory}; it has {names.count()} files, the first are {found}")
    items, documents = (f"{directory}/{n}" for n in pair)
    return (
        spark.read.schema(SILVER_ITEMS).csv(items, header=True),
        spark.read.schema(SILVER_DOCUMENTS).csv(documents, header=True),
    )


def export_overview_csv(overview: DataFrame, path: str, run_ts: str) -> None:
    """The one-row overview with its time of creation as a single CSV file, in a fresh folder."""
    stamped = overview.select(F.lit(run_ts).alias("generated_at"), "*")
    stamped.coalesce(1).write.csv(path, header=True)
