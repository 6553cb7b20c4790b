"""Document ledger analytics: invoices and receipts as Spark DataFrames."""
