"""Web-table ingestion on Spark: HTML tables in, typed de-duplicated tables out."""
