"""Table sources: the given Parquet tables, derived TPC-H columns, file scans."""
