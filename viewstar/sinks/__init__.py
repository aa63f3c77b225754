"""Writers: Parquet, dated KPI folders, JSON batches, CSV, JDBC, tables, topic frames."""
