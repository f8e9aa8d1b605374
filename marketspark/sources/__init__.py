"""Reading and writing Bronze documents, Parquet tables and vendor frames."""
