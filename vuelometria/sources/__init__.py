"""Reading and writing: raw JSON feeds, processed Parquet tables, star-schema CSVs."""
