"""What is read and written: trades, tables, buckets, releases."""
