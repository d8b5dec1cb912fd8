"""Landing reads, relational extracts and versioned Parquet tables."""
