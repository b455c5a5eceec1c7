"""Tables as versioned Parquet, and the landing of delivered files."""
