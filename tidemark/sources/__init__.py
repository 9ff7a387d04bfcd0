"""Reading: feeds, instrument discovery, Parquet of drifting schemas."""
