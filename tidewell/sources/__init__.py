"""Where rowsets come from: a Parquet file, SQL over registered views, or a JDBC database."""
