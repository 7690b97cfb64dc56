"""Writers: CSV/Parquet outputs, tagged snapshots, dated folders."""
