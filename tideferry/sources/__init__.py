"""Where rows come from and go to: delimited text, Parquet, control tables."""
