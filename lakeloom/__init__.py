"""lakeloom: table-level operators for layered lakehouses on Spark."""
