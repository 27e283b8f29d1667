"""Column expressions. They build Columns only and never start a Spark job."""
