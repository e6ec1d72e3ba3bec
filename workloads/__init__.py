"""The registered queries: Spark side and the SQL they are checked against."""
