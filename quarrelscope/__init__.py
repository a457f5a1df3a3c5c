"""Edit-history conflict analytics on Spark: who argues where, when, and how much."""
