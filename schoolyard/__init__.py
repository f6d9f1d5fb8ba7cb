"""Sales-cycle analytics on Spark: clean, resolve, link, report, check."""
