"""Mobile-network monitoring analytics expressed as Spark DataFrame jobs."""
