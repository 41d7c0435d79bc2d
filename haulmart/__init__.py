"""Fleet-logistics analytics expressed as Spark DataFrame jobs."""
