"""asterlap: star-schema loading and OLAP analytics as Spark DataFrame jobs."""
