"""Knowledge-graph preparation and embedding neighbour queries as Spark DataFrame jobs."""
