"""Trust-ranked event analytics as Spark jobs."""
