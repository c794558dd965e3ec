"""Upper-air sounding analytics as Spark jobs."""
