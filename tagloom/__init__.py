"""tagloom: multi-label text analytics as Spark DataFrame jobs."""
