"""Text classification over labelled document collections, as Spark DataFrame jobs."""
