"""adlake: marketing and app-analytics tables built as Spark jobs."""
