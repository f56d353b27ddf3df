"""Watch and rating analytics for a video catalogue, as Spark DataFrame jobs."""
