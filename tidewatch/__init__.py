"""Web access-log security analytics written as Spark jobs."""
