"""Event, log and order analytics for a data lake, written as Spark DataFrame jobs."""
