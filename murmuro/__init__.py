"""murmuro: analytics over large collections of short user-written text, as Spark DataFrame jobs."""
