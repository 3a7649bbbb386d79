"""heraldo: announcements in, a clean and current table of events out, as Spark jobs."""
