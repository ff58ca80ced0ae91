"""Entity resolution, dead-letter routing and an entity mart, written as Spark plans."""
