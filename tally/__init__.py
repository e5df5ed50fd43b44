"""Category tallies over tables and streams, expressed as Spark plans."""
