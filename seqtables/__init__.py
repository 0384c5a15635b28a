"""Tables of a sequencing-experiment database, computed with Spark for all experiments at once."""
