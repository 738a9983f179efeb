"""Battery-cycler analytics as Spark plans."""
