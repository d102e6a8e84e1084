"""inkfall: document evidence analytics as Spark DataFrame plans."""
