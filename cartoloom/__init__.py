"""cartoloom: map-data and training-data analytics expressed as Spark plans."""
