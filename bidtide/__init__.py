"""Ad-event and ride analytics expressed as PySpark DataFrame transformations."""
