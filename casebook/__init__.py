"""Case-document completeness as Spark DataFrame transformations."""
