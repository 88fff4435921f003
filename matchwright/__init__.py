"""Record linkage and curation as Spark DataFrame operators."""
