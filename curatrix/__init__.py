"""Catalog curation and entity resolution as Spark DataFrame operators."""
