"""Curation of labelled text corpora on Spark: lazy DataFrame operators checked against SQL."""
