"""Voxloom: curation of speech and text training corpora as Spark plans."""
