"""Spark jobs over labelled service-incident data, and training-data operators in ``caseweave.llm``."""
