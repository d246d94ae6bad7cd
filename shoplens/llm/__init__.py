"""Operators of a training-data pipeline (deduplication, extraction, search,
token counts, classifiers, mixing).  Nothing else in the library imports this
subpackage; ``shoplens.llm.queries`` registers one query per operator."""
