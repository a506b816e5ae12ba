"""Training-data operators: dedup, filters, token counts, sharding, decontamination.

Nothing else in the library imports this subpackage; its queries are in
``strata.llm.queries`` and the staged pipeline in ``corpus_pipeline.py``.
"""
