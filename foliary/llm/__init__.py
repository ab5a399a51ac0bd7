"""Training-data operators: exact search, tokenisation, deduplication, classification and packing.

Nothing outside this package imports it; ``foliary.llm.queries`` lists its queries.
"""
