"""Training-data operators: deduplication, scoring, sharding, mixing, tokens, search and chat templates.

Nothing outside this folder imports it. Every operator takes and returns DataFrames, keeps its general
interface in its own module, and is applied to the given tables by ``queries``.
"""
