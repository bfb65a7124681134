"""Operators for building training corpora (sharding, filtering, duplicate
removal, decontamination, tokenisation).  Nothing outside this folder imports
it; the registered queries are listed in :mod:`relevo.llm.registry`."""
