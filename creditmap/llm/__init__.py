"""Operators of a training-data pipeline: quality, toxicity, token counts,
language, chat formatting, packing, fingerprints, near duplicates, binary
search and BPE.  Nothing outside this subpackage imports it except the
driver's entry module."""
