"""Training-data operators: decontamination, secret scans, URL filters,
source mixing, quality rules, language ID, line and document
near-duplicates, license scans and pseudonyms.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
