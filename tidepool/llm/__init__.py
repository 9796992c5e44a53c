"""Training-data operators: packing, quality, near-duplicates, quotations, HTML, URLs, PII, BPE and WARC.

Each operator module takes and returns DataFrames and has its own parameters;
``queries`` holds the thin registered queries over the driver's tables.
Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
