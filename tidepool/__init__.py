"""tidepool: a Spark-native engine for contract-checked delivery data and document retrieval.

Layout
------
- ``sources``   readers and writers (tables, event streams, page text, lineage logs)
- ``functions`` reusable Column expressions (text cleanup, uuid5, hashed embeddings, exact rounding)
- ``operators`` the data operators (contract, silver, gold, quality, chunking, bm25, vector, fusion, lineage)
- ``plans``     end-to-end plans over the driver tables (deliveries, retrieval, the gated pipeline)
- ``streaming`` Structured Streaming versions of the ingest route and upsert
"""

__version__ = "0.1.0"
