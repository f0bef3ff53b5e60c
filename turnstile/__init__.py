"""turnstile: ridership marts and an arrival-event feed, expressed as Spark DataFrame plans.

Layout:
  session      SparkSession defaults and the shared scratch folder
  schemas      declared StructTypes (star tables, marts, ledger, arrival JSON)
  star         the star-schema bundle every mart function takes
  adapters     maps the driver's test tables onto the star and the event feed
  sources/     delimited text, Parquet with fallback, JDBC, message topics
  operators/   marts, key-set joins, dedup, top-n, quality counts
  functions/   Column-valued scalar helpers (arrival enrichment, text cleaning)
  plans/       full load, incremental load, event backlog load, catalog DDL
  streaming/   append sink and keyed upsert over Structured Streaming
"""

__version__ = "0.1.0"
