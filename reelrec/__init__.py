"""reelrec: a PySpark-native film-rating analytics and recommendation library.

Layout:
  sources/    text, table, stream and model sources; fixture tables derived from warehouse data
  functions/  column expressions: Java-compatible trim/split, delimited parsing, wire codec
  operators/  DataFrame operators: split, ranking, popularity, scoring, routing, ALS
  plans/      composed batch jobs (ingest, train, serve) and the query registry
  streaming/  Structured Streaming request router
  sinks/      table publishing, JDBC and Kafka writers
"""

__version__ = "0.1.0"
