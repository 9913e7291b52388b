"""inkstone: a PySpark library for knowledge-graph ETL, entity resolution and curation."""
