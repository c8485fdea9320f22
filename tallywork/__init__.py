"""Survey analytics as Spark DataFrame jobs: ingest, staging, marts, quality."""
