"""Sources and sinks: test-data fixtures, bronze ingest, table and JDBC writers."""
