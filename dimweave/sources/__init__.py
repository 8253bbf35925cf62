"""Files, JDBC tables and catalog tables a load reads and writes."""
