"""Independent SQL statements the registered queries are checked against."""
