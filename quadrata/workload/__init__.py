"""The queries of the driver tables, with the SQL that must give the same rows."""
