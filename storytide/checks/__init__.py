"""The registered queries and the SQL statements they are checked against."""
