"""Every operator applied to the shared test tables, with an SQL statement of the result."""
