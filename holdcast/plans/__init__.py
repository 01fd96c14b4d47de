"""Join shapes, the query registry and the SQL oracle."""
