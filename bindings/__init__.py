"""The operators bound to the generated test tables, and the same questions in DuckDB SQL."""
