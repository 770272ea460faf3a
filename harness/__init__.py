"""Running the library on the supplied test tables and checking it against DuckDB SQL."""
