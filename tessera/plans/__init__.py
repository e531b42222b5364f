"""Query catalog (registered queries + DuckDB twins) and the search engine."""
