"""The registered queries, the feeds derived from the test tables, and the SQL oracles."""
