"""The library's feeds derived from the test tables, with the same definitions for a SQL check."""
