"""Silver and gold tables, and the serving queries, as functions of DataFrames."""
