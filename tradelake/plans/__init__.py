"""Plans: the batch build (silver -> gold), serving queries, and the query
registry with its reference SQL."""
