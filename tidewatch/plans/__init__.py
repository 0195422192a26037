"""Layer chain, the daily batch, dashboard reads, the query registry and its SQL oracle."""
