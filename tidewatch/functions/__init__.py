"""Column expressions: rounding, parsing, de-duplication, CASE-chain labels, the lexicon scorer."""
