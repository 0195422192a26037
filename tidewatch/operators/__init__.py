"""DataFrame operators per layer: silver, sentiment, gold, marts, quality, size-checked joins."""
