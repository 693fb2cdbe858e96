"""Column functions: JSON coercion, event time, ids, envelopes."""
