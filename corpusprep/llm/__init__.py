"""Operators of a large-scale training-data pipeline (near-dedup, mixing,
language-model scoring, packing, secret scans, ...). Nothing else in the
library imports this subpackage."""
