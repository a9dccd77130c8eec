"""corpusprep: corpus preparation as Spark DataFrame operators.

Metadata rows become hash-keyed shards, samples resolve to stored objects by
ordered candidate paths, stored shards are audited and repaired, metadata is
joined with payloads under a quality and re-compression policy, vectors are
scored in Arrow batches, and results are released by shard prefix - each step
a DataFrame -> DataFrame function planned by Catalyst.
"""

__version__ = "0.1.0"
