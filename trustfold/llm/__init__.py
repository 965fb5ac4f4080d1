"""Training-data operators: filters, fingerprints, joins, mixing, sharding.

Nothing outside this subpackage imports it.  Each module holds one operator
with its own interface; ``queries`` binds them to the driver's tables.
"""
