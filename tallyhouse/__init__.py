"""Order-history warehouse as Spark DataFrame jobs.

Layers: ``sources`` read raw exports and snapshots, ``plans`` type them and
answer questions, ``operators`` and ``functions`` hold the reusable parts,
``streaming`` keeps the raw layer current, ``publish`` writes tables.
"""
