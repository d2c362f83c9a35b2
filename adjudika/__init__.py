"""Public-tender analytics as Spark DataFrame transforms.

Sub-packages: ``functions`` (column expressions), ``sources`` and ``sinks``, ``extraction`` (archived HTML to rows),
``operators`` (reusable DataFrame transforms), ``plans`` (reports, listings, monitoring, ingest), ``streaming`` and
``catalog`` (the registered queries with their comparison SQL).
"""
