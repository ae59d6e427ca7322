"""tessera: star-schema building blocks on Spark DataFrames.

- ``tessera.session``: session settings (ANSI, UTC, AQE), checkpoint folder.
- ``tessera.functions.columns``: Column builders (guarded casts, flags, initcap, surrogate keys).
- ``tessera.sources``: text landing, extract routing, catalogue/code-list readers, seeds.
- ``tessera.operators``: conformance, type-2 history and point-in-time join, dimensions and band
  join, per-capita rate report, data-quality checks.
- ``tessera.plans``: the road-crash warehouse build and the driver queries with their oracle SQL.
"""

__version__ = "0.1.0"
