"""lucrum — marketplace net-margin operators on Spark.

DataFrame -> DataFrame operators (``lucrum.operators``), scalar column
functions (``lucrum.functions``), bronze/table sources and sinks
(``lucrum.sources``, ``lucrum.sinks``), composed silver/gold plans
(``lucrum.plans``) and the streaming form (``lucrum.streaming``).
"""

__version__ = "0.1.0"
