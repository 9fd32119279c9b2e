"""Learning-activity analytics as Spark DataFrame plans.

``sources`` and ``sinks`` move data in and out, ``functions`` are column
expressions, ``operators`` are column-parametrised DataFrame steps, and
``plans`` combine them into the staging -> clean -> analytics -> quality ->
mart workflow.
"""

__version__ = "0.1.0"
