"""encore: daily analytics for a fleet of self-service karaoke machines, on PySpark.

Layers (all pure ``DataFrame -> DataFrame`` except ``sources`` / ``sinks``):

* ``functions``  Column -> Column helpers (parsers, cleaners, RSI formulas)
* ``operators``  reusable relational building blocks (trailing-window stats,
                 distributed ranking, top-n)
* ``plans``      the warehouse jobs: client log, songs, RSI, users, machines
* ``sources`` / ``sinks``  table and file I/O, JDBC publication
* ``streaming``  incremental (file-stream) variant of the client-log ingest
"""

__version__ = "0.1.0"
