"""keytally — keyed counting over text and record logs, exactly-once stream
accumulation, and seeded synthetic e-commerce tables, all on PySpark.

Subpackages:

* ``functions``  — column expressions (tokeniser, seeded draws, line codecs, time formats)
* ``operators``  — DataFrame -> DataFrame operators (counting, offsets, running sums, generators)
* ``sources``    — record-log views/streams, tables, JDBC and Kafka option builders, sinks
* ``streaming``  — exactly-once keyed delta sink, stream drivers, rate feeds
* ``plans``      — the registered queries and their DuckDB oracle SQL
"""

from keytally.session import get_spark, checkpoint_root

__all__ = ["get_spark", "checkpoint_root"]
