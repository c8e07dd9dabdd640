"""adtrail: a Spark-native advertising-traffic warehouse.

Every operator is a DataFrame -> DataFrame function made of built-in Spark
expressions.  Sub-packages:

* ``sources``   -- readers (delimited text, JSON lines, JDBC, the test-data adapter)
* ``sinks``     -- partition overwrite / append, gzip text, JDBC upsert
* ``functions`` -- column expressions (URL parsing, IPv4 arithmetic, type map)
* ``operators`` -- log parse, IP range join, UA rules, crawler match, traffic rules, dims
* ``plans``     -- compositions: the wide event fact, the daily layer jobs,
                   size-checked broadcast joins
* ``streaming`` -- the stateless log parse run on a file stream
"""

__version__ = "0.1.0"
