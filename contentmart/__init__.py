"""contentmart: a Spark-native content-warehouse load engine.

Authors and articles from any Spark source become a star schema of author,
article and calendar dimensions around an article fact, by full reload or by
incremental MERGE.  Everything is a DataFrame -> DataFrame operator planned by
Catalyst; I/O lives in ``sources`` and ``streaming``.
"""

__version__ = "0.1.0"
