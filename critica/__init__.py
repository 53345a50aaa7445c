"""critica — review analytics and recommendations as Spark DataFrame operators.

Layers (each a package):

* ``sources``   — readers (bronze JSON pages, silver/gold Parquet, driver tables) and writers
* ``functions`` — column expressions (features, surrogate keys, lexicon sentiment, ratings)
* ``operators`` — DataFrame -> DataFrame building blocks (silver, gold, quality, index, recommend, metrics, pages)
* ``plans``     — end-to-end jobs that chain operators (daily run, recommender run)
* ``streaming`` — incremental (availableNow) silver refresh
"""

from critica.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
