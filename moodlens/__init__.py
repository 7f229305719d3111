"""moodlens: Spark-native preparation, profiling and classification of short social texts.

Every public function is either ``Column -> Column`` (functions/), ``DataFrame -> DataFrame``
(operators/, sources/) or a composition of those (plans/).  Nothing here creates a SparkSession
except :mod:`moodlens.session`, which tests and the bench use.
"""

__version__ = "0.1.0"
