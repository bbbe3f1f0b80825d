"""Task functions travel by value, as from ``__spark_entry__``, so that what a test patches holds in the workers too."""

from pyspark.cloudpickle import cloudpickle

import shopstream.llm

cloudpickle.register_pickle_by_value(shopstream.llm)
