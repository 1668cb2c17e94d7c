"""Fine-tuning data for natural-language-to-SQL models, prepared and scored on Spark."""

import sys

from pyspark import cloudpickle

# Task functions travel with their code, so workers need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
