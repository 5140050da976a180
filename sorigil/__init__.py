"""sorigil: speech and text corpus preparation as Spark DataFrame operators.

Public functions take and return DataFrames (or build Columns); every
relational step is a Spark SQL expression, join, aggregate or window, and
Arrow-batched pandas functions are used only for word segmentation, the
vocabulary EM step and the Fourier transform.
"""

__version__ = "0.1.0"

# Functions of this package used inside Spark tasks (Arrow functions, mapInPandas
# bodies) are pickled by value, so executors need no copy of the package on
# their Python path.
from pyspark import cloudpickle as _cloudpickle  # noqa: E402
import sys as _sys  # noqa: E402

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
