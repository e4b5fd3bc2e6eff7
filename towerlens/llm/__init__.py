"""Operators for preparing the text of language models; nothing else in the library imports them.

Functions that run inside tasks are sent whole, so executors need not have this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
