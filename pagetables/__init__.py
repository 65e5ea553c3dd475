"""pagetables: landed web pages to clean story tables, on Spark.

Sub-packages:
  sources/    readers and writers (page tables, CSV, answers, prompts)
  functions/  Column-expression helpers (text, urls, vectors)
  operators/  DataFrame -> DataFrame operators (html, links, content,
              answers, vectors, merge)
  plans/      iterative walks over listing pages and composed pipelines
  streaming/  the same operators over a stream of landed pages
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Python stages (mapInPandas / applyInPandas) ship their functions and
# classes with the task, so executors need no copy of this package on
# their path.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

from pagetables.session import checkpoint_dir, get_spark  # noqa: E402

__all__ = ["get_spark", "checkpoint_dir"]
