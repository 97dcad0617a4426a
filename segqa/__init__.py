"""Question-answer datasets from timed transcripts, on Spark.

Every operator takes and returns DataFrames or columns::

    from segqa import consecutive_segments, generate_qa, split_stats

    segments = consecutive_segments(videos, keep_title=True)
    pairs = generate_qa(segments)
    split_stats(pairs).show()
"""

import sys

from pyspark import cloudpickle

from . import functions, operators, plans, sinks, sources
from .functions import *  # noqa: F401,F403
from .operators import *  # noqa: F401,F403
from .plans import *  # noqa: F401,F403
from .session import local_session, materialize, shared_dir
from .sinks import *  # noqa: F401,F403
from .sources import *  # noqa: F401,F403

# Functions that run in tasks are shipped whole, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = [
    *functions.__all__,
    *operators.__all__,
    *plans.__all__,
    *sinks.__all__,
    *sources.__all__,
    "local_session",
    "materialize",
    "shared_dir",
]
