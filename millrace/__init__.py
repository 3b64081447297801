"""Millrace: web-crawl analytics as Spark jobs.

Crawl archives, location indexes, CSV files and landed block payloads come in
as DataFrames; pages become typed records; the three downstream studies (host
distribution, score changes, transaction edges with address groups) are plain
DataFrame transformations.
"""

import sys

from pyspark import cloudpickle

# Functions shipped to executors travel with the job, so that the package does
# not have to be installed on every machine.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
