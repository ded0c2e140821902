"""Parameters of the registered queries (shared by the queries and the oracle).

The stand-in events span 1995-2001, so the reference's "year >= 2020" cut
would select nothing; the registered region query uses 1998 instead.
"""

OLAP_MIN_YEAR = 1998
SOURCE_WINDOW = ("1997-01-01", "1998-01-01")
MIN_MAGNITUDE = 0.0
SIGNIFICANT_MAGNITUDE = 6.5
HISTOGRAM_WIDTH = 0.5
DENSITY_CELL_DEG = 1.0
SAMPLE_SIZE = 80
BATCH_SPLIT = "1998-01-01"
SAMPLE_SEED = 20
CLUSTER_CELL_DEG = 0.5
CLUSTER_MIN_EVENTS = 155
