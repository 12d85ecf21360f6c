"""vigil: Spark-native media-monitoring analytics.

Listings, transcripts and enrichment tables are Spark DataFrames; every
operator is a ``DataFrame -> DataFrame`` (or ``Column -> Column``) function
that Catalyst plans, so filters and projections reach the Parquet scan and
joins/aggregates run as distributed shuffles.
"""

__version__ = "0.1.0"
