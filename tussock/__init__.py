"""tussock: place-based housing analytics as plain Spark DataFrame transforms.

Layout
------
functions/  column expressions (cleaning, names, metrics, scores, geo)
operators/  DataFrame -> DataFrame operators (distance join, patch union,
            latest-window filters, keep-first top-k, quality checks, profiles)
sources/    landing readers (CSV, JSON envelopes, HTML pages, rate patches,
            census extract, calendar grid), sinks, and the test-data adapter
plans/      staging views, marts, dashboard reports and the query catalogue
"""

from tussock.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
