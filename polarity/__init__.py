"""polarity: review classification as Spark jobs.

Subpackages:

- ``functions``  column expressions (text cleaning, tokens, arrays, math)
- ``operators``  DataFrame -> DataFrame operators (sampling, lookups, metrics,
  ensemble vote, classifier fit/score)
- ``sources``    readers and writers (CSV reviews, vocabularies, encoded ids,
  submissions, metric logs, models, caches)
- ``plans``      end-to-end pipelines and the query catalog over the test tables
- ``streaming``  micro-batch scoring of a review stream with a fitted model
"""

from polarity.config import Defaults

__all__ = ["Defaults"]
