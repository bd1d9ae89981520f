"""labeltext: labelled-text corpora on Spark.

Cleaning, corpus statistics, features, MLlib classifiers, evaluation and
scoring, all over DataFrames. See ``README.md`` for the API by topic.
"""

from labeltext import functions, operators, plans, sources, streaming
from labeltext.session import build_session

__all__ = ["build_session", "functions", "operators", "plans", "sources", "streaming"]
