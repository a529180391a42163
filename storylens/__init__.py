"""storylens: story-link attribution on Spark.

Turns nested social-story documents into a table of which retailer each
profile links to, built only from DataFrame operations so that Catalyst plans
the whole job from scan to sink.
"""

__version__ = "0.1.0"
