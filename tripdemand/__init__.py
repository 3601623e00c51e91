"""Spark-native trip-demand analytics.

Parse raw trip records (zone-coded or GPS), resolve pickups to boroughs,
count trips per 10-minute block, derive historical means, compare a live
Structured Streaming feed against them and serve report DataFrames.
Everything is expressed with DataFrame operators and built-in functions.
"""

__version__ = "0.1.0"
