"""tabsieve: feature screening and encoding operators as Spark DataFrame plans.

Sub-packages
------------
sources    typed readers (CSV/JSON/Parquet), optional inputs, ordered text sink
functions  Column-expression helpers, the text-fold pandas UDF, distributed ranking
operators  cleaning, target encoding, enrichment, joins, text, statistics, models
plans      bindings of the operators to the benchmark tables + the query catalog
streaming  micro-batch application of fitted encoders to arriving rows
"""

__version__ = "0.1.0"
