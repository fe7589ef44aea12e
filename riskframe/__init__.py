"""riskframe: transaction-risk analytics as Spark DataFrame plans.

Every public function takes and returns DataFrames; nothing is collected
except bounded control values (split boundaries, quantile-bucket edges,
threshold grids of at most a few hundred numbers).
"""

__version__ = "0.1.0"
