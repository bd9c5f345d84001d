"""corpusloom: corpus preparation and hybrid retrieval as Spark jobs.

Every operator is a function from DataFrame to DataFrame.  See README.md for
the list, and ``corpusloom.plans`` for the composed jobs.
"""

__version__ = "0.1.0"
