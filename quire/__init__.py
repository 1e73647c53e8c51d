"""quire: questionnaire and phenotype tables on Spark.

Survey workbooks, response sheets, item definitions, participant tables and
BIDS-style trees are handled as DataFrames.  Everything is a set operation over
all studies, files and tasks at once; there are no per-file driver loops.

Sub-packages
------------
functions   Column expressions for identifiers, text cleaning, level maps (C*)
operators   relational operators: responses, sidecars, participants, casting,
            dataset descriptions, trials, gather, quality checks
sources     readers: sheet tables, file discovery, BIDS tree scan, xlsx fleets
sinks       writers: partitioned tables, BIDS file layout, JSON sidecars
plans       end-to-end conversions and the registered driver queries
streaming   incremental ingest of arriving session sheets
"""

__version__ = "0.1.0"
