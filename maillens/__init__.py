"""maillens: message-archive and insider analytics as Spark jobs.

Layout
------
``sources``    scans, parsers and sinks (mail tree, message lines, CSVs,
               derived test tables)
``functions``  column expressions (mail header fields, text cleaning,
               deterministic hash splits)
``operators``  DataFrame operators (traffic counts, term statistics,
               features, model selection, batched linear fits, metrics,
               topics)
``plans``      end-to-end jobs and the registry of named queries
``streaming``  incremental form of the mail extraction stage
"""

__all__ = ["session"]
