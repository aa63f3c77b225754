"""Operators of a training-data pipeline: dedup, PII, joins, scans, search, models, packing.

Nothing else in the library imports this subpackage.  Conventions shared by
the operators: the input's other columns are never read and never clash (each
operator first selects what it needs under names of its own); a null text is
an empty text; bulk text work runs in Arrow batches inside Spark tasks, in
slices of bounded size; whatever must be read twice is written as Parquet
under the shared folder of ``spark.checkpoint.dir``.
"""
