"""Operators of a training-data pipeline. Nothing outside this subpackage imports it.

Call :func:`featward.llm.workers.prepare` with the session first: functions that run in Python workers
are pickled by reference, so executors need this package.
"""
