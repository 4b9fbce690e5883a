"""Corpus pipeline: quality, near duplicates, repeated passages, benchmark leaks, token ids.

The stages stand in ``hourcast.llm.pipeline``.
"""

from hourcast.llm.pipeline import STAGES, run  # noqa: F401

#: The stages of the classifier, the fingerprints and the token ids have no SQL form.
ORACLE_SQL = None
