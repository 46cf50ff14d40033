"""Incremental triggering of the monthly runner.

The original has no streaming input: a month is processed when an operator
calls the monthly procedure.  ``monthly_trigger`` re-expresses that call as a
Structured Streaming file source over the staged postings folder: each
micro-batch of newly arrived files yields the (few) months it touches and
runs the monthly runner for them; the stream's checkpoint records which
files were processed, so a restart never re-processes a file.
"""

from branchbook.streaming.trigger import monthly_trigger  # noqa: F401
