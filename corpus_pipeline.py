"""The corpus pipeline: quality rules, near-duplicates, repeated passages,
secrets, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
kept; all but the last return the columns of ``documents``.  A later stage
reads the written rows of the stage before, so a lost executor repeats one
stage's tasks only; by then that stage's own steps are no longer needed, and
their folder goes (``_workspace``).
"""

from __future__ import annotations

import public_tokenizers

from branchbook.llm import minhash, packing, quality, secrets, substrings
from branchbook.llm.common import Workspace, table


_open: list[Workspace] = []


def _workspace(spark, name, docs):
    """A run folder for a stage.  Folders of earlier stages are removed, but for
    those that ``docs`` still reads (a result that was handed on unwritten)."""
    if _open:
        files = docs.inputFiles()
        for old in list(_open):
            if not any(old.name in f for f in files):
                old.close()
                _open.remove(old)
    _open.append(Workspace(spark, name))
    return _open[-1]


def quality_rules(spark, docs, sf_dir):
    """Drop the documents that the adaptive quality rules reject (operator 4)."""
    return quality.filter_documents(docs, _workspace(spark, "stage-quality", docs))


def near_dedup(spark, docs, sf_dir):
    """Keep one document of each group of near-duplicates (operator 2)."""
    return minhash.deduplicated(docs, _workspace(spark, "stage-near", docs))


def substring_dedup(spark, docs, sf_dir):
    """Remove the passages that an earlier document already has (operator 5)."""
    return substrings.deduplicated(docs, _workspace(spark, "stage-substring", docs))


def secret_scan(spark, docs, sf_dir):
    """Mask the secrets (operator 7)."""
    return secrets.masked(docs)


def pack(spark, docs, sf_dir):
    """Pack the token ids into sequences (operator 6)."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), _workspace(spark, "stage-pack", docs))


STAGES = [("quality", quality_rules), ("near_dedup", near_dedup), ("substring_dedup", substring_dedup),
          ("secrets", secret_scan), ("packing", pack)]

#: The packing and the similarity stage have no SQL form; the tests hold ``run``
#: against a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    ws = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = ws.write(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
