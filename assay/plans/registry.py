"""Every query of the library, by name, with the SQL that gives the same rows."""

from __future__ import annotations

from assay.plans import corpus, dedupe, evidence, graph, knowledge, library, streams, text

QUERIES: dict = {**evidence.QUERIES, **dedupe.QUERIES, **graph.QUERIES, **library.QUERIES, **knowledge.QUERIES, **text.QUERIES, **streams.QUERIES, **corpus.QUERIES}
ORACLE_SQL: dict[str, str] = {**evidence.ORACLE_SQL, **dedupe.ORACLE_SQL, **graph.ORACLE_SQL, **library.ORACLE_SQL, **knowledge.ORACLE_SQL, **text.ORACLE_SQL, **streams.ORACLE_SQL, **corpus.ORACLE_SQL}
