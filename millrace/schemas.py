"""Schemas of the engine's tables in one place; unknown keys of a source go to one map column."""

from __future__ import annotations

DOCUMENTS = "pos bigint, content string, source string, doc_id string, metadata map<string,string>"
TRIPLES = "pos bigint, subject string, predicate string, object string, evidence_sentence string, source_chunk_id string, description string, confidence double"
ENTITIES = "id string, name string, type string, aliases array<string>, description string, confidence double, source string"
EDGES = "subject string, object string, predicates array<string>, source_texts array<string>, source_chunk_ids array<string>, description string, weight int"
MANIFEST = "dataset_name string, version string, license string, source string, language string, collection_date string"
ARCHIVE = "canonical_id string, version int, content string, content_hash string, parent_hash string, stored_at timestamp"
